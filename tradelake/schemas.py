"""Declared schemas of the tables; ``!`` columns of the model are checked by null counts after reading."""

from __future__ import annotations

from .functions.text import LEVELS, MEASURES

_measures = ", ".join(f"{m} bigint" for m in MEASURES)
FACT = f"month string, country_code string, hs10 string, hs8 string, hs6 string, hs4 string, hs2 string, {_measures}, hs_revision string"
ANOMALY = f"reason string, month string, requested_country string, country_code_raw string, hs_code_raw string, hs_length bigint, name_ko string, {_measures}, source_manifest string, source_raw_path string, source_finished_at string"
EDITION = "reference_year smallint, hs_revision string, valid_from string, valid_to string, clip_sct_year string, clip_hstd_year string, hs10 string, hs8 string, hs6 string, hs4 string, hs2 string, name_ko string, name_en string, source string, source_url string"
PARTNER = "country_code string, country_name_ko string, country_name_en string, un_m49 string, iso_alpha3 string, un_match_status string, kcs_source_version string, kcs_source_row string"
ITEM = "year string, statCd string, hsCd string, statKor string, expDlr string, expWgt string, impDlr string, impWgt string, balPayments string"
MANIFEST = "country string, window_start string, window_end string, success boolean, status string, requested_at string, finished_at string"


def level_schema(level: int) -> str:
    """Of the roll-up to a level."""
    codes = ", ".join(f"hs{n} string" for n in LEVELS if n <= level)
    residual = ", ".join(f"residual_{m} bigint" for m in MEASURES)
    return f"month string, country_code string, {codes}, {_measures}, {residual}, source_row_count bigint, exception_row_count bigint, has_residual boolean"
