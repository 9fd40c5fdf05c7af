"""What became of a request: status, whether to split it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Result codes of the gateway, and the texts that say the same.
SUCCESS_CODE, QUOTA_CODES, RATE_CODES, AUTH_CODES = "00", ["22"], ["23"], ["20", "30", "31"]
QUOTA_TEXT, RATE_TEXT = "LIMITED_NUMBER_OF_SERVICE_REQUESTS_EXCEEDS", "LIMITED_NUMBER_OF_SERVICE_REQUESTS_PER_SECOND_EXCEEDS"
#: HTTP statuses after which a smaller request may work, and those whose body says what is wrong.
SPLITTABLE_HTTP, TELLING_HTTP = [408, 413, 500, 502, 503, 504], [400, 401, 403, 404, 405, 409, 422, 429]


def outcome_status(http: Column, code: Column, message: Column, parsed: Column, raised: Column) -> Column:
    """The status of a finished request.

    ``raised``: no whole body came.  Then a status that neither a smaller request nor a body would explain is an
    HTTP error, everything else (no connection, a broken read) one of transport.  With a body the first that
    holds of success, quota, rate limit, authentication and damaged XML counts; else the service said no.
    """
    said, raised = F.upper(F.coalesce(message, F.lit(""))), F.coalesce(raised, F.lit(False))
    parsed = F.coalesce(parsed, F.lit(True))
    return (
        F.when(raised & (http >= 400) & ~http.isin(SPLITTABLE_HTTP) & ~http.isin(TELLING_HTTP), "http_error")
        .when(raised, "transport_error")
        .when(http.between(200, 299) & (code == SUCCESS_CODE) & parsed, "success")
        .when(code.isin(QUOTA_CODES) | F.contains(said, F.lit(QUOTA_TEXT)), "quota_exceeded")
        .when(code.isin(RATE_CODES) | F.contains(said, F.lit(RATE_TEXT)) | (http == 429), "rate_limited")
        .when(code.isin(AUTH_CODES) | http.isin(401, 403), "auth_error")
        .when(~parsed, "parse_error")
        .otherwise("api_error")
    )


#: Why a run stopped.
QUOTA, AUTH, RATE, INTERRUPTED = "daily_quota_exceeded", "authentication_or_permission_failure", "rate_limit_retries_exhausted", "interrupted"


def limit_of(http: int | None, code: str | None, message: str | None, parsed: bool | None, raised: bool | None) -> str | None:
    """The limit that an answer tells a task of, in the order of ``outcome_status``; a task asks before its next request."""
    said = (message or "").upper()
    if raised or (http is not None and 200 <= http < 300 and code == SUCCESS_CODE and parsed is not False):
        return None
    if code in QUOTA_CODES or QUOTA_TEXT in said:
        return QUOTA
    if code in RATE_CODES or RATE_TEXT in said or http == 429:
        return RATE
    return AUTH if code in AUTH_CODES or http in (401, 403) else None


def should_split(status: Column, http: Column, months: Column) -> Column:
    """Only a transport failure is worth smaller requests, and only of a window of several months."""
    return (months > 1) & (status == "transport_error") & (http.isNull() | http.isin(SPLITTABLE_HTTP))
