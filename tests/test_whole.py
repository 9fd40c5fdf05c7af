"""Queries that must cover all rows, whatever their size."""

from pyspark.sql import functions as F
from test_oracles import SF

from tradelake import bindings, catalog


def test_a_source_fills_several_files(spark):
    from tradelake.sources.fixtures import xml_responses
    from tradelake.sources.responses import inspect_responses, read_items

    raw = bindings.raw_rows(spark, SF).where("source in ('src1', 'src2')")
    files = inspect_responses(read_items(spark, xml_responses(spark, raw, file_items=5))).collect()
    sizes = [r["count"] for r in raw.groupBy("source").count().collect()]
    assert len(files) == sum(-(-n // 5) for n in sizes) > 2 and max(r["items"] for r in files) == 6 and sum(r["items"] for r in files) == sum(sizes) + len(files)


def test_all_copies_are_folded(spark):
    copies = {}
    for r in catalog.label_rows(spark, SF).orderBy("ordinal").collect():
        copies.setdefault(r["hs10"], []).append((r["name_ko"], r["name_en"]))

    def fits(a, b):
        a, b = a.strip(), b.strip()
        return a.startswith(b) or b.startswith(a)

    score = lambda x: (bool(x[0]) + bool(x[1]), len(x[0]) + len(x[1]), len(x[0]))
    want = {}
    for code, rows in copies.items():
        kept, conflicts = rows[0], 0
        for new in rows[1:]:
            if not (fits(kept[0], new[0]) and fits(kept[1], new[1])):
                conflicts += 1
            elif score(new) > score(kept):
                kept = new
        want[code] = (len(rows), *kept, conflicts)
    got = {r["hs10"]: (r["copies"], r["name_ko"], r["name_en"], r["conflicts"]) for r in catalog.duplicate_label_fold(spark, SF).collect()}
    assert got == want and max(x[0] for x in want.values()) > 2


def test_the_latest_month_is_the_last_one(spark):
    last = bindings.trade_facts(spark, SF).agg(F.max("month")).first()[0]
    for name in ("top_partners_latest", "products_hs4_latest"):
        assert {r["month"] for r in catalog.queries()[name](spark, SF).collect()} == {last}
