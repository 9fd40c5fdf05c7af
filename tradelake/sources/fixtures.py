"""Response files and workbooks made from the driver's tables, to read them back."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import storage


#: Items of one response file at most.
FILE_ITEMS = 5_000


def xml_responses(spark: SparkSession, raw: DataFrame, file_items: int = FILE_ITEMS, prefix: str = "", damaged=None) -> str:
    """Write raw rows as gzipped responses, each of one source and of at most ``file_items`` items; returns the folder.

    ``prefix`` is a name space's that all tags get; files of sources where ``damaged`` holds end in the middle.
    An item is a line, so no page is held whole.
    """
    path = storage.scratch(spark, "responses")
    field = lambda tag, c: F.concat(F.lit(f"<{prefix}{tag}>"), F.coalesce(c, F.lit("")), F.lit(f"</{prefix}{tag}>"))
    item = F.concat(
        F.lit(f"<{prefix}item>"), field("year", F.concat(F.substring("month", 1, 4), F.lit("."), F.substring("month", 5, 2))), field("statCd", F.col("country_code_raw")), field("hsCd", F.col("hs_code_raw")), field("statKor", F.col("name_ko")),
        field("expDlr", F.col("exp_dlr")), field("expWgt", F.col("exp_wgt")), field("impDlr", F.col("imp_dlr")), field("impWgt", F.col("imp_wgt")), field("balPayments", F.col("bal_payments")), F.lit(f"</{prefix}item>"),
    )
    space = f' xmlns:{prefix[:-1]}="urn:example:trade"' if prefix else ""
    tagged = lambda text: text.replace("</", "\0").replace("<", f"<{prefix}").replace("\0", f"</{prefix}")
    total = tagged("<item><year>total</year><statCd>-</statCd><hsCd>-</hsCd><statKor>-</statKor></item>")
    head = tagged("<response><header><resultCode>00</resultCode><resultMsg>ok</resultMsg></header><body><items>").replace("response>", f"response{space}>", 1)
    tail = tagged("</items></body></response>")
    own = Window.partitionBy("source")
    raw = raw.withColumn("source", F.coalesce("source", F.lit("")))
    rows = raw.select("source", "ordinal", item.alias("x"), F.row_number().over(own.orderBy("ordinal")).alias("nth"), F.count("*").over(own).alias("n"))
    at = (F.col("nth") - 1) % file_items + 1
    size = F.least(F.lit(file_items), F.col("n") - F.col("nth") + at)
    line = F.concat(F.when(at == 1, F.lit(head + total)).otherwise(""), "x", F.when(at == size, F.lit(tail)).otherwise(""))
    if damaged is not None:
        last = F.ceil(size * 0.6)
        opened = F.concat(F.when(at == 1, F.lit(head + total)).otherwise(""), F.expr("substring(x, 1, cast(length(x) * 0.6 as int))"))
        line = F.when(~damaged | (at < last), line).when(at == last, opened).otherwise("")
    # the window has sorted the rows already; a task has whole sources, so a file's lines are neighbours in order
    pages = rows.select("source", "ordinal", line.alias("value")).sortWithinPartitions("source", "ordinal").drop("ordinal")
    pages.write.partitionBy("source").option("compression", "gzip").option("maxRecordsPerFile", file_items).text(path)
    return path


def workbook_bytes(rows: list[list[str]], sheet: str = "codes") -> bytes:
    strings = sorted({c for r in rows for c in r})
    at = {s: i for i, s in enumerate(strings)}
    cell = lambda i, j, c: f'<c r="{chr(65 + j)}{i}" t="s"><v>{at[c]}</v></c>'
    body = "".join(f'<row r="{i}">' + "".join(cell(i, j, c) for j, c in enumerate(r)) + "</row>" for i, r in enumerate(rows, 1))
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{escape(s)}</t></si>" for s in strings) + "</sst>")
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="{sheet}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


#: Rows of one workbook at most.
BOOK_ROWS = 400


def part_workbooks(parts: DataFrame) -> DataFrame:
    """``content``: workbooks of the parts (code, name, size), each of ``BOOK_ROWS`` neighbouring keys, made by tasks."""

    def book(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values("p_partkey")
        cells = [["code", "name", "size"], *([str(k), n, str(z)] for k, n, z in zip(rows["p_partkey"], rows["p_name"], rows["p_size"]))]
        return pd.DataFrame({"content": [workbook_bytes(cells)]})

    return parts.select("p_partkey", "p_name", "p_size").groupBy(F.floor(F.col("p_partkey") / BOOK_ROWS).alias("book")).applyInPandas(book, "content binary")
