"""HTML forms and tables of code lists.  HTML has no reader in Spark, so pages are parsed in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import level_of

#: Names of the service's form fields, table and cells.
YEAR_FIELD, CHAPTER_FIELD, CODE_FIELD, SCT_FIELD, HSTD_FIELD = "aplyYy", "hstdCd", "hsSgn_Mn", "sctYear", "hstdYear"
BODY_ID, NAME_CLASS = "tblLstBody", "hlzoneWrd"
FULL_CODE, CHAPTER = re.compile(r"[0-9]{10}"), re.compile(r"[0-9]{2}")


class Node:
    """A row or cell: its attributes, the inputs in it, its texts and, of a row, its cells."""

    def __init__(self, attributes: dict[str, str]):
        self.attributes, self.inputs, self.texts, self.cells = attributes, [], [], []

    def text(self) -> str | None:
        """Its non-blank texts joined by spaces, or nothing."""
        return " ".join(t for t in (x.strip() for x in self.texts) if t) or None

    def has_class(self, name: str) -> bool:
        return name in self.attributes.get("class", "").split()


class PageParser(HTMLParser):
    """Collects inputs in order, and tables as rows of cells."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inputs: list[tuple[str, str]] = []
        self.tables: list[tuple[str, list[Node]]] = []
        self._open: list[int] = []
        self._cell: Node | None = None

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "input":
            field = (a.get("name", ""), a.get("value", "").strip())
            self.inputs.append(field)
            for i in self._open:
                if self.tables[i][1]:
                    self.tables[i][1][-1].inputs.append(field)
        elif tag in ("table", "tbody"):
            self._open.append(len(self.tables))
            self.tables.append((a.get("id", ""), []))
        elif tag == "tr":
            row = Node(a)
            for i in self._open:
                self.tables[i][1].append(row)
            self._cell = None
        elif tag in ("td", "th") and self._open and self.tables[self._open[-1]][1]:
            self._cell = Node(a)
            self.tables[self._open[-1]][1][-1].cells.append(self._cell)

    def handle_data(self, data):
        if self._cell is not None:
            self._cell.texts.append(data)

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr"):
            self._cell = None
        elif tag in ("table", "tbody") and self._open:
            self._open.pop()


def parsed(page: str | None) -> PageParser:
    p = PageParser()
    p.feed(page or "")
    p.close()
    return p


def hidden_value(page: PageParser, name: str) -> str | None:
    """The value of the first input of a name; a blank one is none."""
    return next((v for n, v in page.inputs if n == name), "") or None


def year_index(page: str, year: int) -> dict:
    """A year's form: the two year values that later requests repeat, and its two-digit chapters in order.

    A form that echoes another year, or has no chapters, is an error.
    """
    p = parsed(page)
    echoed = hidden_value(p, YEAR_FIELD)
    if echoed is not None and echoed != str(year):
        raise ValueError(f"asked for {year}, got {echoed}")
    chapters = sorted({v for n, v in p.inputs if n == CHAPTER_FIELD and CHAPTER.fullmatch(v)})
    if not chapters:
        raise ValueError(f"no chapters for {year}")
    return {"year": year, "clip_sct_year": hidden_value(p, SCT_FIELD), "clip_hstd_year": hidden_value(p, HSTD_FIELD), "chapters": chapters}


def chapter_rows(page: str, chapter: str) -> list[tuple[int, str, str | None, str | None]]:
    """(ordinal, code, Korean label, English label) of a chapter's table, in document order, copies included.

    Only rows with a ten-digit code count; one of another chapter is an error.
    """
    out = []
    for table, rows in parsed(page).tables:
        if table != BODY_ID:
            continue
        for row in rows:
            code = next((v for n, v in row.inputs if n == CODE_FIELD), "")
            if not FULL_CODE.fullmatch(code):
                continue
            if not code.startswith(chapter):
                raise ValueError(f"code {code} stands on a page of chapter {chapter}")
            names = [c.text() for c in row.cells if c.has_class(NAME_CLASS)]
            out.append((len(out), code, *(names + [None, None])[:2]))
    return out


def alpha2_table(page: str, columns: tuple[str, ...] = ("Country or Area", "M49 Code", "ISO-alpha2 Code", "ISO-alpha3 Code")) -> list[tuple[str, ...]]:
    """Rows of the table whose head has these columns; short rows and blank two-letter codes are skipped."""
    squeezed = lambda cell: " ".join((cell.text() or "").split())
    for _, rows in parsed(page).tables:
        texts = [[squeezed(c) for c in r.cells] for r in rows]
        if texts and all(c in texts[0] for c in columns):
            at = [texts[0].index(c) for c in columns]
            return [tuple(r[i] for i in at) for r in texts[1:] if len(r) > max(at) and r[at[2]]]
    raise ValueError("the table with the expected head isn't there")


def chapter_table(pages: DataFrame) -> DataFrame:
    """Rows of chapter pages (reference_year, chapter, html), in document order by ``ordinal``, copies included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["reference_year"], r["chapter"], *x) for r in batch.to_pylist() for x in chapter_rows(r["html"], r["chapter"])]
            if rows:
                kinds = [pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["reference_year", "chapter", "ordinal", "hs10", "name_ko", "name_en"])

    return pages.select(F.col("reference_year").cast("int"), "chapter", "html").mapInArrow(run, "reference_year int, chapter string, ordinal long, hs10 string, name_ko string, name_en string")


def index_table(pages: DataFrame) -> DataFrame:
    """(reference_year, clip_sct_year, clip_hstd_year, chapter) of index pages (reference_year, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                index = year_index(r["html"], r["reference_year"])
                rows += [(index["year"], index["clip_sct_year"], index["clip_hstd_year"], c) for c in index["chapters"]]
            if rows:
                kinds = [pa.int32(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["reference_year", "clip_sct_year", "clip_hstd_year", "chapter"])

    return pages.select(F.col("reference_year").cast("int"), "html").mapInArrow(run, "reference_year int, clip_sct_year string, clip_hstd_year string, chapter string")


def edition_rows(chapters: DataFrame, index: DataFrame, source: str, url: str) -> DataFrame:
    """Labelled codes as rows of the annual reference: revision, validity, coarser codes, provenance."""
    year = F.col("reference_year").cast("string")
    years = index.select("reference_year", "clip_sct_year", "clip_hstd_year").distinct()
    rows = chapters.join(F.broadcast(years), "reference_year", "left")  # a row a year
    codes = {f"hs{n}": level_of(F.col("hs10"), n) for n in (8, 6, 4, 2)}
    rows = rows.withColumns({"hs_revision": F.concat(F.lit("HSK-"), year), "valid_from": F.concat(year, F.lit("-01-01")), "valid_to": F.concat(year, F.lit("-12-31")), "source": F.lit(source), "source_url": F.lit(url)} | codes)
    return rows.select(F.col("reference_year").cast("smallint"), "hs_revision", "valid_from", "valid_to", "clip_sct_year", "clip_hstd_year", "hs10", *codes, "name_ko", "name_en", "source", "source_url")
