"""Sheets of XLSX workbooks: a zip of XML, read with the standard library over ``binaryFile``."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def local(tag: str) -> str:
    return tag.rpartition("}")[2]


def children(node, name: str):
    return [x for x in node.iter() if local(x.tag) == name]


def text_of(node) -> str:
    return "".join(x.text or "" for x in children(node, "t"))


def sheet_rows(data: bytes, sheet: str | None = None) -> list[list[str]]:
    """Cell texts by row of a sheet (the first one, unless a name is given); gaps are empty."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        read = lambda name: ElementTree.fromstring(z.read(name))
        shared = [text_of(x) for x in children(read("xl/sharedStrings.xml"), "si")] if "xl/sharedStrings.xml" in z.namelist() else []
        targets = {x.get("Id"): x.get("Target") for x in children(read("xl/_rels/workbook.xml.rels"), "Relationship")}
        sheets = children(read("xl/workbook.xml"), "sheet")
        chosen = next((x for x in sheets if sheet is None or x.get("name") == sheet), None)
        if chosen is None:
            raise ValueError(f"no sheet {sheet!r}")
        target = targets[next(v for k, v in chosen.attrib.items() if local(k) == "id")]
        out = []
        for row in children(read(target.lstrip("/") if target.startswith("/") else f"xl/{target}"), "row"):
            cells: dict[int, str] = {}
            for c in children(row, "c"):
                at = 0
                for letter in re.match("[A-Z]*", c.get("r", ""))[0]:
                    at = at * 26 + ord(letter) - 64
                at = at or len(cells) + 1
                value = next((x.text or "" for x in children(c, "v")), "")
                cells[at] = shared[int(value)] if c.get("t") == "s" else text_of(c) if c.get("t") == "inlineStr" else value
            out.append([cells.get(i, "").strip() for i in range(1, max(cells, default=0) + 1)])
        return out


def read_workbook(spark: SparkSession, path: str, columns: list[str], sheet: str | None = None, header: bool = True) -> DataFrame:
    """Rows of the workbooks at ``path`` as text columns, with their row number."""
    return workbook_rows(spark.read.format("binaryFile").load(path), columns, sheet, header)


def workbook_rows(files: DataFrame, columns: list[str], sheet: str | None = None, header: bool = True) -> DataFrame:
    """Rows of the workbooks in ``content``, each parsed by one task."""
    schema = "row_number long, " + ", ".join(f"{c} string" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = [(i, *(r + [""] * len(columns))[: len(columns)]) for i, r in enumerate(sheet_rows(content.as_py(), sheet), 1) if any(r)][int(header) :]
                kinds = [pa.int64(), *[pa.string()] * len(columns)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["row_number", *columns])

    return files.select("content").mapInArrow(run, schema)
