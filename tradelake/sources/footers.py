"""What Parquet footers tell of a table: rows, columns and bounds, without a scan.

A footer is a few kilobytes at a file's end; the driver reads them through Hadoop's file systems, some at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession

#: Footers that are read at once.
AT_ONCE = 16


@dataclass(frozen=True)
class Footer:
    path: str
    bytes: int
    rows: int
    columns: tuple[str, ...]
    low: str | None
    high: str | None


def parquet_files(spark: SparkSession, path: str) -> Iterator[tuple[str, int]]:
    """(path, bytes) of the data files below a folder."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.listFiles(there, True)
    while found.hasNext():
        x = found.next()
        if x.getPath().getName().endswith(".parquet"):
            yield x.getPath().toString(), x.getLen()


def footers(spark: SparkSession, path: str, bounds: str = "month") -> list[Footer]:
    """The footers of a table's files in order of name; ``low`` and ``high`` are a text column's, null where a part states none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def read(file: tuple[str, int]) -> Footer:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file[0]), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            meta = reader.getFooter()
            columns = tuple(str(f.toString()) for f in meta.getFileMetaData().getSchema().getFields())
            rows, lows, highs = 0, [], []
            for block in meta.getBlocks():
                rows += block.getRowCount()
                for chunk in block.getColumns():
                    if chunk.getPath().toDotString() == bounds:
                        told = chunk.getStatistics()
                        known = told is not None and told.hasNonNullValue()
                        lows.append(told.minAsString() if known else None)
                        highs.append(told.maxAsString() if known else None)
            known = lows and None not in lows
            return Footer(*file, rows, columns, min(lows) if known else None, max(highs) if known else None)
        finally:
            reader.close()

    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(read, sorted(parquet_files(spark, path))))


@dataclass(frozen=True)
class TableFigures:
    files: int
    bytes: int
    rows: int
    columns: tuple[str, ...]
    low: str | None
    high: str | None


def table_figures(spark: SparkSession, path: str, bounds: str = "month") -> TableFigures:
    """A table's figures by its footers; no file, or files of different columns, are an error."""
    found = footers(spark, path, bounds)
    if not found:
        raise ValueError(f"no files below {path}")
    full = [f for f in found if f.rows]
    other = [f.path for f in found if f.columns != found[0].columns]
    if other:
        raise ValueError(f"schema mismatch: {other[0]} differs from {found[0].path}")
    told = full and all(f.low is not None for f in full)
    return TableFigures(len(found), sum(f.bytes for f in found), sum(f.rows for f in found), found[0].columns, min(f.low for f in full) if told else None, max(f.high for f in full) if told else None)
