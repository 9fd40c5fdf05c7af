"""Files on the cluster's shared storage, through Hadoop's file systems."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def exists(spark: SparkSession, path: str) -> bool:
    fs, there = _fs(spark, path)
    return fs.exists(there)


def delete(spark: SparkSession, path: str) -> None:
    fs, there = _fs(spark, path)
    fs.delete(there, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, there = _fs(spark, old)
    if not fs.rename(there, _fs(spark, new)[1]):
        raise OSError(f"can't rename {old} to {new}")


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small file; it appears under its name when it is whole."""
    fs, there = _fs(spark, f"{path}.tmp")
    out = fs.create(there, True)
    out.write(data)
    out.close()
    if exists(spark, path):
        delete(spark, path)
    rename(spark, f"{path}.tmp", path)


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A small file's content."""
    fs, there = _fs(spark, path)
    stream = fs.open(there)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def join_files(spark: SparkSession, parts: list[str], target: str) -> None:
    """Files one after the other as one file: by the file system itself where it can, else copied as a stream."""
    if not parts:
        raise ValueError("no parts to join")
    fs, there = _fs(spark, target)
    jvm = spark.sparkContext._jvm
    rename(spark, parts[0], target)
    rest = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts) - 1)
    for i, p in enumerate(parts[1:]):
        rest[i] = jvm.org.apache.hadoop.fs.Path(p)
    try:
        if parts[1:]:
            fs.concat(there, rest)
        return
    except UnsupportedOperationException:
        pass
    out = fs.create(_fs(spark, f"{target}.tmp")[1], True)
    try:
        for p in [target, *parts[1:]]:
            stream = fs.open(jvm.org.apache.hadoop.fs.Path(p))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
            finally:
                stream.close()
    finally:
        out.close()
    for p in [target, *parts[1:]]:
        delete(spark, p)
    rename(spark, f"{target}.tmp", target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    write_bytes(spark, path, text.encode())


def copy(spark: SparkSession, source: str, target: str) -> None:
    """A file or folder to another place, possibly in another store."""
    fs, there = _fs(spark, source)
    if not fs.exists(there):
        raise FileNotFoundError(source)
    to_fs, to = _fs(spark, target)
    spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, there, to_fs, to, False, spark.sparkContext._jsc.hadoopConfiguration())


def files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files right below a folder."""
    fs, there = _fs(spark, path)
    return sorted((x.getPath().toString(), x.getLen()) for x in fs.listStatus(there) if x.isFile())


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a temporary folder on one machine and an error on a cluster."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not top:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        top = tempfile.mkdtemp(prefix="tradelake-")
        spark.conf.set("spark.checkpoint.dir", top)
    return top.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under ``shared_dir``, removed at the end."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def clean() -> None:
        try:
            delete(spark, path)
        except Exception:  # the JVM has ended
            pass

    atexit.register(clean)
    return path


def swap(spark: SparkSession, staging: str, target: str, overwrite: bool = True) -> None:
    """Put a finished folder in the place of another; the old one comes back if that fails."""
    if not overwrite and exists(spark, target):
        raise FileExistsError(target)
    backup = f"{target}.backup-{uuid.uuid4().hex}"
    had = exists(spark, target)
    if had:
        rename(spark, target, backup)
    try:
        rename(spark, staging, target)
    except Exception:
        if had:
            rename(spark, backup, target)
        raise
    if had:
        delete(spark, backup)


#: A dimension is broadcast up to this size by Spark's own estimate; larger ones are joined by sorting.
BROADCAST_BYTES = 64 << 20


def small_side(df: DataFrame) -> DataFrame:
    """A dimension, to be broadcast if the files that it's read from are small enough."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(size)) <= BROADCAST_BYTES else df


def by_sorting(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the input: joined by sorting, whatever Spark takes it for.

    Spark estimates a written table by its compressed files and the share of the columns that are read, so
    millions of rows pass for the few MB that may be broadcast, and the driver would gather them.
    """
    return df.hint("merge")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """A table of fewer splits than cores, dealt out by its keys before anything is computed from its rows.

    A file of one row group is one task's, however many cores there are; a table of many splits stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def written(df: DataFrame, name: str) -> DataFrame:
    """A table in the shared folder, read again: it is computed once, its size is known and lineage ends there."""
    path = f"{scratch(df.sparkSession, name)}/rows"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
