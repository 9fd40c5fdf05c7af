"""Labelled rows to learn from: all of them, or a bounded sample that the ids alone fix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a model is fitted on at most.  They are the first by a hash of their id.
SAMPLE_ROWS = 12_000


def known_labels(labels: DataFrame, label: str, train=None, label_id: str = "doc_id") -> DataFrame:
    """``doc_id, label`` of the rows that satisfy ``train``; without null ids and labels, of several of one id the larger."""
    known = labels.select(F.col(label_id).alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null")
    if train is not None:
        known = known.where(train(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.max("label").alias("label"))


def with_texts(docs: DataFrame, known: DataFrame, id_col: str, text_col: str) -> DataFrame:
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.join(known, "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.length("text"))).alias("text"))


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, train=None, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id") -> DataFrame:
    """``doc_id, label, text`` of every document with a label that satisfies ``train``; odd rows as in ``labelled_sample``.

    Labels grow with the documents, so Spark decides by their size whether they are broadcast.
    """
    return with_texts(docs, known_labels(labels, label, train, label_id), id_col, text_col)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train=None, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id") -> DataFrame:
    """``doc_id, label, text`` of at most ``rows`` documents that satisfy ``train``.

    Rows with a null id or label are left out; of several labels of one id the larger counts, of several
    texts the one with the smallest hash.  A null text counts as empty; an empty table gives no rows.  The
    labels' side is at most ``rows`` pairs of numbers, so it is broadcast; copies of an id are reduced to one
    before they are shuffled.
    """
    known = known_labels(labels, label, train, label_id).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return with_texts(docs, F.broadcast(known), id_col, text_col)
