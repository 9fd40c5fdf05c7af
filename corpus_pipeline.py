"""A corpus pipeline of five stages, each over all that the one before kept.

toxicity -> quality -> near-duplicates -> benchmark leaks -> byte-level BPE.  The first four return rows of
``documents`` with its columns, whatever these are called; the last returns a row of digests for each document.

In every stage a null text counts as empty, a text of any length is read whole, rows with a null id are judged
as others are (but have no near-duplicates), repeated rows share a fate, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradelake.llm import byte_bpe, decontaminate, near_dup, quality, toxicity
from tradelake.llm.common import Workspace
from tradelake.llm.queries import table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject; it learns from the labelled ones among them.

    Without labels, or with clean ones only, nothing is rejected; a text without words has the score of the bias.
    """
    return toxicity.drop_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking doesn't reject; it learns from the labelled ones among them.

    Without labels, or with good ones only, nothing is rejected; empty texts are ranked by their form like all.
    """
    return quality.drop_poor(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by 0.8 of their five-word shingles.

    Texts without words and rows with a null id stay, and so do repeated rows of a kept id.
    """
    return near_dup.deduplicate(docs, shingle=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found; items without words or with a null id are found nowhere."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's number of tokens and digests of its ids and of the bytes they decode to; an empty text has none."""
    import public_tokenizers

    return byte_bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", toxicity_stage), ("quality", quality_stage), ("near_duplicates", near_dup_stage), ("decontamination", decontamination_stage), ("byte_bpe", encoding_stage)]

#: Models, edit distances and encodings have no SQL; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    work, docs = Workspace(spark, "pipeline"), table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir) if i == len(STAGES) - 1 else work.table(name, stage(spark, docs, sf_dir))
        if i > 1:
            work.drop(STAGES[i - 2][0])
    return docs
