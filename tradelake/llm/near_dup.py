"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

Sketch: a set is thrown into ``t`` bins in rounds.  In each of the first ``t`` rounds every element lands
in a hashed bin with a hashed value; in round ``t + b`` every element lands in bin ``b``, so each bin fills
in the end.  A bin keeps the value of the first round that reached it, the smallest on a tie.  Two sets
agree in a bin with the probability of their Jaccard similarity, and the bins' dependence keeps the share
of agreeing bins as concentrated as independent hashes would.  A set of n elements needs about
``t log t / n`` rounds, against ``t`` for plain MinHash.

Banding: ``bands`` bands of ``rows`` bins.  Two sets of similarity s share a bucket with probability
``1 - (1 - s^rows)^bands``: 1 - 5e-8 at 0.8 with 32 bands of 4.

Verification is exact on whole sets, and complete within buckets without listing a bucket's pairs:

1. Copies of one set are one class, named by its smallest id.
2. In each bucket all are compared with the bucket's centre, the member whose buckets are fullest (for
   edited copies of one text that is a copy near the original).  Most links show up here, as many
   comparisons as members.
3. A bucket that now lies in one component is done.  In the others, pairs from different components are
   compared unless the counts known by then exclude a link.  With x, y members shared with the centre and
   f, g further members that any other candidate has at all, two sets share min(x, y) + min(f, g) at most.

Edits that no other copy has are thus never paired, so a large group of copies with edits of their own
costs about as many comparisons as it has members, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, worker_clear
from .components import connected_components
from .shingles import WordHashes, chain, mix, shingle_set

#: Parts that the copies of one text are dealt to when they learn their component.
SALTS = 16


def fast_sketch(x: np.ndarray, bins: int) -> np.ndarray:
    """The sketch of a non-empty set of fingerprints: ``bins`` numbers."""
    out = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    done, n = 0, len(x)
    while done < bins:
        rounds = min(bins - done, 1 + int(1.2 * bins * np.log(bins + 1) / n))
        at = np.arange(done, done + rounds, dtype=np.uint64)
        h = mix(x[None, :] ^ mix(at + np.uint64(1))[:, None])
        place = (((h >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64).ravel()
        key = (at[:, None] << np.uint64(32) | h & np.uint64(0xFFFFFFFF)).ravel()
        order = np.argsort(key)[::-1]
        found = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
        found[place[order]] = key[order]  # of several, the last and so the smallest stays
        out = np.minimum(out, found)
        done += rounds
        if out.max() != np.iinfo(np.uint64).max:
            return out
    for b in np.flatnonzero(out == np.iinfo(np.uint64).max):
        h = mix(x ^ mix(np.array([bins + int(b) + 1], np.uint64)))
        out[b] = np.uint64(bins + int(b)) << np.uint64(32) | (h & np.uint64(0xFFFFFFFF)).min()
    return out


def band_keys(sketch: np.ndarray, bands: int) -> np.ndarray:
    parts = sketch.reshape(bands, -1)
    return chain([np.arange(bands, dtype=np.uint64), *(parts[:, i] for i in range(parts.shape[1]))])


def sketches(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, n_shingles, set_key, bands``; an empty set has no key and no bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_clear()
        known = WordHashes()
        for batch in batches:
            n, keys, lists = [], [], []
            for text in batch.column(1):
                x = shingle_set(text.as_py(), shingle, known)
                n.append(len(x))
                keys.append(xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None)
                lists.append(band_keys(fast_sketch(x, bands * rows), bands).view(np.int64) if len(x) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(lists, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "set_key", "bands"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, bands array<long>")


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """``id, items``: whole shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_clear()
        known = WordHashes()
        for batch in batches:
            sets = [shingle_set(text.as_py(), shingle, known).view(np.int64) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "items"])

    return docs.mapInArrow(run, "id long, items array<long>")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 32, rows: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Documents are linked if 100 * |intersection| >= ``percent`` * |union| of their shingle sets;
    ``component_id`` is the smallest id that links reach, ``kept`` whether it is the row's own.  A text
    without words, or null, has an empty set and is linked with nothing.  Rows with a null id take no part:
    their component is null and they are kept.  Repeated rows are one document listed twice and share a
    fate.  Other columns are not read.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "near-dup")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    own = work.table("sketches", sketches(docs, shingle, bands, rows))

    real = own.where("n_shingles > 0 and doc_id is not null")
    classes = work.table("classes", real.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.min_by("bands", "doc_id").alias("bands"), F.count("*").alias("copies")))
    firsts = classes.select("id", F.explode("bands").alias("bucket"))
    shared = firsts.groupBy("bucket").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n")).where("first < last")
    members = work.table("members", firsts.join(shared, "bucket").select("bucket", "id", "n").distinct())
    weights = work.table("weights", members.groupBy("id").agg(F.sum("n").alias("weight")))
    sets = work.table("sets", shingle_sets(docs.join(weights, F.col("doc_id") == F.col("id"), "left_semi").dropDuplicates(["doc_id"]), shingle))
    weighed = members.join(weights, "id").select("bucket", "id", "weight")
    centres = weighed.groupBy("bucket").agg(F.max_by("id", F.struct(F.col("weight"), -F.col("id"))).alias("centre"))
    members = work.table("centred", weighed.join(centres, "bucket").select("bucket", "id", "centre"))
    work.drop("members", "weights")

    compared = work.table("compared", scored(members.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct(), sets))
    components = connected_components(compared.where(linked(percent)).select("a", "b"), work, "components")
    labelled = members.join(components, "id", "left").withColumn("component", F.coalesce("component", "id"))
    undone = labelled.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).where("lo < hi and n > 2").select("bucket")
    rest = work.table("rest", labelled.join(undone, "bucket", "left_semi"))
    items = sets.join(rest.select("id").distinct(), "id", "left_semi").select("id", F.explode("items").alias("item"))
    only = items.groupBy("item").agg(F.min("id").alias("id"), F.count("*").alias("n")).where("n = 1").groupBy("id").agg(F.count("*").alias("own"))
    known = compared.select(F.col("a").alias("centre"), F.col("b").alias("id"), F.col("n_b").alias("size"), F.col("both").alias("x"))
    places = rest.groupBy("id").agg(F.collect_set("bucket").alias("buckets"))  # ``bands`` at most
    facts = rest.join(known, ["centre", "id"]).join(only, "id", "left").join(places, "id").select("bucket", "id", "component", "buckets", "size", "x", F.greatest(F.col("size") - F.col("x") - F.coalesce("own", F.lit(0)), F.lit(0)).alias("f"))
    left = facts.select("bucket", *[F.col(c).alias(f"a_{c}") for c in facts.columns[1:]])
    right = facts.select("bucket", *[F.col(c).alias(f"b_{c}") for c in facts.columns[1:]])
    most = F.least("a_x", "b_x") + F.least("a_f", "b_f")
    possible = most * 100 >= (F.col("a_size") + F.col("b_size") - most) * percent
    first = left["bucket"] == F.array_min(F.array_intersect("a_buckets", "b_buckets"))  # a pair counts in one bucket only
    pairs = left.join(right, (left["bucket"] == right["bucket"]) & (F.col("a_id") < F.col("b_id")) & (F.col("a_component") != F.col("b_component")) & possible & first)
    pairs = pairs.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct()
    late = work.table("late", scored(pairs, sets).where(linked(percent)).select("a", "b"))
    # links found late join whole components
    name = lambda c: components.select(F.col("id").alias(c), F.col("component").alias(f"{c}_component"))
    bridges = late.join(name("a"), "a", "left").join(name("b"), "b", "left").select(F.coalesce("a_component", "a").alias("a"), F.coalesce("b_component", "b").alias("b")).where("a <> b").distinct()
    joined = connected_components(bridges, work, "joined").select(F.col("id").alias("component_id"), F.col("component").alias("lowest"))
    work.drop("sets", "centred", "compared", "rest", "late")

    # a class of one document that is linked with nothing needs no lookup; the others' rows are salted, as one may have a third of all
    named = classes.join(components, "id", "left").select("set_key", "id", "copies", F.coalesce("component", "id").alias("component_id"))
    named = named.join(joined, "component_id", "left").select("set_key", "id", "copies", F.coalesce("lowest", "component_id").alias("component_id")).where("copies > 1 or component_id <> id")
    named = named.select("set_key", "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    out = own.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    out = out.join(named, ["set_key", "salt"], "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def scored(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with their sets' sizes and the size of the intersection."""
    a = sets.select(F.col("id").alias("a"), F.col("items").alias("a_items"))
    b = sets.select(F.col("id").alias("b"), F.col("items").alias("b_items"))
    joined = pairs.join(a, "a").join(b, "b")
    return joined.select("a", "b", F.size("a_items").alias("n_a"), F.size("b_items").alias("n_b"), F.size(F.array_intersect("a_items", "b_items")).alias("both"))


def linked(percent: int):
    return F.col("both") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("both")) * percent


def deduplicate(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Keep the document of the smallest id of each group, with all columns, whatever their names.

    Rows without words and rows with a null id stay; repeated rows of a kept id all stay; an empty table stays empty.
    """
    gone = near_duplicates(docs, shingle, percent, id_col=id_col, text_col=text_col).where("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")
