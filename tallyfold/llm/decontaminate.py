"""Benchmark decontamination by size-partitioned MinHash containment, native expressions only.

The shingle that has the least value of a hash function is a random shingle of its item, so a document that
contains the share c of an item's shingles holds that shingle with probability c, however long the document is.
(Plain MinHash banding would compare an item with a document hundreds of times its size.) Items are partitioned by
their number of shingles in powers of two. Each partition has its own number of hash functions, and a document is a
candidate for an item if it holds as many distinct minima as the partition asks. Candidates are then checked by exact
containment: distinct shingles of the item that the whole document has, against the threshold.

Words: runs other than space and 0x09-0x0D, lower case. Shingles: five words; a shorter text is one shingle.

Defined cases: null and empty texts, of items or documents, match nothing; equal items are listed each; rows with
equal doc_id are taken as one document whose shingles are the union; rows with a null doc_id match nothing and are
kept; an empty benchmark leaves the documents as they are. Other columns are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.store import BROADCAST_ROWS, settle, small

SHINGLE = 5
#: Shingles of the smaller partitions, whose minima are all their shingles; then hash functions of larger ones.
SMALL_ITEM, MINIMA = 16, 24


def shingles(text: Column) -> Column:
    """64-bit hashes of all shingles in order, repeats included; an empty array for null or no words.

    The words are bound to a lambda's variable, so that they are split once and not again for every place.
    """
    words = F.filter(F.split(F.lower(text.cast("string")), "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")
    return F.coalesce(F.transform(F.array(words), _hashed)[0], F.array().cast("array<long>"))


def _hashed(words: Column) -> Column:
    places = F.sequence(F.lit(0), F.size(words) - SHINGLE)
    each = F.transform(places, lambda i: F.xxhash64(*[words[i + j] for j in range(SHINGLE)]))
    short = F.array(F.xxhash64(F.lit("short"), F.array_join(words, " ")))
    return F.when(F.size(words) >= SHINGLE, each).when(F.size(words) > 0, short)


def item_minima(items: DataFrame) -> DataFrame:
    """item_id, shingle, wanted: the distinct minima of each item under its partition's hash functions.

    ``items`` has item_id and shingles (distinct). A document with 0.75 of the shingles holds none of 24 minima with
    probability 4 ** -24; the small partition needs one of all its shingles and is exact.
    """
    each = items.select("item_id", F.size("shingles").alias("q"), F.explode("shingles").alias("shingle"))
    whole = each.where(f"q <= {SMALL_ITEM}").select("item_id", "shingle")
    functions = each.where(f"q > {SMALL_ITEM}").withColumn("f", F.explode(F.sequence(F.lit(1), F.lit(MINIMA))))
    least = functions.groupBy("item_id", "f").agg(F.min_by("shingle", F.xxhash64("f", "shingle")).alias("shingle"))
    return whole.unionByName(least.select("item_id", "shingle")).distinct()


def contained(docs: DataFrame, benchmark: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, item_id, n_shared, n_item: documents that hold ``percent`` of an item's distinct shingles or more."""
    items = settle(benchmark.select("item_id", F.array_distinct(shingles(F.col("text"))).alias("shingles")).where(
        F.size("shingles") > 0))
    minima = settle(item_minima(items))
    texts = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    # whole texts are exploded to hashes, and the minima decide which of them go on
    seen = texts.select("doc_id", F.explode(shingles(F.col("text"))).alias("shingle"))
    hits = seen.join(small(minima), "shingle").select("doc_id", "item_id").distinct()
    candidates = settle(hits)
    ids = settle(candidates.select("doc_id").distinct())
    found = texts.join(small(ids), "doc_id", "left_semi").select("doc_id", F.explode(shingles(F.col("text"))).alias("shingle"))
    known = items.select("item_id", F.size("shingles").alias("n_item"), F.explode("shingles").alias("shingle"))
    shared = found.join(small(settle(known)), "shingle").join(candidates, ["doc_id", "item_id"], "left_semi")
    counts = shared.groupBy("doc_id", "item_id", "n_item").agg(F.countDistinct("shingle").alias("n_shared"))
    return counts.where(F.col("n_shared") * 100 >= F.col("n_item") * percent).select("doc_id", "item_id", "n_shared", "n_item")


def decontaminate(docs: DataFrame, benchmark: DataFrame, percent: int = 75) -> DataFrame:
    """``docs`` without those that contain an item."""
    leaks = settle(contained(docs, benchmark, percent).select(F.col("doc_id").alias("leak_id")).distinct())
    return docs.join(small(leaks, BROADCAST_ROWS), docs["doc_id"] == leaks["leak_id"], "left_anti")
