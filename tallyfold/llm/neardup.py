"""Near-duplicate documents by MinHash.

1. Every text gives its set of five-word shingles, 256 minima of universal hash functions, of which 128 are read as
   32 bands of 4, and one bit of each minimum as a sketch. Texts with equal sets are one class from here on.
2. Stars: in every band's bucket each class is a candidate with the bucket's least class, if sizes and sketches do
   not rule a link out. Candidates are confirmed on the full sets. Components of the confirmed links follow.
3. Crossings: buckets that hold classes of two or more components give the pairs between different components, so
   no pair within a component is made. Shingles that only one of these classes has are counted first: they cannot be
   shared, which rules out, exactly, most classes that a large group of near copies has lost by too many changes. The
   others are dealt into segments by hash, and the segments' smaller counts bound what two classes share, so that two
   copies which lost different words make no pair. What is left is confirmed alike, and the components are joined.

A link of similarity 0.75 shares no bucket with probability (1 - 0.75 ** 4) ** 32 = 5e-6, and fails the sketch test
with about 1e-6. Nothing is cut off: a pair that shares a bucket is confirmed, lies within a confirmed component, or
was ruled out by sizes, own shingles or sketches.

Defined cases: null or empty texts have an empty set and are linked with nothing; a text of fewer than five words has
one shingle, its whole sequence; rows with equal doc_id count as one node; a null doc_id is null in the result, each
such row kept and linked with nothing; an empty table gives no row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.components import components
from tallyfold.llm.store import arrow_rows, forget, settle, small
from tallyfold.llm.words import encoded, mix, odd_numbers, shingle_sets, slices, sparing, words_of

MINIMA, BANDS, BAND_ROWS = 256, 32, 4
#: Of 256 sketch bits, those that may differ: 32 are expected at a similarity of 0.75, with a deviation of 5.3.
MOST_BITS = 60
#: Rows with texts that Python gets at once, and bytes of them that are cut into words at once.
ROWS_AT_ONCE, SLICE_BYTES = 2000, 1 << 19
_A, _B = odd_numbers(MINIMA, 11), odd_numbers(MINIMA, 12)
_BAND = odd_numbers(BANDS, 13)
SETS = ("doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, "
        "sketch_0 long, sketch_1 long, sketch_2 long, sketch_3 long")
SKETCH = [f"sketch_{i}" for i in range(4)]
#: Segments into which shingles are dealt by hash, and counts of a segment that have a bit of their own.
SEGMENT_BITS, LEVELS = 8, 3
SEGMENTS = 1 << SEGMENT_BITS
LEVEL_BITS = [f"level_{i}" for i in range(LEVELS * SEGMENTS // 64)]


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Least value of each hash function (32 bits) over each set, all of which have members."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    out, value = np.empty((len(sets), MINIMA), np.uint64), np.empty_like(flat)
    for i in range(MINIMA):
        np.multiply(flat, _A[i], out=value)
        np.add(value, _B[i], out=value)
        np.minimum.reduceat(value, starts, out=out[:, i])
    return out >> np.uint64(32)


def band_keys(sig: np.ndarray) -> np.ndarray:
    cut = sig[:, : BANDS * BAND_ROWS].reshape(len(sig), BANDS, BAND_ROWS)
    key = np.zeros((len(sig), BANDS), np.uint64)
    for j in range(BAND_ROWS):
        key = mix(key * _BAND[j] + cut[:, :, j] + np.uint64(j + 1))
    return mix(key ^ _BAND).view(np.int64)


def sketches(sig: np.ndarray) -> np.ndarray:
    bits = (mix(sig) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<i8")


def fingerprints(sets: list[np.ndarray]) -> np.ndarray:
    """set_a and set_b of every set."""
    marks = [(int(s.sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mix(s * _A[0])))) if len(s) else (0, 0) for s in sets]
    return np.array(marks, np.uint64).reshape(-1, 2).view(np.int64)


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, set size, fingerprint of the set, band keys and sketch of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in sparing(batches):
            texts = encoded(batch["text"])
            for a, b in slices([len(t) for t in texts], SLICE_BYTES):
                sets = shingle_sets(words_of(texts[a:b]))
                full = [i for i, s in enumerate(sets) if len(s)]
                bands = np.zeros((b - a, BANDS), np.int64)
                sketch = np.zeros((b - a, 4), np.int64)
                if full:
                    sig = minima([sets[i] for i in full])
                    bands[full], sketch[full] = band_keys(sig), sketches(sig)
                prints = fingerprints(sets)
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[a:b].array, "n_shingles": [len(s) for s in sets], "set_a": prints[:, 0],
                    "set_b": prints[:, 1], "bands": list(bands), **{c: sketch[:, i] for i, c in enumerate(SKETCH)}})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, SETS)


def _may_link(a: str, b: str, percent: int) -> Column:
    """Sizes allow the similarity and the sketches look like it."""
    sizes = (F.col(f"{a}.n_shingles") * 100 >= F.col(f"{b}.n_shingles") * percent) & (
        F.col(f"{b}.n_shingles") * 100 >= F.col(f"{a}.n_shingles") * percent)
    differ = sum((F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in SKETCH), F.lit(0))
    return sizes & (differ <= MOST_BITS)


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        small(ids), "doc_id", "left_semi")


def _levels(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """set_a, set_b, shareable, LEVEL_BITS, excess: shingles of a class that another text has too, dealt into SEGMENTS by hash.

    Bit i of level k tells that segment i has k shingles or more, and ``excess`` counts those beyond the last level. Two
    classes share no more than the segments' smaller counts, which the bits of both levels give. A doc_id may have several texts, so it is no key.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in sparing(batches):
            texts = encoded(batch["text"])
            for a, b in slices([len(t) for t in texts], SLICE_BYTES):
                sets = shingle_sets(words_of(texts[a:b]))
                owner = np.repeat(fingerprints(sets), [len(s) for s in sets], axis=0)
                kinds, first, n = np.unique(np.concatenate(sets), return_index=True, return_counts=True)
                yield pd.DataFrame({"shingle": kinds.view(np.int64), "n": n, "set_a": owner[first, 0], "set_b": owner[first, 1]})

    counts = _texts_of(docs, ids).mapInPandas(run, "shingle long, n long, set_a long, set_b long").groupBy("shingle").agg(
        F.sum("n").alias("n"), F.min("set_a").alias("set_a"), F.min("set_b").alias("set_b"))
    # as many as a text has shingles, at most
    own = counts.where("n = 1").groupBy("set_a", "set_b").agg(F.collect_list("shingle").alias("own"))

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in sparing(batches):
            texts = encoded(batch["text"])
            for a, b in slices([len(t) for t in texts], SLICE_BYTES):
                sets = shingle_sets(words_of(texts[a:b]))
                prints = fingerprints(sets)
                yield pd.DataFrame({"set_a": prints[:, 0], "set_b": prints[:, 1],
                                    "per_segment": [np.bincount(_segments(s), minlength=SEGMENTS).astype(np.int32) for s in sets]})

    totals = _texts_of(docs, ids).mapInPandas(whole, "set_a long, set_b long, per_segment array<int>").dropDuplicates(["set_a", "set_b"])

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in sparing(batches):
            left = np.zeros((len(batch), SEGMENTS), np.int64)
            for i, (n, gone) in enumerate(zip(batch["per_segment"], batch["own"])):
                left[i] = n
                if gone is not None and len(gone):
                    left[i] -= np.bincount(_segments(np.asarray(gone, np.int64).view(np.uint64)), minlength=SEGMENTS)
            out = {"set_a": batch["set_a"], "set_b": batch["set_b"], "shareable": left.sum(axis=1),
                   "excess": np.maximum(left - LEVELS, 0).sum(axis=1)}
            words = np.concatenate([np.packbits(left >= k, axis=1, bitorder="little").view("<i8") for k in range(1, LEVELS + 1)], axis=1)
            yield pd.DataFrame(out | {c: words[:, i] for i, c in enumerate(LEVEL_BITS)})

    return totals.join(own, ["set_a", "set_b"], "left").mapInPandas(
        bits, "set_a long, set_b long, shareable long, excess long, " + ", ".join(f"{c} long" for c in LEVEL_BITS))


def _segments(shingles: np.ndarray) -> np.ndarray:
    return (mix(shingles * _B[0]) >> np.uint64(64 - SEGMENT_BITS)).astype(np.int64)


def _most_shared(a: str, b: str) -> Column:
    """An upper bound of the shingles that two classes share."""
    both = sum((F.bit_count(F.col(f"{a}.{c}").bitwiseAND(F.col(f"{b}.{c}"))) for c in LEVEL_BITS), F.lit(0).cast("long"))
    return both + F.least(f"{a}.excess", f"{b}.excess")


def _confirmed(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Those of the (a, b) pairs whose full sets have the similarity."""
    ids = settle(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    texts = _texts_of(docs, ids)
    both = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in sparing(batches):
            left, right = encoded(batch["text_a"]), encoded(batch["text_b"])
            for p, q in slices([len(x) + len(y) for x, y in zip(left, right)], SLICE_BYTES):
                # a text that many pairs share is read once in a slice
                own = list(dict.fromkeys(left[p:q] + right[p:q]))
                sets = dict(zip(own, shingle_sets(words_of(own))))
                keep = []
                for x, y in zip(left[p:q], right[p:q]):
                    s, t = sets[x], sets[y]
                    shared = len(s) + len(t) - len(np.union1d(s, t))
                    keep.append(100 * shared >= percent * (len(s) + len(t) - shared))
                yield batch[["a", "b"]].iloc[p:q][np.array(keep, bool)]

    with arrow_rows(docs.sparkSession, ROWS_AT_ONCE):
        return settle(both.mapInPandas(run, "a long, b long"))


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``."""
    with arrow_rows(docs.sparkSession, ROWS_AT_ONCE):
        rows = settle(describe(docs))
    full = rows.where("n_shingles > 0 and doc_id is not null")
    classes = settle(full.groupBy("set_a", "set_b").agg(
        F.min_by(F.struct("doc_id", "n_shingles", "bands", *SKETCH), "doc_id").alias("own")).select("set_a", "set_b", "own.*"))
    stars = _confirmed(_star_pairs(classes, percent), docs, percent)
    first = settle(components(stars))
    crossings = _confirmed(_crossing_pairs(classes, first, docs, percent), docs, percent)
    # a doc_id on several rows may belong to several classes, which are then one
    owned = full.join(classes.select("set_a", "set_b", F.col("doc_id").alias("own")), ["set_a", "set_b"]).select("doc_id", "own")
    several = owned.groupBy("doc_id").agg(F.min("own").alias("low"), F.max("own").alias("high")).where("low < high")
    extra = owned.join(several.select("doc_id"), "doc_id").select(F.col("own").alias("a"), F.col("doc_id").alias("b"))
    links = first.select(F.col("node").alias("a"), F.col("component").alias("b")).union(crossings).union(extra)
    found = settle(components(links))
    of_class = classes.join(found, classes["doc_id"] == found["node"], "left").select(
        "set_a", "set_b", F.coalesce("component", "doc_id").alias("component_id"))
    placed = full.join(of_class, ["set_a", "set_b"]).select("doc_id", "n_shingles", "component_id")
    rest = rows.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    forget(stars, crossings)
    return placed.union(rest).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _buckets(classes: DataFrame, *more: str) -> DataFrame:
    return classes.select(F.posexplode("bands").alias("band", "key"), "doc_id", "n_shingles", *SKETCH, *more)


def _star_pairs(classes: DataFrame, percent: int) -> DataFrame:
    rows = _buckets(classes)
    whole = F.struct("doc_id", "n_shingles", *SKETCH)
    centre = rows.groupBy("band", "key").agg(F.min(whole).alias("c"), F.max("doc_id").alias("last")).where(F.col("c.doc_id") < F.col("last"))
    return settle(rows.alias("r").join(centre.alias("s"), ["band", "key"]).select(F.struct("r.doc_id", "r.n_shingles", *[f"r.{c}" for c in SKETCH]).alias("r"), "c").where(
        F.col("r.doc_id") > F.col("c.doc_id")).where(_may_link("r", "c", percent)).select(
        F.col("c.doc_id").alias("a"), F.col("r.doc_id").alias("b")).distinct())


def _crossing_pairs(classes: DataFrame, found: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs in a bucket from different components. The component with most classes in a bucket is set apart, so that
    its classes meet only those of others."""
    placed = settle(classes.join(found, classes["doc_id"] == found["node"], "left").select(
        "doc_id", "set_a", "set_b", "n_shingles", "bands", *SKETCH, F.coalesce("component", "doc_id").alias("part")))
    rows = _buckets(placed, "part", "set_a", "set_b")
    mixed = rows.groupBy("band", "key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    inside = settle(rows.join(mixed.select("band", "key"), ["band", "key"]))
    main = inside.groupBy("band", "key", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("band", "key").agg(
        F.max(F.struct("n", "part")).alias("top")).select("band", "key", F.col("top.part").alias("main"))
    ids = settle(inside.select("doc_id").distinct())
    with arrow_rows(docs.sparkSession, ROWS_AT_ONCE):
        levels = settle(_levels(docs, ids))
    # a class needs percent / 100 of its shingles shared by any link
    able = levels.join(placed.select("set_a", "set_b", "n_shingles", "bands"), ["set_a", "set_b"]).where(
        F.col("shareable") * 100 >= F.col("n_shingles") * percent).drop("n_shingles")
    marked = settle(inside.join(main, ["band", "key"]).join(settle(able), ["set_a", "set_b"]))
    # a similarity of percent / 100 takes percent / (100 + percent) of both sizes together as shared shingles
    enough = _most_shared("x", "y") * (100 + percent) >= (F.col("x.n_shingles") + F.col("y.n_shingles")) * percent
    # a pair that shares several bands is made in the first of them
    once = F.array_position(F.zip_with("x.bands", "y.bands", lambda p, q: p == q), True) == F.col("x.band") + 1
    others = marked.where("part <> main")
    met = [(others, marked.where("part = main"), F.lit(True)), (others, others, F.col("x.part") < F.col("y.part"))]
    pairs = [x.alias("x").join(y.alias("y"), (F.col("x.band") == F.col("y.band")) & (F.col("x.key") == F.col("y.key"))
                               & order & enough & _may_link("x", "y", percent) & once).select(
        F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")) for x, y, order in met]
    out = settle(pairs[0].union(pairs[1]).distinct())
    forget(placed, inside, marked)
    return out


def drop_near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One document of each group: the row of the least doc_id, and of rows that share it one.

    Rows with a null doc_id or without words are kept.
    """
    found = settle(near_duplicates(docs, percent))
    gone = settle(found.where("not kept").select(F.col("doc_id").alias("gone")).distinct())
    twice = settle(found.where("doc_id is not null and n_shingles > 0").groupBy("doc_id").count().where("count > 1").select(
        F.col("doc_id").alias("twice")))
    left = docs.join(small(gone), docs["doc_id"] == gone["gone"], "left_anti")
    once = left.join(small(twice), left["doc_id"] == twice["twice"], "left_anti")
    more = left.join(small(twice), left["doc_id"] == twice["twice"], "left_semi")
    packed = more.select(F.struct(*[more[c] for c in docs.columns]).alias("doc"), F.col("doc_id").alias("key"))
    one = packed.groupBy("key").agg(F.first("doc").alias("doc")).select("doc.*")
    return once.union(one)
