"""Importance resampling of documents towards a target distribution, with features hashed by a position table.

The crc32 of a byte string is linear over its bits up to a constant that depends on the length alone. So a byte's
share in it depends on its value and its distance from the end, and is read from a table; the shares of a feature's
bytes are XORed by ``bitwise_xor.reduceat`` over all features of many texts at once, and the length's constant is
added. Spans longer than the table are cut into blocks counted from their end; a block's value is carried over the
bytes behind it by operators for 1, 2, 4... blocks, and the blocks of a span are XORed.

Defined cases: a null text has no words, as an empty one; rows with a null doc_id take the place of an empty id in the
draw's hash and come last among equal scores; rows with equal doc_id are drawn each for itself; without target texts or
documents every gain follows from the zero counts; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.store import arrow_rows, settle
from tallyfold.llm.words import encoded, slices
from tallyfold.operators.ranking import total_rank

N_BUCKETS, LEAST_WORDS, DRAWN_PERCENT, SEED = 10_000, 20, 25, 7
#: Distances in the position table, and so the bytes of a block of a longer span.
BLOCK = 64
#: Bytes of features that are looked up at once, and bytes of text whose words are found at once.
LOOKUP_BYTES, SLICE_BYTES = 1 << 20, 1 << 19
ROWS_AT_ONCE = 512
_POLYNOMIAL = 0xEDB88320

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Share of every byte at each distance from the end, and the crc32 of 0 to BLOCK zero bytes."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(_POLYNOMIAL), one >> 1).astype(np.uint32)
    shares, constants = [one], [np.uint32(0xFFFFFFFF)]
    for _ in range(BLOCK - 1):
        shares.append((shares[-1] >> np.uint32(8)) ^ one[shares[-1] & 255])
    for _ in range(BLOCK):
        constants.append((constants[-1] >> np.uint32(8)) ^ one[constants[-1] & 255])
    return np.stack(shares), np.array(constants, np.uint32)


@cache
def _carry(power: int) -> np.ndarray:
    """What each byte of a value becomes behind 2**power blocks of zero bytes: 4 x 256."""
    shares, _ = _tables()
    if power == 0:
        # the value's lowest byte meets the first of the zero bytes
        return np.stack([shares[BLOCK - 1 - i] for i in range(4)])
    before = _carry(power - 1)
    return _carried(before, before)


def _carried(operator: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = operator[0][values & 255]
    for i in (1, 2, 3):
        out = out ^ operator[i][(values >> np.uint32(8 * i)) & 255]
    return out


def _over_blocks(values: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Every value behind as many blocks of zero bytes."""
    values = values.copy()
    for power in range(int(blocks.max(initial=0)).bit_length()):
        there = (blocks >> power) & 1 == 1
        values[there] = _carried(_carry(power), values[there])
    return values


def _lookup(data: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """XOR of the bytes' shares of spans of 1 to BLOCK bytes, a bounded number of bytes at a time."""
    shares = _tables()[0].reshape(-1)
    out, total = np.zeros(len(ends), np.uint32), np.cumsum(sizes)
    first = 0
    while first < len(ends):
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + LOOKUP_BYTES, "right")))
        n = sizes[first:last].astype(np.int32)
        behind = np.cumsum(n, dtype=np.int32)
        distance = np.repeat(behind, n) - np.arange(1, behind[-1] + 1, dtype=np.int32)
        at = np.repeat(ends[first:last] - 1, n) - distance
        found = shares[(distance << 8) + data[at]]
        out[first:last] = np.bitwise_xor.reduceat(found, behind - n)
        first = last
    return out


def crc32_spans(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """crc32 of ``data[start : start + size]`` for every span; spans may overlap and be empty."""
    _, constants = _tables()
    out = np.zeros(len(starts), np.uint32)
    short = np.flatnonzero((sizes > 0) & (sizes <= BLOCK))
    out[short] = _lookup(data, starts[short] + sizes[short], sizes[short])
    out ^= constants[np.minimum(sizes, BLOCK)]
    long = np.flatnonzero(sizes > BLOCK)
    if len(long):
        size = sizes[long]
        n = -(-size // BLOCK)
        firsts = np.cumsum(n) - n
        behind = np.repeat(firsts + n, n) - 1 - np.arange(int(n.sum()))  # blocks behind each
        ends = np.repeat(starts[long] + size, n) - behind * BLOCK
        begins = np.maximum(ends - BLOCK, np.repeat(starts[long], n))
        values = _over_blocks(_lookup(data, ends, ends - begins), behind)
        # the constant of a length: that of what is beside whole blocks, carried over these
        out[long] = np.bitwise_xor.reduceat(values, firsts) ^ _over_blocks(constants[size % BLOCK], size // BLOCK)
    return out ^ np.uint32(0xFFFFFFFF)


def feature_buckets(texts: list[bytes], n_buckets: int = N_BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, buckets of all words and pairs of neighbours, and the text of each of them."""
    data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    inside = _WORD[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside])))
    start, size = edge[::2], edge[1::2] - edge[::2]
    n_words = np.diff(np.searchsorted(start, begins))
    # words with one space behind each: pairs are then spans too
    behind = np.zeros(len(data), bool)
    behind[edge[1::2]] = True
    data[behind] = 32
    data = data[inside | behind]
    start = np.cumsum(size + 1) - size - 1
    text = np.repeat(np.arange(len(texts)), n_words)
    pair = np.flatnonzero(text[1:] == text[:-1])
    starts = np.concatenate([start, start[pair]])
    sizes = np.concatenate([size, size[pair] + 1 + size[pair + 1]])
    buckets = crc32_spans(data, starts, sizes) % np.uint32(n_buckets)
    return n_words, buckets.astype(np.int64), np.concatenate([text, text[pair]])


def bucket_counts(docs: DataFrame, n_buckets: int = N_BUCKETS) -> DataFrame:
    """bucket, n: features of all texts; every task adds up its own first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            texts = encoded(batch["text"])
            for a, b in slices([len(t) for t in texts], SLICE_BYTES):
                total += np.bincount(feature_buckets(texts[a:b], n_buckets)[1], minlength=n_buckets)
        there = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": there.astype(np.int32), "n": total[there]})

    rows = docs.select(F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, n_buckets: int = N_BUCKETS) -> np.ndarray:
    """Thousandths of the log ratio of the target's share in each bucket to that of the documents, rounded down.

    The counts that come to the driver are one number for each of the fixed buckets and side.
    """
    def counted(df: DataFrame) -> np.ndarray:
        out = np.zeros(n_buckets, np.int64)
        for row in bucket_counts(df, n_buckets).collect():
            out[row["bucket"]] = row["n"]
        return out

    with arrow_rows(docs.sparkSession, ROWS_AT_ONCE):
        s, t = counted(docs), counted(target)
    all_s, all_t = float(s.sum() + n_buckets), float(t.sum() + n_buckets)
    return np.array([math.floor(1000 * math.log((float(y) + 1) * all_s / ((float(x) + 1) * all_t))) for x, y in zip(s, t)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row: the mean gain of its features, rounded down."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = encoded(batch["text"])
            for a, b in slices([len(t) for t in texts], SLICE_BYTES):
                n_words, buckets, text = feature_buckets(texts[a:b], len(gain))
                n = n_words + np.maximum(n_words - 1, 0)
                # whole numbers below 2**53, so the sums are exact
                total = np.bincount(text, gain[buckets], minlength=b - a).astype(np.int64)
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[a:b].astype("Int64").array, "n_words": n_words, "n_features": n,
                                    "weight": total // np.maximum(n, 1)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_words long, n_features long, weight long")


def chance(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate that the id and the seed give, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
             n_buckets: int = N_BUCKETS) -> DataFrame:
    """Every document with its weight and score; ``rank`` counts the drawn ones from the highest score.

    Adding a Gumbel variate to the log weights and taking the highest draws without replacement in proportion to the
    weights. ``percent`` of the documents with ``least_words`` words are drawn, ties by the smaller doc_id.
    """
    gain = gains(docs, target, n_buckets)
    with arrow_rows(docs.sparkSession, ROWS_AT_ONCE):
        scored = settle(weigh(docs, gain).withColumn("score", F.col("weight") + chance(F.col("doc_id"), seed)))
    fit = scored.where(F.col("n_words") >= least_words)
    drawn = percent * fit.count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    ranked = total_rank(fit, order).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)
