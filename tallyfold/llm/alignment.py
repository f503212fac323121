"""Links between the tokens of two tokenizers over the same bytes, and how often each pair of ids is linked.

Both tokenizers cut a text's bytes; where tokens of both end, a group ends. Most groups are one token on either side,
which then have the same bytes: a map from every id of the first tokenizer to the id of the second with the same bytes,
made from the vocabularies alone, recognises them, and they are counted in a vector as long as the first vocabulary.
Only the links of the other groups are shuffled as pairs of ids.

Both tokenizers cut before the spaces that follow a word, so what they make of a word, with the spaces before it, is
worked out once in a worker and remembered.

Every document then needs the counts of its own links. Those of the map come from the vector. Of the other pairs those that hold
at least one link in PAIRS_SENT are broadcast, so there are PAIRS_SENT of them at most whatever the corpus; the rest are
joined by a shuffle, in which by the same rule no pair is frequent.

Defined cases: a null or empty text, or one of which either tokenizer does not give back the bytes, has no tokens: its
counts are 0 and its digest is empty. Rows with a null doc_id or with equal ones are rows of their own. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm.store import arrow_rows, settle
from tallyfold.llm.words import slices

#: Most pairs that are broadcast, and the share of all links (one in as many) from which on a pair is among them.
PAIRS_SENT = 1_000_000
ROWS_AT_ONCE, SLICE_BYTES = 256, 1 << 19
#: Units and their letters that a worker remembers, units that are tokenized as one text, and new ones learned at once.
REMEMBERED_UNITS, REMEMBERED_LETTERS, UNITS_AT_ONCE, LEARNED_AT_ONCE = 400_000, 1 << 23, 1000, 50_000
_ODD_SPACE = re.compile(r"\s |^ | $")
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("groups_sha256", pa.string()),
    ("direct", pa.binary()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])
ALIGNED_SQL = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
               "direct binary, pairs array<long>, times array<int>")


def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a letter: printable ones as themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def piece_bytes(piece: str) -> bytes:
    """Bytes of a piece: U+2581 is a space, <0xHH> one byte."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Tokenizers:
    """Both tokenizers, the bytes of their ids, and the map from one's ids to the other's with the same bytes."""

    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.first = Tokenizer.from_file(byte_level)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=pieces)
        letters = byte_of_letter()
        self.first_bytes = [b""] * self.first.get_vocab_size()
        for token, i in self.first.get_vocab().items():
            self.first_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        n = self.second.get_piece_size()
        self.second_bytes = [piece_bytes(self.second.id_to_piece(i)) for i in range(n)]
        # a piece of its own goes before a single byte with the same bytes, as it is what texts are cut into
        by_bytes = {b: i for i, b in enumerate(self.second_bytes) if self.second.is_byte(i)}
        by_bytes |= {b: i for i, b in enumerate(self.second_bytes) if not self.second.is_byte(i)}
        self.same = np.array([by_bytes.get(b, -1) for b in self.first_bytes], np.int64)
        self.first_size, self.second_size = (np.array(list(map(len, x)), np.int64) for x in (self.first_bytes, self.second_bytes))
        #: Written forms of an id within a group and at the end of its side.
        self.first_text, self.second_text = ([np.array([f"{i}{end}" for i in range(len(x))], object) for end in ends] for x, ends in (
            (self.first_bytes, ",|"), (self.second_bytes, ",;")))

        # no token of the second goes from another character into a space, as none of the first does: texts can be cut there
        self.cuts = not any(b" " in b.lstrip(b" ") for b in self.second_bytes)

    def units(self, text: str) -> list[str]:
        """A text with a space before it, cut before every run of spaces that follows a character other than white
        space. What both tokenizers make of such a unit does not depend on what is around it."""
        if not self.cuts:
            return [" " + text]
        words = text.split(" ")
        if not _ODD_SPACE.search(text):
            return [" " + w for w in words]
        out, open_ = [], False
        for w in words:
            if open_:
                out[-1] += " " + w
            else:
                out.append(" " + w)
            open_ = not w or w[-1].isspace()
        if len(out) > 1 and out[-1].isspace():
            out[-2:] = [out[-2] + out[-1]]
        return out

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both tokenizers for units one after the other, and the bytes of each unit: 0 where they are not given back."""
        runs: list[list[str]] = []
        for unit in units:
            if not runs or len(runs[-1]) >= UNITS_AT_ONCE or runs[-1][-1][-1].isspace():
                runs.append([])
            runs[-1].append(unit)
        ids, sizes = ([], []), []
        texts = ["".join(run) for run in runs]
        found = self.first.encode_batch_fast(texts, add_special_tokens=False)
        for run, text, a, b in zip(runs, texts, found, self.second.encode([t[1:] for t in texts], num_threads=1)):
            own, a = text.encode("utf-8", "surrogatepass"), a.ids
            if b"".join(map(self.first_bytes.__getitem__, a)) == own == b"".join(map(self.second_bytes.__getitem__, b)):
                parts = [(a, b, [len(u.encode("utf-8", "surrogatepass")) for u in run])]
            else:
                parts = [self.encode([u]) for u in run] if len(run) > 1 else [([], [], [0])]
            for x, y, n in parts:
                ids[0].append(np.asarray(x, np.int64))
                ids[1].append(np.asarray(y, np.int64))
                sizes.extend(n)
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *ids[0]]), np.concatenate([none, *ids[1]]), np.array(sizes, np.int64)


@lru_cache(maxsize=1)
def tokenizers_of(byte_level: str, pieces: str) -> Tokenizers:
    return Tokenizers(byte_level, pieces)


class Links(NamedTuple):
    """Links of some units in order, and what they belong to."""

    counts: np.ndarray  # units x COUNTS
    kept: np.ndarray  # whether the unit's bytes are given back
    first: np.ndarray
    second: np.ndarray
    unit: np.ndarray
    direct: np.ndarray  # whether the map gives the link
    written: list[str]


def linked(own: Tokenizers, units: list[str]) -> Links:
    """Links and groups of units: each stretch between two token ends of either side is one link."""
    a, b, sizes = own.encode(units)
    ends_a, ends_b = np.cumsum(own.first_size[a]), np.cumsum(own.second_size[b])
    # both sides of a unit have the same bytes, so ends of all units are on one scale
    bounds = np.cumsum(sizes)
    ends = np.union1d(ends_a, ends_b)
    at_a, at_b, unit = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends), np.searchsorted(bounds, ends)
    closes = (ends_a[at_a] == ends) & (ends_b[at_b] == ends) if len(ends) else np.zeros(0, bool)
    opens = np.concatenate([[True], closes[:-1]]) if len(ends) else closes
    first, second = a[at_a], b[at_b]
    direct = opens & closes & (own.same[first] == second)
    n = [np.bincount(np.searchsorted(bounds, e), minlength=len(units)) for e in (ends_a, ends_b)]
    counts = np.stack([*n, np.bincount(unit[closes], minlength=len(units)), np.bincount(unit, minlength=len(units))], axis=1)

    # the groups as text: a group's ids of the first side, then those of the second
    last_a, last_b = at_a[closes], at_b[closes]
    n_a, n_b = (np.diff(np.concatenate([[-1], x])) for x in (last_a, last_b))
    place_a = np.arange(len(a)) + np.repeat(last_b + 1 - n_b, n_a)
    place_b = np.arange(len(b)) + np.repeat(last_a + 1, n_b)
    parts = np.empty(len(a) + len(b), object)
    parts[place_a], parts[place_b] = own.first_text[0][a], own.second_text[0][b]
    parts[place_a[last_a]], parts[place_b[last_b]] = own.first_text[1][a[last_a]], own.second_text[1][b[last_b]]
    cuts = np.concatenate([[0], np.cumsum(n[0] + n[1])])
    written = ["".join(parts[x:y])[:-1] for x, y in zip(cuts[:-1], cuts[1:])]
    return Links(counts, sizes > 0, first, second, unit, direct, written)


class _Lists:
    """Growing rows of numbers, one after the other."""

    def __init__(self):
        self.values, self.ends = np.zeros(1 << 16, np.int64), [np.zeros(1, np.int64)]
        self.used = 0

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        if self.used + len(values) > len(self.values):
            self.values = np.resize(self.values, 2 * (self.used + len(values)))
        self.values[self.used : self.used + len(values)] = values
        self.ends.append(self.used + np.cumsum(sizes))
        self.used += len(values)

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the given rows, and the size of each."""
        if len(self.ends) > 1:
            self.ends = [np.concatenate(self.ends)]
        ends = self.ends[0]
        sizes = ends[rows + 1] - ends[rows]
        last = np.cumsum(sizes)
        return self.values[np.repeat(ends[rows] - last + sizes, sizes) + np.arange(int(sizes.sum()))], sizes


class Memory:
    """Links of units seen before, so that each is tokenized once; all are forgotten when there are too many."""

    def __init__(self, own: Tokenizers):
        self.own = own
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.written: list[str] = []
        self.counts = [np.zeros((0, len(COUNTS) + 1), np.int64)]
        self.direct, self.others = _Lists(), _Lists()
        self.letters = 0

    def numbers(self, units: list[str]) -> np.ndarray:
        """Numbers of units; new ones are tokenized together."""
        if len(self.number) > REMEMBERED_UNITS or self.letters > REMEMBERED_LETTERS:
            self.forget()
        new = [u for u in dict.fromkeys(units) if u not in self.number]
        for start in range(0, len(new), LEARNED_AT_ONCE):
            self._learn(new[start : start + LEARNED_AT_ONCE])
        return np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))

    def _learn(self, units: list[str]) -> None:
        found = linked(self.own, units)
        width, n = len(self.own.second_bytes), len(units)
        self.number.update(zip(units, range(len(self.number), len(self.number) + n)))
        self.letters += sum(map(len, units))
        self.written += found.written
        self.counts.append(np.column_stack([found.counts, ~found.kept]))
        self.direct.add(found.first[found.direct], np.bincount(found.unit[found.direct], minlength=n))
        other = ~found.direct
        self.others.add(found.first[other] * width + found.second[other], np.bincount(found.unit[other], minlength=n))

    def counts_of(self, rows: np.ndarray) -> np.ndarray:
        if len(self.counts) > 1:
            self.counts = [np.concatenate(self.counts)]
        return self.counts[0][rows]


@lru_cache(maxsize=1)
def memory_of(byte_level: str, pieces: str) -> Memory:
    return Memory(tokenizers_of(byte_level, pieces))


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([np.zeros_like(values[:1]) if len(values) else np.zeros((1, *values.shape[1:]), values.dtype),
                                   np.cumsum(values, axis=0)])[cuts], axis=0)


def documents_linked(memory: Memory, texts: list[str]) -> dict[str, list | np.ndarray]:
    """Columns of ALIGNED for some texts."""
    units, cuts = [], [0]
    for text in texts:
        if text:
            units += memory.own.units(text)
        cuts.append(len(units))
    rows, cuts = memory.numbers(units), np.array(cuts)
    # a text with a unit whose bytes are not given back has no tokens
    lost = _sums(memory.counts_of(rows)[:, -1], cuts) > 0
    if lost.any():
        n = np.where(lost, 0, np.diff(cuts))
        rows, cuts = rows[np.repeat(~lost, np.diff(cuts))], np.concatenate([[0], np.cumsum(n)])
    text = np.repeat(np.arange(len(texts)), np.diff(cuts))
    first, n_first = memory.direct.of(rows)
    pair, n_pairs = memory.others.of(rows)
    codes, code = np.unique(pair, return_inverse=True)
    span = max(len(codes), 1)
    keys, times = np.unique(np.repeat(text, n_pairs) * span + code, return_counts=True)
    names = list(map(memory.written.__getitem__, rows.tolist()))
    first = first.astype("<u4")
    steps = _sums(n_first, cuts).cumsum()
    return {
        "counts": _sums(memory.counts_of(rows)[:, :-1], cuts),
        "digests": [hashlib.sha256(";".join(names[x:y]).encode()).hexdigest() if y > x else "" for x, y in zip(cuts[:-1], cuts[1:])],
        "direct": [first[x:y].tobytes() for x, y in zip([0, *steps[:-1]], steps)],
        "cuts": np.searchsorted(keys, np.arange(len(texts) + 1) * span).astype(np.int32),
        "pairs": codes[keys % span] if len(codes) else keys, "times": times.astype(np.int32)}


def align(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """A row for every document: counts, digest of its groups, first ids of the links that the map gives, and the
    other pairs (first id x size of the second vocabulary + second id) with the times they are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = memory_of(byte_level, pieces)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for x, y in slices([len(t) for t in texts], SLICE_BYTES):
                found = documents_linked(memory, texts[x:y])
                yield pa.RecordBatch.from_arrays([
                    batch.column("row").slice(x, y - x), batch.column("doc_id").slice(x, y - x), *[pa.array(c) for c in found["counts"].T],
                    pa.array(found["digests"], pa.string()), pa.array(found["direct"], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(found["cuts"]), pa.array(found["pairs"])),
                    pa.ListArray.from_arrays(pa.array(found["cuts"]), pa.array(found["times"]))], schema=ALIGNED)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, ALIGNED_SQL)


def direct_counts(aligned: DataFrame, n_ids: int) -> DataFrame:
    """first, n: links given by the map; every task counts in one vector of the vocabulary's length."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(n_ids, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch["direct"]), "<u4"), minlength=n_ids)
        there = np.flatnonzero(total)
        yield pd.DataFrame({"first": there, "n": total[there]})

    return aligned.select("direct").mapInPandas(run, "first long, n long").groupBy("first").agg(F.sum("n").alias("n"))


def same_ids(spark: SparkSession, own: Tokenizers) -> DataFrame:
    """first, pair: the map, a row for each id of the first vocabulary that has one."""
    width, there = len(own.second_bytes), np.flatnonzero(own.same >= 0)
    return spark.createDataFrame(pd.DataFrame({"first": there, "pair": there * width + own.same[there]}), "first long, pair long")


def pair_counts(aligned: DataFrame, own: Tokenizers) -> DataFrame:
    """pair, first, second, n, best: links of every pair of ids, and whether no other pair of the second id has more."""
    width = len(own.second_bytes)
    # the map has a row for each id of a vocabulary at most
    mapped = direct_counts(aligned, len(own.first_bytes)).join(F.broadcast(same_ids(aligned.sparkSession, own)), "first").select("pair", "n")
    others = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.pairs", "p.times").groupBy("pairs").agg(
        F.sum("times").alias("n")).toDF("pair", "n")
    counts = mapped.unionByName(others).groupBy("pair").agg(F.sum("n").alias("n"))
    second = F.col("pair") % width
    split = counts.select("pair", F.floor((F.col("pair") - second) / width).cast("long").alias("first"), second.alias("second"), "n")
    most = split.groupBy("second").agg(F.max("n").alias("most"))
    return split.join(most, "second").select("pair", "first", "second", "n", (F.col("n") == F.col("most")).alias("best"))


def _direct_sums(aligned: DataFrame, counts: DataFrame, own: Tokenizers) -> DataFrame:
    """Every document's sums over the links that the map gives, from two vectors of the vocabulary's length."""
    count, best = (np.zeros(len(own.first_bytes), np.int64) for _ in range(2))
    for row in counts.join(F.broadcast(same_ids(aligned.sparkSession, own)), ["pair", "first"]).select("first", "n", "best").collect():
        count[row["first"]], best[row["first"]] = row["n"], row["best"]
    kept = ["row", "doc_id", *COUNTS, "groups_sha256"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = np.frombuffer(b"".join(batch["direct"]), "<u4")
            cuts = np.concatenate([[0], np.cumsum([len(d) // 4 for d in batch["direct"]], dtype=np.int64)])
            sums = [np.diff(np.concatenate([[0], np.cumsum(v[ids])])[cuts]) for v in (best, count)]
            out = batch[kept].copy()
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out.assign(direct_best=sums[0], direct_sum=sums[1])

    return aligned.select(*kept, "direct").mapInPandas(
        run, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, direct_best long, direct_sum long")


def _other_sums(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Every row's sums over its other pairs: frequent pairs by broadcast, the rest by a shuffle without frequent keys."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    values = counts.select("pair", "n", F.col("best").cast("int").alias("best"))
    frequent = F.col("n") * PAIRS_SENT >= total
    zipped = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), "p.times")
    met = zipped.join(F.broadcast(values.where(frequent)), "pair", "left")
    rare = met.where("n is null").select("row", "pair", "times").join(values.where(~frequent), "pair")

    def sums(df: DataFrame) -> DataFrame:
        return df.groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("s"), F.sum(F.col("times") * F.col("best")).alias("b"))

    both = sums(met.where("n is not null")).unionByName(sums(rare))
    return both.groupBy("row").agg(F.sum("b").alias("other_best"), F.sum("s").alias("other_sum"))


def align_tokenizers(docs: DataFrame, byte_level: str, pieces: str) -> tuple[DataFrame, DataFrame]:
    """Documents with their links' sums, and the table of all linked pairs of ids."""
    own = tokenizers_of(byte_level, pieces)
    spark = docs.sparkSession
    with arrow_rows(spark, ROWS_AT_ONCE):
        aligned = settle(align(docs, byte_level, pieces), "zstd")
    counts = settle(pair_counts(aligned, own))
    sums = _direct_sums(aligned, counts, own).join(_other_sums(aligned, counts), "row", "left")
    zero = F.lit(0).cast("long")
    rows = sums.select("doc_id", *COUNTS, (F.col("direct_best") + F.coalesce("other_best", zero)).alias("n_best"),
                       (F.col("direct_sum") + F.coalesce("other_sum", zero)).alias("count_sum"), "groups_sha256")
    return rows, counts
