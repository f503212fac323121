"""Language-model scores by deleted interpolation.

The probability of a word after another mixes three estimates: the pair's share in the context's pairs, the word's
share in all words, and the add-one share. The mixture weights depend on how often the context was seen (one bucket
for each power of two) and are learned by expectation maximisation on deleted counts: every training token is held
out from the counts it helped to make.

How it runs: documents are dealt to chunks. Each chunk sorts its distinct words and pairs (as 64-bit hashes) and sends
each range of hashes, with its counts, to that range's group, which adds up what all chunks sent and answers with
totals in the same order, so that the answer needs no keys. A hot word is one number for each chunk. The documents of a
chunk then meet the answers (the exchange of texts is one and is used twice), and each document keeps the totals
of its tokens in a compressed form. Expectation maximisation sees a table of cells: context bucket and the two shares
on a grid of 1/8 powers of two, over all training tokens; its size is bounded by the grid. A last pass scores.

Words: runs other than space and 0x09-0x0D, lower case A-Z; every text ends with an end token.

Defined cases: null and empty texts are an end token alone; rows with equal doc_id are scored each; a null doc_id is not
held out; an empty table gives no row; without training rows the base alone is the model. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.store import settle
from tallyfold.llm.words import encoded, mix, odd_numbers, slices, words_of_many

CHUNK_BYTES = 8 << 20
GRID = 8
ROUNDS = 60
#: Bytes of packed totals whose cells are counted at once.
TOKENS_AT_ONCE = 1 << 20
_END, _PAIR, _NEXT = odd_numbers(3, 21)
#: Share of a token that the training data had nowhere else, on the grid.
NEVER = -(1 << 20)
TOKENS = "doc_id long, held_out boolean, n_tokens long, word_totals binary, pair_totals binary, n_words long, n_kinds long, n_docs long"
MESSAGE = "chunk int, range int, n int, keys binary, counts binary"
ANSWER = "chunk int, range int, n int, totals binary, n_words long, n_kinds long, n_docs long"


def pack_ints(x: np.ndarray) -> bytes:
    """Whole numbers as planes of bytes, as many as the largest needs; compressors find the empty ones."""
    x = np.ascontiguousarray(x, "<u8")
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return bytes([width]) + x.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack_ints(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view("<u8").ravel()


def is_held_out(doc_id, of: int, rest: int) -> bool:
    return not pd.isna(doc_id) and zlib.crc32(str(int(doc_id)).encode()) % of == rest


class Chunk:
    """Tokens of a chunk's documents, and its sorted distinct keys: words have the last bit set, pairs have not."""

    def __init__(self, rows: pd.DataFrame, of: int, rest: int):
        self.doc_ids = [None if pd.isna(d) else int(d) for d in rows["doc_id"]]
        self.held = np.array([is_held_out(d, of, rest) for d in self.doc_ids], bool)
        words = words_of_many(encoded(rows["text"]))
        n = len(rows)
        self.bounds = words.bounds + np.arange(n + 1)
        word = np.full(self.bounds[-1], _END)
        inside = np.ones(len(word), bool)
        inside[self.bounds[1:] - 1] = False
        word[inside] = words.hash
        before = np.full(len(word), _END)  # a text starts after the end of another
        before[1:] = word[:-1]
        single, pair = mix(word) | np.uint64(1), mix(before * _PAIR + word * _NEXT) & ~np.uint64(1)
        self.keys, where = np.unique(np.concatenate([single, pair]), return_inverse=True)
        self.word_at, self.pair_at = where[: len(word)], where[len(word) :]
        self.learned = ~np.repeat(self.held, np.diff(self.bounds))

    def counts(self) -> np.ndarray:
        size = len(self.keys)
        return np.bincount(self.word_at[self.learned], minlength=size) + np.bincount(self.pair_at[self.learned], minlength=size)


def range_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def token_totals(docs: DataFrame, of: int, rest: int) -> DataFrame:
    """Each document's tokens with the training totals of word and pair; rows with n_docs carry sums of a range."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)) + 8 * F.count(F.lit(1))).first()[0]
    n = max(1, -(-total // CHUNK_BYTES))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int"))
    end_key = (mix(np.array([_END])) | np.uint64(1))[0]

    def send(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        chunk = Chunk(own, of, rest)
        counts, ranges = chunk.counts(), range_of(chunk.keys, n)
        cuts = np.flatnonzero(np.diff(ranges, prepend=-1))
        out = []
        for a, b in zip(cuts, [*cuts[1:], len(ranges)]):
            out.append((key[0], int(ranges[a]), b - a, pack_ints(np.diff(chunk.keys[a:b], prepend=np.uint64(0))), pack_ints(counts[a:b])))
        return pd.DataFrame(out, columns=["chunk", "range", "n", "keys", "counts"])

    def add_up(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.cumsum(unpack_ints(k), dtype=np.uint64) for k in own["keys"]])
        kinds, where = np.unique(keys, return_inverse=True)
        counts = np.concatenate([unpack_ints(c) for c in own["counts"]])
        totals = np.zeros(len(kinds), np.uint64)
        np.add.at(totals, where, counts)
        each, cuts = totals[where], np.cumsum([0, *own["n"]])
        word = (kinds & np.uint64(1)).astype(bool)
        out = own[["chunk", "range", "n"]].assign(totals=[pack_ints(each[a:b]) for a, b in zip(cuts[:-1], cuts[1:])],
                                                  n_words=None, n_kinds=None, n_docs=None)
        sums = pd.DataFrame({"chunk": [-1], "range": [key[0]], "n": [0], "totals": [b""], "n_words": [int(totals[word].sum())],
                             "n_kinds": [int((totals[word] > 0).sum())], "n_docs": [int(totals[kinds == end_key].sum())]})
        return pd.concat([sums, out.astype(object)], ignore_index=True)

    def meet(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        names = [x.split()[0] for x in TOKENS.split(", ")]
        if not len(own):  # the sums of all ranges
            return pd.DataFrame([(None, None, None, None, None, int(a.n_words), int(a.n_kinds), int(a.n_docs)) for a in answers.itertuples()],
                                columns=names).astype(object)
        chunk = Chunk(own, of, rest)
        answers = answers.sort_values("range")
        totals = np.concatenate([unpack_ints(t) for t in answers["totals"]])
        if len(totals) != len(chunk.keys):
            raise ValueError("answers do not match the chunk's keys")
        word, pair = totals[chunk.word_at], totals[chunk.pair_at]
        spans = list(zip(chunk.bounds[:-1], chunk.bounds[1:]))
        return pd.DataFrame([(d, bool(h), int(b - a), pack_ints(word[a:b]), pack_ints(pair[a:b]), None, None, None)
                             for d, h, (a, b) in zip(chunk.doc_ids, chunk.held, spans)], columns=names).astype(object)

    by_chunk = dealt.groupBy("chunk")
    answers = by_chunk.applyInPandas(send, MESSAGE).groupBy("range").applyInPandas(add_up, ANSWER)
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInPandas(meet, TOKENS)


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else 1 + the power of two that its count reaches."""
    return np.where(context > 0, np.frexp(np.maximum(context, 1).astype(float))[1], 0)


def contexts(word_totals: np.ndarray, n_docs: int) -> np.ndarray:
    """Training count of each token's context: the start of a text, then the word before."""
    return np.concatenate([[n_docs], word_totals[:-1].astype(np.int64)])


def deleted_cells(tokens: DataFrame, n_words: int, n_docs: int) -> pd.DataFrame:
    """Training tokens by context bucket and shares without the token itself, on the grid."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in slices([len(w) for w in batch["word_totals"]], TOKENS_AT_ONCE):
                words = [unpack_ints(w).astype(np.int64) for w in batch["word_totals"].iloc[a:b]]
                context = np.concatenate([contexts(w, n_docs) for w in words]) - 1
                word = np.concatenate(words) - 1
                pair = np.concatenate([unpack_ints(p).astype(np.int64) for p in batch["pair_totals"].iloc[a:b]]) - 1
                shares = []
                for part, whole in ((pair, context), (word, np.int64(n_words - 1))):
                    some = (part > 0) & (whole > 0)
                    share = np.log2(np.where(some, part, 1) / np.where(some, whole, 1))
                    shares.append(np.where(some, np.rint(share * GRID), NEVER).astype(np.int64))
                cells = pd.DataFrame({"bucket": bucket_of(context), "pair": shares[0], "word": shares[1]})
                yield cells.groupby(["bucket", "pair", "word"]).size().rename("n").reset_index()

    rows = tokens.where("not held_out").select("word_totals", "pair_totals")
    return rows.mapInPandas(run, "bucket int, pair int, word int, n long").groupBy("bucket", "pair", "word").agg(
        F.sum("n").alias("n")).toPandas().sort_values(["bucket", "pair", "word"])


def learn_weights(cells: pd.DataFrame, n_words: int, n_kinds: int) -> np.ndarray:
    """(65, 3): weights of the add-one, word and pair shares in each context bucket, by expectation maximisation."""
    weights = np.tile([0.1, 0.3, 0.6], (65, 1))
    weights[0] = [0.25, 0.75, 0.0]
    if n_words < 2:
        return np.tile([1.0, 0.0, 0.0], (65, 1))
    b, n = cells["bucket"].to_numpy(), cells["n"].to_numpy(float)
    p2, p1 = (np.where(cells[c] == NEVER, 0.0, np.exp2(np.maximum(cells[c], -2000) / GRID)) for c in ("pair", "word"))
    p0 = (p1 * (n_words - 1) + 1) / (n_words + n_kinds)
    shares = np.stack([p0, p1, p2], axis=1)
    for _ in range(ROUNDS):
        part = weights[b] * shares
        part *= (n / part.sum(axis=1))[:, None]
        new = np.stack([np.bincount(b, part[:, j], 65) for j in range(3)], axis=1) + weights
        weights = new / new.sum(axis=1, keepdims=True)
    return weights


def score_texts(docs: DataFrame, of: int = 7, rest: int = 2) -> DataFrame:
    """Scores of every row, learned from rows whose crc32 of the doc_id's text mod ``of`` is not ``rest``."""
    tokens = settle(token_totals(docs, of, rest), "zstd")
    n_words, n_kinds, n_docs = (int(x or 0) for x in tokens.agg(F.sum("n_words"), F.sum("n_kinds"), F.sum("n_docs")).first())
    texts = tokens.where("n_tokens is not null")
    weights = learn_weights(deleted_cells(texts, n_words, n_docs), n_words, n_kinds)
    floor = n_words + n_kinds + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            base, score, known = [], [], []
            for w, p in zip(batch["word_totals"], batch["pair_totals"]):
                word, pair = unpack_ints(w).astype(np.int64), unpack_ints(p).astype(float)
                context = contexts(word, n_docs)
                low = (word + 1) / floor
                own = weights[bucket_of(context)]
                mixed = own[:, 0] * low + own[:, 1] * word / max(n_words, 1) + own[:, 2] * pair / np.maximum(context, 1)
                base.append(np.log10(low).sum())
                score.append(np.log10(mixed).sum())
                known.append((word > 0).sum())
            yield batch[["doc_id", "held_out", "n_tokens"]].assign(n_known=known, train_tokens=n_words, base_score=base, score=score)

    return texts.select("doc_id", "held_out", "n_tokens", "word_totals", "pair_totals").mapInPandas(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
