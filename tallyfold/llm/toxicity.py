"""Toxicity by a linear-chain conditional random field over words.

1. From the labelled training rows: in how many toxic and clean documents each word, and each four-letter beginning
   of a word, occurs. Those that lean to toxic documents form the lexicon, with their log odds.
2. Training tokens are tagged toxic where a toxic document has a word of high odds. The field's features are the odds
   classes of a word and of its neighbours, and the tags of neighbours. Its weights are fitted on a bounded sample of
   labelled documents (SAMPLE_DOCS of each label, SAMPLE_WORDS words of each: of a longer one the window that has most
   words of the lexicon); so is the step from marginals to a document's score.
3. Every whole document is tagged: forward-backward marginals give its score and the offsets of toxic spans.

Labels, language, source and doc_id are no inputs of a score. Words are runs other than space and 0x09-0x0D; lower
case A-Z, punctuation at the ends is stripped.

Defined cases: null and empty texts score as a text without toxic words; a doc_id labelled twice is toxic if one label
says so; null labels are none; without a toxic and a clean training row every score is 0; rows with a null doc_id are
scored, and not held out; an empty table gives no row. Other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.store import settle, small
from tallyfold.llm.words import encoded, slices

SAMPLE_DOCS, SAMPLE_WORDS = 600, 2000
#: A lexicon entry occurs in so many toxic training documents and in such a share of them at least.
LEAST_DOCS, LEAST_SHARE = 5, 0.002
#: Log odds from which the odds classes 1, 2, ... start, and those from which a word of a toxic document is tagged.
ODDS_STEPS, TAG_ODDS = (1.0, 2.0, 3.0, 4.5, 6.0), 3.0
CLASSES = len(ODDS_STEPS) + 1
CODES = CLASSES * CLASSES
ROUNDS, STEP, DECAY = 150, 0.15, 1e-4
REMEMBERED_WORDS = 400_000
_ENDS = b".,;:!?\"'()[]{}*#$%&|<>-_"
_WORD = re.compile("[^\x20\x09-\x0d]+")


def parts_of(word: bytes) -> tuple[bytes, bytes]:
    """Keys of the lexicon for a lower-case word: the word and its beginning."""
    bare = word.strip(_ENDS)
    return b"w" + bare, b"b" + (bare[:4] if bare.isascii() else bare.decode("utf-8", "replace")[:4].encode("utf-8"))


class Field(NamedTuple):
    """Scores of tag 1 over tag 0 by the code of the word, the one before and the one after; of tags by place."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    start: np.ndarray
    moves: np.ndarray


def _matrices(score: np.ndarray, first: np.ndarray, field: Field) -> np.ndarray:
    """(n, 2, 2): weight of going from the tag before to the tag here; a text's first word forgets the tag before."""
    m = np.where(first[:, None, None], field.start[None, None, :], field.moves[None])
    m = m + np.stack([np.zeros_like(score), score], axis=1)[:, None, :]
    return np.exp(m - m.max(axis=(1, 2), keepdims=True))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    c = np.empty_like(a)
    for i in (0, 1):
        for j in (0, 1):
            c[:, i, j] = a[:, i, 0] * b[:, 0, j] + a[:, i, 1] * b[:, 1, j]
    return c / c.max(axis=(1, 2), keepdims=True)


def forward_backward(score: np.ndarray, first: np.ndarray, field: Field):
    """Matrices, forward and backward vectors of all words, those of many texts one after the other.

    Words are cut into blocks whose products are formed side by side; a pass over the blocks links them.
    """
    n = len(score)
    m = _matrices(score, first, field)
    length = max(1, int(np.sqrt(n)))
    blocks = -(-n // length)
    padded = np.concatenate([m, np.ones((blocks * length - n, 2, 2))]).reshape(blocks, length, 2, 2)
    head, tail = np.empty_like(padded), np.empty_like(padded)
    head[:, 0] = padded[:, 0]
    for t in range(1, length):
        head[:, t] = _product(head[:, t - 1], padded[:, t])
    tail[:, length - 1] = np.eye(2)
    for t in range(length - 2, -1, -1):
        tail[:, t] = _product(padded[:, t + 1], tail[:, t + 1])
    into, out = np.empty((blocks, 2)), np.empty((blocks, 2))
    vector = np.full(2, 0.5)
    for b in range(blocks):
        into[b] = vector
        vector = vector @ head[b, -1]
        vector = vector / vector.sum()
    vector = np.full(2, 0.5)
    for b in range(blocks - 1, -1, -1):
        out[b] = vector
        vector = padded[b, 0] @ (tail[b, 0] @ vector)
        vector = vector / vector.sum()
    alpha = (into[:, None, :, None] * head).sum(axis=2).reshape(-1, 2)[:n]
    beta = (tail * out[:, None, None, :]).sum(axis=3).reshape(-1, 2)[:n]
    return m, alpha / alpha.sum(axis=1, keepdims=True), beta / beta.sum(axis=1, keepdims=True)


def _marginals(alpha: np.ndarray, beta: np.ndarray) -> np.ndarray:
    both = alpha * beta
    return both[:, 1] / both.sum(axis=1)


def neighbours(code: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words before and after in the same text; 0 at its ends."""
    before, after = np.zeros_like(code), np.zeros_like(code)
    before[1:], after[:-1] = code[:-1], code[1:]
    before[first] = 0
    after[:-1][first[1:]] = 0
    return before, after


def scores(code: np.ndarray, first: np.ndarray, field: Field) -> np.ndarray:
    before, after = neighbours(code, first)
    return field.own[code] + field.before[before] + field.after[after]


def word_marginals(code: np.ndarray, first: np.ndarray, field: Field) -> np.ndarray:
    """Probability of the toxic tag for every word."""
    if not len(code):
        return np.zeros(0)
    _, alpha, beta = forward_backward(scores(code, first, field), first, field)
    return _marginals(alpha, beta)


def fit_field(code: np.ndarray, first: np.ndarray, tag: np.ndarray) -> Field:
    """Maximum likelihood with a small penalty, by Adam."""
    sizes = [CODES, CODES, CODES, 2, 4]
    cuts = np.cumsum([0, *sizes])
    x, mean, spread = np.zeros(cuts[-1]), np.zeros(cuts[-1]), np.zeros(cuts[-1])
    before, after = neighbours(code, first)
    inner = np.flatnonzero(~first)

    def unpack(x: np.ndarray) -> Field:
        a, b, c, s, m = (x[p:q] for p, q in zip(cuts[:-1], cuts[1:]))
        return Field(a, b, c, s, m.reshape(2, 2))

    seen_moves = np.bincount(2 * tag[inner - 1] + tag[inner], minlength=4) if len(inner) else np.zeros(4)
    seen_start = np.bincount(tag[first], minlength=2)
    for k in range(1, ROUNDS + 1):
        field = unpack(x)
        m, alpha, beta = forward_backward(field.own[code] + field.before[before] + field.after[after], first, field)
        p = _marginals(alpha, beta)
        off = tag - p
        pair = alpha[inner - 1][:, :, None] * m[inner] * beta[inner][:, None, :]
        pair = (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0) if len(inner) else np.zeros((2, 2))
        start = np.array([(1 - p[first]).sum(), p[first].sum()])
        grad = np.concatenate([*(np.bincount(c, off, CODES) for c in (code, before, after)), seen_start - start,
                               seen_moves - pair.ravel()]) / len(code) * 100 - DECAY * x
        mean, spread = 0.9 * mean + 0.1 * grad, 0.999 * spread + 0.001 * grad * grad
        x = x + STEP * (mean / (1 - 0.9**k)) / (np.sqrt(spread / (1 - 0.999**k)) + 1e-8)
    return unpack(x)


class Model(NamedTuple):
    lexicon: dict[bytes, float]
    field: Field
    weights: np.ndarray  # of constant, log(1 + sum of marginals), largest marginal, mean marginal


class _CodeOf(dict):
    """Code of a word from the odds classes of its parts; forgets all when it holds many."""

    def __init__(self, lexicon: dict[bytes, float]):
        super().__init__()
        self.classes = {k: bisect_right(ODDS_STEPS, v) for k, v in lexicon.items()}

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED_WORDS:
            self.clear()
        whole, begin = parts_of(word)
        self[word] = code = self.classes.get(whole, 0) * CLASSES + self.classes.get(begin, 0)
        return code


def coded(texts: list[bytes], code_of: _CodeOf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all words, marks of first words, and each text's range."""
    per_text = [t.lower().split() for t in texts]
    bounds = np.cumsum([0, *map(len, per_text)])
    code = np.fromiter(map(code_of.__getitem__, chain.from_iterable(per_text)), np.int64, int(bounds[-1]))
    first = np.zeros(len(code), bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    return code, first, bounds


def summary(p: np.ndarray) -> list[float]:
    return [1.0, float(np.log1p(p.sum())), float(p.max()), float(p.mean())] if len(p) else [1.0, 0.0, 0.0, 0.0]


def _fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - p)) - 0.1 * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(hess, grad), -2, 2)
    return w


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _count_keys(rows: DataFrame, known: set[bytes] | None) -> DataFrame:
    """key, n: documents that have it; only known keys if given."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = encoded(batch["text"])
            for a, b in slices([len(t) for t in texts]):
                found: Counter = Counter()
                for t in texts[a:b]:
                    keys = {x for w in set(t.lower().split()) for x in parts_of(w)}
                    found.update(keys if known is None else keys & known)
                yield pd.DataFrame({"key": list(found), "n": list(found.values())})

    return rows.select("text").mapInPandas(run, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))


def densest(text: bytes, lexicon: dict[bytes, float]) -> bytes:
    """The text, or of more than SAMPLE_WORDS words the first window of as many that has most in the lexicon."""
    words = text.split()
    if len(words) <= SAMPLE_WORDS:
        return text
    known = np.cumsum([0, *[any(p in lexicon for p in parts_of(w.lower())) for w in words]])
    at = int(np.argmax(known[SAMPLE_WORDS:] - known[:-SAMPLE_WORDS]))
    return b" ".join(words[at : at + SAMPLE_WORDS])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model | None:
    """Lexicon from all labelled training rows, weights from a bounded sample of them."""
    key = F.col("doc_id").cast("long")
    marks = settle(labels.where(key.isNotNull() & F.col(label).isNotNull() & ~held_out(key)).groupBy(key.alias("own_id")).agg(
        F.max(F.col(label).cast("int")).alias("y")))
    texts = docs.select(key.alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = settle(texts.join(small(marks), key == F.col("own_id")).select("doc_id", "text", "y"))
    totals = dict(rows.groupBy("y").count().collect())
    if not totals.get(0) or not totals.get(1):
        return None
    least = max(LEAST_DOCS, LEAST_SHARE * totals[1])
    # every document has its keys once, so there are at most 1 / LEAST_SHARE times the keys of a mean document
    toxic = {bytes(r[0]): r[1] for r in _count_keys(rows.where("y = 1"), None).where(F.col("n") >= least).collect()}
    clean = {bytes(r[0]): r[1] for r in _count_keys(rows.where("y = 0"), set(toxic)).collect()}
    odds = {k: float(np.log((n + 0.5) / (totals[1] + 1)) - np.log((clean.get(k, 0) + 0.5) / (totals[0] + 1))) for k, n in toxic.items()}
    lexicon = {k: v for k, v in odds.items() if v >= ODDS_STEPS[0]}
    mark = F.xxhash64("doc_id", "text")

    def chosen_of(y: int) -> DataFrame:
        """Rows of least hash. Most are left out before the sort, which then sees a few times SAMPLE_DOCS rows."""
        own = rows.where(F.col("y") == y)
        share = 4 * SAMPLE_DOCS / max(1, totals[y])
        least = own.where((mark / F.lit(2.0**64) + 0.5) < share) if share < 1 else own
        return least.orderBy(mark, "doc_id").limit(SAMPLE_DOCS)

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"text": [densest(t, lexicon) for t in encoded(batch["text"])], "y": batch["y"]})

    chosen = [chosen_of(y) for y in (0, 1)]
    sample = chosen[0].union(chosen[1]).mapInPandas(windows, "text binary, y int").toPandas()
    code, first, bounds = coded([bytes(t) for t in sample["text"]], _CodeOf(lexicon))
    y = sample["y"].to_numpy()
    tagged = bisect_right(ODDS_STEPS, TAG_ODDS)
    high = (code // CLASSES >= tagged) | (code % CLASSES >= tagged)
    tag = (high & (np.repeat(y, np.diff(bounds)) == 1)).astype(np.int64)
    if not len(code):
        return None
    field = fit_field(code, first, tag)
    p = word_marginals(code, first, field)
    x = np.array([summary(p[a:b]) for a, b in zip(bounds[:-1], bounds[1:])])
    weight = np.where(y == 1, totals[1] / max(1, y.sum()), totals[0] / max(1, (1 - y).sum()))
    return Model(lexicon, field, _fit_logistic(x, y, weight / weight.mean()))


def spans_of(text: str, p: np.ndarray) -> list[dict]:
    """Character offsets of runs of words whose toxic tag is likelier than not."""
    out: list[dict] = []
    last = -2
    for i, word in enumerate(_WORD.finditer(text)):
        if p[i] >= 0.5:
            if i == last + 1:
                out[-1] |= {"end": word.end(), "p": max(out[-1]["p"], float(p[i]))}
            else:
                out.append({"start": word.start(), "end": word.end(), "p": float(p[i])})
            last = i
    return out


def score_toxicity(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score, predicted and spans of every whole text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code_of = _CodeOf(model.lexicon) if model else None
        for batch in batches:
            texts = encoded(batch["text"])
            for a, b in slices([len(t) for t in texts]):
                score, spans = np.zeros(b - a), [[] for _ in range(b - a)]
                if model:
                    code, first, bounds = coded(texts[a:b], code_of)
                    p = word_marginals(code, first, model.field)
                    own = [p[i:j] for i, j in zip(bounds[:-1], bounds[1:])]
                    x = np.array([summary(q) for q in own])
                    score = 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))
                    spans = [spans_of(t.decode("utf-8", "surrogatepass"), q) if len(q) and q.max() >= 0.5 else []
                             for t, q in zip(texts[a:b], own)]
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[a:b].array, "score": score,
                                    "predicted": (score >= 0.5).astype(np.int32), "spans": spans})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(
        run, "doc_id long, score double, predicted int, spans array<struct<start: int, end: int, p: double>>")
