"""Quality rules by the divergence of a document's histograms from those of its language.

References are gathered from all documents: for every language the shares of character classes, and of its common
words, which are the words that make up COMMON_SHARE of its words or more (so there are 1 / COMMON_SHARE at most). Such
a word has that share in at least one part of the texts, so parts name candidates and a second pass counts them.
A document is rejected if the Jensen-Shannon distance of one of its histograms is above its limit for its own
language and for every other, as a language may be named wrongly. Short texts, and languages of which little is
known, are not judged that way.

Base rules come first: fewer than ten words, or more than a fifth of the words in repeated five-word windows.

Words are runs other than space and 0x09-0x0D, as they are written. Defined cases: null and empty texts have no words
and fail the base rules; a null language is a language of its own; equal rows are judged alike, each by itself; an
empty table gives no row. Other columns are carried along by ``good_documents``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.store import settle
from tallyfold.llm.words import SHINGLE, encoded, give_back, slices, sparing, windows, words_of

COMMON_SHARE = 0.002
#: Words of a language after which a task names its candidates.
PART_WORDS = 500_000
#: Distances (0 to 1) above which a document is rejected, and the characters or words it must have to be judged.
CHAR_LIMIT, WORD_LIMIT = 0.33, 0.45
LEAST_CHARS, LEAST_WORDS = 200, 100
#: Words of a language that must be known, else its documents are not judged by it.
LEAST_REFERENCE = 20_000
#: Bytes of texts that are cut into words at once.
SLICE_BYTES = 1 << 19
SYMBOLS = "#*$%&|<>"
N_CLASSES = 9
VERDICT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "char_distance double, word_distance double, base_failed boolean, kept boolean")


def _class_table() -> np.ndarray:
    """Class of the code points below 192: vowels, other small letters, capitals, digits, blanks, line ends,
    sentence marks, other marks, all else. Code points from 192 count as letters beyond ASCII, with class 8."""
    table = np.full(192, 7, np.uint8)
    for marks, kind in (("aeiou", 0), ("bcdfghjklmnpqrstvwxyz", 1), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), ("0123456789", 3),
                        (" \t\x0b\x0c", 4), ("\n\r", 5), (".,;:!?'\"()-", 6)):
        table[[ord(c) for c in marks]] = kind
    return table


_CLASS = _class_table()


def char_counts(text: bytes) -> np.ndarray:
    points = np.frombuffer(text.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.full(len(points), 8, np.uint8)
    low = points < 192
    kinds[low] = _CLASS[points[low]]
    return np.bincount(kinds, minlength=N_CLASSES)


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance with base 2; both have a positive sum."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return float(np.sqrt(max(0.0, parts.sum() / 2)))


def _by_lang(batch: pd.DataFrame) -> Iterator[tuple[str | None, list[bytes]]]:
    texts, langs = encoded(batch["text"]), [None if pd.isna(x) else str(x) for x in batch["lang"]]
    for a, b in slices([len(t) for t in texts], SLICE_BYTES):
        groups: dict = {}
        for lang, text in zip(langs[a:b], texts[a:b]):
            groups.setdefault(lang, []).append(text)
        yield from groups.items()


def references(docs: DataFrame) -> dict:
    """lang -> (share of character classes, index of common words, their counts with the rest at the end)."""
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}

        def common(lang) -> pd.DataFrame:
            found = held.pop(lang)
            least = COMMON_SHARE * found.total()
            words = [w for w, n in found.items() if n >= least]
            return pd.DataFrame({"lang": pd.Series([lang] * len(words), dtype=object), "word": pd.Series(words, dtype=object)})

        for batch in sparing(batches):
            for lang, texts in _by_lang(batch):
                found = held.setdefault(lang, Counter())
                for t in texts:
                    found.update(t.split())
                if found.total() >= PART_WORDS:
                    yield common(lang)
        for lang in list(held):
            yield common(lang)

    named: dict = {}
    for r in rows.mapInPandas(candidates, "lang string, word binary").distinct().collect():
        named.setdefault(r["lang"], set()).add(bytes(r["word"]))

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}  # of a task: no more words than candidates
        for batch in sparing(batches):
            for lang, texts in _by_lang(batch):
                own = held.setdefault(lang, [0, np.zeros(N_CLASSES, np.int64), Counter()])
                wanted = named.get(lang, ())
                for t in texts:
                    words = t.split()
                    own[0] += len(words)
                    own[1] += char_counts(t)
                    own[2].update([w for w in words if w in wanted])
        for lang, (n, chars, found) in held.items():
            kinds = ["all"] + ["char"] * N_CLASSES + ["word"] * len(found)
            keys = [b""] + [b"%d" % i for i in range(N_CLASSES)] + list(found)
            yield pd.DataFrame({"lang": [lang] * len(kinds), "kind": kinds, "key": keys, "n": [n, *chars.tolist(), *found.values()]})

    out: dict = {}
    summed = rows.mapInPandas(counts, "lang string, kind string, key binary, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    for r in summed.collect():
        own = out.setdefault(r["lang"], {"all": 0, "char": np.zeros(N_CLASSES), "word": {}})
        if r["kind"] == "all":
            own["all"] = r["n"]
        elif r["kind"] == "char":
            own["char"][int(r["key"])] = r["n"]
        else:
            own["word"][bytes(r["key"])] = r["n"]
    tables = {}
    for lang, own in out.items():
        if own["all"] >= LEAST_REFERENCE:
            common = sorted(w for w, n in own["word"].items() if n >= COMMON_SHARE * own["all"])
            known = [own["word"][w] for w in common]
            tables[lang] = (own["char"], {w: i for i, w in enumerate(common)}, np.array([*known, own["all"] - sum(known)], float))
    return tables


def _repeated_words(texts: list[bytes]) -> list[int]:
    """Words in five-word windows that a text has twice or more, the first included."""
    words = words_of(texts, lower=False)
    hashes, full = windows(words)
    out = []
    for a, b in zip(words.bounds[:-1], words.bounds[1:]):
        own = hashes[a:b][full[a:b]]
        _, where, times = np.unique(own, return_inverse=True, return_counts=True)
        again = np.concatenate([times[where] > 1, np.zeros(SHINGLE - 1, bool)]) if len(own) else np.zeros(0, bool)
        covered = again.copy()
        for j in range(1, SHINGLE):
            covered[j:] |= again[:-j] if len(again) else again
        out.append(int(covered.sum()))
    return out


def _dup_lines(text: bytes) -> int:
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line.split():
            n += line in seen
            seen.add(line)
    return n


def _word_distance(words: list[bytes], table: tuple) -> float:
    at = np.fromiter((table[1].get(w, len(table[1])) for w in words), np.int64, len(words))
    return distance(np.bincount(at, minlength=len(table[2])).astype(float), table[2])


def _judge(texts: list[bytes], langs: list, tables: dict) -> pd.DataFrame:
    out = []
    for text, lang, n_repeat in zip(texts, langs, _repeated_words(texts)):
        words, table = text.split(), tables.get(lang)
        n, chars = len(words), char_counts(text)
        n_chars = int(chars.sum())
        blanks = sum(text.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
        failed = n < 10 or 100 * n_repeat > 20 * n
        by_char = by_word = None
        if table and n_chars >= LEAST_CHARS:
            by_char = distance(chars.astype(float), table[0])
        if table and n >= LEAST_WORDS:
            by_word = _word_distance(words, table)
        others = [x for x in tables.values() if x is not table]
        far = (by_char is not None and by_char > CHAR_LIMIT and all(distance(chars.astype(float), x[0]) > CHAR_LIMIT for x in others)) or (
            by_word is not None and by_word > WORD_LIMIT and all(_word_distance(words, x) > WORD_LIMIT for x in others))
        out.append((n, n_chars - blanks, sum(text.count(c.encode()) for c in SYMBOLS), _dup_lines(text), n_repeat,
                    by_char, by_word, failed, not failed and not far))
    return pd.DataFrame(out, columns=[x.split()[0] for x in VERDICT.split(", ")])


def judged(docs: DataFrame, tables: dict, *carried: str) -> DataFrame:
    """The carried columns of every row with its measures and verdict."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in sparing(batches):
            texts, langs = encoded(batch["_text"]), [None if pd.isna(x) else str(x) for x in batch["_lang"]]
            for a, b in slices([len(t) for t in texts], SLICE_BYTES):
                found = _judge(texts[a:b], langs[a:b], tables)
                found.index = batch.index[a:b]
                yield pd.concat([batch[list(carried)].iloc[a:b], found], axis=1)

    kept = docs.select(*carried).schema
    rows = docs.select(*carried, F.col("text").cast("string").alias("_text"), F.col("lang").cast("string").alias("_lang"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return rows.mapInPandas(run, fields + VERDICT)


def quality_report(docs: DataFrame) -> DataFrame:
    """doc_id and all measures of every row."""
    return judged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang"), references(docs), "doc_id")


def good_documents(docs: DataFrame) -> DataFrame:
    """``docs`` without the rejected rows. The verdict is a predicate over text and lang, so no row is shuffled."""
    tables = references(docs)

    def keep(text: pd.Series, lang: pd.Series) -> pd.Series:
        texts, langs = encoded(text), [None if pd.isna(x) else str(x) for x in lang]
        found = [_judge(texts[a:b], langs[a:b], tables)["kept"] for a, b in slices([len(t) for t in texts], SLICE_BYTES)]
        del texts
        give_back()
        return pd.concat(found, ignore_index=True).astype(bool) if found else pd.Series([], dtype=bool)

    verdict = F.pandas_udf(keep, "boolean")
    return docs.where(verdict(F.col("text").cast("string"), F.col("lang").cast("string")))
