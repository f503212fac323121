"""Token ids as directly addressable codes.

The ids of a segment are cut into 8-bit chunks. Level 0 holds the lowest chunk of every id, level 1 the next
chunk of those ids that have one, and so on. A bitmap for each level but the last tells which ids go on, and a
directory counts its ones before every 512 bits, so the place of id i on the next level is one lookup and a
count within one block: any token is read without decoding its neighbours.

Defined cases: a null or empty text has the end id alone; rows with a null doc_id come first; rows with equal
doc_id follow each other by text; an empty table gives no segment. Other columns of the input are not read.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.store import settle, small
from tallyfold.llm.words import SLICE_BYTES, encoded, slices, words_of

CHUNK_BITS, BLOCK_WORDS = 8, 8
MAGIC = b"DAC1"
#: A segment is closed when it has as many tokens.
SEGMENT_TOKENS = 1 << 20
#: Words whose ids a worker remembers; it forgets all when there are more.
REMEMBERED_WORDS = 800_000
#: Word that is put between words which are tokenized together, and how many of those there are.
MARK, JOIN, AT_ONCE = b"\x00", b" \x00 ", 400
STOPS = b".,;:!?&$*%#"
#: Bytes of ASCII and of U+00C0 to U+023F: single letters but for two signs, none of which a neighbour changes. One grows a mark when lowered.
_LATIN = bytes([*range(0xC0), *range(0xC3, 0xC9)])
_DOTTED = b"\xc4\xb0"
SEGMENT = "part int, seq int, n_tokens long, doc_ids array<long>, sizes array<long>, payload binary"


def pack(ids: np.ndarray) -> bytes:
    """Ids below 2**32 as chunk levels, bitmaps and rank directories."""
    rest, levels = np.asarray(ids, np.uint32), []
    while True:
        chunk = (rest & np.uint32(255)).astype(np.uint8)
        more = rest > 255
        if not more.any():
            levels.append(struct.pack("<Q", len(chunk)) + chunk.tobytes())
            break
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (8 * BLOCK_WORDS), np.uint8)])
        ones = np.bitwise_count(bits.reshape(-1, 8 * BLOCK_WORDS)).sum(axis=1, dtype=np.uint32)
        ranks = (np.cumsum(ones) - ones).astype("<u4")
        levels.append(struct.pack("<Q", len(chunk)) + chunk.tobytes() + bits.tobytes() + ranks.tobytes())
        rest = rest[more] >> np.uint32(CHUNK_BITS)
    return MAGIC + struct.pack("<BQ", len(levels), len(ids)) + b"".join(levels)


class Codes:
    """Reader of one packed segment."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a segment of token codes")
        n_levels, self.n = struct.unpack_from("<BQ", payload, 4)
        at, self.levels = 13, []
        for level in range(n_levels):
            (n,) = struct.unpack_from("<Q", payload, at)
            chunk = np.frombuffer(payload, np.uint8, n, at + 8)
            at += 8 + n
            bits = ranks = None
            if level < n_levels - 1:
                blocks = -(-n // (64 * BLOCK_WORDS))
                bits = np.frombuffer(payload, np.uint8, 8 * BLOCK_WORDS * blocks, at)
                ranks = np.frombuffer(payload, "<u4", blocks, at + len(bits))
                at += len(bits) + 4 * blocks
            self.levels.append((chunk, bits, ranks))

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, (chunk, bits, ranks) in enumerate(self.levels):
            value |= int(chunk[i]) << (CHUNK_BITS * level)
            if bits is None or not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // (64 * BLOCK_WORDS)
            before = bits[block * 8 * BLOCK_WORDS : i >> 3]
            i = int(ranks[block]) + int(np.bitwise_count(before).sum()) + int(bits[i >> 3] & ((1 << (i & 7)) - 1)).bit_count()
        return value

    def all(self) -> np.ndarray:
        value = np.zeros(0, np.uint32)
        for chunk, bits, _ in reversed(self.levels):
            here = chunk.astype(np.uint32)
            if bits is not None:
                more = np.unpackbits(bits, count=len(chunk), bitorder="little").astype(bool)
                here[more] |= value << np.uint32(CHUNK_BITS)
            value = here
        return value


_STOP, _PLAIN = np.zeros(256, bool), np.zeros(256, bool)
_STOP[list(STOPS)] = True
_PLAIN[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True


def spaced(texts: list[bytes]) -> list[bytes]:
    """Texts of the same ids, with small letters of ASCII and a space between these and a stop, so that they have fewer distinct words.

    Texts with marks that change a letter before them, or with special tokens, stay.
    """
    at = [i for i, t in enumerate(texts) if b"<|" not in t and b"\xcc" not in t and b"\xcd" not in t]
    joined = b" ".join([texts[i] for i in at]).lower()
    data = np.frombuffer(joined, np.uint8)
    cuts = np.flatnonzero(_STOP[data[1:]] & _PLAIN[data[:-1]]) + 1
    joined = np.insert(data, cuts, 32).tobytes()
    ends = np.cumsum([len(texts[i]) + 1 for i in at]) - 1
    ends += np.searchsorted(cuts, ends)
    out, begin = list(texts), 0
    for i, end in zip(at, ends.tolist()):
        out[i], begin = joined[begin:end], end + 1
    return out


def latin(word: bytes) -> bool:
    """Whether lowering and cutting its bytes is lowering and cutting its letters."""
    return word.isascii() or not word.translate(None, _LATIN) and _DOTTED not in word


def ends_in_letter(word: bytes) -> bool:
    """Whether the last character of a latin word is a letter or digit."""
    return word[-1:].isalnum() or word[-1:] > b"\x7f" and word[-2:].decode().isalpha()


class TextEncoder:
    """Ids of texts by the ids of their words, each of which the tokenizer sees once.

    Holds for tokenizers that lower all letters, drop white space and never join characters across it, nor a letter or
    digit with a stop after it, as the one in use does. Where pieces that end a run of letters are marked in the
    vocabulary, words of letters need no mark between them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.mark,) = self.tokenizer.encode(MARK.decode(), add_special_tokens=False).ids
        if hasattr(self.tokenizer.model, "_resize_cache"):
            # it would look up every word, none of which comes twice
            self.tokenizer.model._resize_cache(0)
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if suffix:
            self.last[[i for piece, i in self.tokenizer.get_vocab().items() if piece.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.n = self.used = 0
        self.begin, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.uint32)

    def _add(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        need, used = self.n + len(words), self.used + len(ids)
        if need > len(self.begin):
            self.begin, self.size = (np.resize(a, 2 * need) for a in (self.begin, self.size))
        if used > len(self.ids):
            self.ids = np.resize(self.ids, 2 * used)
        self.size[self.n : need] = sizes
        self.begin[self.n : need] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used : used] = ids
        self.index.update(zip(words, range(self.n, need)))
        self.n, self.used = need, used

    def _joined(self, words: list[bytes], between: bytes) -> Iterator[tuple[list[bytes], np.ndarray]]:
        """Words and the ids of their joined text, many at once."""
        own = [words[i : i + AT_ONCE] for i in range(0, len(words), AT_ONCE)]
        texts = [between.join(x).decode("utf-8", "surrogatepass") for x in own]
        for x, e in zip(own, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            yield x, np.array(e.ids, np.uint32)

    def _tokenize(self, words: list[bytes]) -> None:
        """New words, many in a text: of letters beside each other, others with a mark between them whose id nothing else has."""
        letters, plain, odd = [], [], []
        for w in words:
            if w.isalpha() or not w.isascii() and latin(w) and w.decode().isalpha():
                letters.append(w)
            elif MARK in w:
                odd.append(w)
            else:
                plain.append(w)
        for own, ids in self._joined(letters, b" "):
            cut = np.flatnonzero(self.last[ids])
            if len(cut) == len(own) and cut[-1] == len(ids) - 1:
                self._add(own, ids, np.diff(cut, prepend=-1))
            else:
                plain += own
        for own, ids in self._joined(plain, JOIN):
            cut = np.flatnonzero(ids == self.mark)
            if len(cut) != len(own) - 1:
                raise ValueError("the tokenizer does not keep words apart")
            self._add(own, np.delete(ids, cut), np.diff(np.concatenate([[-1], cut, [len(ids)]])) - 1)
        for w in odd:
            ids = self.tokenizer.encode(w.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids
            self._add([w], np.array(ids, np.uint32), np.array([len(ids)]))

    def _learn(self, words: list[bytes]) -> None:
        """Capitals of ASCII and stops of latin words are taken off first: the tokenizer lowers all letters and cuts between a
        letter and a stop, so what is left is known more often."""
        new = [w for w in words if w not in self.index]
        # no word has a line feed, so all are lowered at once
        lows = b"\n".join(new).lower().split(b"\n")
        heads = [low.rstrip(STOPS) for low in lows]
        simple, composed, firsts, seconds = [], [], [], []
        for w, low, head in zip(new, lows, heads):
            if w == head or not (w.isascii() or latin(w)) or b"<|" in w:
                simple.append(w)
            elif low != head and head and (head[-1:].isalnum() or ends_in_letter(head)):
                composed.append(w)
                firsts.append(head)
                seconds.append(low[len(head) :])
            elif low != w:
                composed.append(w)
                firsts.append(low)
                seconds.append(b"")
            else:
                simple.append(w)
        parts = dict.fromkeys(simple)
        parts.update(dict.fromkeys(p for p in {*firsts, *seconds} if p and p not in self.index))
        self._tokenize(list(parts))
        if composed:
            # both parts of every word, the second of which may be empty
            flat = [self.index.get(p, -1) for pair in zip(firsts, seconds) for p in pair]
            flat = np.array(flat, np.int64)
            counts = np.where(flat < 0, 0, self.size[flat])
            ends = np.cumsum(counts)
            ids = self.ids[np.repeat(self.begin[flat] - ends + counts, counts) + np.arange(int(counts.sum()))]
            self._add(composed, ids, counts.reshape(-1, 2).sum(axis=1))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if self.n > REMEMBERED_WORDS:
            self.forget()
        texts = spaced(texts)
        words = words_of(texts, lower=False)
        if not len(words.hash):
            return [np.zeros(0, np.uint32) for _ in texts]
        _, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
        text = np.searchsorted(words.bounds, first, "right") - 1
        own = [texts[d][s : s + n] for d, s, n in zip(text.tolist(), words.start[first].tolist(), words.size[first].tolist())]
        self._learn(own)
        at = np.fromiter(map(self.index.__getitem__, own), np.int64, len(own))[which]
        sizes = self.size[at]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.begin[at] - ends + sizes, sizes) + np.arange(int(sizes.sum()))]
        cuts = np.concatenate([[0], ends])[words.bounds]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


@lru_cache(maxsize=1)
def encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


def encode_segments(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Segments in ascending doc_id order: a range partition gives part, its segments follow by seq."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        own, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids: list = []
        held: list[np.ndarray] = []
        n = 0

        def segment() -> pd.DataFrame:
            sizes = [len(x) for x in held]
            return pd.DataFrame({"part": [part], "seq": [seq], "n_tokens": [n], "doc_ids": [list(doc_ids)],
                                 "sizes": [sizes], "payload": [pack(np.concatenate(held))]})

        for batch in batches:
            texts = encoded(batch["text"])
            ids = [None if pd.isna(d) else int(d) for d in batch["doc_id"]]
            for a, b in slices([len(t) for t in texts], SLICE_BYTES):
                for d, x in zip(ids[a:b], own.encode(texts[a:b])):
                    doc_ids.append(d)
                    held.append(np.append(x, np.uint32(end_id)))
                    n += len(x) + 1
                    if n >= SEGMENT_TOKENS:
                        yield segment()
                        doc_ids, held, n, seq = [], [], 0, seq + 1
        if held:
            yield segment()

    key = F.col("doc_id").cast("long")
    rows = docs.select(key.alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.repartitionByRange(F.asc_nulls_first("doc_id"), F.xxhash64("text")).sortWithinPartitions(
        F.asc_nulls_first("doc_id"), "text")
    return rows.mapInPandas(run, SEGMENT)


def with_start(segments: DataFrame) -> DataFrame:
    """Adds the tokens of all segments before. The window without a key has one row for each range partition."""
    before = segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        F.col("part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inner = Window.partitionBy("part").orderBy("seq")
    starts = segments.select("part", "seq", "n_tokens").join(before, "part").select(
        "part", "seq", (F.col("before") + F.sum("n_tokens").over(inner) - F.col("n_tokens")).alias("start"))
    return segments.join(small(settle(starts)), ["part", "seq"])


def read_documents(segments: DataFrame) -> DataFrame:
    """Documents of segments that have their start: first token, tokens and crc32 of the ids as little-endian words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start, doc_ids, sizes, payload in zip(batch["start"], batch["doc_ids"], batch["sizes"], batch["payload"]):
                ids = Codes(payload).all().astype("<u4")
                sizes = np.asarray(sizes, np.int64)
                ends = np.cumsum(sizes)
                sums = [zlib.crc32(ids[b - n : b]) for n, b in zip(sizes, ends)]
                keys = pd.array([None if pd.isna(d) else int(d) for d in doc_ids], "Int64")
                yield pd.DataFrame({"doc_id": keys, "start": start + ends - sizes, "n_tokens": sizes, "ids_crc32": sums})

    return segments.select("start", "doc_ids", "sizes", "payload").mapInPandas(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Writes the segment files and reads every document back from them."""
    return read_documents(with_start(settle(encode_segments(docs, tokenizer, end_id))))
