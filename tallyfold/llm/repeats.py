"""Exact repeats of byte strings across documents, by sorted suffixes of the pieces that may hold one.

A repeat is a string of WINDOW bytes that starts in two documents; the bytes it covers are removed from all of them
but those of the least doc_id. Equal strings have the same least hash of their SEED bytes long parts, so texts are cut
into pieces, runs of neighbouring windows with the same least hash, and pieces are dealt by it: each window is in one piece, and
equal windows meet in one task. Copies of a piece are resolved where they are read: all but the ones in the least document of
a slice of the input are removed there and not sent, so a text that occurs a million times is sent once for each slice.

A task sorts the suffixes of its pieces column by column (``suffixes.sorted_suffixes``), where different pieces of different
documents have the least hash and enough of the bytes beside it in common. Neighbours with WINDOW bytes in common are the classes of equal windows. Such collections
are taken hash by hash up to COLLECTION_BYTES, so the columns of a collection, which every round reads and writes
in sequence, are in memory; a single hash with more pieces is a collection of its own.

Defined cases: a null text is empty; a null doc_id is greater than any other; rows with equal doc_id do not remove each other's bytes;
texts shorter than WINDOW keep all; an empty table gives no rows. ``docs`` has to give the same rows whenever it is
read, as a table does. Other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.store import arrow_rows, settle
from tallyfold.llm.suffixes import sorted_suffixes
from tallyfold.llm.words import give_back, mix

WINDOW, SEED_BYTES = 50, 16
SEEDS_IN_WINDOW = WINDOW - SEED_BYTES + 1
#: Bytes that a window has at least on one side of any of its seeds.
SIDE = (WINDOW - SEED_BYTES) // 2
#: Text that is cut at once and of which copies are resolved, and the part of it that is hashed at once.
SLICE_BYTES, HASHED_BYTES = 1 << 23, 1 << 18
#: Text whose pieces go to one task, pieces that are sorted together, and rows and bytes that are handed over at once.
BUCKET_BYTES, COLLECTION_BYTES, ROWS_AT_ONCE, BYTES_AT_ONCE = 1 << 25, 1 << 21, 256, 1 << 22
#: Pieces of a slice, and bytes of a task's contents, that are there as Python objects at once.
PIECES_AT_ONCE, GROUP_BYTES = 1 << 16, 1 << 23
#: Bytes of pieces that are sent in a row, level of zstandard, and bits of a piece's hash that are sent.
PARCEL_BYTES, LEVEL, SENT_BITS = 1 << 19, 5, 24
NO_ID = np.iinfo(np.int64).max
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
PARCEL = "bucket int, meta binary, contents binary"
RANGES = "doc long, print long, begin long, until long"


def seed_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the SEED_BYTES bytes from every place, which two words of 8 bytes cover."""
    n = len(data) - SEED_BYTES + 1
    words = np.empty(len(data) - 7, np.uint64)
    for i in range(8):
        part = data[i : i + (len(data) - i) // 8 * 8].view("<u8")
        words[i::8] = part[: len(words[i::8])]
    return mix(words[:n] * _A + words[SEED_BYTES - 8 :][:n] * _B)


def least_in_window(hashes: np.ndarray) -> np.ndarray:
    out, width = hashes, 1
    while 2 * width <= SEEDS_IN_WINDOW:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    rest = SEEDS_IN_WINDOW - width
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _parts(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Text number, first byte and bytes of parts of HASHED_BYTES; parts of one text overlap by WINDOW - 1."""
    held, n = [], 0
    for i, text in enumerate(texts):
        for a in range(0, max(len(text) - WINDOW + 1, 0), HASHED_BYTES):
            part = text[a : a + HASHED_BYTES + WINDOW - 1]
            if held and n + len(part) > HASHED_BYTES:
                yield held
                held, n = [], 0
            held.append((i, a, part))
            n += len(part)
    if held:
        yield held


def pieces_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first byte, bytes and least hash of every piece."""
    out = []
    for parts in _parts(texts):
        data = np.frombuffer(b"".join(p for *_, p in parts), np.uint8)
        ends = np.cumsum([len(p) for *_, p in parts])
        least = least_in_window(seed_hashes(data))
        inside = np.ones(len(least), bool)
        for e in ends[:-1].tolist():
            inside[max(e - WINDOW + 1, 0) : e] = False
        cut = np.concatenate([[True], (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])])
        start = np.flatnonzero(cut)
        n = np.diff(np.append(start, len(least)))
        start, n = start[inside[start]], n[inside[start]]
        # long runs of one hash, as of a repeated character, are cut on
        times = -(-n // SEEDS_IN_WINDOW)
        first = np.repeat(np.cumsum(times) - times, times)
        step = (np.arange(len(first)) - first) * SEEDS_IN_WINDOW
        start, n = np.repeat(start, times) + step, np.minimum(np.repeat(n, times) - step, SEEDS_IN_WINDOW)
        part = np.searchsorted(ends, start, "right")
        text, shift = (np.array([p[i] for p in parts], np.int64) for i in (0, 1))
        out.append((text[part], start - np.concatenate([[0], ends[:-1]])[part] + shift[part], n + WINDOW - 1, least[start]))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(c) for c in zip(*out))


def merged(text: np.ndarray, begin: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges in order, those that touch or overlap in one text joined."""
    if not len(text):
        return text, begin, until
    order = np.lexsort((begin, text))
    text, begin, until = text[order], begin[order], until[order]
    # ranges of a text on a scale of their own, so that one running maximum serves all
    scale = int(until.max()) + 1
    reach = np.maximum.accumulate(text * scale + until)
    opens = np.concatenate([[True], text[1:] * scale + begin[1:] > reach[:-1]])
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(text)) - 1
    return text[first], begin[first], reach[last] - text[first] * scale


def _packed(*columns: np.ndarray, level: int = LEVEL) -> bytes:
    """Columns of numbers, the bytes of a column by their place so that they compress."""
    head = struct.pack("<B", len(columns)) + b"".join(struct.pack("<QB", len(c), c.dtype.itemsize) for c in columns)
    body = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(-1, c.dtype.itemsize).T.tobytes() for c in columns)
    return zstandard.compress(head + body, level)


def _unpacked(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    sizes = [struct.unpack_from("<QB", raw, 1 + 9 * i) for i in range(raw[0])]
    at, out = 1 + 9 * len(sizes), []
    for n, width in sizes:
        planes = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(-1))
        at += n * width
    return out


def _steps(values: np.ndarray, kind: str) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0)).astype(kind)


def _hashed(values: np.ndarray) -> np.ndarray:
    """Another hash of least hashes, which are all small."""
    return mix(values * _B + _A)


def _homes(hashed: np.ndarray, n_buckets: int) -> np.ndarray:
    return (hashed >> np.uint64(32)).astype(np.int64) % n_buckets


def _some_buckets(seed: np.ndarray, n_buckets: int) -> Iterator[np.ndarray]:
    """Numbers of pieces, in order: all of a bucket together and as many buckets as PIECES_AT_ONCE hold."""
    home = _homes(_hashed(seed), n_buckets)
    order = np.argsort(home, kind="stable")
    last = np.flatnonzero(np.append(home[order][1:] != home[order][:-1], True)) + 1 if len(order) else np.zeros(0, np.int64)
    part = (last - 1) // PIECES_AT_ONCE
    cuts = last[np.append(part[1:] != part[:-1], True)] if len(last) else last
    for x, y in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
        yield np.sort(order[x:y])


def parcels(docs: np.ndarray, prints: np.ndarray, texts: list[bytes], n_buckets: int) -> Iterator[tuple[int, bytes, bytes | None]]:
    """What a slice of the input sends: pieces with the places in their least document, and ranges already removed."""
    pieces = pieces_of(texts)
    begins = np.cumsum([0, *[len(t) for t in texts[:-1]]])
    gone = [tuple(np.zeros(0, np.int64) for _ in range(3))]
    # copies have one hash, so the pieces of some buckets are resolved without the others
    for some in _some_buckets(pieces[3], n_buckets):
        text, at, size, seed = (c[some] for c in pieces)
        code, contents = pd.factorize(np.array([texts[t][a : a + n] for t, a, n in zip(text.tolist(), at.tolist(), size.tolist())], object))
        least = np.full(len(contents), NO_ID)
        np.minimum.at(least, code, docs[text])
        later = docs[text] > least[code]
        gone.append((text[later], at[later], at[later] + size[later]))
        # contents by bucket, places by content
        first = np.full(len(contents), len(code))
        np.minimum.at(first, code, np.arange(len(code)))
        hashed = _hashed(seed[first])
        home = _homes(hashed, n_buckets)
        order = np.argsort(home, kind="stable")
        new_code = np.empty(len(contents), np.int64)
        new_code[order] = np.arange(len(contents))
        here = np.flatnonzero(~later)
        here = here[np.argsort(new_code[code[here]], kind="stable")]
        places = new_code[code[here]]
        # a parcel has contents of one bucket, and of PARCEL_BYTES at most
        sizes = size[first[order]]
        part = home[order] * (len(order) + 1) + np.cumsum(sizes) // PARCEL_BYTES
        opens = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        closes = np.append(opens[1:], len(order))
        place_cuts = np.searchsorted(places, np.append(opens, len(order)))
        for i, (x, y) in enumerate(zip(opens.tolist(), closes.tolist())):
            own, found = order[x:y], here[place_cuts[i] : place_cuts[i + 1]]
            rows = np.unique(text[found])
            content = places[place_cuts[i] : place_cuts[i + 1]] - x
            # places on a scale of all texts of the slice, mostly in order
            yield int(home[own[0]]), _packed(
                _steps(docs[rows], "<i8"), prints[rows], _steps(begins[rows], "<i8"), _steps(begins[text[found]] + at[found], "<i8"), _steps(content, "<u4"),
                sizes[x:y].astype(np.uint8), (hashed[own] & np.uint64((1 << SENT_BITS) - 1)).astype(np.uint32)), zstandard.compress(b"".join(contents[own]), LEVEL)
    text, begin, until = merged(*(np.concatenate(c) for c in zip(*gone)))
    home = _homes(_hashed(docs[text].astype(np.uint64)), n_buckets)
    for bucket in np.unique(home).tolist():
        own = home == bucket
        rows, row = np.unique(text[own], return_inverse=True)
        yield bucket, _packed(docs[rows].view(np.uint64), prints[rows].view(np.uint64), row.astype(np.uint32),
                              begin[own].astype(np.uint64), until[own].astype(np.uint64)), None


def _candidates(pieces: list[bytes], seeds: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Pieces that may share a window with one of another document.

    A window around a least hash holds the SIDE bytes before it or those behind it, so two pieces that share a window
    share such a longer string. Only hashes of these are compared: equal ones by chance do no harm.
    """
    sizes = np.array([len(p) for p in pieces], np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    hashes = seed_hashes(data)
    place = np.arange(len(hashes))
    piece = np.searchsorted(ends, place, "right")
    hashes[place + SEED_BYTES > ends[piece]] = np.uint64(0xFFFFFFFFFFFFFFFF)
    starts = ends - sizes
    # the least hash of all windows of a piece, at each of its places
    lowest = np.minimum.reduceat(hashes, starts)
    at = np.flatnonzero(hashes == lowest[piece])
    owner, hashed = piece[at], hashes[at]
    # SIDE bytes by the hashes of parts of them, the last of which overlaps the one before
    steps = [*range(0, SIDE - SEED_BYTES, SEED_BYTES), SIDE - SEED_BYTES]
    behind, before = at + SEED_BYTES, at - SIDE
    keys, owners = [], []
    for first, fits, salt in ((behind, behind + SIDE <= ends[owner], _A), (before, before >= starts[owner], _B)):
        key = mix(hashed[fits] * salt + seeds[owner[fits]])
        for step in steps:
            key = mix(key * _A + hashes[first[fits] + step])
        keys.append(key)
        owners.append(owner[fits])
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(key, kind="stable")
    key, owner = key[order], owner[order]
    opens = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    out = np.zeros(len(pieces), bool)
    if len(opens):
        mixed = np.minimum.reduceat(least[owner], opens) < np.maximum.reduceat(least[owner], opens)
        out[owner[np.repeat(mixed, np.diff(np.append(opens, len(key))))]] = True
    return np.flatnonzero(out)


def _window_ranges(pieces: list[bytes], least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Piece and ranges of windows that a piece with a smaller document has too."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    string, length, common = sorted_suffixes(np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(sizes) - sizes, sizes, WINDOW)
    opens = np.flatnonzero(common < WINDOW)
    lowest = np.repeat(np.minimum.reduceat(least[string], opens), np.diff(np.append(opens, len(string))))
    # a shorter suffix is a class of its own, whichever it is
    hit = (lowest < least[string]) & (length >= WINDOW)
    begin = sizes[string[hit]] - length[hit]
    return merged(string[hit], begin, begin + WINDOW)


def _collections(seeds: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of pieces, all of a seed together and as many seeds as COLLECTION_BYTES hold."""
    order = np.argsort(seeds, kind="stable")
    ends = np.flatnonzero(np.append(seeds[order][1:] != seeds[order][:-1], True)) + 1 if len(order) else np.zeros(0, int)
    filled = np.cumsum(sizes[order])
    first = 0
    while first < len(order):
        done = filled[first - 1] if first else 0
        fit = ends[(ends > first) & (filled[ends - 1] <= done + COLLECTION_BYTES)]
        last = int(fit[-1]) if len(fit) else int(ends[ends > first][0])
        yield order[first:last]
        first = last


def _share(contents: bytes, columns: list[np.ndarray], wanted: np.ndarray, groups: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """What a parcel has for each group: number, columns and contents."""
    doc_steps, prints, begin_steps, place_steps, steps, sizes, seed = columns
    content, docs, begins, places = (np.cumsum(c.view("<i8") if c.dtype.itemsize == 8 else c.astype(np.int64))
                                     for c in (steps, doc_steps, begin_steps, place_steps))
    # the places of a content are side by side, and all in its least document of the slice
    first, last = np.searchsorted(content, wanted), np.searchsorted(content, wanted, "right")
    raw, ends = zstandard.decompress(contents), np.cumsum(sizes.astype(np.int64))
    for group in np.unique(groups).tolist():
        own = groups == group
        picked, times = wanted[own], (last - first)[own]
        found = np.repeat(first[own], times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        row = np.searchsorted(begins, places[found], "right") - 1
        yield group, _packed(sizes[picked], seed[picked], np.repeat(np.arange(len(picked), dtype=np.uint32), times), docs[row].view(np.uint64),
                             prints[row], (places[found] - begins[row]).view(np.uint64), level=1), zstandard.compress(
            b"".join([raw[e - n : e] for e, n in zip(ends[picked].tolist(), sizes[picked].tolist())]), 1)


def resolve(blobs: list[tuple[bytes, bytes | None]]) -> Iterator[pd.DataFrame]:
    """Ranges to remove, from all parcels of a task, which are taken out of ``blobs``.

    Equal windows have one hash, so contents whose hash another has too are dealt by it into groups of about GROUP_BYTES that are
    resolved one after the other. Only one group is there as Python objects, what waits is compressed.
    """
    metas, seeds, sizes = [], [np.zeros(0, np.uint32)], [np.zeros(0, np.uint8)]
    while blobs:
        meta, contents = blobs.pop()
        if contents is None:
            docs, prints, row, begin, until = (c.view(f"<i{c.dtype.itemsize}") if c.dtype.itemsize == 8 else c for c in _unpacked(meta))
            yield _frame(docs[row], prints[row], begin, until)
        else:
            *_, size, seed = _unpacked(meta)
            metas.append((meta, contents))
            seeds.append(seed)
            sizes.append(size)
    all_seeds = np.concatenate(seeds)
    shared = np.sort(all_seeds)
    repeated = np.zeros(1 << SENT_BITS, bool)
    repeated[shared[1:][shared[1:] == shared[:-1]]] = True
    n_groups = max(1, -(-int(np.concatenate(sizes)[repeated[all_seeds]].sum(dtype=np.int64)) // GROUP_BYTES))
    del seeds, sizes, all_seeds, shared
    waiting: list[list[tuple[bytes, bytes]]] = [[] for _ in range(n_groups)]
    while metas:
        meta, contents = metas.pop()
        columns = _unpacked(meta)
        wanted = np.flatnonzero(repeated[columns[6]])
        if len(wanted):
            for group, *share in _share(contents, columns, wanted, (columns[6][wanted].astype(np.int64) * n_groups) >> SENT_BITS):
                waiting[group].append(tuple(share))
    del repeated
    while waiting:
        give_back()
        yield from _resolved(waiting.pop())


def _frame(docs: np.ndarray, prints: np.ndarray, begin: np.ndarray, until: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"doc": docs, "print": prints, "begin": begin, "until": until})


def _resolved(shares: list[tuple[bytes, bytes]]) -> Iterator[pd.DataFrame]:
    """Ranges to remove, from a group's shares of all parcels."""
    number: dict[bytes, int] = {}
    seeds, least, found = [], [], []
    for packed, contents in shares:
        sizes, seed, content, *places = _unpacked(packed)
        docs, prints, at = (c.view("<i8") for c in places)
        raw = zstandard.decompress(contents)
        ends = np.cumsum(sizes.astype(np.int64)).tolist()
        lowest = docs[np.searchsorted(content, np.arange(len(sizes)))].tolist()
        piece = np.zeros(len(sizes), np.int64)
        for c, (d, e, n) in enumerate(zip(lowest, ends, sizes.tolist())):
            p = piece[c] = number.setdefault(raw[e - n : e], len(number))
            if p == len(seeds):
                seeds.append(int(seed[c]))
                least.append(d)
            else:
                least[p] = min(least[p], d)
        found.append((piece[content], docs, prints, at))
    pieces, seeds, least = list(number), np.array(seeds, np.uint32), np.array(least, np.int64)
    sizes = np.array([len(p) for p in pieces], np.int64)
    piece, docs, prints, at = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 4
    later = docs > least[piece]
    yield _frame(docs[later], prints[later], at[later], at[later] + sizes[piece[later]])
    # windows of a content's least document, where another content with the same seed and another document may have them
    group, inverse = np.unique(seeds, return_inverse=True)
    low, high = np.full(len(group), NO_ID), np.full(len(group), np.iinfo(np.int64).min)
    np.minimum.at(low, inverse, least)
    np.maximum.at(high, inverse, least)
    mixed = np.flatnonzero((low < high)[inverse])
    first_piece, docs, prints, at = piece[~later], docs[~later], prints[~later], at[~later]
    order = np.argsort(first_piece, kind="stable")
    first_piece = first_piece[order]
    for some in _collections(seeds[mixed], sizes[mixed]):
        own = mixed[some]
        own = own[_candidates([pieces[p] for p in own], seeds[own].astype(np.uint64), least[own])]
        if not len(own):
            continue
        string, begin, until = _window_ranges([pieces[p] for p in own], least[own])
        a, b = np.searchsorted(first_piece, own[string]), np.searchsorted(first_piece, own[string], "right")
        times = b - a
        place = order[np.repeat(a, times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)]
        yield _frame(docs[place], prints[place], at[place] + np.repeat(begin, times), at[place] + np.repeat(until, times))


def _address(docs: DataFrame) -> list[Column]:
    """doc_id, a null one as the greatest number, and a hash that tells rows with equal doc_id apart by their text."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("doc"), F.xxhash64(text).alias("print"), text.alias("text")]


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """doc, print, begin, until: ranges of bytes to remove; ranges of a text may touch."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("binary")))).first()[0] or 0
    n_buckets = max(2 * spark.sparkContext.defaultParallelism, -(-total // BUCKET_BYTES))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, prints, texts, n = [], [], [], 0

        def sent() -> Iterator[pa.RecordBatch]:
            for bucket, meta, contents in parcels(np.array(ids, np.int64), np.array(prints, np.int64), texts, n_buckets):
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([meta], pa.binary()),
                                                  pa.array([contents], pa.binary())], names=["bucket", "meta", "contents"])

        for batch in batches:
            for doc, own, text in zip(*[batch.column(c).to_pylist() for c in ("doc", "print", "text")]):
                ids.append(doc)
                prints.append(own)
                texts.append(text)
                n += len(text)
                if n >= SLICE_BYTES:
                    yield from sent()
                    ids, prints, texts, n = [], [], [], 0
                    give_back()
        if n:
            yield from sent()
        ids, prints, texts = [], [], []
        give_back()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [(m, c) for batch in batches for m, c in zip(batch.column("meta").to_pylist(), batch.column("contents").to_pylist())]
        give_back()
        for found in resolve(blobs):
            if len(found):
                yield pa.RecordBatch.from_pandas(found, preserve_index=False)
        give_back()

    with arrow_rows(spark, ROWS_AT_ONCE, BYTES_AT_ONCE):
        sent = docs.select(*_address(docs)).mapInArrow(cut, PARCEL)
        return settle(sent.repartitionById(int(n_buckets), F.col("bucket")).select("meta", "contents").mapInArrow(compare, RANGES), "zstd")


def _compressed(docs: DataFrame) -> DataFrame:
    """doc_id, address and compressed text: what the join with the ranges shuffles."""
    schema = pa.schema([("doc_id", pa.int64()), ("doc", pa.int64()), ("print", pa.int64()), ("text", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = pa.array([packer.compress(t.as_buffer()) for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], texts], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_address(docs))
    return rows.mapInArrow(run, "doc_id long, doc long, print long, text binary")


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (maximal runs of removed bytes) and kept (the other bytes) of every row."""
    ranges = repeated_ranges(docs).groupBy("doc", "print").agg(F.collect_list("begin").alias("begins"), F.collect_list("until").alias("untils"))
    rows = _compressed(docs).join(ranges, ["doc", "print"], "left")
    out = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("begins", pa.list_(pa.int64())), ("untils", pa.list_(pa.int64())),
                     ("kept", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for packed, begins, untils in zip(*[batch.column(c).to_pylist() for c in ("text", "begins", "untils")]):
                text = zstandard.decompress(packed)
                begin, until = np.array(begins or [], np.int64), np.array(untils or [], np.int64)
                _, begin, until = merged(np.zeros(len(begin), np.int64), begin, until)
                edges = [0, *np.stack([begin, until], axis=1).reshape(-1).tolist(), len(text)]
                rows.append((len(text), begin, until, b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))))
            n, begin, until, kept = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(begin, out.field(2).type),
                                              pa.array(until, out.field(3).type), pa.array(kept, pa.binary())], schema=out)

    found = rows.select("doc_id", "text", "begins", "untils").mapInArrow(cut, "doc_id long, n_bytes long, begins array<long>, untils array<long>, kept binary")
    spans = F.arrays_zip(F.col("begins").alias("begin"), F.col("untils").alias("until"))
    return found.select("doc_id", "n_bytes", spans.alias("spans"), "kept")
