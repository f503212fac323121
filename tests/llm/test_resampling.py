import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from tallyfold.llm import resampling as rs


def test_spans_have_their_crc32():
    rng = random.Random(1)
    data = np.frombuffer(rng.randbytes(200_000), np.uint8)
    sizes = np.array([0, 1, 2, 63, 64, 65, 127, 128, 129, 1000, 64 * 64, 100_003, *[rng.randint(1, 300) for _ in range(500)]])
    starts = np.array([rng.randint(0, len(data) - int(n)) for n in sizes])
    want = [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts, sizes)]
    assert rs.crc32_spans(data, starts, sizes).tolist() == want
    assert rs.crc32_spans(data, np.zeros(0, int), np.zeros(0, int)).tolist() == []


def test_spans_are_looked_up_in_parts(monkeypatch):
    monkeypatch.setattr(rs, "LOOKUP_BYTES", 100)
    test_spans_have_their_crc32()


def features(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    return len(w), w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def brute(docs, target, percent, least):
    s, t = np.zeros(10_000, int), np.zeros(10_000, int)
    for text in (x for _, x in docs):
        for f in features(text)[1]:
            s[zlib.crc32(f.encode()) % 10_000] += 1
    for text in target:
        for f in features(text)[1]:
            t[zlib.crc32(f.encode()) % 10_000] += 1
    big_s, big_t = int(s.sum()), int(t.sum())
    rows = []
    for doc_id, text in docs:
        n_words, fs = features(text)
        g = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in
             (zlib.crc32(f.encode()) % 10_000 for f in fs)]
        weight = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for i, row in enumerate(fit[: percent * len(fit) // 100], 1):
        row[4] = i
    return sorted((tuple(r[:5]) for r in rows), key=repr)


@pytest.mark.parametrize("percent, least", [(25, 20), (60, 1), (100, 0)])
def test_odd_rows(spark, odd, odd_rows, clashing, percent, least):
    target = [" ".join(["another", "text", "here"] * 3), None, ""]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    want = brute([r[:2] for r in odd_rows], target, percent, least)
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    for docs in (odd, clashing):
        got = rs.resample(docs, frame, percent, least).select(*columns).collect()
        assert sorted(map(tuple, got), key=repr) == want


def test_whole_tables(spark, sf):
    import __spark_entry__ as entry

    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("text").collect()]
    got = entry.queries()["op11_position_crc"](spark, sf).collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs, target, 25, 20)
    assert sum(r["rank"] is not None for r in got) > 10


def test_no_rows(spark, none):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert rs.resample(none, empty).collect() == []
