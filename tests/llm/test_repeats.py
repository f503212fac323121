import hashlib
import random
import tracemalloc

import numpy as np
import pytest

from tallyfold.llm import repeats as rp
from tallyfold.llm.suffixes import sorted_suffixes


def naive(strings):
    suffixes = sorted((s[i:], n) for n, s in enumerate(strings) for i in range(len(s)))
    out, above = [], None
    for suffix, _ in suffixes:
        same = 0
        while above is not None and same < min(len(above), len(suffix)) and above[same] == suffix[same]:
            same += 1
        out.append((suffix, same))
        above = suffix
    return out


@pytest.mark.parametrize("seed", range(60))
def test_suffixes_are_sorted(seed):
    rng = random.Random(seed)
    letters = [b"a", b"ab", b"abcd", bytes(range(255))][seed % 4]
    strings = [bytes(rng.choice(letters) for _ in range(rng.randint(1, 20))) for _ in range(rng.randint(1, 12))]
    strings += rng.choices(strings, k=seed % 3)
    sizes = np.array(list(map(len, strings)))
    string, length, common = sorted_suffixes(np.frombuffer(b"".join(strings), np.uint8), np.cumsum(sizes) - sizes, sizes)
    assert [(strings[s][len(strings[s]) - n :], c) for s, n, c in zip(string, length, common)] == naive(strings)


def brute(docs):
    """Every string of WINDOW bytes in a dictionary."""
    least = {}
    data = [(d, (t or "").encode()) for d, t in docs]
    order = [(rp.NO_ID if d is None else d, t) for d, t in data]
    for d, t in order:
        for i in range(len(t) - rp.WINDOW + 1):
            w = t[i : i + rp.WINDOW]
            least[w] = min(least.get(w, rp.NO_ID), d)
    out = []
    for (doc_id, _), (d, t) in zip(data, order):
        gone = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - rp.WINDOW + 1):
            if least[t[i : i + rp.WINDOW]] < d:
                gone[i] += 1
                if i + rp.WINDOW < len(gone):
                    gone[i + rp.WINDOW] -= 1
        gone = np.cumsum(gone)[: len(t)] > 0
        runs = int(np.count_nonzero(np.diff(np.concatenate([[False], gone]).astype(int)) == 1))
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((doc_id, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def digests(cut):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest())
                   for r in cut.collect()), key=repr)


def planted(seed):
    rng = random.Random(seed)

    def text(n, letters="abcdefgh ,."):
        return "".join(rng.choice(letters) for _ in range(n))

    shared = [text(n) for n in (49, 50, 51, 84, 85, 86, 200, 3000)]
    docs = [(i, "".join(rng.choice([text(rng.randint(0, 120)), rng.choice(shared), rng.choice(shared)[rng.randint(0, 40):]])
                       for _ in range(rng.randint(0, 8)))) for i in rng.sample(range(100), 40)]
    docs += [(200, "a" * 400), (201, "a" * 49), (202, "b" + "a" * 300 + "b"), (203, "ab" * 200), (204, "ba" * 100), (150, "x" * 60 + "a" * 51)]
    docs += [(300 + i, "é" * 30 + text(20) + "ü" * 40) for i in range(3)]
    # one document repeats itself, one has its text twice under one id, one is there often
    body = text(500)
    docs += [(400, body + text(10) + body), (401, text(7) + body), (401, body), *[(500 + i % 7, body[:300]) for i in range(60)], (None, body), (None, body)]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_repeats(spark, seed):
    docs = planted(seed)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).cache()
    assert digests(rp.without_repeats(frame)) == brute(docs)


def test_small_slices_and_collections(spark, monkeypatch):
    docs = planted(3)
    want = brute(docs)
    rows = [(rp.NO_ID if d is None else d, n, (t or "").encode()) for n, (d, t) in enumerate(docs)]
    monkeypatch.setattr(rp, "HASHED_BYTES", 700)
    monkeypatch.setattr(rp, "COLLECTION_BYTES", 500)
    for size in (1, 7, 1000):
        sent = {}
        for i in range(0, len(rows), size):
            ids, prints, texts = zip(*rows[i : i + size])
            for bucket, meta, contents in rp.parcels(np.array(ids), np.array(prints), list(texts), 5):
                sent.setdefault(bucket, []).append((meta, contents))
        gone = [np.zeros(len(t), bool) for *_, t in rows]
        for blobs in sent.values():
            for found in rp.resolve(blobs):
                for n, a, b in zip(found["print"], found["begin"], found["until"]):
                    gone[n][a:b] = True
        got = [(d, len(t), int(g.sum()), hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~g])).hexdigest())
               for (d, _), (_, _, t), g in zip(docs, rows, gone)]
        assert sorted(got, key=repr) == sorted([(a, b, c, e) for a, b, c, _, e in want], key=repr)


def test_odd_rows(spark, odd, odd_rows, clashing):
    want = brute([r[:2] for r in odd_rows])
    assert digests(rp.without_repeats(odd)) == want
    assert digests(rp.without_repeats(clashing)) == want


def test_spans_are_in_order_and_apart(spark, odd):
    for row in rp.without_repeats(odd).collect():
        edges = [x for s in row["spans"] for x in (s["begin"], s["until"])]
        assert edges == sorted(set(edges)) and (not edges or edges[-1] <= row["n_bytes"])


def test_whole_table(spark, sf):
    import __spark_entry__ as entry

    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = entry.queries()["op13_column_suffixes"](spark, sf).collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs)
    assert sum(r["n_removed"] > 0 for r in got) > 5


def test_no_rows(none):
    assert rp.without_repeats(none).collect() == []


def test_a_task_holds_a_group_of_contents_at_once(monkeypatch):
    """Objects for some pieces and not for all that a task has: 24 slices share most of their texts. 55 MB when all were there."""
    monkeypatch.setattr(rp, "GROUP_BYTES", 1 << 20, raising=False)
    rng = np.random.default_rng(5)
    body = [bytes(rng.integers(97, 123, 1500, np.uint8)) for _ in range(600)]
    blobs = []
    for k in range(24):
        texts = [t[:700] + b"%03d" % k + t[700:] for t in body[k :: 8] + body[k % 3 :: 8]]
        ids = np.arange(len(texts)) + 1000 * k
        blobs += [(meta, contents) for bucket, meta, contents in rp.parcels(ids, ids, texts, 2) if bucket == 1]
    tracemalloc.start()
    rows = sum(len(found) for found in rp.resolve(blobs))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows > 100_000
    assert peak < 40e6
