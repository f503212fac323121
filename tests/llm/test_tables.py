"""Operators on tables against plain Python, and odd input for all operators."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import TABLES, compare
from tallyfold.llm import decontaminate, language_model, mixing, neardup, passages, quality, sharding, tokens, toxicity, urls
from tallyfold.llm.oracle import SQL

from .conftest import CLASHES, DOCS


def test_best_fit_is_that_of_a_list():
    rng = random.Random(1)
    for _ in range(50):
        sizes = [rng.randint(1, 60) for _ in range(rng.randint(0, 60))]
        room, placed = [], []
        for size in sorted(sizes, reverse=True):
            fit = [i for i, r in enumerate(room) if r >= size]
            if fit:
                room[min(fit, key=lambda i: (room[i], i))] -= size
            else:
                room.append(64 - size)
        bins = sharding.best_fit_decreasing(sizes, 64)
        loads = defaultdict(int)
        for b, s in zip(bins, sizes):
            loads[b] += s
        assert sorted(loads.values()) == sorted(64 - r for r in room) and all(v <= 64 for v in loads.values())


def check_shards(rows, n, text=lambda r: r.text):
    shards, slots, loads = {}, defaultdict(list), [0] * n
    for r in rows:
        assert r.size == len((text(r) or "").encode()) + 16
        assert shards.setdefault(text(r), r.shard) == r.shard
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    return loads


def test_shards_are_even_and_keep_copies_together(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    loads = check_shards(sharding.shard_documents(docs, n_shards=8).shards.collect(), 8)
    assert max(loads) - min(loads) <= 0.02 * sum(loads) / 8 + 16


def test_fixed_capacity(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    packed = sharding.shard_documents(docs, capacity=100_000)
    loads = check_shards(packed.shards.collect(), packed.n_shards)
    assert max(loads) <= 100_000 and packed.n_shards <= 1.1 * sum(loads) / 100_000 + 1


def test_no_shard_above_a_capacity_that_every_group_fits(spark, monkeypatch):
    rows = [(i, f"{i:06d}" + "x" * 994, "en", "a", 1) for i in range(6000)]
    packed = sharding.shard_documents(spark.createDataFrame(rows, DOCS), capacity=2100)
    loads = check_shards(packed.shards.collect(), packed.n_shards)
    # two of 1016 bytes in each, but for the last shard of each slice
    assert max(loads) <= 2100 and packed.n_shards <= 3000 + 6000 * 1016 // (2100 * sharding.SLICE_BINS) + 1
    # groups far smaller than a bin share items, and one above the capacity is alone
    rows = [(i, f"t{i}", "en", "a", 1) for i in range(5000)] + [(9000, "y" * 30_000, "en", "a", 1)]
    packed = sharding.shard_documents(spark.createDataFrame(rows, DOCS), capacity=10_000)
    loads = sorted(check_shards(packed.shards.collect(), packed.n_shards))
    assert loads[-1] == 30_016 and loads[-2] <= 10_000


def uniform(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2**52


def test_counts_are_inverse_poisson(spark):
    rows = [(i, "t", "en", "big" if i % 10 else "small", 1) for i in range(600)]
    weights = spark.createDataFrame([("small", 3.0), ("big", 1.0)], "source string, weight double")
    df = spark.createDataFrame(rows, DOCS)
    mixed = mixing.mix_sources(df, mixing.weighted_rates(df, weights, 3000.0), seed=1).collect()
    found = Counter(r.doc_id for r in mixed)
    for i, _, _, source, _ in rows:
        rate = 3000 * (0.75 / 60 if source == "small" else 0.25 / 540)
        parts = max(1, math.ceil(rate / mixing.STEP))
        n = 0
        for j in range(1, parts + 1):
            u, k, term = uniform(f"1:{i}:{j}"), 0, math.exp(-rate / parts)
            total = term
            while total <= u:
                k, term = k + 1, term * rate / parts / (k + 1)
                total += term
            n += k
        assert found[i] == n
    keys = [r.shuffle_key for r in mixed]
    assert keys == sorted(keys) and abs(len(mixed) - 3000) < 5 * math.sqrt(3000)


def test_lists_as_of_the_fetch_day(spark):
    entries = [("Bad.example", "2020-01-10", "block"), ("bad.example", "2020-03-01", "allow"), ("a.bad.example", "2020-02-01", "block"),
               ("a.bad.example/Ok", "2020-02-05", "allow"), ("bad.example", "2020-01-10", "allow"), (None, "2020-01-01", "block"), ("x", None, "block")]
    captures = [(1, "http://u@A.bad.example:80/ok/x?y#z", d) for d in ("2020-01-09", "2020-01-10", "2020-02-04", "2020-02-05", "2024-01-01")]
    captures += [(2, "https://bad.example", "2020-02-29"), (3, "https://bad.example/", "2020-03-01"), (4, None, "2020-03-01"), (5, "nonsense", "2020-03-01"),
                 (6, "http://notbad.example/", None), (2, "https://bad.example", "2020-02-29"), (7, "http://notbad.example/", "2020-02-02")]
    table = spark.createDataFrame([(i, u, d, 0) for i, u, d in captures], "page_id int, url string, fetched_on string, verdict int")
    found = urls.judge_captures(table, spark.createDataFrame(entries, "pattern string, listed_on string, verdict string")).collect()

    history = defaultdict(dict)
    for p, d, v in entries:
        if p and d:
            history[p.lower()][d] = max(v, history[p.lower()].get(d, ""))

    def verdict(url, day):
        if not url or not day or "://" not in url:
            return None
        host, _, path = url.split("://")[1].split("?")[0].partition("/")
        host = host.split("@")[-1].split(":")[0].lower()
        labels, segments = host.split("."), [s.lower() for s in path.split("/") if s]
        names = ["/".join([host, *segments[:k]]) for k in range(len(segments), 0, -1)] + [".".join(labels[k:]) for k in range(len(labels))]
        for name in names:
            days = [d for d in history.get(name, ()) if d <= day]
            if days:
                return history[name][max(days)]
        return None

    assert sorted((r.page_id, str(r.url), str(r.fetched_on), str(r.verdict)) for r in found) == sorted(
        (i, str(u), str(d), str(verdict(u, d))) for i, u, d in captures)


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, sf, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    ours = entry.queries()[name](spark, sf).toPandas()
    assert compare(name, ours, db.execute(SQL[name]).df()).startswith("ok")


def all_operators(spark, df, tokenizer):
    """Results of every operator, by name, with the number of rows expected for rows of df (None: any)."""
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (3, None), (None, 1)], "doc_id long, toxic int")
    benchmark = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (4, "one"), (None, "no such item at all here")], "item_id long, text string")
    yield "tokens", tokens.token_files(df, tokenizer), 1
    yield "shards", sharding.shard_documents(df, n_shards=4).shards, 1
    yield "neardup", neardup.near_duplicates(df), 1
    yield "keep one", neardup.drop_near_duplicates(df), None
    yield "mix", mixing.mix_sources(df, mixing.tempered_rates(df)), None
    yield "model", language_model.score_texts(df), 1
    yield "passages", passages.repeated_passages(df), None
    yield "quality", quality.quality_report(df), 1
    yield "good", quality.good_documents(df), None
    yield "toxicity", toxicity.score_toxicity(df, toxicity.train(df, labels)), 1
    yield "contained", decontaminate.contained(df, benchmark), None
    yield "decontaminate", decontaminate.decontaminate(df, benchmark), None
    pages = df.select("*", F.col("text").alias("url"), F.lit("2020-01-01").alias("fetched_on"))
    yield "urls", urls.judge_captures(pages, spark.createDataFrame([], "pattern string, listed_on string, verdict string")), 1


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("kind", ["odd", "none", "clashing"])
def test_odd_input(spark, request, tokenizer, kind):
    df = request.getfixturevalue(kind)
    n = df.count()
    for name, out, share in all_operators(spark, df, tokenizer):
        rows = out.collect()
        assert share is None or len(rows) == n * share, name
        assert n or not rows, name


def test_odd_rows_have_the_stated_results(spark, odd, tokenizer):
    found = defaultdict(list)
    for r in neardup.near_duplicates(odd).collect():
        found[r.doc_id].append((r.n_shingles, r.component_id, r.kept))
    assert found[2] == [(76, 1, False)] * 2 and found[3][0][1:] == (1, False) and found[8] == [(1, 7, False)]
    assert found[4] == [(0, 4, True)] and found[6] == [(0, 6, True)] and all(c is None and k for _, c, k in found[None])
    kept = Counter(r.doc_id for r in neardup.drop_near_duplicates(odd).collect())
    assert kept[1] == 1 and not kept[2] and not kept[3] and kept[9] == 1 and kept[None] == 2 and not kept[8]
    tokens_of = {r.doc_id: r.n_tokens for r in tokens.token_files(odd, tokenizer).collect()}
    assert tokens_of[4] == tokens_of[5] == tokens_of[6] == 1
    benchmark = spark.createDataFrame([(3, "ONE"), (5, "another text here")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contained(odd, benchmark).collect()} == {(7, 3), (8, 3), (9, 5)}
    copies = {(r.doc_id, r.other_id) for r in passages.repeated_passages(odd).collect() if r.kind == "copy"}
    assert copies == {(2, 1)}
    shards = sharding.shard_documents(odd, n_shards=4).shards.collect()
    check_shards(shards, 4)


def test_other_columns_stay(clashing):
    mixed = mixing.mix_sources(clashing, mixing.tempered_rates(clashing))
    assert mixed.columns == [c for c in clashing.columns if c not in ("copy", "shuffle_key")] + ["copy", "shuffle_key"]
    shards = sharding.shard_documents(clashing, n_shards=2).shards
    assert shards.columns == [c for c in clashing.columns if c not in ("size", "shard", "slot")] + ["size", "shard", "slot"]
    for out in (quality.good_documents(clashing), neardup.drop_near_duplicates(clashing)):
        assert out.columns == clashing.columns and set(CLASHES) <= set(out.columns)
