"""The pipeline against plain Python, stage by stage on one document set."""

import math
from collections import Counter

import corpus_pipeline
from tallyfold.llm import mixing, quality

from .test_tables import check_shards, uniform
from .test_texts import components, shingles


def test_pipeline_is_its_stages_by_hand(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r for r in docs.collect()}
    # the verdicts' measures are tested on their own
    kept = {r.doc_id for r in quality.quality_report(docs).collect() if r.kept}
    root = components({i: shingles(texts[i].text) for i in kept})
    kept = {i for i in kept if root[i] == i}
    items = [s for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() if (s := shingles(r.text))]
    kept = {i for i in kept if not any(100 * len(s & shingles(texts[i].text)) >= 75 * len(s) for s in items)}
    sources = Counter(texts[i].source for i in kept)
    weight = sum(n**corpus_pipeline.MIX_POWER for n in sources.values())
    expected = Counter()
    for i in kept:
        n = sources[texts[i].source]
        rate = n**corpus_pipeline.MIX_POWER / weight * len(kept) / n
        parts = max(1, math.ceil(rate / mixing.STEP))
        for j in range(1, parts + 1):
            u, k, term = uniform(f"{corpus_pipeline.SEED}:{i}:{j}"), 0, math.exp(-rate / parts)
            total = term
            while total <= u:
                k, term = k + 1, term * rate / parts / (k + 1)
                total += term
            expected[i] += k
    rows = corpus_pipeline.run(spark, sf).collect()
    assert Counter(r.doc_id for r in rows) == +expected
    assert rows[0].asDict().keys() >= {"doc_id", "text", "lang", "source", "n_chars", "size", "shard", "slot"}
    check_shards(rows, corpus_pipeline.N_SHARDS)


def test_stages_take_odd_documents(spark, odd, none, clashing, sf):
    for df in (odd, none, clashing):
        out, columns = df, df.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, sf)
            kept = [c for c in columns if name != "source_mix" or c not in ("copy", "shuffle_key")]
            assert out.columns == kept, name
            columns = kept
        corpus_pipeline.STAGES[-1][1](spark, out, sf).collect()
