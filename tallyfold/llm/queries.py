"""Registered queries of the operators of this package, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm.alignment import align_tokenizers
from tallyfold.llm.decontaminate import contained
from tallyfold.llm.language_model import score_texts
from tallyfold.llm.mixing import mix_sources, tempered_rates
from tallyfold.llm.neardup import near_duplicates
from tallyfold.llm.passages import repeated_passages
from tallyfold.llm.quality import quality_report
from tallyfold.llm.repeats import without_repeats
from tallyfold.llm.resampling import resample
from tallyfold.llm.sharding import shard_documents
from tallyfold.llm.tokens import token_files
from tallyfold.llm.toxicity import held_out, score_toxicity, train
from tallyfold.llm.urls import judge_captures

END_ID, N_SHARDS, MIX_POWER, SEED = 1, 40, 0.5, 7


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_files(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), END_ID)


def op2_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    packed = shard_documents(docs, n_shards=N_SHARDS).shards
    return packed.select("doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                         F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op4_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return mix_sources(docs, tempered_rates(docs, MIX_POWER), SEED).select(
        "doc_id", "source", "copy", "shuffle_key", F.md5("text").alias("text_md5"))


def op5_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read(spark, sf_dir, "documents"))


def op6_chained_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read(spark, sf_dir, "documents"))


def op7_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(read(spark, sf_dir, "documents"))


def op8_chain_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = score_toxicity(docs, train(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "spans")


def dated_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch day, spread over four years by page_id: the table has none."""
    return pages.select("page_id", "url", F.expr("date_add(date'2020-01-01', cast(page_id * 7919 % 1461 as int))").alias("fetched_on"))


def dated_list(pages: DataFrame) -> DataFrame:
    """A list with a history, made from the pages' own hosts: a third of the sites and all whose name says so are
    blocked from some day on, half of those are cleared later, and some languages of a site have entries of their own."""
    host = "lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1))"
    sites = pages.select(F.expr(f"regexp_extract({host}, '([^.]+[.][^.]+[.][^.]+)$', 1)").alias("site")).where("site <> ''").distinct()
    hashed = sites.select("site", F.expr("cast(conv(substr(md5(site), 1, 6), 16, 10) as int)").alias("h"))
    listed = hashed.where("h % 3 = 0 or site rlike '(spam|adult|bets)'").withColumn("since", F.expr("date_add(date'2019-12-01', h % 997)"))
    again = [("block", "site", "since", "true"), ("allow", "site", "date_add(since, 90 + h % 300)", "h % 2 = 0"),
             ("block", "site", "date_add(since, 500 + h % 300)", "h % 4 = 0"), ("allow", "concat(site, '/en')", "date_add(since, 30)", "h % 5 < 2"),
             ("block", "concat(site, '/de')", "date_add(since, -60)", "h % 7 < 3")]
    parts = [listed.where(when).select(F.expr(pattern).alias("pattern"), F.expr(day).alias("listed_on"), F.lit(verdict).alias("verdict"))
             for verdict, pattern, day, when in again]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def op9_temporal_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    judged = judge_captures(dated_captures(pages), dated_list(pages))
    days = [F.col(c).cast("string").alias(c) for c in ("fetched_on", "listed_on")]
    return judged.select("page_id", "url", "verdict", "pattern", *days)


def op10_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_position_crc(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_identity_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rows, _ = align_tokenizers(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                               public_tokenizers.path("piece_bpe_32k.model"))
    return rows


def op13_column_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = without_repeats(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_token_codes, op2_bin_packing, op3_minhash, op4_poisson_mix,
                                op5_deleted_interpolation, op6_chained_passages, op7_divergence, op8_chain_field,
                                op9_temporal_lists, op10_containment, op11_position_crc, op12_identity_map,
                                op13_column_suffixes)}
