"""Mixing sources to target weights by Poisson replication.

A source with weight w of a mix of T documents, and n documents of its own, has the mean repetition rate w * T / n.
Each document's count is the inverse of that Poisson distribution at a uniform number hashed from seed and doc_id,
so a rerun gives the same mix. Rates above STEP are the sum of independent Poisson numbers of rate STEP or less,
which has the same distribution and keeps exp() away from zero.

Defined cases: a null source is a source of its own; equal rows get equal counts; a null doc_id hashes as the
word null; an empty text is a document like any other; an empty table gives no row; other columns are carried
along, and columns named copy, shuffle_key are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.store import settle

STEP = 32.0
#: Terms of the distribution function that are kept: those after them sum to less than 2**-60 at a rate of STEP.
TERMS = 128
#: Rows of rates (one for each source) that are broadcast; more of them are joined by a shuffle.
MOST_SOURCES = 100_000

#: 52 bits of an md5 as a number in [0, 1): every engine has md5.
UNIFORM = "cast(conv(substr(md5({}), 1, 13), 16, 10) as double) / 4503599627370496D"


def tempered_rates(docs: DataFrame, power: float = 0.5, total: float | None = None) -> DataFrame:
    """source, rate: weights in proportion to (documents of the source) ** power; ``total`` documents on average,
    as many as there are if it is null."""
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    all_weight, all_n = counts.agg(F.sum(F.pow("n", F.lit(power))), F.sum("n")).first()
    wanted = float(all_n or 0 if total is None else total)
    return counts.select("source", (F.pow("n", F.lit(power)) / F.lit(all_weight or 1.0) * F.lit(wanted) / F.col("n")).alias("rate"))


def weighted_rates(docs: DataFrame, weights: DataFrame, total: float) -> DataFrame:
    """source, rate from a table of source and weight (unique by source); sources without a weight have rate 0."""
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    given = weights.select(F.col("source").alias("given"), F.col("weight").cast("double").alias("weight"))
    all_weight = given.agg(F.sum("weight")).first()[0] or 1.0
    return counts.join(given, F.col("source").eqNullSafe(F.col("given")), "left").select(
        "source", (F.coalesce(F.col("weight"), F.lit(0.0)) / F.lit(all_weight) * F.lit(float(total)) / F.col("n")).alias("rate"))


def _with_distribution(rates: DataFrame) -> DataFrame:
    """Adds parts and the distribution function of rate / parts, term by term."""
    parts = f"cast(greatest(1D, ceil(rate / {STEP}D)) as int)"
    cdf = f"""transform(aggregate(sequence(1, {TERMS}),
        struct(exp(-r) as term, exp(-r) as total, array(exp(-r)) as cdf),
        (a, k) -> struct(a.term * r / k as term, a.total + a.term * r / k as total,
                         concat(a.cdf, array(a.total + a.term * r / k)) as cdf)).cdf, x -> x)"""
    return rates.withColumn("parts", F.expr(parts)).withColumn("r", F.expr("rate / parts")).withColumn(
        "cdf", F.expr(cdf)).select(F.col("source").alias("rate_source"), "rate", "parts", "cdf")


def mix_sources(docs: DataFrame, rates: DataFrame, seed: int = 0) -> DataFrame:
    """``docs``, each row as often as its count says, with copy (from 1) and shuffle_key, in the order of that key."""
    table = settle(_with_distribution(rates))
    known = table.limit(MOST_SOURCES + 1).count() <= MOST_SOURCES
    kept = [docs[c] for c in docs.columns if c not in ("copy", "shuffle_key")]
    name = "coalesce(cast(key as string), 'null')"
    uniforms = "transform(sequence(1, parts), j -> {})".format(
        UNIFORM.format(f"concat('{seed}:', {name}, ':', cast(j as string))"))
    count = f"aggregate({uniforms}, 0, (n, u) -> n + size(filter(cdf, p -> p <= u)))"
    rows = docs.select(F.struct(*kept).alias("doc"), F.col("doc_id").alias("key"), F.col("source").alias("own_source"))
    rows = rows.join(F.broadcast(table) if known else table, F.col("own_source").eqNullSafe(F.col("rate_source")))
    rows = rows.select("doc", "key", F.expr(count).alias("n")).where("n > 0").select(
        "doc", "key", F.explode(F.expr("sequence(1, n)")).alias("copy"))
    order = UNIFORM.format(f"concat('{seed}:order:', {name}, ':', cast(copy as string))")
    rows = rows.withColumn("shuffle_key", F.expr(f"cast(({order}) * 4503599627370496D as bigint)"))
    return rows.orderBy("shuffle_key", "key", "copy").select("doc.*", "copy", "shuffle_key")
