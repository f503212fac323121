"""URL filter lists joined as of the fetch time.

A list is a history: each entry says from which day on a pattern has a verdict, until the pattern's next entry. So entries
become validity intervals. A capture is looked up under every suffix of its host and every prefix of its path; of the
intervals that hold its fetch time the most specific pattern decides: paths before hosts, then the longer one.

Intervals are cut at fixed periods of PERIOD_DAYS, which are part of the join key, so a pattern with a long history does
not meet each capture with each of its entries. A small list is broadcast. A larger one is shuffled, with a salt, so that
a host with a third of the captures is dealt to SALTS tasks.

Defined cases: a null or unreadable url, or a null fetch day, has no verdict; patterns are compared in lower case,
without scheme, user, port, query and fragment; of entries of one pattern and day the greatest verdict (by text) holds;
entries with a null pattern, day or verdict are left out; repeated captures get the same verdict each; empty tables
give no rows or no verdicts. Other columns are carried along; those named verdict, pattern, listed_on are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.store import BROADCAST_ROWS, settle

PERIOD_DAYS, SALTS = 64, 16


_READ = "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^?#]*)"


def patterns_of(url: Column) -> Column:
    """Patterns under which a list can name the url: host suffixes, then path prefixes of the whole host."""
    host = F.lower(F.regexp_replace(F.regexp_extract(url, _READ, 1), "^.*@|:[0-9]*$", ""))
    parts = F.struct(F.split(host, "[.]").alias("h"), F.filter(F.split(F.lower(F.regexp_extract(url, _READ, 2)), "/"), lambda x: x != "").alias("s"))

    def named(p: Column) -> Column:
        h, s = p["h"], p["s"]
        hosts = F.transform(F.sequence(F.lit(1), F.size(h)), lambda i: F.array_join(F.slice(h, i, F.size(h)), "."))
        paths = F.transform(F.sequence(F.lit(1), F.size(s)), lambda j: F.concat(F.array_join(h, "."), F.lit("/"), F.array_join(F.slice(s, 1, j), "/")))
        none = F.array().cast("array<string>")
        return F.when(F.array_join(h, ".") == "", none).when(F.size(s) == 0, hosts).otherwise(F.concat(hosts, paths))

    return F.transform(F.array(parts), named)[0]


def intervals(entries: DataFrame) -> DataFrame:
    """pattern, verdict, listed_on, until (exclusive; null: still valid) of entries pattern, listed_on, verdict."""
    rows = entries.select(F.lower("pattern").alias("pattern"), F.col("listed_on").cast("date").alias("listed_on"), "verdict").dropna()
    daily = rows.groupBy("pattern", "listed_on").agg(F.max("verdict").alias("verdict"))
    until = F.lead("listed_on").over(Window.partitionBy("pattern").orderBy("listed_on"))
    return daily.withColumn("until", until)


def _period(day: Column | str) -> Column:
    return F.floor(F.unix_date(F.col(day) if isinstance(day, str) else day) / PERIOD_DAYS).cast("int")


def judge_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (url, fetched_on and more) with verdict, pattern and listed_on; null where no entry was valid."""
    asked = settle(captures.select("url", F.col("fetched_on").cast("date").alias("fetched_on")).dropna().distinct())
    last = asked.agg(F.max(_period("fetched_on"))).first()[0]
    end = F.coalesce(_period(F.date_sub("until", 1)), F.lit(last if last is not None else 0))
    cut = intervals(entries).withColumn("first", _period("listed_on")).where(end >= F.col("first"))
    table = settle(cut.withColumn("period", F.explode(F.sequence("first", end))).drop("first"))
    looked = asked.withColumn("period", _period("fetched_on")).withColumn("pattern", F.explode(patterns_of(F.col("url"))))
    if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        met = looked.join(F.broadcast(table), ["pattern", "period"])
    else:
        salt = F.pmod(F.xxhash64("url", "fetched_on"), F.lit(SALTS)).cast("int")
        salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = looked.withColumn("salt", salt).join(salted, ["pattern", "period", "salt"])
    valid = met.where("listed_on <= fetched_on and (until is null or fetched_on < until)")
    rank = F.struct(F.col("pattern").contains("/").alias("path"), F.length("pattern").alias("size"), "pattern", "listed_on", "verdict")
    best = valid.groupBy("url", "fetched_on").agg(F.max(rank).alias("best")).select(
        F.col("url").alias("own_url"), F.col("fetched_on").alias("own_day"), "best")
    kept = [captures[c] for c in captures.columns if c not in ("verdict", "pattern", "listed_on")]
    rows = captures.select(F.struct(*kept).alias("doc"), F.col("url").alias("u"), F.col("fetched_on").cast("date").alias("d"))
    return rows.join(best, (F.col("u") == F.col("own_url")) & (F.col("d") == F.col("own_day")), "left").select(
        "doc.*", "best.verdict", "best.pattern", "best.listed_on")
