"""Problem 6: the N items with the highest score within every group, by a consistent tie rule.

Every group of more than HISTOGRAM_TIMES x N rows, but at most the 1 / SHARE largest ones, gets a
histogram of its scores. Its highest bucket at or above which lie N items is a safe threshold: rows
below it can't be among the first N and are dropped where they are read. What is left of these groups,
and the small groups whole, is ranked exactly by score and key; Spark cuts every group to its first N
within each task before the shuffle, so many equal scores don't reach one task either.

Results for odd input: rows with a null group, null key, or a null or NaN score are out; infinities
count as scores; of an item's versions the one with the latest ``version`` counts (null is oldest,
equal ones by the greater score), and if that has no score the item is out; equal scores rank by
the smaller key; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphloom.operators.skew import top_n
from glyphloom.session import written

BUCKETS = 1024
#: Groups of at least this share of all rows get a threshold, so no more than 20,000 are broadcast.
SHARE = 1 / 20_000
#: Groups of fewer than so many times N rows need none.
HISTOGRAM_TIMES = 8


def latest_scores(df: DataFrame, group: str, key: str, score: str, version: str) -> DataFrame:
    """(group_key, item_key, score) of every item's latest version, if that has a score."""
    newest = F.max(F.struct(F.col(version).alias("v"), F.col(score).cast("double").alias("score"), F.col(group).alias("group_key"))).alias("m")
    latest = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("item_key")).agg(newest)
    return latest.select("m.group_key", "item_key", "m.score").where("group_key is not null and score is not null and not isnan(score)")


def _bucket(score: Column) -> Column:
    """Never falls as the score rises: each step of it is a rounded monotone operation."""
    b = F.floor((score - F.col("lo")) * F.col("scale"))
    return F.when(score <= F.col("lo"), F.lit(0)).when(score >= F.col("hi"), F.lit(BUCKETS)).otherwise(F.least(b, F.lit(BUCKETS))).cast("int")


def thresholds(scored: DataFrame, n: int, share: float = SHARE, least: int | None = None) -> DataFrame:
    """(group_key, lo, hi, scale, floor_bucket) of the at most 1 / share groups that hold at least
    that share of the rows and ``least`` rows (HISTOGRAM_TIMES x n)."""
    finite = F.when(F.abs("score") != float("inf"), F.col("score"))
    stats = scored.groupBy("group_key").agg(F.count(F.lit(1)).alias("n"), F.min(finite).alias("lo"), F.max(finite).alias("hi"))
    bound = stats.agg(F.greatest(F.sum("n") * F.lit(share), F.lit(float(max(HISTOGRAM_TIMES * n if least is None else least, n)))).alias("least"))
    heavy = stats.join(F.broadcast(bound), F.col("n") >= F.col("least"))
    # the width of the range is halved before it is taken, lest it overflow
    scale = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(BUCKETS / 2) / (F.col("hi") / 2 - F.col("lo") / 2), F.lit(1e300)) * F.lit(0.5)).otherwise(F.lit(0.0))
    heavy = heavy.select("group_key", F.coalesce("lo", F.lit(0.0)).alias("lo"), F.coalesce("hi", F.lit(0.0)).alias("hi")).withColumn("scale", scale * 2)
    counts = scored.join(F.broadcast(heavy), "group_key").groupBy("group_key", "lo", "hi", "scale", _bucket(F.col("score")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    from_top = Window.partitionBy("group_key").orderBy(F.desc("bucket"))
    enough = counts.withColumn("at_least", F.sum("n").over(from_top)).where(F.col("at_least") >= n)
    return enough.groupBy("group_key", "lo", "hi", "scale").agg(F.max("bucket").alias("floor_bucket"))


def top_items(scored: DataFrame, n: int, share: float = SHARE, least: int | None = None) -> DataFrame:
    """(group_key, item_key, score, rank): the first n items of every group."""
    limits = F.broadcast(thresholds(scored, n, share, least))
    left = scored.join(limits, "group_key", "left").where(F.col("floor_bucket").isNull() | (_bucket(F.col("score")) >= F.col("floor_bucket")))
    return top_n(left.select("group_key", "item_key", "score"), ["group_key"], [F.desc("score"), F.asc("item_key")], n)


def top_of_table(df: DataFrame, group: str, key: str, score: str, version: str, n: int) -> DataFrame:
    return top_items(written(latest_scores(df, group, key, score, version), "scores"), n)
