"""Joins and rankings that stay even when one key holds a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy if it holds at least this share of the rows, so there are never more than 20,000 heavy
#: keys: that bounds what is broadcast, whatever the size of the input.
HEAVY_SHARE = 1 / 20_000
#: Below this many rows no key can trouble a task.
HEAVY_ROWS = 20_000


def heavy_keys(df: DataFrame, keys: list[str], share: float = HEAVY_SHARE, least: int = HEAVY_ROWS) -> DataFrame:
    """The keys that hold at least ``share`` of the rows and ``least`` rows; at most 1 / share rows.

    Counted with a map-side combine. Null keys count as keys here; an equi-join drops them anyway.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    bound = counts.agg(F.greatest(F.sum("_n") * F.lit(share), F.lit(float(least))).alias("_least"))
    return counts.join(F.broadcast(bound), F.col("_n") >= F.col("_least")).select(*keys)


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", heavy: DataFrame | None = None) -> DataFrame:
    """left ⋈ right where right has one row per key and keys of left may be heavy.

    Rows of heavy keys meet the (at most 1 / HEAVY_SHARE) matching rows of right by broadcast and
    are never shuffled; all others meet by a shuffled join. how: inner or left.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    heavy = F.broadcast((heavy if heavy is not None else heavy_keys(left, keys)).withColumn("_heavy", F.lit(True)))
    marked = left.join(heavy, keys, "left")
    few = right.join(heavy, keys, "left_semi")
    hot = marked.where("_heavy").drop("_heavy").join(F.broadcast(few), keys, how)
    cold = marked.where("_heavy is null").drop("_heavy").join(right, keys, how)
    return hot.unionByName(cold)


def with_counts(df: DataFrame, scope: list[str], sets: dict[str, list[str]]) -> DataFrame:
    """df with, for each name, the number of its rows that agree in scope and in the set's keys.

    Scopes are windows of one task each; heavy ones are counted with a map-side combine instead and
    the counts looked up, so no scope is gathered whatever its size. No key may be null."""
    from pyspark.sql import Window

    from glyphloom.session import written

    windowed = lambda d: d.select("*", *(F.count(F.lit(1)).over(Window.partitionBy(*scope, *keys)).alias(name) for name, keys in sets.items()))
    heavy = written(heavy_keys(df, scope), "heavy")
    if heavy.isEmpty():
        return windowed(df)
    hot = written(df.join(F.broadcast(heavy), scope, "left_semi"), "hot")
    for name, keys in sets.items():
        by = [*scope, *keys]
        hot = written(lookup_join(hot, hot.groupBy(*by).agg(F.count(F.lit(1)).alias(name)), by, "left"), "hot")
    return windowed(df.join(F.broadcast(heavy), scope, "left_anti")).unionByName(hot)


def top_n(df: DataFrame, groups: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows of each group; Spark cuts each group to n rows before the shuffle as well."""
    from pyspark.sql import Window

    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)
