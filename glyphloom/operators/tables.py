"""Operators on whole tables: subsets, overwrites, upserts, unions by key, samples, rates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphloom.operators.skew import lookup_join
from glyphloom.session import evenly, written


def subset(df: DataFrame, ids: DataFrame, key: str = "image_id") -> DataFrame:
    """The rows of the given ids. ids may repeat."""
    return df.join(ids.select(key), key, "left_semi")


def without(df: DataFrame, ids: DataFrame, key: str = "image_id") -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def overwrite(primary: DataFrame, rescue: DataFrame, ids: DataFrame, key: str = "image_id") -> DataFrame:
    """The rows of the ids from rescue, even where it has none, all others from primary."""
    return without(primary, ids, key).unionByName(subset(rescue, ids, key), allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of old replaced by those of new with equal keys (null keys are equal to each other), and
    the rest of new. new has one row a key."""
    values = [c for c in old.columns if c not in keys]
    l, r = old.alias("l"), new.alias("r")
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    marked = l.join(r.withColumn("_new", F.lit(True)).alias("r"), on, "full")
    pick = lambda c: F.when(F.col("r._new"), F.col(f"r.{c}")).otherwise(F.col(f"l.{c}")).alias(c)
    return marked.select(*map(pick, [*keys, *values]))


def gathered(rows: DataFrame, key: str, item: str, entries: list[str]) -> DataFrame:
    """(key, item): the rows of each key as an array of structs, in the order of their entries."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*entries))).alias(item))


def one_a_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key in the order, which should leave no ties."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def first_wins(tables: list[DataFrame], key: str, order: list[Column]) -> DataFrame:
    """Union of tables with a row for each key: of the first table that has it, first in the order.
    table_no counts from 0."""
    a, *rest = [t.withColumn("table_no", F.lit(i)) for i, t in enumerate(tables)]
    for t in rest:
        a = a.unionByName(t, allowMissingColumns=True)
    return one_a_key(a, key, [F.asc("table_no"), *order])


def added_ids(union: DataFrame, tables: int) -> DataFrame:
    """(table_no, ids_added) of a union by first_wins: how many keys each table brought, also if none."""
    numbers = union.sparkSession.range(tables).select(F.col("id").cast("int").alias("table_no"))
    n = union.groupBy("table_no").agg(F.count(F.lit(1)).alias("n"))
    return numbers.join(n, "table_no", "left").select("table_no", F.coalesce("n", F.lit(0)).alias("ids_added"))


def last_wins(df: DataFrame, key: str, ordinal: list[str]) -> DataFrame:
    """The last row of each key by the ordinal columns, combined before the shuffle."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*ordinal)).alias("r")).select(key, "r.*")


def exact_sample(df: DataFrame, key: str, n: int, seed: int, excluded: DataFrame | None = None) -> DataFrame:
    """n rows without replacement, those whose keys have the smallest hashes (MD5, the same in any engine);
    a top-n, not a sort."""
    left = without(df, excluded, key) if excluded is not None else df
    return left.orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col(key))), key).limit(n)


def round_robin(df: DataFrame, strata: list[str], key: str, score: str, n: int, seed: int) -> DataFrame:
    """n rows taken in turns from strata, best first, in a shuffled order of the strata each turn.

    A key counts once, with its best row. Spark cuts every stratum to its first n rows early."""
    best = one_a_key(df, key, [F.desc(score), *map(F.asc, strata), *(F.asc(c) for c in df.columns if c not in (key, score, *strata))])
    w = Window.partitionBy(*strata).orderBy(F.desc(score), F.asc(key))
    turns = best.withColumn("turn", F.row_number().over(w)).where(F.col("turn") <= n)
    names = [F.coalesce(F.col(s).cast("string"), F.lit("")) for s in strata]
    return turns.orderBy("turn", F.md5(F.concat_ws(":", F.lit(seed), F.col("turn"), *names)), key).limit(n).orderBy(key)


def ordered_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def counts_of(df: DataFrame, value: Column, known: list[str]) -> DataFrame:
    """(value, rows): counts of the known values, also of those that don't occur."""
    names = df.sparkSession.createDataFrame([(k,) for k in known], "value string")
    n = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return names.join(n, "value", "left").select("value", F.coalesce("n", F.lit(0)).alias("rows"))


def rates(df: DataFrame, by: list[str], flags: dict[str, Column]) -> DataFrame:
    """(by..., rows, rates...): overall and for every prefix of ``by``, from one pass; null stands for
    all values, (unknown) for a null one."""
    named = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("(unknown)")).alias(c) for c in by), *(f.cast("double").alias(n) for n, f in flags.items()))
    return named.rollup(*by).agg(F.count(F.lit(1)).alias("rows"), *(F.bround(F.avg(n), 6).alias(n) for n in flags))


def mapped(df: DataFrame, column: str, function: Callable[[Column], Column], name: str) -> DataFrame:
    """df with function of the column as ``name``, computed once for every distinct value.

    For costly functions of columns with few values. Rows of heavy values meet theirs by broadcast."""
    values = evenly(df.select(F.col(column).alias(column)).where(F.col(column).isNotNull()).distinct())
    values = written(values.withColumn(name, function(F.col(column))), "values")
    return lookup_join(df, values, [column], "left")


def unique_in(df: DataFrame, keys: list[str]) -> Column:
    """Whether a row is the only one of its keys."""
    return F.count(F.lit(1)).over(Window.partitionBy(*keys)) == 1


def positional_join(left: DataFrame, right: DataFrame, group: str, index: str, ordinal: str) -> DataFrame:
    """left with the struct ``item`` of the right row of its group and index, or else of its place.

    ordinal: a column by which both are ordered within a group; places count from 0."""
    w = Window.partitionBy(group).orderBy(ordinal)
    placed = left.withColumn("_at", F.row_number().over(w) - 1)
    items = right.withColumn("_at", F.row_number().over(w) - 1)
    named = items.where(F.col(index).isNotNull()).select(group, index, F.struct(*right.columns).alias("_a")).dropDuplicates([group, index])
    by_place = items.select(group, "_at", F.struct(*right.columns).alias("_b"))
    both = placed.join(named, [group, index], "left").join(by_place, [group, "_at"], "left")
    return both.withColumn("item", F.coalesce("_a", "_b")).drop("_a", "_b", "_at")
