"""Draws an exact number of rows from each cell at random, by a seeded hash of the row's key.

The rows of a cell with the smallest hashes are drawn. Where a cell ends is found by histograms of
the hashes: each pass narrows the interval that holds the boundary by HISTOGRAM_BITS, until few
rows lie in it; only those are ranked. No cell, however large, is sorted or gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HISTOGRAM_BITS = 12
HASH_BITS = 62
#: So many rows about a cell's boundary may be ranked in one task.
RANKED_ROWS = 50_000
#: Cells are categories, strata or bundles; their table is held by the driver and broadcast.
MAX_CELLS = 20_000


def draw(rows: DataFrame, cell: list[str], key: str, quotas: dict[tuple, int], seed: int, ranked_rows: int = RANKED_ROWS) -> DataFrame:
    """The rows drawn, with rows' columns: quotas[cell] of each cell, all of a cell with fewer.

    The same rows each time for the same keys and seed. Keys should be unique; rows of equal key
    share a hash. Cells without a quota give none, null is a cell value like any other.
    """
    if len(quotas) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} cells")
    spark = rows.sparkSession
    hashed = rows.withColumn("_u", F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 64 - HASH_BITS))
    fields = [f for f in rows.schema.fields if f.name in cell]
    fields = sorted(fields, key=lambda f: cell.index(f.name))
    schema = T.StructType([*(T.StructField(f"_c{i}", f.dataType) for i, f in enumerate(fields)), *(T.StructField(n, T.LongType()) for n in ("_lo", "_hi", "_need"))])
    same = lambda bounds: [hashed[f.name].eqNullSafe(bounds[f"_c{i}"]) for i, f in enumerate(fields)]

    width = HASH_BITS
    bounds = {c: (0, 1 << width, n) for c, n in quotas.items() if n > 0}
    at = lambda: spark.createDataFrame([(*c, lo, hi, need) for c, (lo, hi, need) in bounds.items()], schema)
    joined = lambda: hashed.join(F.broadcast(b := at()), same(b))
    cells = [f"_c{i}" for i in range(len(fields))]

    inside = F.col("_u").between(F.col("_lo"), F.col("_hi") - 1)
    counted = joined().groupBy(*cells).agg(F.count(F.lit(1)).alias("n")).collect() if bounds else []
    size = {tuple(r[c] for c in cells): r["n"] for r in counted}
    while width > 0 and max(size.values(), default=0) > ranked_rows:
        step = min(HISTOGRAM_BITS, width)
        width -= step
        bucket = F.shiftright(F.col("_u") - F.col("_lo"), width)
        counts = joined().where(inside).groupBy(*cells, "_need", bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
        upward = Window.partitionBy(*cells).orderBy("_b")
        counts = counts.withColumn("_sum", F.sum("_n").over(upward))
        # the bucket that holds the boundary; a cell with fewer rows than its quota has none
        edge = counts.where("_sum >= _need and _sum - _n < _need").select(*cells, "_b", "_n", (F.col("_need") - F.col("_sum") + F.col("_n")).alias("_rest"))
        found = {tuple(r[c] for c in cells): r for r in edge.collect()}  # one row a cell
        for c, (lo, hi, need) in bounds.items():
            if c in found:
                r = found[c]
                bounds[c] = (lo + (r["_b"] << width), lo + ((r["_b"] + 1) << width), r["_rest"])
                size[c] = r["_n"]
            else:
                bounds[c] = (hi, hi, 0)
                size[c] = 0
    if not bounds:
        return rows.limit(0)
    last = joined()
    order = Window.partitionBy(*cells).orderBy("_u", key)
    surely = last.where("_u < _lo").select(*rows.columns)
    edge = last.where(inside).withColumn("_rank", F.row_number().over(order)).where("_rank <= _need").select(*rows.columns)
    return surely.unionByName(edge)
