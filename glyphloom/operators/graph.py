"""Connected components of any graph given as edges.

Randomised contraction: in each round every node goes over to the neighbour with the smallest hash
of the round, which leaves a constant share of the nodes at most. A remainder of at most
FINISH_EDGES edges is closed by union-find in one task. Nothing is gathered by the driver, hubs of
any degree are met by broadcast, and each round is a written table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphloom.operators.skew import lookup_join
from glyphloom.session import written

#: So many edges are closed in one task at once; more are contracted first.
FINISH_EDGES = 300_000


def _close(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(node, root) of all edges of one task, by union-find; the root is the smallest node."""
    up: dict[str, str] = {}

    def root(x: str) -> str:
        top = x
        while up.setdefault(top, top) != top:
            top = up[top]
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    for f in frames:
        for a, b in zip(f["a"].tolist(), f["b"].tolist()):
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
    nodes = list(up)
    yield pd.DataFrame({"node": nodes, "root": [root(x) for x in nodes]}, dtype=object)


def components(edges: DataFrame, finish_edges: int = FINISH_EDGES) -> DataFrame:
    """(node, root): for every node of the edges (a, b), strings, a node that its component shares.

    Loops and edges with a null end tie nothing; nodes without another end are not in the result."""
    ordered = lambda e: e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    edges, steps = written(ordered(edges.where("a is not null and b is not null")), "edges"), []
    while edges.count() > finish_edges:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        seed = F.lit(len(steps))
        hashed = lambda c, seed=seed: F.struct(F.xxhash64(seed, c).alias("h"), F.col(c).alias("v"))
        nearest = both.groupBy("a").agg(F.min(hashed("b")).alias("m"))
        step = written(nearest.select(F.col("a").alias("node"), F.least(F.col("m"), hashed("a")).getField("v").alias("next")), "step")
        steps.append(step)
        for end in ("a", "b"):
            moved = lookup_join(edges, step.select(F.col("node").alias(end), "next"), [end])
            edges = moved.drop(end).withColumnRenamed("next", end)
        edges = written(ordered(edges), "edges")
    roots = written(edges.repartition(1).mapInPandas(_close, "node string, root string"), "roots")
    for step in reversed(steps):
        on = roots.select(F.col("node").alias("next"), "root")
        roots = written(lookup_join(step, on, ["next"], "left").select("node", F.coalesce("root", "next").alias("root")), "roots")
    return roots
