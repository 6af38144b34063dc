"""Problem 2: a sample whose categories have given shares, with minimums, and where that fails.

The pool is counted in cells of category x stratum. A flow network over these counts gives the
quotas: from the source to every category arcs for its minimum and for the rest of its target, on
to its cells as far as rows are available, from the cells to the strata (whose margins follow the
pool) and to the sink; a slack arc past each category shows what it lacks. Fractions are rounded
by random costs, up with a probability near the fraction, so quotas are whole numbers drawn at random. The rows are then drawn by hash.

Results for odd input: a record is a non-null key, of several deliveries the alphabetically first
category counts; records whose category is null or in no target are outside the pool; a category
without records has a shortfall if it has any target; a null share or minimum counts as 0, a null
rate as 1; an empty pool falls short in every category with a minimum; other columns are ignored.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphloom.functions.words import alike_key
from glyphloom.llm.draw import MAX_CELLS, draw
from glyphloom.llm.flow import MinCostFlow
from glyphloom.session import written

#: Costs in the network: a unit that a category lacks, a unit off a stratum's margin, a unit off a
#: cell's proportional share; random costs for rounding lie below ROUND.
LACK, OFF_MARGIN, OFF_CELL, ROUND = 10**15, 10**9, 10**8, 10**7


@dataclass(frozen=True)
class Target:
    category: str
    share: float
    least: int
    rate: float

    def rows(self, pool: int) -> Fraction:
        """Not rounded, and without the error of binary fractions."""
        return Fraction(str(self.share)) * Fraction(str(self.rate)) * pool


def targets_of(mix: DataFrame, field: str) -> list[Target]:
    """The targets of one field; their table is bounded by MAX_CELLS."""
    rows = mix.where((F.col("field_name") == field) & F.col("category").isNotNull()).limit(MAX_CELLS + 1).collect()
    if len(rows) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} categories")
    rate = lambda r: 1.0 if r["sample_rate"] is None else r["sample_rate"]
    return sorted((Target(r["category"], r["target_share"] or 0.0, r["min_rows"] or 0, rate(r)) for r in rows), key=lambda t: t.category)


def pool_of(df: DataFrame, key: str, category: str, stratum: str, targets: list[Target]) -> DataFrame:
    """(key, category, stratum): the distinct records whose category is alike a target's."""
    names = df.sparkSession.createDataFrame([(t.category,) for t in targets], "category string").select("category", alike_key(F.col("category")).alias("like"))
    kept = df.select(F.col(key).alias("key"), alike_key(F.col(category)).alias("like"), F.col(stratum).alias("stratum")).where("key is not null and like is not null")
    kept = kept.join(F.broadcast(names), "like")  # at most MAX_CELLS rows
    return kept.groupBy("key").agg(F.min("category").alias("category"), F.max("stratum").alias("stratum"))


@dataclass(frozen=True)
class Plan:
    quotas: dict[tuple, int]  # (category, stratum) -> rows
    wanted: dict[str, int]
    available: dict[str, int]
    lacking: dict[str, int]


def _round_cost(part: float, rnd: random.Random) -> int:
    """A random cost of rounding up what has the fractional part ``part``. Of parts that compete, those of
    least cost are rounded up, each with a probability near its part (order sampling of Pareto type)."""
    u = rnd.random()
    odds = lambda p: p / max(1 - p, 1e-9)
    q = odds(u) / max(odds(part), 1e-9)
    return int((ROUND - 1) * q / (1 + q))


def plan_quotas(cells: dict[tuple, int], targets: list[Target], seed: int) -> Plan:
    """Quotas of the cells, from their counts."""
    pool = sum(cells.values())
    have = {t.category: sum(n for (c, _), n in cells.items() if c == t.category) for t in targets}
    want = {t.category: max(math.ceil(t.rows(pool)), t.least) for t in targets}
    strata = sorted({s for _, s in cells}, key=lambda s: (s is not None, str(s)))
    total, rnd, net = sum(want.values()), random.Random(seed), MinCostFlow()
    margin = {s: total * sum(n for (_, x), n in cells.items() if x == s) / max(pool, 1) for s in strata}

    slack, parts = {}, {}
    for t in targets:
        c = t.category
        net.add("source", ("category", c), min(t.least, want[c]), 0)
        net.add("source", ("category", c), want[c] - min(t.least, want[c]), 0)
        slack[c] = net.add(("category", c), "sink", want[c], LACK)
        for s in strata:
            n = cells.get((c, s), 0)
            if not n:
                continue
            share = min(n, want[c]) * n / max(have[c], 1) if want[c] >= have[c] else want[c] * n / have[c]
            whole = min(n, math.floor(share))
            steps = ((whole, 0), (min(1, n - whole), _round_cost(share - whole, rnd)), (n - whole - min(1, n - whole), OFF_CELL))
            parts[c, s] = [net.add(("category", c), ("cell", c, s), size, cost) for size, cost in steps]
            net.add(("cell", c, s), ("stratum", s), n, 0)
    for s in strata:
        net.add(("stratum", s), "sink", math.floor(margin[s]), 0)
        net.add(("stratum", s), "sink", 1, 0)  # rounded with the cells
        net.add(("stratum", s), "sink", total, OFF_MARGIN)
    net.solve("source", "sink", total)
    return Plan({k: sum(map(net.flow, arcs)) for k, arcs in parts.items()}, want, have, {c: net.flow(arc) for c, arc in slack.items()})


@dataclass(frozen=True)
class Mixture:
    pool: DataFrame
    targets: list[Target]
    plan: Plan
    seed: int

    def sample(self) -> DataFrame:
        """(key, category, stratum): the rows drawn."""
        return draw(self.pool, ["category", "stratum"], "key", self.plan.quotas, self.seed)

    def report(self) -> list[tuple]:
        """(category, pool, wanted, drawn, lacking) of every target."""
        p = self.plan
        drawn = {c: sum(n for (x, _), n in p.quotas.items() if x == c) for c in p.wanted}
        return [(t.category, p.available[t.category], p.wanted[t.category], drawn[t.category], p.lacking[t.category]) for t in self.targets]


def mixture(df: DataFrame, key: str, category: str, stratum: str, mix: DataFrame, field: str, seed: int = 0) -> Mixture:
    targets = targets_of(mix, field)
    pool = written(pool_of(df, key, category, stratum, targets), "pool")
    counts = pool.groupBy("category", "stratum").agg(F.count(F.lit(1)).alias("n")).limit(MAX_CELLS + 1).collect()
    if len(counts) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} cells")
    cells = {(r["category"], r["stratum"]): r["n"] for r in counts}
    return Mixture(pool, targets, plan_quotas(cells, targets, seed), seed)
