from __future__ import annotations

import math
import random
from collections import defaultdict
from datetime import datetime, timedelta

from glyphloom.llm import topn

T0 = datetime(2025, 1, 1)
SCHEMA = "grp string, id string, score double, at timestamp, rank int, lo double"
INF = float("inf")


def run(spark, rows, n=3, **how):
    df = spark.createDataFrame([(*r, 0, 0.0) for r in rows], SCHEMA)
    scored = topn.latest_scores(df, "grp", "id", "score", "at")
    return sorted((r.group_key, r["rank"], r.item_key) for r in topn.top_items(scored, n, **how).collect())


def brute(rows, n=3):
    last = {}
    for g, i, s, at in rows:
        k = (at or datetime.min, -INF if s is None else INF if s != s else s)
        if i is not None and (i not in last or k >= last[i][0]):
            last[i] = (k, g, s)
    groups = defaultdict(list)
    for i, (_, g, s) in last.items():
        if g is not None and s is not None and not math.isnan(s):
            groups[g].append((-s, i))
    return sorted((g, r, i) for g, x in groups.items() for r, (_, i) in enumerate(sorted(x)[:n], 1))


def test_versions_ties_nulls(spark):
    later = T0 + timedelta(days=1)
    rows = [("g", "a", 1.0, T0), ("g", "b", 1.0, T0), ("g", "c", 2.0, T0), ("g", "c", 0.5, later), ("g", "d", 9.0, T0), ("g", "d", float("nan"), later), ("g", "e", 9.0, T0), ("g", "e", None, later), ("g", "f", 0.5, None), (None, "x", 1.0, T0), ("g", None, 99.0, T0), ("h", "z", -INF, T0), ("h", "y", INF, T0)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert got == [("g", 1, "a"), ("g", 2, "b"), ("g", 3, "c"), ("h", 1, "y"), ("h", 2, "z")]


def test_empty(spark):
    assert run(spark, []) == []


def test_thresholds_lose_nothing(spark):
    rnd = random.Random(3)
    scores = [lambda: rnd.gauss(0, 1), lambda: float(rnd.randrange(3)), lambda: 1.0, lambda: rnd.choice([1e308, -1e308, INF, -INF, 0.0]), lambda: math.exp(rnd.gauss(0, 20)), lambda: rnd.random() * 5e-324 + 1e-300]
    rows = [(f"g{i % 6}", f"id{i:05d}", scores[i % 6](), T0) for i in range(3000)] + [(f"s{i % 50}", f"s{i}", rnd.random(), T0) for i in range(300)]
    rnd.shuffle(rows)
    assert run(spark, rows, 5, least=20) == brute(rows, 5)


def test_thresholds_cut_hot_groups(spark):
    rows = [("hot", f"id{i:05d}", i / 7, T0) for i in range(4000)]
    df = spark.createDataFrame([(*r, 0, 0.0) for r in rows], SCHEMA)
    scored = topn.latest_scores(df, "grp", "id", "score", "at")
    limit = topn.thresholds(scored, 3).collect()
    assert len(limit) == 1
    kept = sum(1 for _, _, s, _ in rows if (s - limit[0].lo) * limit[0].scale >= limit[0].floor_bucket)
    assert 3 <= kept <= 12
