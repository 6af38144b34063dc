from __future__ import annotations

import itertools
import random
from collections import Counter

import pytest
from glyphloom.llm.draw import draw
from glyphloom.llm.flow import MinCostFlow
from glyphloom.llm.mixture import Target, mixture, plan_quotas

MIX = "field_name string, category string, target_share double, min_rows int, sample_rate double"


def test_flow_against_enumeration():
    rnd = random.Random(1)
    for _ in range(40):
        supply, caps = [rnd.randrange(1, 4) for _ in range(2)], [[rnd.randrange(3) for _ in range(3)] for _ in range(2)]
        costs, room = [[rnd.randrange(9) for _ in range(3)] for _ in range(2)], [rnd.randrange(3) for _ in range(3)]
        net = MinCostFlow()
        arcs = {}
        for i in range(2):
            net.add("s", i, supply[i], 0)
            for j in range(3):
                arcs[i, j] = net.add(i, ("t", j), caps[i][j], costs[i][j])
        for j in range(3):
            net.add(("t", j), "t", room[j], 0)
        sent = net.solve("s", "t", 99)
        best = {}
        for x in itertools.product(*(range(caps[i][j] + 1) for i in range(2) for j in range(3))):
            x = [x[:3], x[3:]]
            if all(sum(x[i]) <= supply[i] for i in range(2)) and all(x[0][j] + x[1][j] <= room[j] for j in range(3)):
                n, c = sum(map(sum, x)), sum(x[i][j] * costs[i][j] for i in range(2) for j in range(3))
                best[n] = min(c, best.get(n, 10**9))
        assert sent == max(best)
        assert sum(net.flow(a) * costs[i][j] for (i, j), a in arcs.items()) == best[sent]


def test_quotas_meet_targets_or_show_what_lacks():
    targets = [Target("a", 0.5, 0, 0.1), Target("b", 0.3, 10, 0.1), Target("c", 0.2, 5, 0.1), Target("d", 0.0, 7, 0.1)]
    cells = {("a", "x"): 600, ("a", "y"): 200, ("b", "x"): 100, ("b", None): 95, ("c", "x"): 3, ("c", "y"): 2}
    p = plan_quotas(cells, targets, 0)
    assert p.wanted == {"a": 50, "b": 30, "c": 20, "d": 7}
    assert p.lacking == {"a": 0, "b": 0, "c": 15, "d": 7}
    by = Counter()
    for (c, _), n in p.quotas.items():
        by[c] += n
    assert by == {"a": 50, "b": 30, "c": 5}
    assert all(p.quotas[k] <= n for k, n in cells.items())
    assert abs(p.quotas["a", "x"] - 37.5) < 5


def test_fractions_are_rounded_up_as_often_as_they_say():
    targets = [Target("a", 1.0, 0, 0.1)]
    cells = {("a", "x"): 112, ("a", "y"): 37, ("a", "z"): 61}  # shares of 11.2, 3.7 and 6.1 rows
    n = 600
    mean = {k: sum(plan_quotas(cells, targets, seed).quotas[k] for seed in range(n)) / n for k in cells}
    assert all(abs(mean[k] - c / 10) < 0.12 for k, c in cells.items())


def test_draw_is_exact_and_repeats(spark):
    rows = [(c, k, f"{c}{i}") for c, k, n in (("a", 1, 900), ("a", None, 40), ("b", 1, 10), ("c", 2, 5)) for i in range(n)]
    df = spark.createDataFrame(rows, "cat string, k int, id string").withColumnRenamed("cat", "_cat").withColumnRenamed("_cat", "cat")
    quotas = {("a", 1): 333, ("a", None): 7, ("b", 1): 20, ("c", 2): 0}
    few = draw(df, ["cat", "k"], "id", quotas, 3, ranked_rows=10).collect()
    assert Counter((r.cat, r.k) for r in few) == {("a", 1): 333, ("a", None): 7, ("b", 1): 10}
    assert len({r.id + str(r.k) for r in few}) == len(few)
    whole = draw(df.repartition(7), ["cat", "k"], "id", quotas, 3).collect()
    assert sorted(map(str, few)) == sorted(map(str, whole))
    assert sorted(map(str, draw(df, ["cat", "k"], "id", quotas, 4).collect())) != sorted(map(str, few))
    assert draw(df, ["cat", "k"], "id", {}, 3).collect() == []


def test_mixture_of_spellings_nulls_and_repeats(spark):
    rows = [("1", "Yes_No", "w"), ("1", "Yes_No", "w"), ("2", "yes-no ", None), ("3", None, "w"), (None, "yes_no", "w"), ("4", "other", "w"), ("5", "", "w")]
    rows += [(f"x{i}", "READ", "l") for i in range(20)]
    df = spark.createDataFrame(rows, "id string, t string, level string").selectExpr("*", "id as key", "t as category")
    mix = spark.createDataFrame([("t", "YES_NO", 0.5, 3, 0.5), ("t", "READ", 0.5, 2, 0.5), ("t", "NONE", None, 1, None), ("u", "READ", 1.0, 9, 1.0)], MIX)
    m = mixture(df, "id", "t", "level", mix, "t")
    assert m.report() == [("NONE", 0, 1, 0, 1), ("READ", 20, 6, 6, 0), ("YES_NO", 2, 6, 2, 4)]
    drawn = m.sample().collect()
    assert Counter(r.category for r in drawn) == {"READ": 6, "YES_NO": 2}
    assert len({r.key for r in drawn}) == 8


def test_empty_pool(spark):
    df = spark.createDataFrame([], "id string, t string, level string")
    mix = spark.createDataFrame([("t", "A", 1.0, 3, 0.5)], MIX)
    m = mixture(df, "id", "t", "level", mix, "t")
    assert m.report() == [("A", 0, 3, 0, 3)] and m.sample().collect() == []


def test_too_many_cells_are_refused(spark):
    with pytest.raises(ValueError):
        draw(spark.createDataFrame([("a", "b")], "c string, id string"), ["c"], "id", {(str(i),): 1 for i in range(20_001)}, 0)
