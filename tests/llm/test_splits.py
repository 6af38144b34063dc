from __future__ import annotations

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from glyphloom.llm import queries, splits
from glyphloom.llm.flow import DealFlow

TUPLES = "ann_id string, image_id string, image_path string, source_dataset string, level string, split string, group_id string"
LINKS = "image_id_a string, image_id_b string, link_kind string"
REGISTRY = "source_dataset string, keep_whole boolean"
SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}


def tuples(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], TUPLES)


def components(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        up[root(a)] = root(b)
    groups = defaultdict(set)
    for x in list(up):
        groups[root(x)].add(x)
    return sorted(map(sorted, groups.values()))


def found(df):
    groups = defaultdict(set)
    for r in df.collect():
        groups[r.root].add(r.node)
    return sorted(map(sorted, groups.values()))


def test_components_by_contraction_and_at_once(spark):
    rnd = random.Random(4)
    edges = [(f"n{i:04d}", f"n{i + 1:04d}") for i in range(0, 300)]  # a chain
    edges += [("hub", f"s{i}") for i in range(300)] + [(f"r{rnd.randrange(200)}", f"r{rnd.randrange(200)}") for _ in range(120)]
    edges += [("x", "x"), ("n0007", "n0006")]
    df = spark.createDataFrame(edges, "a string, b string")
    want = components([e for e in edges if e[0] != e[1]])
    assert found(splits.components(df)) == want
    assert found(splits.components(df, finish_edges=5)) == want


def test_no_edges(spark):
    assert found(splits.components(spark.createDataFrame([], "a string, b string"))) == []


def test_ties(spark):
    rows = [("1", "b", "/x/B.jpg", "Album-1", "w"), ("2", "a", "/y/a.jpg", "album 1", "w"), ("3", "c", "/z/b.JPG", "other", "w"), ("4", "d", "/z/d.jpg", "other", "w"), ("5", "e", None, None, "w"), ("6", None, "/x/d.jpg", "album_1", "w"), ("7", "f", "/x/", "", None), ("8", "g", "/y/", "", None), ("9", "h", "h.jpg", "free", "w")]
    registry = spark.createDataFrame([("album_1", True), ("other", False), ("free", None), (None, True)], REGISTRY)
    links = spark.createDataFrame([("d", "q", "same"), ("q", "e", None), ("d", "h", "rejected"), ("h", "h", "same"), (None, "h", "same"), ("zz", "yy", "same")], LINKS)
    df = tuples(spark, rows)
    got = sorted((r.image_id_a, r.image_id_b) for r in splits.tied_pairs(splits.split(df, splits.groups_of(df, registry, links), "level", SHARES).images()).collect())
    assert got == [("a", "b"), ("a", "c"), ("d", "e")]


def test_quotas_of_bundles():
    sizes = {"hot": (1, 4000), "mid": (3, 300), "one": (5000, 1), "two": (7, 2)}
    quotas = splits.bundle_quotas({b: (k, {1: k * n}) for b, (k, n) in sizes.items()}, SHARES)
    rows = {s: sum(q[b,] * n for b, (_, n) in sizes.items()) for s, q in quotas.items()}
    total = sum(k * n for k, n in sizes.values())
    assert all(sum(quotas[s][b,] for s in SHARES) == k for b, (k, _) in sizes.items())
    assert all(abs(rows[s] - share * total) <= 1 for s, share in SHARES.items())


def test_flow_makes_up_for_a_heavy_group_of_one_label():
    """One group is a tenth of the rows and all of one label; the others can balance it."""
    bundles = {"hot": (1, {1: 400}), "a": (500, {1: 1000}), "b": (600, {1: 600, 2: 1200}), "c": (800, {2: 800})}
    quotas = splits.bundle_quotas(bundles, SHARES)
    for label in (1, 2):
        pool = sum(p.get(label, 0) for _, p in bundles.values())
        for s, share in SHARES.items():
            got = sum(quotas[s][b,] * p.get(label, 0) / n for b, (n, p) in bundles.items())
            assert abs(got - share * pool) <= 2


def test_flow_against_all_ways_to_deal():
    rnd = random.Random(3)
    shares = np.array([0.6, 0.4])
    for _ in range(30):
        amounts = np.array([rnd.randrange(1, 4) for _ in range(4)])
        contents = np.array([[a + b, a, b] for a, b in ((rnd.randrange(6), rnd.randrange(1, 6)) for _ in range(4))], dtype=float)
        flow = DealFlow(amounts, contents, shares)
        got = flow.solve()
        assert (got.sum(axis=1) == amounts).all() and (got >= 0).all()
        found, costs = flow.cost(), []
        for first in itertools.product(*(range(n + 1) for n in amounts)):
            flow.flow = np.column_stack([first, amounts - np.array(first)])
            costs.append(flow.cost())
        # near the least of all ways: no single cycle is left that would lower it
        assert found <= min(costs) + 0.05 * max(costs)


def test_split_keeps_groups_whole_and_shares(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(4000):
        image = "hot" if i % 5 == 0 else f"i{rnd.randrange(900):04d}"
        rows.append((f"a{i:05d}", image, f"/p/{image}.jpg", "src", rnd.choice(["word", "line", None])))
    rows += rows[:100] + [("n1", None, None, None, None), (None, "hot", "/p/hot.jpg", "src", "word")]
    df = tuples(spark, rows)
    links = spark.createDataFrame([(f"i{k:04d}", f"i{k + 1:04d}", "same") for k in range(0, 60, 2)], LINKS)
    groups = splits.groups_of(df, spark.createDataFrame([], REGISTRY), links)
    out = splits.split(df, groups, "level", SHARES).tuples().collect()
    assert len(out) == len({r.ann_id for r in out}) == 4001
    where = defaultdict(set)
    for r in out:
        where[r.group_id].add(r.split)
    assert all(len(s) == 1 for s in where.values())
    n = Counter(r.split for r in out)
    assert all(abs(n[s] - share * 4001) < 40 for s, share in SHARES.items())
    again = splits.split(df.repartition(5), groups, "level", SHARES).tuples().collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_shares_of_many_labels(spark):
    rows = [(f"a{k:05d}", f"i{k:05d}", None, None, f"label{k % 8}" if k % 9 else None) for k in range(4500)]
    df = tuples(spark, rows)
    groups = splits.groups_of(df, spark.createDataFrame([], REGISTRY), spark.createDataFrame([], LINKS))
    label = {r[0]: r[4] for r in rows}
    n = Counter((label[r.ann_id], r.split) for r in splits.split(df, groups, "level", SHARES).tuples().collect())
    assert len(n) == 27 and all(abs(v - SHARES[s] * 500) <= 2 for (_, s), v in n.items())


def test_profiles_are_coarsened_not_dropped(spark, monkeypatch):
    rnd = random.Random(8)
    rows = [(f"a{g:03d}_{k:02d}", f"i{g:03d}", None, None, "abcdefgh"[g % 8] if k < 20 else rnd.choice("pqrstuvw")) for g in range(400) for k in range(30)]
    df = tuples(spark, rows)
    groups = splits.groups_of(df, spark.createDataFrame([], REGISTRY), spark.createDataFrame([], LINKS))
    monkeypatch.setattr(splits, "MAX_CELLS", 40)
    n = Counter((int(r.image_id[1:]) % 8, r.split) for r in splits.split(df, groups, "level", SHARES).tuples().collect())
    assert all(abs(n[which, s] / 30 - share * 50) <= 1 for which in range(8) for s, share in SHARES.items())


def test_empty(spark):
    df = tuples(spark, [])
    groups = splits.groups_of(df, spark.createDataFrame([], REGISTRY), spark.createDataFrame([], LINKS))
    assert groups.collect() == [] and splits.split(df, groups, "level", SHARES).tuples().collect() == []


@pytest.mark.parametrize(("hot", "kept"), [(0, True), (950, False)])
def test_balance_compares_with_the_whole_pool(spark, tmp_path, hot, kept):
    """hot: rows of one image, which no split but train can take and train only beyond its share."""
    rows = [(f"a{k:04d}", "hot" if k < hot else f"i{k:04d}", None, None, ("line", "word", None)[k % 3]) for k in range(1000)]
    tuples(spark, rows + rows[:50]).withColumnRenamed("level", "answer_level").write.parquet(f"{tmp_path}/bootstrap_tuples.parquet")
    spark.createDataFrame([], REGISTRY).write.parquet(f"{tmp_path}/source_registry.parquet")
    spark.createDataFrame([], LINKS).write.parquet(f"{tmp_path}/image_links.parquet")
    got = {(r.split, r.label): tuple(r)[2:] for r in queries.p5_balance(spark, str(tmp_path)).collect()}
    assert {k: v[0] for k, v in got.items()} == {(s, label): n for s in SHARES for label, n in (("line", 334), ("word", 333), (None, 333))}
    assert all(share == kept and whole for _, _, share, whole in got.values())
    assert not kept or all(label_share for _, label_share, _, _ in got.values())


def test_balance_on_the_smallest_tables(spark, sf):
    got = queries.p5_balance(spark, sf).collect()
    assert len(got) == 6 and all(r.label_share_kept and r.share_kept and r.groups_whole for r in got)
