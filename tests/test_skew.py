from __future__ import annotations

import random
from collections import Counter

from glyphloom.operators import boxes, skew
from pyspark.sql import functions as F

BOX = "struct<x1: double, y1: double, x2: double, y2: double>"


def test_counts_of_heavy_and_light_scopes(spark, monkeypatch):
    rnd = random.Random(1)
    rows = [("hot" if i % 3 == 0 else f"g{rnd.randrange(40)}", rnd.choice("ab"), rnd.choice("xyz")) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, a string, b string")
    sets = {"n_a": ["a"], "n_ab": ["a", "b"], "n": []}
    want = sorted((*r, sum(x[:2] == r[:2] for x in rows), Counter(rows)[r], sum(x[0] == r[0] for x in rows)) for r in rows)
    assert sorted(map(tuple, skew.with_counts(df, ["g"], sets).collect())) == want
    monkeypatch.setattr(skew, "heavy_keys", lambda d, keys, *_: d.groupBy(*keys).count().where("count > 100").select(*keys))
    assert sorted(map(tuple, skew.with_counts(df, ["g"], sets).collect())) == want


def test_competitors_of_a_hot_image(spark, monkeypatch):
    rnd = random.Random(2)
    rows = []
    for i in range(150):
        x, y = rnd.uniform(0, 300), rnd.uniform(0, 300)
        rows.append(("hot" if i % 3 else f"i{i % 7}", f"t{i:03d}", rnd.choice(["on", "in"]), rnd.choice(["", "sign", "can"]), rnd.choice(["", "a", "b"]), rnd.choice(["ul", "cc"]), rnd.choice(["", "s1"]), rnd.choice(["", "k1", "k2"]), (x, y, x + 80, y + 60)))
    df = spark.createDataFrame(rows, f"image_id string, tuple_id string, relation string, label string, answer string, coarse string, specific string, bucket string, box {BOX}")

    def iou(a, b):
        s = max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))
        return s / (9600 - s)

    want = {}
    for r in rows:
        near = [o for o in rows if o[0] == r[0] and o[2] == r[2] and o[1] != r[1]]
        filled = lambda o, n: r[n] != "" and o[n] == r[n]  # noqa: B023, E731
        confusable = [o for o in near if o[3] == r[3] and (filled(o, 5) or filled(o, 6) or filled(o, 7)) or iou(o[8], r[8]) >= 0.6 or filled(o, 5) and filled(o, 7)]
        same = [o for o in near if o[3] == r[3] and filled(o, 4)]
        answers = {o[4] for o in [*near, r] if o[3] == r[3] and o[4]}
        want[r[1]] = (sum(o[3] == r[3] for o in near), sum(iou(o[8], r[8]) >= 0.45 for o in near), sum(filled(o, 5) for o in near), sum(filled(o, 7) for o in near), len(confusable), len(same) + 1 if r[4] else 0, sum(iou(o[8], r[8]) < 0.35 for o in same) + 1 if r[4] else 0, len(answers))
    names = ["anchor_label_competitors", "anchor_overlap_competitors", "coarse_region_competitors", "bucket_competitors", "competing_tuples", "same_anchor_same_answer_count", "same_anchor_same_answer_nonoverlap_instances", "same_anchor_distinct_answer_count"]
    got = lambda: {r.tuple_id: tuple(r[n] for n in names) for r in boxes.competitors(df).collect()}
    assert got() == want
    monkeypatch.setattr(skew, "heavy_keys", lambda d, keys, *_: d.groupBy(*keys).count().where("count > 30").select(*keys))
    assert got() == want


def test_groups_of_texts_come_with_their_smallest_key(spark):
    rows = [("i", f"n{k}", (k * 10.0, 0.0, k * 10.0 + 12, 10.0), 1000, 1000) for k in range(6)] + [("i", "z", (900.0, 900.0, 910.0, 910.0), 1000, 1000), ("j", "n9", (0.0, 0.0, 5.0, 5.0), 10, 10)]
    df = spark.createDataFrame(rows, f"image_id string, node_id string, box {BOX}, image_width int, image_height int")
    got = {(r.image_id, r.node_id): r.group_id for r in boxes.text_groups(df).select("image_id", "node_id", F.col("group_id")).collect()}
    assert got == {("i", f"n{k}"): "n0" for k in range(6)} | {("i", "z"): "z", ("j", "n9"): "n9"}


def test_places_of_texts_in_their_group(spark, monkeypatch):
    at = lambda i, n, x, y, ok=True: (i, n, (x, y, x + 10.0, y + 10.0), 1000, 1000, ok)
    # a grid within one third of the picture; a compact row, stack and cluster about the picture's middle
    rows = [at("grid", "ab"[r] + "12"[c], 20.0 + 15 * c, 20.0 + 15 * r, (r, c) != (0, 0)) for r in range(2) for c in range(2)] + [at("grid", "a3", 20.0, 35.0, None)]
    rows += [at("row", f"n{k}", 320.0 + 12 * k, 500.0) for k in range(3)] + [at("stack", f"n{k}", 500.0, 320.0 + 12 * k) for k in range(2)] + [at("one", "n", 5.0, 5.0)]
    rows += [at("cluster", f"n{k}", x, y) for k, (x, y) in enumerate([(335.0, 335.0), (347.0, 335.0), (335.0, 347.0)])]
    df = spark.createDataFrame(rows, f"image_id string, node_id string, box {BOX}, image_width int, image_height int, resolvable boolean")

    def got():
        found = boxes.text_places(boxes.text_groups(df)).collect()
        return {(r.image_id, r.node_id): (r.shape, r.size, r.unresolved, r.x_rank, r.y_rank, r.bucket_key, r.bucket_occupancy, tuple(r.group_box)) for r in found}

    g, r, s, c = (20.0, 20.0, 45.0, 45.0), (320.0, 500.0, 354.0, 510.0), (500.0, 320.0, 510.0, 342.0), (335.0, 335.0, 357.0, 357.0)
    want = {("grid", "a1"): ("grid", 5, 2, 0, 0, "upper_left", 1, g), ("grid", "a2"): ("grid", 5, 2, 3, 1, "upper_right", 1, g), ("grid", "b2"): ("grid", 5, 2, 4, 4, "lower_right", 1, g)}
    want |= {("grid", n): ("grid", 5, 2, 1, 2, "lower_left", 2, g) for n in ("b1", "a3")}  # equal centres share a rank
    want |= {("row", f"n{k}"): ("row", 3, 0, k, 0 + k, n, 0, r) for k, n in enumerate(["left", "middle", "right"])}
    want |= {("stack", f"n{k}"): ("stack", 2, 0, k, k, n, 0, s) for k, n in enumerate(["upper", "lower"])}
    want |= {("one", "n"): ("singleton", 1, 0, 0, 0, "singleton", 0, (5.0, 5.0, 15.0, 15.0))}
    want |= {("cluster", f"n{k}"): ("cluster", 3, 0, *ranks, n, 1, c) for k, (ranks, n) in enumerate([((0, 0), "upper_left"), ((2, 1), "upper_right"), ((1, 2), "lower_left")])}
    assert got() == want
    monkeypatch.setattr(skew, "heavy_keys", lambda d, keys, *_: d.groupBy(*keys).count().where("count > 2").select(*keys))
    assert got() == want
