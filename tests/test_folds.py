"""Folds over large images: kept boxes looked up by size and place, blocks cut without forming pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from glyphloom.operators import folds

BOX = "struct<x1: double, y1: double, x2: double, y2: double>"


def boxes(r, n, side):
    """Of like sizes, so that many overlap in all degrees; some empty or turned."""
    out = []
    for _ in range(n):
        x, y, w, h = r.uniform(0, side), r.uniform(0, side), r.choice([30, 32, 64, 90]) * r.uniform(0.9, 1.1), r.choice([16, 20, 40]) * r.uniform(0.9, 1.1)
        out.append((x, y, x + r.choice([w] * 20 + [0, -w]), y + h))
    return out


def block(rows):
    columns = {"box": [dict(zip(("x1", "y1", "x2", "y2"), b)) for b in rows], "label": [None] * len(rows)}
    return folds.Block(columns, 0, len(rows))


@pytest.mark.parametrize("least", [0.5, 0.62, 0.85])
def test_kept_boxes_are_looked_up(least):
    """the same clusters as by measuring every kept box, of which only a small part is measured."""
    rows = boxes(random.Random(3), 1500, 250)
    measured = []

    def fits(o, box):
        a, b, u = o.measure(box)
        measured.append((len(a), o.n))
        return (np.minimum(a, b) >= least) | (u >= least)

    every = folds.exemplars(block(rows), fits, ["label"])
    assert all(m == n for m, n in measured) and len(every) < 1500
    measured.clear()
    assert folds.exemplars(block(rows), fits, ["label"], least) == every
    assert sum(m for m, n in measured if n > folds.Overlaps.FEW) * 4 < sum(n for _, n in measured if n > folds.Overlaps.FEW)


def test_groups_of_touching_boxes(spark):
    """F8: as by comparing all boxes, though the many on one lattice point form no pairs."""
    from glyphloom.operators.boxes import strangers, touching
    from pyspark.sql import functions as F

    r = random.Random(8)
    rows = [(s, f"{s}{i}", b) for s, side in (("a", 500), ("b", 4000)) for i, b in enumerate(boxes(r, 250, side)) if b[2] >= b[0]]
    df = spark.createDataFrame(rows, f"block_id string, name string, box {BOX}")
    up = {n: n for _, n, _ in rows}

    def top(x):
        return x if up[x] == x else top(up[x])

    for s, n, a in rows:
        for t, m, b in rows:
            if s == t and max(a[0], b[0]) <= min(a[2], b[2]) and max(a[1], b[1]) <= min(a[3], b[3]):
                up[top(n)] = top(m)
    groups = {}
    for row in touching(df, "name", "block_id").collect():
        groups.setdefault(row["_root"], set()).add(row["name"])
    want = {}
    for n in up:
        want.setdefault(top(n), set()).add(n)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values())) and 20 < len(want) < 400
    one = df.where("block_id = 'a'").withColumn("_root", F.lit("x"))
    assert strangers(one, "_root", "box", "block_id").count() == 0


def test_large_images_are_cut_by_relation(spark):
    """rows of different relations are apart, though their boxes lie on each other."""
    rows = [("i", f"k{n}", (10.0, 10.0, 90.0, 60.0), f"r{n % 7}") for n in range(70)] + [("j", "k", (10.0, 10.0, 90.0, 60.0), "r0")]
    df = spark.createDataFrame(rows, f"image_id string, key string, box {BOX}, _part string")
    cut = folds.blocks(df, "key", block_rows=20)
    assert "_part" not in cut.columns and cut.count() == 71
    assert sorted(r[1] for r in cut.groupBy("block_id").count().collect()) == [1] + [10] * 7
    assert folds.blocks(df, "key", block_rows=5).select("block_id").distinct().count() == 8


def test_merged_detections_of_equal_confidence(spark, monkeypatch):
    """an image folded in several blocks numbers what is equally sure as if it were one: by area, then key."""
    r = random.Random(4)
    rows = [("i", f"k{r.random()}", b, r.choice([0.5, 0.9, None]), ["s"]) for b in boxes(r, 150, 900) if b[2] > b[0]]
    df = spark.createDataFrame(rows, f"image_id string, key string, box {BOX}, confidence double, sources array<string>")
    results = lambda: sorted((x.number, x.key) for x in folds.merge_detections(df, most=40).collect())
    whole, split = results(), folds.blocks
    monkeypatch.setattr(folds, "blocks", lambda d, k: split(d, k, block_rows=10))
    assert folds.blocks(df, "key").select("block_id").distinct().count() > 10
    assert len(whole) == 40 and results() == whole
