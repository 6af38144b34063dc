"""Candidates by tiles give what the SQL of the queries gives, whatever the tiles and the input."""

from __future__ import annotations

import random

import pytest
from glyphloom.operators import boxes
from glyphloom.plans import queries as Q
from glyphloom.plans import views as V
from pyspark.sql import functions as F

BOX = "struct<x1: double, y1: double, x2: double, y2: double>"
CA = Q._CANDIDATES.removeprefix(f"{V.NODES}, {V.ANCHORS}, ")


def made(spark, n, seed, sizes=((900, 700),)):
    """n texts and n anchors of one image a size, among them turned and empty boxes, and anchors without a side."""
    r = random.Random(seed)

    def box(wide, high, w, h, *more):
        x, y = round(r.uniform(-20, (w or 900) - 10), 1), round(r.uniform(-20, (h or 700) - 10), 1)
        b = (x, y, x + round(r.uniform(0, wide), 1), y + round(r.uniform(0, high), 1))
        return r.choice([b] * 30 + [(b[2], b[1], b[0], b[3]), (b[0], b[1], b[0], b[3])] + [(None, *b[1:])] * len(more))

    texts, anchors = [], []
    for k, (w, h) in enumerate(sizes):
        for i in range(n):
            b = box(90, 40, w, h)
            corners = [b[0], b[1], b[2], b[1], b[2], b[3], b[0], b[3]]
            texts.append((f"i{k}", f"n{i}", b, corners, w, h))
            wide = r.choice([90, 300, 800])
            anchors.append((f"i{k}", f"a{i}", r.choice(["sign", "wall", "can"]), round(r.random(), 2), r.choice(["in", "on", None]), box(wide, wide / 2, w, h, None)))
    t = spark.createDataFrame(texts, f"image_id string, node_id string, box {BOX}, polygon array<double>, image_width int, image_height int")
    a = spark.createDataFrame(anchors, f"image_id string, anchor_id string, label string, score double, source string, box {BOX}")
    return t, a


@pytest.fixture
def db(tmp_path):
    duckdb = pytest.importorskip("duckdb")
    with duckdb.connect() as c:

        def load(**frames):
            for name, df in frames.items():
                df.write.parquet(str(tmp_path / name))
                c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path / name}/*.parquet'")
            return c

        yield load


def keyed(rows, columns):
    return sorted(tuple(str(r[c]) for c in columns) for r in rows)


@pytest.mark.parametrize("n,sizes", [(40, ((900, 700), (None, 700), (None, None), (300, 300))), (400, ((2000, 1500),))])
def test_candidates_as_in_sql(spark, db, n, sizes):
    """In one tile and in many; an image of many texts has several thousand pairs compared at once."""
    from glyphloom.operators import anchoring

    texts, anchors = made(spark, n, n, sizes)
    columns = ["image_id", "node_id", "anchor_id", "relation", "relevance"]
    want = keyed(db(nodes=texts, anchors=anchors).execute(f"WITH {CA} SELECT {', '.join(columns)} FROM cand").df().to_dict("records"), columns)
    assert len({r[3] for r in want}) == 5
    assert keyed(boxes.anchor_candidates(texts, anchors).collect(), columns) == want
    assert keyed(anchoring.candidates(texts, anchors, tile_texts=15).collect(), columns) == want


def test_best_anchor_as_in_sql(spark, db):
    """Chosen in the tile, among equal relevance and score by anchor_id."""
    from glyphloom.operators import anchoring

    texts, anchors = made(spark, 300, 5, ((900, 700), (2000, 1500)))
    anchors = anchors.unionByName(anchors.withColumn("anchor_id", F.concat(F.lit("0"), "anchor_id")))
    columns = ["image_id", "node_id", "anchor_id", "relation", "relevance"]
    sql = f"WITH {CA} SELECT DISTINCT ON (image_id, node_id) {', '.join(columns)} FROM cand ORDER BY image_id, node_id, relevance DESC, score DESC, anchor_id"
    want = keyed(db(nodes=texts, anchors=anchors).execute(sql).df().to_dict("records"), columns)
    assert len(want) > 400 and all(r[2][0] == "0" for r in want)
    assert keyed(anchoring.nearest_anchors(texts, anchors).collect(), columns) == want
    assert keyed(anchoring.nearest_anchors(texts, anchors, tile_texts=15).collect(), columns) == want


def test_signs_of_a_large_image(spark, sf, db, monkeypatch):
    """The image that holds a tenth of the rows, cut into tiles, bears the signs that SQL finds."""
    from glyphloom.operators import anchoring

    monkeypatch.setattr(anchoring, "tiled", lambda n, a, k, f=anchoring.tiled: f(n, a, 2))
    c = db()
    for t in ("text_nodes", "bootstrap_tuples"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    columns = ["image_id", "label", "node_ids", "answer"]
    want = keyed(c.execute(Q.SQL["sign_groups"]).df().to_dict("records"), columns)
    assert want and keyed(Q.QUERIES["sign_groups"](spark, sf).collect(), columns) == want


@pytest.mark.parametrize("small", [0, 1000])
def test_groups_of_texts_as_in_sql(spark, db, small):
    """As arrays, or tied by tiles and then pair by pair; also where the picture's size is unknown."""
    texts, _ = made(spark, 200, 9, ((9000, 8000), (9000, 8000)))
    texts = texts.withColumns({"image_width": F.when(F.col("image_id") == "i0", 800), "image_height": F.lit(600)})
    columns = ["image_id", "node_id", "group_id"]
    sql = Q._TEXT_GROUPS.removeprefix(f"{V.NODES}, ")
    want = keyed(db(nodes=texts).execute(f"WITH RECURSIVE {sql} SELECT * FROM gr").df().to_dict("records"), columns)
    assert 20 < len({r[::2] for r in want}) < 390
    assert keyed(boxes.text_groups(texts, small=small).collect(), columns) == want


def test_a_crowd_of_texts_forms_no_pairs(spark, monkeypatch):
    """All texts of a crowded picture are tied by tiles, so none is left to compare."""
    left = []

    def counted(*args, f=boxes.strangers, **more):
        left.append(f(*args, **more))
        return left[-1]

    monkeypatch.setattr(boxes, "strangers", counted)
    texts, _ = made(spark, 3000, 1, ((2000, 1500),))
    assert boxes.text_groups(texts).select("group_id").distinct().count() == 1
    assert [f.count() for f in left] == [0]


def test_support_by_tiles(spark):
    """As the fold over each text's candidates counts it; in small tiles, and as bits in a large one."""
    from glyphloom.operators import anchoring, folds

    texts, anchors = made(spark, 300, 7, ((2000, 1500), (300, 200)))
    anchors = anchors.withColumn("label", F.when(F.col("anchor_id").endswith("3"), "").when(F.col("anchor_id").endswith("4"), F.lit(None)).otherwise(F.col("label")))
    columns = ["image_id", "node_id", "anchor_id", "support_count", "source_support_count", "labels"]
    found = folds.with_support(boxes.anchor_candidates(texts, anchors)).withColumn("labels", F.size("support_labels"))
    want = keyed(found.collect(), columns)
    for tile_texts in (500, 20):
        assert keyed(anchoring.with_support(texts, anchors, tile_texts=tile_texts).collect(), columns) == want
