from __future__ import annotations

import json
import random

import pytest
from glyphloom.functions.labels import PLAIN_ANCHORS
from glyphloom.operators import agreement, boxes, folds, graph, quality, rescue, skew, tables, votes
from glyphloom.sources import readers, writers
from pyspark.sql import functions as F

BOX = "struct<x1: double, y1: double, x2: double, y2: double>"


def test_consensus_tiers(spark):
    cases = {
        "strong": ([("parseq", "OPEN", 0.98), ("trocr_small", "OPEN", 0.91), ("trocr_base", "OPEN", 0.95)], (True, "strong_consensus", "OPEN")),
        "standard": ([("a", "HELLO", 0.90), ("b", "HELLO", 0.88), ("c", "WORLD", 0.92)], (True, "standard_consensus", "HELLO")),
        "edit": ([("a", "APPRENTICE", 0.83), ("b", "APPRENTlCE", 0.81), ("c", "APPFENTICE", 0.72)], (True, "edit_rescue", "APPRENTICE")),
        "low": ([("a", "NOPE", 0.21), ("b", "N0PE", 0.14), ("c", "MAYBE", 0.19)], (False, "dropped", "low_confidence")),
        "one": ([("a", "111111111111", 0.99), ("b", "", 0.91), ("c", "***", 0.88)], (False, "dropped", "invalid_text_or_low_confidence")),
        "none": ([("a", "One", 0.9), ("b", "Two", 0.9)], (False, "dropped", "full_disagreement")),
    }
    rows = [("i", n, m, t, c, 0) for n, (vs, _) in cases.items() for m, t, c in vs]
    df = spark.createDataFrame(rows, "image_id string, node_id string, model_name string, text string, confidence double, rotation int")
    got = {r.node_id: (r.accepted, r.consensus_tier, r.text or r.failure_reason) for r in votes.consensus(df).collect()}
    assert got == {n: want for n, (_, want) in cases.items()}
    detections = spark.createDataFrame([("i", "strong"), ("i", "missing")], "image_id string, node_id string")
    reasons = {r.node_id: r.failure_reason for r in votes.node_consensus(detections, df).collect()}
    assert reasons == {"strong": None, "missing": "no_votes"}


def random_boxes(rnd, n, image="i", size=600):
    out = []
    for k in range(n):
        x, y = rnd.uniform(0, size), rnd.uniform(0, size)
        out.append((image, f"k{k:04d}", (x, y, x + rnd.uniform(1, 200), y + rnd.uniform(1, 120))))
    return out


def area(b):
    return (b[2] - b[0]) * (b[3] - b[1])


def shared(a, b):
    return max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))


def iou(a, b):
    s = shared(a, b)
    return s / (area(a) + area(b) - s) if s else 0


def mutual(a, b):
    return shared(a, b) / max(area(a), area(b))


def test_grid_join_finds_every_touching_pair_once(spark):
    rnd = random.Random(1)
    rows = random_boxes(rnd, 60) + random_boxes(rnd, 30, "j") + [("i", "zz", None)]
    df = spark.createDataFrame(rows, f"image_id string, key string, box {BOX}")
    got = sorted((r.l.image_id, r.l.key, r.r.key) for r in boxes.near_pairs(df, df, cell=64).collect())
    touch = lambda a, b: a[0] <= b[2] and b[0] <= a[2] and a[1] <= b[3] and b[1] <= a[3]
    want = sorted((i, k, m) for i, k, a in rows for j, m, b in rows if i == j and a and b and touch(a, b))
    assert got == want


def test_nearest_against_all_distances(spark):
    rnd = random.Random(2)
    rows = [(*r, 600, 600) for r in random_boxes(rnd, 80)] + [(*r, 600, 600) for r in random_boxes(rnd, 5, "j")] + [("one", "k", (0.0, 0.0, 1.0, 1.0), 10, 10)]
    df = spark.createDataFrame(rows, f"image_id string, node_id string, box {BOX}, image_width int, image_height int")
    got = {(r.image_id, r.node_id, r["rank"]): r.neighbor for r in boxes.nearest(df, 4).collect()}
    center = lambda b: ((b[0] + b[2]) / 2, (b[1] + b[3]) / 2)
    want = {}
    for i, k, a, *_ in rows:
        near = sorted((round(((center(a)[0] - center(b)[0]) ** 2 + (center(a)[1] - center(b)[1]) ** 2) ** 0.5, 1), m) for j, m, b, *_ in rows if j == i and m != k)
        want |= {(i, k, n): m for n, (_, m) in enumerate(near[:4], 1)}
    assert got == want


def test_components(spark):
    df = spark.createDataFrame([("a", "b"), ("c", "b"), ("d", "e"), ("f", "f"), (None, "a")], "a string, b string")
    for finish in (100, 0):
        groups = {}
        for r in graph.components(df, finish).collect():
            groups.setdefault(r.root, set()).add(r.node)
        assert sorted(map(sorted, groups.values())) == [["a", "b", "c"], ["d", "e"]]


def test_lookup_join_with_heavy_keys(spark):
    left = spark.createDataFrame([("hot" if i % 2 else f"k{i}", i) for i in range(200)] + [(None, 999)], "k string, v int")
    right = spark.createDataFrame([("hot", 1), ("k2", 2)], "k string, w int")
    heavy = skew.heavy_keys(left, ["k"], share=0.1, least=10)
    assert [r.k for r in heavy.collect()] == ["hot"]
    for how, n in (("inner", 101), ("left", 201)):
        assert skew.lookup_join(left, right, ["k"], how, heavy).count() == n


def test_subsumed_rows(spark):
    rows = [("i", "m", "on", (0.0, 0.0, 10.0, 10.0), ["a", "b", "c"], "merged"), ("i", "w", "on", (0.0, 0.0, 9.0, 9.0), ["a"], "word"), ("i", "p", "on", (0.0, 0.0, 9.0, 9.0), ["a", "b"], "pair"), ("i", "u", "on", (0.0, 0.0, 9.0, 9.0), ["z"], "word")]
    df = spark.createDataFrame(rows, f"image_id string, tuple_id string, relation string, box {BOX}, text_node_ids array<string>, group_kind string")
    assert sorted(r.tuple_id for r in boxes.not_subsumed(df).collect()) == ["m", "u"]


def test_tables(spark):
    a = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "image_id string, v int")
    b = spark.createDataFrame([("b", 20), ("c", 30)], "image_id string, v int")
    ids = spark.createDataFrame([("b",), ("c",), ("b",)], "image_id string")
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(tables.overwrite(a, b, ids)) == [("a", 1), ("b", 20), ("c", 30), (None, 3)]
    assert rows(tables.upsert(a, b, ["image_id"])) == [("a", 1), ("b", 20), ("c", 30), (None, 3)]
    union = tables.first_wins([ids.distinct(), a.select("image_id")], "image_id", [])
    assert rows(tables.added_ids(union, 3)) == [(0, 2), (1, 2), (2, 0)]
    assert [r.rows for r in tables.counts_of(a, F.col("image_id"), ["a", "x"]).orderBy("value").collect()] == [1, 0]
    sample = tables.exact_sample(spark.range(100).select(F.col("id").cast("string").alias("image_id")), "image_id", 10, 1, ids)
    assert sample.count() == 10 and rows(sample) == rows(sample)
    left = spark.createDataFrame([("g", 0, 1), ("g", 5, 2), ("g", None, 3)], "g string, idx int, o int")
    right = spark.createDataFrame([("g", 5, 1, "five"), ("g", None, 2, "second"), ("g", None, 3, "third")], "g string, idx int, o int, answer string")
    assert [r.item.answer for r in tables.positional_join(left, right, "g", "idx", "o").orderBy("o").collect()] == ["five", "five", "third"]


def test_round_robin_takes_turns(spark):
    rows = [("big", f"b{i}", float(i)) for i in range(50)] + [("small", "s1", 1.0), ("small", "s2", 0.5)]
    got = tables.round_robin(spark.createDataFrame(rows, "stratum string, id string, score double"), ["stratum"], "id", "score", 6, 1).collect()
    assert sorted(r.id for r in got) == sorted(["b49", "b48", "b47", "b46", "s1", "s2"])


def test_quality(spark):
    summary = spark.createDataFrame([(4, 10, 0.4, 2, 2, 0, 0, 0, 0)], "accepted_qas int, generated_qas int, qa_accept_rate double, images_with_final_rows int, anchor_missing int, ambiguous_grounding int, reverse_ambiguous int, reverse_invalid int, validation_failed int")
    rows = spark.createDataFrame([("DIRECT_READ", "low", None, None, True), ("YES_NO", "high", "negative", None, True), ("REVERSE_GROUND", "high", None, "local", True), ("REVERSE_GROUND", "low", None, "mixed", False)], "question_type string, ambiguity_level string, yesno_polarity string, scope string, frontier_correct boolean")
    r = quality.run_quality(summary, rows).first()
    assert r.high_ambiguity_fraction == 0.5 and r.anchor_missing_rate == 0.2
    assert (r.inline_frontier_mean, r.precision_first_score, r.sweep_score) == (0.75, 1.5, 1.5)
    assert r.quality_score == pytest.approx(15 * 0.4 + 0.8 + 1.1 + 1.5 - 0.9 - 0.8 + 0.15 + 0.15 + 0.08, abs=0.006)
    empty = quality.run_quality(summary.withColumn("accepted_qas", F.lit(0)), rows.limit(0)).first()
    assert empty.q4_score == 0 and empty.high_ambiguity_fraction == 1
    assert quality.answer_distribution(spark.createDataFrame([], "answer string, question_type string")).first().unique_answers == 0


def test_agreement(spark):
    p = spark.createDataFrame([("1", "p", "a", "x"), ("1", "q", "b", "x"), ("2", "p", "a", "x"), ("2", "q", "b", "y"), ("3", "p", "a", "x")], "sample_id string, provider string, model string, prediction_norm string")
    p = p.selectExpr("*", "'DIRECT_READ' question_type", "'easy' difficulty", "'low' ambiguity_level", "cast(null as string) error_type")
    s = agreement.by_sample(p)
    assert s.count() == 2 and agreement.pairwise(s).first().agreement_rate == 0.5
    assert {(r.question_type, r.difficulty): r.unanimous_rate for r in agreement.by_group(s).collect()}[None, None] == 0.5


def test_rescue(spark):
    rows = spark.createDataFrame([("mid", "DIRECT_READ", "a"), ("mid", "YES_NO", "b")] + [("good", t, f"a{i}") for i, t in enumerate(quality.QUESTION_TYPES)], "image_id string, question_type string, answer string")
    tuples = spark.createDataFrame([("low", "sign"), ("mid", "red can"), ("good", "red can"), ("good", "blue car")], "image_id string, anchor_label string")
    got = rescue.select_images(rescue.image_scores(rows, tuples), rescue.Deficit(images=2)).collect()
    assert [r.image_id for r in got] == ["low", "mid"]


# folds against plain restatements


def test_merge_detections(spark):
    rnd = random.Random(3)
    rows = []
    for i, k, b in random_boxes(rnd, 40, size=200):
        rows.append((i, k, b, round(rnd.random(), 3), [rnd.choice("ab")]))
        if rnd.random() < 0.6:
            rows.append((i, k + "x", tuple(v + rnd.uniform(-2, 2) for v in b), round(rnd.random(), 3), ["c"]))
    df = spark.createDataFrame(rows, f"image_id string, key string, box {BOX}, confidence double, sources array<string>")
    kept = []
    for _, k, b, c, s in sorted(rows, key=lambda r: (-r[3], -area(r[2]), r[1])):
        best = max(kept, key=lambda e: max(mutual(b, e[1]), iou(b, e[1])), default=None)
        if best and max(mutual(b, best[1]), iou(b, best[1])) >= 0.62:
            e = best[1]
            best[1] = tuple(round(v, 2) for v in (min(e[0], b[0]), min(e[1], b[1]), max(e[2], b[2]), max(e[3], b[3])))
            best[2] = list(dict.fromkeys(best[2] + s))
        else:
            kept.append([k, b, s])
    got = {r.key: (tuple(r.box), r.sources) for r in folds.merge_detections(df).collect()}
    assert {k: s for k, (_, s) in got.items()} == {k: s for k, _, s in kept}
    assert all(got[k][0] == pytest.approx(b) for k, b, _ in kept)


def clusters_of(rows, fits, same):
    out = []
    for r in rows:
        c = next((c for c in out if same(c[0], r) and fits(c[0], r)), None)
        c.append(r) if c else out.append([r])
    return out


def test_exemplar_folds(spark):
    rnd = random.Random(4)
    rows = []
    for n, (i, k, b) in enumerate(random_boxes(rnd, 60, size=120)):
        rows.append((i, k, b, rnd.choice(["sign", "red can", "door"]), round(rnd.random(), 3), rnd.choice(["on", "above"]), n % 3))
    df = spark.createDataFrame(rows, f"image_id string, key string, box {BOX}, label string, score double, relation string, pass_index int").selectExpr("*", "score as selection_score", "1 as support_count", "'x' as source", "label as raw_label")
    order = sorted(rows, key=lambda r: (-r[4], r[3], r[1]))
    kept = []
    for r in order:
        if not any(e[3] == r[3] and mutual(e[2], r[2]) >= 0.85 for e in kept):
            kept.append(r)
    assert sorted(r.key for r in folds.dedupe_anchors(df).collect()) == sorted(r[1] for r in kept)

    passes = clusters_of(order, lambda a, b: iou(a[2], b[2]) >= 0.55, lambda a, b: a[3] == b[3])
    want = sorted((len({r[6] for r in c}), len(c)) for c in passes)
    got = folds.merge_passes(df).collect()
    assert sorted(r.pass_support_count for r in got) == sorted(n for n, _ in want)
    assert len(folds.merge_passes(df, least_passes=2).collect()) == sum(n >= 2 for n, _ in want)

    groups = clusters_of(order, lambda a, b: mutual(a[2], b[2]) >= 0.78 or iou(a[2], b[2]) >= 0.68, lambda a, b: a[5] == b[5])
    assert sorted(r.cluster_size for r in folds.consolidate(df, PLAIN_ANCHORS).collect()) == sorted(map(len, groups))
    on = clusters_of(order, lambda a, b: max(mutual(a[2], b[2]), iou(a[2], b[2])) >= 0.1, lambda a, b: True)
    assert sorted(sorted(r.member_keys) for r in folds.anchor_clusters(df).collect()) == sorted(sorted(r[1] for r in c) for c in on)


def test_large_images_are_folded_in_blocks(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(*r, rnd.choice("ab"), rnd.random()) for r in random_boxes(rnd, 80, size=900)]
    df = spark.createDataFrame(rows, f"image_id string, key string, box {BOX}, label string, score double")
    whole = sorted(r.key for r in folds.dedupe_anchors(df, 0.3).collect())
    split = folds.blocks
    monkeypatch.setattr(folds, "blocks", lambda d, k: split(d, k, block_rows=10))
    assert folds.blocks(df, "key").select("block_id").distinct().count() > 1
    assert sorted(r.key for r in folds.dedupe_anchors(df, 0.3).collect()) == whole


def test_clusters_of_large_images_are_numbered_through(spark, monkeypatch):
    from glyphloom.operators import tuples

    rnd = random.Random(6)
    labels, scores = ["wall", "sign", None], [0.5, 0.9, None, 0.7]
    rows = [(*r, rnd.choice(labels), rnd.choice(scores), rnd.choice(scores), rnd.choice(["on", "above"])) for i in "ij" for r in random_boxes(rnd, 60, i, 2500)]
    df = spark.createDataFrame(rows, f"image_id string, key string, box {BOX}, label string, score double, selection_score double, relation string").withColumn("anchor_score", F.col("score"))
    # words in pairs, far from other pairs, each pair on its own anchor
    texts = [("i", f"t{k:03d}{w}", w, w, (x, y, x + 40.0, y + 20.0), 0.9, True) for k in range(30) for w, x, y in [("OPEN", k % 6 * 400.0, k // 6 * 400.0), ("DAILY", k % 6 * 400.0 + 45, k // 6 * 400.0)]]
    nodes = spark.createDataFrame(texts, f"image_id string, node_id string, text string, text_normalized string, box {BOX}, confidence double, resolvable boolean")
    on = nodes.selectExpr("image_id", "node_id as key", "struct(floor(box.x1 / 400) * 400.0d as x1, box.y1 as y1, floor(box.x1 / 400) * 400.0d + 100 as x2, box.y2 + 30 as y2) as box", "concat('sign ', substr(node_id, 2, 3)) as label", "0.5d as selection_score", "0.5d as score")

    def results():
        clusters = folds.anchor_clusters(df).select("image_id", "cluster_no", "member_keys", "labels", "box", "key").collect()
        groups = folds.relabel_groups(df).select("image_id", "group_no", "key").collect()
        signs = tuples.merged_signs(nodes, folds.anchor_clusters(on)).select("image_id", "cluster_no", "label", "node_ids", "answer").collect()
        return [sorted(map(str, rows)) for rows in (clusters, groups, signs)]

    whole = results()
    split = folds.blocks
    monkeypatch.setattr(folds, "blocks", lambda d, k: split(d, k, block_rows=10))
    assert folds.blocks(df, "key").select("block_id").distinct().count() > 10
    assert results() == whole and len(whole[2]) == 30


def test_support(spark):
    rows = [("i", "n", "a", "on", (10.0, 10.0, 100.0, 100.0), "wall", "x"), ("i", "n", "b", "on", (12.0, 12.0, 102.0, 102.0), "sign wall", "y"), ("i", "n", "c", "on", (140.0, 10.0, 180.0, 90.0), "bottle", "x"), ("i", "n", "d", "above", (10.0, 10.0, 100.0, 100.0), None, None)]
    df = spark.createDataFrame(rows, f"image_id string, node_id string, anchor_id string, relation string, box {BOX}, label string, source string")
    got = {r.anchor_id: (r.support_count, r.source_support_count, r.support_labels) for r in folds.with_support(df).collect()}
    assert got == {"a": (2, 2, ["sign wall", "wall"]), "b": (2, 2, ["sign wall", "wall"]), "c": (1, 1, ["bottle"]), "d": (1, 1, [])}


def test_reading_order(spark):
    rows = [("i", "g", "a", (20.0, 40.0, 60.0, 60.0)), ("i", "g", "b", (90.0, 34.0, 140.0, 54.0)), ("i", "g", "c", (160.0, 20.0, 210.0, 40.0)), ("i", "h", "z", None)]
    df = spark.createDataFrame(rows, f"image_id string, group_id string, key string, box {BOX}")
    assert [r.key for r in folds.reading_order(df).orderBy("position").collect()] == ["c", "a", "b"]
    assert folds.text_lines(df).count() == 3


def test_greedy_selection(spark):
    rows = [("i", "c1", 0.9, "DIRECT_READ", "t1", "sign", True), ("i", "c2", 0.8, "DIRECT_READ", "t1", "sign", True), ("i", "c3", 0.1, "YES_NO", "t2", "can", False), ("i", "c4", 0.2, "YES_NO", "t1", "can", False), ("j", "d1", 0.5, "YES_NO", "t", None, None)]
    df = spark.createDataFrame(rows, "image_id string, candidate_id string, quality double, question_type string, text_key string, label string, capped boolean")
    got = folds.greedy_selection(df, 2).orderBy("image_id", "pick").collect()
    assert [r.candidate_id for r in got] == ["c1", "c3", "d1"]


def test_folds_of_nothing(spark):
    df = spark.createDataFrame([], f"image_id string, key string, box {BOX}, label string, score double")
    assert folds.dedupe_anchors(df).collect() == []


# sources and sinks


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([("b", None), ("a", 1)], "image_id string, v int")
    path = str(tmp_path / "rows")
    writers.json_lines(rows, path, [F.asc("image_id")])
    assert [tuple(r) for r in readers.json_lines(spark, path, "image_id string, v int").orderBy("image_id").collect()] == [("a", 1), ("b", None)]
    assert readers.json_lines(spark, str(tmp_path / "none"), "image_id string").collect() == []
    writers.json_document(spark, str(tmp_path / "m.json"), {"items": [{"image_id": "a", "dataset_source": "s"}]})
    writers.json_document(spark, str(tmp_path / "n.json"), {"image_ids": ["a", "b"]})
    got = readers.excluded_images(spark, [str(tmp_path / "m.json"), str(tmp_path / "n.json")])
    assert sorted((r.image_id, r.dataset_source, r.table_no) for r in got.collect()) == [("a", "s", 0), ("b", None, 1)]
    assert readers.json_document(spark, str(tmp_path / "none.json")) is None


def test_annotations(spark, tmp_path):
    ann = lambda k, i, x, t: {"id": k, "image_id": i, "bbox": [x, x, 20, 20], "utf8_string": t, "points": [x, x, x + 20, x, x + 20, x + 20, x, x + 20]}
    doc = {"imgs": {"1": {"id": "1", "width": 100, "height": 100, "file_name": "train/1.jpg"}, "2": {"id": "2", "width": 100, "height": 100, "file_name": "2.jpg"}}, "anns": {k: ann(k, i, x, t) for k, i, x, t in (("a", "1", 0, "HELLO"), ("b", "2", 60, " WORLD "), ("c", "1", 70, "."), ("d", "9", 0, "LOST"))}}
    (tmp_path / "a.json").write_text(json.dumps(doc))
    texts = readers.annotated_texts(spark, str(tmp_path / "a.json"))
    assert sorted((r.image_id, r.node_id, r.text, r.region_key, r.file_name) for r in texts.collect()) == [("1", "a", "HELLO", "ul", "1.jpg"), ("2", "b", "WORLD", "lr", "2.jpg")]
    assert sorted((r.image_id, r.ann_id, r.anchor_label) for r in readers.region_tuples(texts).collect()) == [("1", "a", "upper-left area of the image"), ("2", "b", "lower-right area of the image")]


def test_stream_counts_deliveries_once(spark, tmp_path):
    from datetime import datetime, timedelta

    from glyphloom.streaming.readings import first_deliveries

    t = datetime(2025, 1, 1)
    rows = [("i", "n", "m", t, t), ("i", "n", "m", t, t + timedelta(hours=1)), ("i", "n", "m", t + timedelta(hours=2), t + timedelta(hours=3)), (None, "n", "m", t, t)]
    schema = "image_id string, node_id string, model_name string, read_at timestamp, ingested_at timestamp"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    q = first_deliveries(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("seen").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT * FROM seen").count() == 2


def test_stacked_names_become_one_sign(spark):
    from glyphloom.operators import tuples

    stack = [("i", f"n{k}", t, (20.0, 20.0 + 30 * k, 120.0, 44.0 + 30 * k), True) for k, t in enumerate(["JOHN", "PAUL", "GEORGE", "RINGO"])]
    rows = [*stack, ("i", "far", "NOISE", (400.0, 300.0, 440.0, 320.0), True), ("i", "x", "12", (150.0, 20.0, 170.0, 44.0), False)]
    nodes = spark.createDataFrame(rows, f"image_id string, node_id string, text string, box {BOX}, resolvable boolean").selectExpr("*", "lower(text) as text_normalized", "0.9 as confidence")
    clusters = spark.createDataFrame([("i", 1, "album cover", (0.0, 0.0, 200.0, 200.0)), ("i", 2, "album cover", (0.0, 0.0, 190.0, 190.0))], f"image_id string, cluster_no int, label string, box {BOX}")
    got = tuples.merged_signs(nodes, clusters).collect()
    assert [(r.cluster_no, r.node_ids, r.answer) for r in got] == [(1, ["n0", "n1", "n2", "n3"], "JOHN PAUL GEORGE RINGO")]
    assert tuple(got[0].box) == (20.0, 20.0, 120.0, 134.0)


def test_line_windows(spark):
    from glyphloom.operators import tuples

    xs = [("a", "ONE", 0), ("b", "TWO", 30), ("c", "SIX", 60), ("d", "www.x.com", 90), ("e", "FAR", 400), ("f", "OFF", 430)]
    rows = [("i", k, t, (x * 1.0, 0.0, x + 25.0, 20.0), 1, n) for n, (k, t, x) in enumerate(xs, 1)]
    df = spark.createDataFrame(rows, f"image_id string, key string, text string, box {BOX}, line_no int, position int")
    assert sorted(r.answer for r in tuples.line_windows(df).collect()) == ["FAR OFF", "ONE TWO", "ONE TWO SIX", "TWO SIX"]


def test_validated_items(spark):
    from glyphloom.operators import tuples

    df = spark.createDataFrame([("t", "OPEN", ["red sign"], [("What does the red sign say here?", "open!"), ("Which word is on the red sign now?", "closed")])], "tuple_id string, answer string, anchor_synonyms array<string>, items array<struct<question: string, answer: string>>")
    got = [(r.answer_ok, r.anchor_ok, r.length_ok, r.duplicate_ok, r.accepted) for r in tuples.validated_items(df).orderBy("item_no").collect()]
    assert got == [(True, True, True, True, True), (False, True, True, True, False)]
