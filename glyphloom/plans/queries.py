"""The core queries: name to (spark, folder of the tables) -> DataFrame, with the same result in SQL.

Each runs one operator over its whole tables. Where SQL cannot state the operator, a test compares
it with a plain restatement on small tables.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphloom.functions import bins as B
from glyphloom.functions import geometry as G
from glyphloom.functions import labels as L
from glyphloom.functions import normalize as N
from glyphloom.functions import scoring as S
from glyphloom.functions.geometry import Box
from glyphloom.operators import agreement, anchoring, boxes, folds, quality, rescue, tables, tuples, votes
from glyphloom.plans import foldsql as Y
from glyphloom.plans import sqltext as X
from glyphloom.plans import views as V
from glyphloom.session import evenly, spread, table, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# consensus of recognisers

_VOTES = f"""
    votes AS (SELECT image_id, node_id, model_name, coalesce(m.text, '') AS text, coalesce(m.c, 0.0) AS c, {X.plain("m.text")} AS norm
              FROM (SELECT image_id, node_id, model_name, arg_max({{'text': coalesce(text, ''), 'c': CASE WHEN isnan(confidence) THEN NULL WHEN confidence > 1 THEN confidence / 100 ELSE confidence END}}, (read_at, coalesce(text, ''))) AS m
                    FROM readings WHERE image_id IS NOT NULL AND node_id IS NOT NULL AND model_name IS NOT NULL GROUP BY 1, 2, 3)),
    v AS (SELECT *, round_even(c, 6) AS conf FROM votes),
    n AS (SELECT image_id, node_id, max(conf) AS most, count(DISTINCT nullif(norm, '')) AS texts FROM v GROUP BY 1, 2),
    g AS (SELECT image_id, node_id, norm, count(*) AS n, min(conf) AS least, max(conf) AS most, min(model_name) AS first, arg_max(text, (conf, model_name)) AS text
          FROM v WHERE norm <> '' GROUP BY 1, 2, 3),
    t AS (SELECT DISTINCT ON (image_id, node_id) * FROM g ORDER BY image_id, node_id, n DESC, most DESC, first),
    p AS (SELECT a.image_id, a.node_id, a.model_name AS m1, b.model_name AS m2, CASE WHEN length(a.norm) >= length(b.norm) THEN a.text ELSE b.text END AS longer,
                 CASE WHEN (a.conf, a.model_name) >= (b.conf, b.model_name) THEN {{'text': a.text, 'norm': a.norm, 'conf': a.conf}} ELSE {{'text': b.text, 'norm': b.norm, 'conf': b.conf}} END AS best
          FROM v a JOIN v b ON a.image_id = b.image_id AND a.node_id = b.node_id AND a.model_name < b.model_name
          WHERE a.norm <> '' AND b.norm <> '' AND levenshtein(a.norm, b.norm) = 1 AND greatest(length(a.norm), length(b.norm)) >= 8),
    r AS (SELECT DISTINCT ON (image_id, node_id) * FROM p WHERE {X.valid("longer")} AND NOT regexp_full_match({X.compact("longer")}, '\\p{{Nd}}+') ORDER BY image_id, node_id, m1, m2),
    k AS (SELECT n.image_id, n.node_id, n.most, t.text, t.norm, t.least, t.most AS top, r.best,
                 CASE WHEN texts = 1 AND t.n >= 3 AND t.least >= 0.8 AND {X.valid("t.text")} THEN 'strong_consensus' WHEN texts = 1 THEN 'invalid_text_or_low_confidence'
                      WHEN t.n >= 2 AND t.least >= 0.85 AND {X.valid("t.text")} THEN 'standard_consensus' WHEN r.best IS NOT NULL THEN 'edit_rescue'
                      WHEN n.most < 0.6 THEN 'low_confidence' ELSE 'full_disagreement' END AS o
          FROM n LEFT JOIN t USING (image_id, node_id) LEFT JOIN r USING (image_id, node_id)),
    c AS (SELECT image_id, node_id, o LIKE '%consensus' OR o = 'edit_rescue' AS accepted,
                 CASE WHEN o LIKE '%consensus' THEN text WHEN o = 'edit_rescue' THEN best.text ELSE '' END AS text,
                 CASE WHEN o LIKE '%consensus' THEN norm WHEN o = 'edit_rescue' THEN best.norm ELSE '' END AS text_normalized,
                 CASE WHEN o LIKE '%consensus' THEN least WHEN o = 'edit_rescue' THEN best.conf WHEN o = 'invalid_text_or_low_confidence' THEN top ELSE most END AS confidence,
                 CASE WHEN o LIKE '%consensus' OR o = 'edit_rescue' THEN o ELSE 'dropped' END AS consensus_tier,
                 CASE WHEN o LIKE '%consensus' OR o = 'edit_rescue' THEN NULL ELSE o END AS failure_reason
          FROM k)"""


@query(f"WITH {_VOTES} SELECT image_id, node_id, accepted, text, text_normalized, confidence, consensus_tier, failure_reason FROM c")
def consensus_vote(spark: SparkSession, d: str) -> DataFrame:
    return votes.consensus(V.votes(spark, d)).drop("model_votes")


@query(
    f"""WITH {_VOTES}, {V.NODES}, j AS (SELECT n.image_id, n.node_id, n.source_dataset, c.accepted, c.text, coalesce(c.consensus_tier, 'dropped') AS tier,
            CASE WHEN c.accepted IS NULL THEN 'no_votes' WHEN c.accepted AND NOT {X.valid("c.text")} THEN 'invalid_text' WHEN c.accepted AND regexp_full_match({X.compact(X.plain("c.text"))}, '1{{4,}}|l{{4,}}|i{{4,}}') THEN 'degenerate_repeat_junk' ELSE c.failure_reason END AS reason
            FROM nodes n LEFT JOIN c USING (image_id, node_id)),
        l AS (SELECT *, length({X.strip("text")}) AS len FROM j)
        SELECT 'tier' AS measure, tier AS value, count(*) AS rows FROM l GROUP BY 2 UNION ALL SELECT 'reason', reason, count(*) FROM l WHERE reason IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'source', coalesce(source_dataset, 'unknown'), count(*) FROM l GROUP BY 2
        UNION ALL SELECT 'length', CASE WHEN len <= 1 THEN 'single_char' WHEN len <= 4 THEN 'short_2-4' WHEN len <= 10 THEN 'medium_5-10' ELSE 'long_11+' END, count(*) FROM l WHERE accepted AND reason IS NULL GROUP BY 2"""
)
def consensus_stats(spark: SparkSession, d: str) -> DataFrame:
    detections = V.nodes(spark, d).select("image_id", "node_id", "source_dataset")
    return votes.consensus_stats(votes.node_consensus(detections, V.votes(spark, d)), "source_dataset")


@query(
    f"WITH v AS (SELECT image_id, node_id, CASE WHEN isnan(confidence) THEN NULL WHEN confidence > 1 THEN confidence / 100 ELSE confidence END AS c FROM readings) SELECT image_id, node_id, round(coalesce(exp(avg(ln(greatest(c, 1e-6)))), 0.0), 6) AS confidence FROM v GROUP BY 1, 2"
)
def reading_confidence(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("confidence")
    share = F.when(F.isnan(c), F.lit(None)).when(c > 1, c / 100).otherwise(c)
    return table(spark, d, "readings").groupBy("image_id", "node_id").agg(F.round(votes.geometric_mean(share), 6).alias("confidence"))


# text functions


@query(
    f"""SELECT doc_id, md5({X.plain("text")}) AS plain, md5({X.vqa("text")}) AS vqa, md5({X.text_answer("text")}) AS said, {X.valid("text")} AS valid, {X.blocked("text")} AS blocked,
        {X.case_tag("text")} AS case_tag, {X.text_kind("text")} AS text_kind FROM documents"""
)
def text_normal_forms(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return spread(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", F.md5(N.plain_answer(t)).alias("plain"), F.md5(N.vqa_answer(t)).alias("vqa"), F.md5(N.text_answer(t)).alias("said"), N.valid_text(t).alias("valid"), N.blocked_answer(t).alias("blocked"), N.case_tag(t).alias("case_tag"), N.text_kind(t).alias("text_kind"))


@query(f"WITH {V.SAMPLES} SELECT sample_id, {X.by_type('answer', 'answer_type')} AS normal, {X.plain('answer')} AS plain, {X.valid('answer')} AS valid FROM samples")
def answer_normal_forms(spark: SparkSession, d: str) -> DataFrame:
    return V.samples(spark, d).select("sample_id", N.answer_by_type(F.col("answer"), F.col("answer_type")).alias("normal"), N.plain_answer(F.col("answer")).alias("plain"), N.valid_text(F.col("answer")).alias("valid"))


_LOW = r"trim(regexp_replace(regexp_replace(lower(coalesce(anchor_label, '')), '[^a-z0-9\s-]+', ' ', 'g'), '\s+', ' ', 'g'))"
_COLORS = sorted(L.COLORS, key=lambda w: (-len(w), w))


def _label_sql() -> str:
    def holds(words: tuple[str, ...]) -> str:
        return "(" + " OR ".join(f"contains(low, {X.q(w)})" for w in words) + ")"

    rules = []
    for groups, result in L.LABEL_RULES:
        value = f"prefix || {X.q(result[7:])}" if result.startswith("{color}") else X.q(result)
        rules.append(f"WHEN {' AND '.join(map(holds, groups))} THEN {value}")
    term = lambda s, words: f"[w FOR w IN {X.listed(words)} IF regexp_matches({s}, '\\b' || w || '\\b')][1]"
    tails = " ".join(f"WHEN len(parts) >= {n} AND list_contains({X.listed(L.VOCABULARY)}, {p}) THEN CASE WHEN starts_with({p}, color) THEN {p} ELSE prefix || {p} END" for n, p in ((n, f"array_to_string(parts[-{n}:], ' ')") for n in (3, 2, 1)))
    return f"""WITH l AS (SELECT DISTINCT anchor_label, {_LOW} AS low FROM bootstrap_tuples),
        c AS (SELECT *, {term("low", tuple(_COLORS))} AS color FROM l),
        x AS (SELECT *, coalesce(color || ' ', '') AS prefix, [w FOR w IN string_split(low, ' ') IF w NOT IN ({', '.join(map(X.q, L.PHRASE_FILLERS))})] AS parts, CASE WHEN low LIKE '%s' THEN low[:-2] END AS single FROM c),
        v AS (SELECT *, CASE WHEN low = '' OR low IN ({', '.join(map(X.q, (*L.PLACE_WORDS, *L.NOISE_WORDS)))}) OR contains(low, 'object detected') THEN NULL {' '.join(rules)}
            ELSE coalesce(CASE WHEN color IS NOT NULL THEN coalesce(CASE {tails} END, prefix || {term("low", L.COLORED_OBJECTS)}) END,
                 prefix || CASE WHEN list_contains({X.listed(L.VOCABULARY)}, single) THEN {term("single", L.VOCABULARY)} ELSE {term("low", L.VOCABULARY)} END) END AS label FROM x)
        SELECT anchor_label, color, label, coalesce(label IN ({', '.join(map(X.q, L.GENERIC_ANCHORS))}), false) AS generic FROM v"""


@query(_label_sql())
def anchor_labels(spark: SparkSession, d: str) -> DataFrame:
    a = F.col("anchor_label")
    rows = evenly(table(spark, d, "bootstrap_tuples").select(a).distinct()).select(a, L.color(a).alias("color"), L.vocabulary_label(a).alias("label"))
    return rows.withColumn("generic", F.coalesce(F.col("label").isin(*L.GENERIC_ANCHORS), F.lit(False)))


# geometry


@query(
    f"""WITH {V.NODES}, n AS (SELECT *, box AS b FROM nodes)
        SELECT image_id, node_id, {X.region("b", "image_width", "image_height")} AS region, {X.area("b")} AS area, round({X.width("b")} / image_width * 224, 6) AS px_w, round({X.height("b")} / image_height * 224, 6) AS px_h,
        {X.width("b")} / image_width * 224 >= 28 AND {X.height("b")} / image_height * 224 >= 11.2 AS passes FROM n"""
)
def node_geometry(spark: SparkSession, d: str) -> DataFrame:
    b, w, h = Box.of("box"), F.col("image_width"), F.col("image_height")
    n = V.nodes(spark, d).withColumn("r", G.resolvability("box", w, h))
    return n.select("image_id", "node_id", G.region(b, w, h).alias("region"), b.area.alias("area"), F.round("r.text_px_w", 6).alias("px_w"), F.round("r.text_px_h", 6).alias("px_h"), F.col("r.passes").alias("passes"))


@query(
    f"""WITH {V.NODES} SELECT a.image_id, a.node_id AS a, b.node_id AS b, {X.iou("a.box", "b.box")} AS value FROM nodes a JOIN nodes b ON a.image_id = b.image_id AND a.node_id < b.node_id
        WHERE {X.iou("a.box", "b.box")} >= 0.05"""
)
def iou_pairs(spark: SparkSession, d: str) -> DataFrame:
    return boxes.overlapping_pairs(V.nodes(spark, d), "node_id", 0.05)


@query(
    f"""WITH {V.NODES} SELECT a.image_id, a.node_id AS a, b.node_id AS b FROM nodes a JOIN nodes b ON a.image_id = b.image_id AND a.node_id < b.node_id
        WHERE {X.connected("a.box", "b.box", "a.image_width", "a.image_height")}"""
)
def connected_texts(spark: SparkSession, d: str) -> DataFrame:
    return boxes.connected_pairs(V.nodes(spark, d))


_TEXT_GROUPS = f"""{V.NODES}, e AS (SELECT a.image_id, a.node_id AS x, b.node_id AS y FROM nodes a JOIN nodes b ON a.image_id = b.image_id AND a.node_id <> b.node_id WHERE {X.connected("a.box", "b.box", "a.image_width", "a.image_height")}),
    r AS (SELECT image_id, node_id AS x, node_id AS y FROM nodes UNION SELECT r.image_id, r.x, e.y FROM r JOIN e ON r.image_id = e.image_id AND r.y = e.x),
    gr AS (SELECT image_id, x AS node_id, min(y) AS group_id FROM r GROUP BY 1, 2)"""


@query(f"WITH RECURSIVE {_TEXT_GROUPS} SELECT image_id, node_id, group_id FROM gr")
def text_groups(spark: SparkSession, d: str) -> DataFrame:
    grouped = boxes.text_groups(V.nodes(spark, d))
    return grouped.select("image_id", "node_id", F.substring_index("group_id", "\u0001", -1).alias("group_id"))


@query(
    f"""WITH RECURSIVE {_TEXT_GROUPS}, m AS (SELECT image_id, group_id, count(*) AS size, count(*) FILTER (NOT resolvable) AS unresolved, max({X.cx("n.box")}) - min({X.cx("n.box")}) AS xr, max({X.cy("n.box")}) - min({X.cy("n.box")}) AS yr,
            count(DISTINCT CASE WHEN {X.cx("n.box")} / image_width < 0.34 THEN 0 WHEN {X.cx("n.box")} / image_width <= 0.66 THEN 1 ELSE 2 END) AS cols,
            count(DISTINCT CASE WHEN {X.cy("n.box")} / image_height < 0.34 THEN 0 WHEN {X.cy("n.box")} / image_height <= 0.66 THEN 1 ELSE 2 END) AS rws FROM nodes n JOIN gr USING (image_id, node_id) GROUP BY 1, 2)
        SELECT image_id, group_id, size, unresolved, CASE WHEN size = 1 THEN 'singleton' WHEN size >= 4 AND cols >= 2 AND rws >= 2 THEN 'grid' WHEN xr > 1.6 * yr THEN 'row' WHEN yr > 1.6 * xr THEN 'stack' ELSE 'cluster' END AS shape FROM m"""
)
def text_group_shapes(spark: SparkSession, d: str) -> DataFrame:
    grouped = boxes.text_groups(V.nodes(spark, d))
    return boxes.group_shapes(grouped).withColumn("group_id", F.substring_index("group_id", "\u0001", -1))


@query(
    f"""WITH RECURSIVE {_TEXT_GROUPS}, p AS (SELECT image_id, group_id, node_id, {X.cx("n.box")} AS cx, {X.cy("n.box")} AS cy, coalesce(resolvable, false) AS ok, n.box.x1 AS x1, n.box.y1 AS y1, n.box.x2 AS x2, n.box.y2 AS y2 FROM nodes n JOIN gr USING (image_id, node_id)),
        f AS (SELECT image_id, group_id, count(*) AS size, count(*) FILTER (NOT ok) AS unresolved, max(cx) - min(cx) AS xr, max(cy) - min(cy) AS yr, min(x1) AS gx1, min(y1) AS gy1, max(x2) AS gx2, max(y2) AS gy2 FROM p GROUP BY 1, 2),
        s AS (SELECT *, (cx - gx1) / greatest(gx2 - gx1, 1.0) AS fx, (cy - gy1) / greatest(gy2 - gy1, 1.0) AS fy FROM p JOIN f USING (image_id, group_id)),
        t AS (SELECT *, CASE WHEN fy < 0.34::DOUBLE THEN 'upper' WHEN fy > 0.66::DOUBLE THEN 'lower' ELSE 'middle' END AS v, CASE WHEN fx < 0.34::DOUBLE THEN 'left' WHEN fx > 0.66::DOUBLE THEN 'right' ELSE 'center' END AS h,
            rank() OVER (PARTITION BY image_id, group_id ORDER BY cx, cy) - 1 AS x_rank, rank() OVER (PARTITION BY image_id, group_id ORDER BY cy, cx) - 1 AS y_rank FROM s),
        g AS (SELECT image_id, group_id, count(DISTINCT v) AS rws, count(DISTINCT h) AS cols FROM t GROUP BY 1, 2),
        k AS (SELECT *, CASE WHEN size = 1 THEN 'singleton' WHEN size >= 4 AND cols >= 2 AND rws >= 2 THEN 'grid' WHEN xr > yr * 1.6::DOUBLE THEN 'row' WHEN yr > xr * 1.6::DOUBLE THEN 'stack' ELSE 'cluster' END AS shape FROM t JOIN g USING (image_id, group_id)),
        b AS (SELECT *, CASE shape WHEN 'singleton' THEN 'singleton' WHEN 'row' THEN CASE x_rank WHEN 0 THEN 'left' WHEN size - 1 THEN 'right' ELSE 'middle' END WHEN 'stack' THEN CASE y_rank WHEN 0 THEN 'upper' WHEN size - 1 THEN 'lower' ELSE 'middle' END ELSE v || '_' || h END AS bucket_key FROM k)
        SELECT image_id, node_id, group_id, size, unresolved, shape, x_rank, y_rank, bucket_key, (SELECT count(*) FROM t WHERE t.image_id = b.image_id AND t.group_id = b.group_id AND t.v || '_' || t.h = b.bucket_key) AS bucket_occupancy,
            round_even(gx1, 2) AS group_x1, round_even(gy1, 2) AS group_y1, round_even(gx2, 2) AS group_x2, round_even(gy2, 2) AS group_y2 FROM b"""
)
def text_places(spark: SparkSession, d: str) -> DataFrame:
    found = boxes.text_places(boxes.text_groups(V.nodes(spark, d))).withColumn("group_id", F.substring_index("group_id", "\u0001", -1))
    return found.select("*", *(F.col(f"group_box.{s}").alias(f"group_{s}") for s in ("x1", "y1", "x2", "y2"))).drop("group_box")


@query(
    f"""WITH {V.NODES}, p AS (SELECT a.image_id, a.node_id, b.node_id AS neighbor, round_even({X.distance("a.box", "b.box")}, 1) AS distance_px, {X.direction("a.box", "b.box", "a.image_width", "a.image_height")} AS relation
            FROM nodes a JOIN nodes b ON a.image_id = b.image_id AND a.node_id <> b.node_id), r AS (SELECT *, row_number() OVER (PARTITION BY image_id, node_id ORDER BY distance_px, neighbor)::INTEGER AS rank FROM p)
        SELECT * FROM r WHERE rank <= 10"""
)
def nearest_texts(spark: SparkSession, d: str) -> DataFrame:
    return boxes.nearest(V.nodes(spark, d))


_CANDIDATES = f"""{V.NODES}, {V.ANCHORS}, ca AS (SELECT n.image_id, node_id, anchor_id, label, score, source, a.box, n.image_width, n.image_height, {X.relation("n.box", "a.box", "n.image_width", "n.image_height")} AS relation,
        {X.relevance("n.box", "a.box", "((polygon[1] + polygon[3] + polygon[5] + polygon[7]) / 4)", "((polygon[2] + polygon[4] + polygon[6] + polygon[8]) / 4)", "n.image_width", "n.image_height")} AS raw
        FROM nodes n JOIN anchors a ON n.image_id = a.image_id AND a.box.x1 <= a.box.x2 AND a.box.y1 <= a.box.y2),
    cand AS (SELECT *, floor(raw * 1e9 + 0.3) / 1e9 AS relevance FROM ca WHERE relation IS NOT NULL AND floor(raw * 1e9 + 0.3) / 1e9 >= 0.08)"""


@query(f"WITH {_CANDIDATES} SELECT image_id, node_id, anchor_id, label, relation, relevance FROM cand")
def anchor_candidates(spark: SparkSession, d: str) -> DataFrame:
    return boxes.anchor_candidates(V.nodes(spark, d), V.anchors(spark, d), columns=("image_id", "node_id", "anchor_id", "label", "relation", "relevance"))


@query(
    f"""WITH {_CANDIDATES} SELECT a.image_id, a.node_id, a.anchor_id, count(*) AS support_count, count(DISTINCT coalesce(b.source, 'unknown')) AS source_support_count, count(DISTINCT nullif(b.label, '')) AS labels
        FROM cand a JOIN cand b ON a.image_id = b.image_id AND a.node_id = b.node_id AND a.relation = b.relation AND {X.supports("a.box", "b.box")} GROUP BY 1, 2, 3"""
)
def anchor_support(spark: SparkSession, d: str) -> DataFrame:
    return anchoring.with_support(V.nodes(spark, d), V.anchors(spark, d), ("image_id", "node_id", "anchor_id"))


def _best(spark: SparkSession, d: str) -> DataFrame:
    candidates = written(boxes.anchor_candidates(V.nodes(spark, d), V.anchors(spark, d)), "candidates")
    return folds.with_support(candidates).withColumn("selection_score", boxes.selection_score(L.PLAIN_ANCHORS))


def _first_anchors(spark: SparkSession, d: str, n: int) -> DataFrame:
    """The n best anchors of each text by selection score: chosen roughly in their tile, then exactly."""

    def score(relevance, region, plain, support, sources, share):
        return relevance + 0.045 * region + np.where(plain, -0.075, 0.035) + (support - 1) * 0.04 + (sources - 1) * 0.02 - np.maximum(share - 0.42, 0.0) * 0.35

    found = anchoring.best_supported(V.nodes(spark, d), V.anchors(spark, d), n, score, L.PLAIN_ANCHORS)
    return boxes.best_anchors(found.withColumn("selection_score", boxes.selection_score(L.PLAIN_ANCHORS)), n)


@query(f"WITH {_CANDIDATES}, {Y.CHOSEN} SELECT image_id, node_id, anchor_id, label, relation, relevance, selection_score, rank FROM ranked WHERE rank <= 5")
def best_anchors(spark: SparkSession, d: str) -> DataFrame:
    return _first_anchors(spark, d, 5).select("image_id", "node_id", "anchor_id", "label", "relation", "relevance", "selection_score", "rank")


@query(f"SELECT DISTINCT image_id, r || c AS region_key FROM image_specs, (VALUES ('u'), ('c'), ('l')) a(r), (VALUES ('l'), ('c'), ('r')) b(c) WHERE image_width IS NOT NULL AND image_id IS NOT NULL")
def region_anchors(spark: SparkSession, d: str) -> DataFrame:
    images = table(spark, d, "image_specs").where("image_width is not null and image_id is not null").dropDuplicates(["image_id"])
    return boxes.region_anchors(images).select("image_id", "region_key")


_COMPETING = f"""{V.TUPLES}, u AS (SELECT image_id, ann_id AS tuple_id, coalesce(relation, '') AS relation, {X.plain("anchor_label")} AS label, {X.plain("answer")} AS answer, {X.plain("region_key")} AS coarse, coalesce(CASE WHEN image_width > 0 AND image_height > 0 THEN greatest(least(floor((text_bbox[2] + text_bbox[2] + text_bbox[4]) / 2 * 6 / image_height), 5), 0)::INTEGER || '-' || greatest(least(floor((text_bbox[1] + text_bbox[1] + text_bbox[3]) / 2 * 6 / image_width), 5), 0)::INTEGER END, '') AS specific, coalesce(region_key, '') AS bucket,
        {{'x1': text_bbox[1], 'y1': text_bbox[2], 'x2': text_bbox[1] + text_bbox[3], 'y2': text_bbox[2] + text_bbox[4]}} AS box FROM tuples WHERE image_id IS NOT NULL)"""


@query(
    f"""WITH {_COMPETING}, p AS (SELECT a.image_id, a.tuple_id, a.answer AS own, b.tuple_id AS o, b.answer AS other, coalesce(a.label = b.label, false) AS l, coalesce(a.coarse <> '' AND a.coarse = b.coarse, false) AS c, coalesce(a.specific <> '' AND a.specific = b.specific, false) AS s, coalesce(a.bucket <> '' AND a.bucket = b.bucket, false) AS k, CASE WHEN b.tuple_id IS NOT NULL THEN {X.iou("a.box", "b.box")} END AS v
            FROM u a LEFT JOIN u b ON a.image_id = b.image_id AND a.relation = b.relation AND a.tuple_id <> b.tuple_id),
        s AS (SELECT image_id, tuple_id, min(own) AS own, count(*) FILTER (l) AS al, count(*) FILTER (v >= 0.45) AS ao, count(*) FILTER (c) AS cr, count(*) FILTER (k) AS bk, count(*) FILTER ((l AND (c OR s OR k)) OR v >= 0.6 OR (c AND k)) AS comp,
              count(*) FILTER (l AND own <> '' AND other = own) AS sa, count(*) FILTER (l AND own <> '' AND other = own AND v < 0.35) AS nz, len(list_distinct(list_append(coalesce(list(other) FILTER (l AND other <> ''), []), min(nullif(own, ''))))) AS da FROM p GROUP BY 1, 2)
        SELECT image_id, tuple_id, al AS anchor_label_competitors, ao AS anchor_overlap_competitors, cr AS coarse_region_competitors, bk AS bucket_competitors, comp AS competing_tuples, CASE WHEN own <> '' THEN sa + 1 ELSE 0 END AS same_anchor_same_answer_count,
               CASE WHEN own <> '' THEN nz + 1 ELSE 0 END AS same_anchor_same_answer_nonoverlap_instances, da AS same_anchor_distinct_answer_count, al >= 2 AND ao <= 1 AS diffuse_same_anchor_scene FROM s"""
)
def competing_tuples(spark: SparkSession, d: str) -> DataFrame:
    t = V.tuples(spark, d).where("image_id is not null").withColumn("b", G.from_xywh(F.col("text_bbox")))
    text = lambda c: N.plain_answer(F.col(c))
    rows = t.select("image_id", F.col("ann_id").alias("tuple_id"), N.text_of(F.col("relation")).alias("relation"), text("anchor_label").alias("label"), text("answer").alias("answer"), text("region_key").alias("coarse"), G.fine_cell(Box.of("b"), F.col("image_width"), F.col("image_height")).alias("specific"), N.text_of(F.col("region_key")).alias("bucket"), F.col("b").alias("box"))
    return boxes.competitors(rows)


# whole-table operators


@query(f"WITH {V.TUPLES}, ids AS (SELECT DISTINCT image_id FROM text_nodes) SELECT image_id, count(*) AS rows FROM tuples WHERE image_id IN (SELECT image_id FROM ids) GROUP BY 1")
def subset_rows(spark: SparkSession, d: str) -> DataFrame:
    return tables.subset(V.tuples(spark, d), table(spark, d, "text_nodes")).groupBy("image_id").agg(F.count(F.lit(1)).alias("rows"))


@query(
    f"""WITH {V.TUPLES}, {V.SAMPLES}, ids AS (SELECT DISTINCT image_id FROM text_nodes)
        SELECT ann_id AS row_id, image_id, answer FROM tuples WHERE image_id IS NULL OR image_id NOT IN (SELECT image_id FROM ids) UNION ALL SELECT sample_id, image_id, answer FROM samples WHERE image_id IN (SELECT image_id FROM ids)"""
)
def overwritten_images(spark: SparkSession, d: str) -> DataFrame:
    primary = V.tuples(spark, d).select(F.col("ann_id").alias("row_id"), "image_id", "answer")
    rescued = V.samples(spark, d).select(F.col("sample_id").alias("row_id"), "image_id", "answer")
    return tables.overwrite(primary, rescued, table(spark, d, "text_nodes"))


@query(
    f"""WITH {V.SAMPLES}, r AS (SELECT image_id, min(answer) AS answer FROM samples GROUP BY 1), {V.TUPLES}, l AS (SELECT image_id, max(answer) AS answer FROM tuples GROUP BY 1)
        SELECT CASE WHEN r.n THEN r.image_id ELSE l.image_id END AS image_id, CASE WHEN r.n THEN r.answer ELSE l.answer END AS answer FROM l FULL JOIN (SELECT *, true AS n FROM r) r ON l.image_id IS NOT DISTINCT FROM r.image_id"""
)
def upserted_answers(spark: SparkSession, d: str) -> DataFrame:
    old = V.tuples(spark, d).groupBy("image_id").agg(F.max("answer").alias("answer"))
    new = V.samples(spark, d).groupBy("image_id").agg(F.min("answer").alias("answer"))
    return tables.upsert(old, new, ["image_id"])


@query(
    """WITH t AS (SELECT image_id, 0 AS table_no FROM text_nodes UNION SELECT image_id, 1 FROM bootstrap_tuples UNION SELECT image_id, 2 FROM ocr_qa_dataset UNION SELECT image_id, 3 FROM image_specs), f AS (SELECT image_id, min(table_no) AS table_no FROM t WHERE image_id IS NOT NULL GROUP BY 1)
       SELECT n.table_no::INTEGER AS table_no, count(f.image_id) AS ids_added FROM range(4) n(table_no) LEFT JOIN f USING (table_no) GROUP BY 1"""
)
def excluded_images(spark: SparkSession, d: str) -> DataFrame:
    names = ["text_nodes", "bootstrap_tuples", "ocr_qa_dataset", "image_specs"]
    ids = [table(spark, d, n).select("image_id").where("image_id is not null").distinct() for n in names]
    return tables.added_ids(tables.first_wins(ids, "image_id", []), 4)


@query("SELECT image_id, arg_max({'p': image_path}, listed_at).p AS image_path FROM image_specs WHERE image_id IS NOT NULL GROUP BY 1")
def latest_specs(spark: SparkSession, d: str) -> DataFrame:
    specs = table(spark, d, "image_specs").where("image_id is not null").select("image_id", "image_path", "listed_at")
    return tables.last_wins(specs, "image_id", ["listed_at"]).select("image_id", "image_path")


@query("SELECT DISTINCT image_id, md5('42:' || image_id) AS h FROM image_specs WHERE image_id IS NOT NULL AND image_id NOT IN (SELECT image_id FROM text_nodes WHERE image_id IS NOT NULL) ORDER BY h, image_id LIMIT 200".join(("SELECT image_id FROM (", ")")))
def sampled_images(spark: SparkSession, d: str) -> DataFrame:
    specs = table(spark, d, "image_specs").where("image_id is not null").select("image_id").distinct()
    return tables.exact_sample(specs, "image_id", 200, 42, table(spark, d, "text_nodes"))


@query(
    f"""WITH {V.TUPLES.replace("'valid_text_count': valid_text_count}", "'valid_text_count': valid_text_count, 'density_bucket': density_bucket, 'area_bucket': area_bucket, 'sc': score}")},
        b AS (SELECT DISTINCT ON (image_id) image_id, ann_id, sc AS score, density_bucket, area_bucket, region_key FROM tuples WHERE image_id IS NOT NULL AND sc IS NOT NULL AND NOT isnan(sc) ORDER BY image_id, sc DESC, density_bucket NULLS FIRST, area_bucket NULLS FIRST, region_key NULLS FIRST, ann_id),
        t AS (SELECT *, row_number() OVER (PARTITION BY density_bucket, area_bucket, region_key ORDER BY score DESC, image_id)::INTEGER AS turn FROM b)
        SELECT image_id, ann_id, score, turn FROM (SELECT * FROM t ORDER BY turn, md5(concat_ws(':', '42', turn, coalesce(density_bucket, ''), coalesce(area_bucket, ''), coalesce(region_key, ''))), image_id LIMIT 200)"""
)
def stratified_tuples(spark: SparkSession, d: str) -> DataFrame:
    t = V.tuples(spark, d).where("image_id is not null and score is not null and not isnan(score)")
    return tables.round_robin(t, ["density_bucket", "area_bucket", "region_key"], "image_id", "score", 200, 42).select("image_id", "ann_id", "score", "turn")


@query(
    f"""WITH {V.TUPLES}, k(value) AS (VALUES ('chartqa'), ('coco_text'), ('textocr_bootstrap'), ('elsewhere')), s AS (SELECT CASE WHEN contains(lower(source_dataset), 'chartqa') THEN 'chartqa' WHEN contains(lower(source_dataset), 'coco') THEN 'coco_text' WHEN contains(lower(source_dataset), 'textocr') THEN 'textocr_bootstrap' ELSE 'other' END AS value FROM tuples)
        SELECT k.value, count(s.value) AS rows FROM k LEFT JOIN s USING (value) GROUP BY 1"""
)
def source_breakdown(spark: SparkSession, d: str) -> DataFrame:
    s = F.lower("source_dataset")
    kind = F.when(F.contains(s, F.lit("chartqa")), "chartqa").when(F.contains(s, F.lit("coco")), "coco_text").when(F.contains(s, F.lit("textocr")), "textocr_bootstrap").otherwise("other")
    return tables.counts_of(V.tuples(spark, d), kind, ["chartqa", "coco_text", "textocr_bootstrap", "elsewhere"])


@query(f'WITH {V.TUPLES}, a AS (SELECT *, {X.plain("answer")} AS a FROM tuples) SELECT ann_id, image_id IS NOT NULL AND count(*) OVER (PARTITION BY image_id, a) = 1 AS "unique" FROM a')
def unique_answers(spark: SparkSession, d: str) -> DataFrame:
    return quality.with_uniqueness(V.tuples(spark, d)).select("ann_id", "unique")


@query(
    """SELECT *, CASE WHEN s <= 1 THEN 'low' WHEN s <= 4 THEN 'medium' ELSE 'high' END AS level FROM (SELECT DISTINCT valid_text_count, CASE WHEN valid_text_count <= 5 THEN 'low' WHEN valid_text_count <= 14 THEN 'medium' ELSE 'high' END AS density,
       CASE WHEN valid_text_count <= 2 THEN 'sparse_1-2' WHEN valid_text_count <= 5 THEN 'moderate_3-5' ELSE 'dense_6+' END AS crowd, CASE WHEN valid_text_count > 9 THEN 5 ELSE valid_text_count // 2 END AS s FROM bootstrap_tuples WHERE valid_text_count IS NOT NULL)"""
)
def count_bins(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("valid_text_count")
    s = F.when(n > 9, 5).otherwise(F.expr("cast(valid_text_count div 2 as int)"))
    rows = table(spark, d, "bootstrap_tuples").where(n.isNotNull()).select(n).distinct()
    return rows.select(n, B.density(n).alias("density"), B.text_density(n).alias("crowd"), s.alias("s"), B.ambiguity(s).alias("level"))


# quality


_QA = f"{V.SAMPLES}"


@query(
    f"""WITH {_QA}, a AS (SELECT lower({X.strip("answer")}) AS a, count(*) AS n FROM samples WHERE answer <> '' GROUP BY 1), t AS (SELECT n FROM a ORDER BY n DESC, a LIMIT 10),
        w AS (SELECT greatest(coalesce(sum(n), 0), 1)::BIGINT AS total_answers, count(*) AS unique_answers, coalesce(ln(sum(n)) - sum(n * ln(n)) / sum(n), 0) AS h FROM a),
        y AS (SELECT count(*) FILTER (upper(question_type) = 'YES_NO' AND lower({X.strip("answer")}) = 'yes') / greatest(count(*) FILTER (upper(question_type) = 'YES_NO'), 1) AS r FROM samples)
        SELECT total_answers, unique_answers, round_even(r, 4) AS yesno_yes_rate, round_even(1 - r, 4) AS yesno_no_rate, round_even((SELECT max(n) FROM t) / total_answers, 4) AS top1_concentration, round_even((SELECT sum(n)::DOUBLE FROM t) / total_answers, 4) AS top10_concentration, round_even(h, 4) AS answer_entropy FROM w, y"""
)
def answer_distribution(spark: SparkSession, d: str) -> DataFrame:
    return quality.answer_distribution(V.samples(spark, d))


@query(f"WITH {_QA} SELECT lower({X.strip('answer')}) AS answer, count(*) AS rows FROM samples WHERE answer <> '' GROUP BY 1 ORDER BY rows DESC, answer LIMIT 10")
def top_answers(spark: SparkSession, d: str) -> DataFrame:
    return quality.top_answers(V.samples(spark, d))


@query(
    f"""WITH {_QA}, i AS (SELECT image_id, count(DISTINCT nullif(lower({X.strip("anchor_label")}), '')) AS n FROM samples WHERE image_id <> '' GROUP BY 1), o AS (SELECT n, row_number() OVER (ORDER BY n) - 1 AS pos, count(*) OVER () AS c FROM i)
        SELECT count(*) AS images, round_even(avg(n), 3) AS mean_unique_anchors, max(n) FILTER (pos = c // 2)::DOUBLE AS median_unique_anchors, count(*) FILTER (n >= 2) AS images_with_multiple_anchors, round_even(count(*) FILTER (n >= 2) / count(*), 4) AS images_with_multiple_anchors_rate FROM o"""
)
def anchor_coverage(spark: SparkSession, d: str) -> DataFrame:
    return quality.anchor_coverage(V.samples(spark, d))


@query(
    f"""WITH {_QA}, c AS (SELECT question_type, count(*) AS n FROM samples GROUP BY 1)
        SELECT round(least((ln(sum(n)) - sum(n * ln(n)) / sum(n)) / ln(5), 1), 9) AS type_diversity, count(*) FILTER (n >= 3) AS num_types_with_coverage FROM c"""
)
def type_diversity(spark: SparkSession, d: str) -> DataFrame:
    return quality.type_diversity(V.samples(spark, d)).withColumn("type_diversity", F.round("type_diversity", 9))


@query()
def run_quality(spark: SparkSession, d: str) -> DataFrame:
    s = V.samples(spark, d).withColumns({"yesno_polarity": F.when(F.lower("answer") == "no", "negative").otherwise("positive"), "scope": F.when(F.col("relation") == "on", "local").when(F.col("relation") == "in", "global").otherwise("mixed"), "frontier_correct": F.when(F.col("difficulty") != "hard", F.col("difficulty") == "easy")})
    n = F.count(F.lit(1))
    fails = {c: F.count(F.when(F.col("answer").isNull() & (F.col("question_type") == k), 1)) for c, k in zip(("anchor_missing", "ambiguous_grounding", "reverse_ambiguous", "reverse_invalid", "validation_failed"), quality.QUESTION_TYPES)}
    summary = s.agg(F.count("answer").alias("accepted_qas"), n.alias("generated_qas"), (F.count("answer") / n).alias("qa_accept_rate"), F.count_distinct("image_id").alias("images_with_final_rows"), *(c.alias(k) for k, c in fails.items()))
    stats = [quality.answer_distribution(s).select("unique_answers", "answer_entropy", "yesno_yes_rate"), quality.anchor_coverage(s).select("mean_unique_anchors", "images_with_multiple_anchors_rate")]
    return quality.run_quality(summary, s.where("answer is not null"), stats)


@query(
    f"""WITH {V.NODES}, v AS (SELECT resolvable, box.x2 - box.x1 AS x FROM nodes)
        SELECT n.bin::INTEGER AS bin, count(v.x) AS rows FROM range(6) n(bin) LEFT JOIN v ON n.bin = (x >= 16)::INT + (x >= 24)::INT + (x >= 32)::INT + (x >= 48)::INT + (x >= 64)::INT GROUP BY 1"""
)
def width_histogram(spark: SparkSession, d: str) -> DataFrame:
    return quality.histogram(V.nodes(spark, d).withColumn("x", F.col("box.x2") - F.col("box.x1")), "x", [16.0, 24.0, 32.0, 48.0, 64.0])


@query(
    f"""WITH {V.NODES}, v AS (SELECT resolvable, box.x2 - box.x1 AS x FROM nodes) SELECT resolvable, count(x) AS count, round_even(min(x), 4) AS min, round_even(quantile_cont(x, 0.25), 4) AS p25, round_even(quantile_cont(x, 0.5), 4) AS median, round_even(quantile_cont(x, 0.75), 4) AS p75, round_even(max(x), 4) AS max, round_even(avg(x), 4) AS mean FROM v GROUP BY 1"""
)
def width_summary(spark: SparkSession, d: str) -> DataFrame:
    return quality.summary_of(V.nodes(spark, d).withColumn("x", F.col("box.x2") - F.col("box.x1")), "x", ["resolvable"])


@query(
    f"""WITH {V.NODES} SELECT CASE WHEN grouping(s) = 0 THEN s END AS source, count(*) AS total, count(*) FILTER (resolvable) AS accepted, count(*) FILTER (NOT resolvable) AS dropped, count(*) FILTER (NOT resolvable) / count(*) AS drop_rate
        FROM (SELECT *, coalesce(source_dataset, 'unknown') AS s FROM nodes) GROUP BY ROLLUP (s)"""
)
def resolvability_stats(spark: SparkSession, d: str) -> DataFrame:
    return quality.resolvability_stats(V.nodes(spark, d))


# agreement and scoring


_SAID = f"""{V.PREDICTIONS}, n AS (SELECT *, provider || ':' || model AS m, {X.by_type("prediction", "answer_type")} AS norm FROM predictions WHERE error_type IS NULL),
    s AS (SELECT sample_id, min(question_type) AS question_type, min(difficulty) AS difficulty, count(*) AS models, count(DISTINCT norm) = 1 AS unanimous FROM n GROUP BY 1 HAVING count(*) >= 2)"""


def _samples_said(spark: SparkSession, d: str) -> DataFrame:
    p = V.predictions(spark, d).withColumn("prediction_norm", N.answer_by_type(F.col("prediction"), F.col("answer_type")))
    return agreement.by_sample(p)


@query(
    f"""WITH {_SAID} SELECT a.m AS model_a, b.m AS model_b, count(*) FILTER (a.norm = b.norm) AS matches, count(*) AS total, count(*) FILTER (a.norm = b.norm) / count(*) AS agreement_rate FROM n a JOIN n b ON a.sample_id = b.sample_id AND a.m < b.m GROUP BY 1, 2"""
)
def model_agreement(spark: SparkSession, d: str) -> DataFrame:
    return agreement.pairwise(_samples_said(spark, d))


@query(
    f"""WITH {_SAID}, x AS (SELECT coalesce(question_type, '(unknown)') AS q, coalesce(difficulty, '(unknown)') AS e, unanimous FROM s)
        SELECT CASE WHEN grouping(q) = 0 THEN q END AS question_type, CASE WHEN grouping(e) = 0 THEN e END AS difficulty, count(*) AS rows, round_even(avg(unanimous::INT), 6) AS unanimous_rate FROM x GROUP BY ROLLUP (q, e)"""
)
def agreement_by_group(spark: SparkSession, d: str) -> DataFrame:
    return agreement.by_group(_samples_said(spark, d))


_IDLE = ", ".join(map(X.q, S.IDLE_WORDS))


def _content(x: str) -> str:
    return f"[w FOR w IN {X.tokens(x)} IF w NOT IN ({_IDLE}) AND length(w) > 1]"


_SCORED = f"""{V.PREDICTIONS}, b AS (SELECT *, {X.by_type("gold", "answer_type")} AS g, {X.by_type("prediction", "answer_type")} AS p, upper(trim(coalesce(question_type, ''))) AS k FROM predictions),
    e AS (SELECT *, strip_accents(g) AS ga, strip_accents(p) AS pa, {X.strip("regexp_replace(g, '[][(.,;:!?)''" + '"' + "]+$', '')")} AS t FROM b),
    f AS (SELECT *, {X.tokens("strip_accents(t)")} AS gw, {X.tokens("pa")} AS pw, {_content("g")} AS gc, {_content("p")} AS pc FROM e),
    h AS (SELECT *, [CASE WHEN length(w) > 3 THEN regexp_replace(w, 's$', '') ELSE w END FOR w IN gw] AS gs, [CASE WHEN length(w) > 3 THEN regexp_replace(w, 's$', '') ELSE w END FOR w IN pw] AS ps,
                 list_sum([least(len([1 FOR y IN gc IF y = w]), len([1 FOR y IN pc IF y = w])) FOR w IN list_distinct(gc)]) AS c FROM f),
    z AS (SELECT *, g = p OR ga = pa AS exact_correct, CASE WHEN k = 'REVERSE_GROUND' AND c > 0 THEN 2.0 * c / (len(gc) + len(pc)) ELSE 0.0 END AS f1,
                 CASE WHEN t = '' THEN false WHEN length(t) < 3 THEN contains(pa, strip_accents(t)) ELSE len(gw) > 0 AND len(pw) > 0 AND (list_has_all(ps, gs) OR (len(pw) <= 3 AND list_has_all(gs, ps))
                      OR (len(gw) = 1 AND len(pw) >= 2 AND length(strip_accents(t)) >= 4 AND strip_accents(t) = array_to_string(pw, '')) OR (len(pw) = 1 AND len(gw) >= 2 AND length(pa) >= 4 AND pa = array_to_string(gw, ''))) END AS part FROM h),
    sc AS (SELECT *, k = 'DIRECT_READ' AND NOT exact_correct AND part AS partial_correct, f1 >= 0.5 AS semantic_correct FROM z)"""


@query(f"WITH {_SCORED} SELECT sample_id, provider, p AS prediction_norm, g AS gold_norm, exact_correct, partial_correct, semantic_correct, round_even(f1, 4) AS word_f1, exact_correct OR partial_correct OR semantic_correct AS soft_correct FROM sc")
def scored_predictions(spark: SparkSession, d: str) -> DataFrame:
    scored = agreement.with_scores(V.predictions(spark, d))
    return scored.select("sample_id", "provider", "prediction_norm", "gold_norm", "exact_correct", "partial_correct", "semantic_correct", "word_f1", "soft_correct")


@query(
    f"""WITH {_SCORED}, x AS (SELECT *, provider || ':' || model AS m, coalesce(question_type, '(unknown)') AS q, exact_correct OR partial_correct OR semantic_correct AS soft FROM sc)
        SELECT CASE WHEN grouping(m) = 0 THEN m END AS model, CASE WHEN grouping(q) = 0 THEN q END AS question_type, count(*) AS rows, round_even(avg(exact_correct::INT), 6) AS exact_rate, round_even(avg(partial_correct::INT), 6) AS partial_rate,
               round_even(avg(semantic_correct::INT), 6) AS semantic_rate, round_even(avg(soft::INT), 6) AS soft_rate FROM x GROUP BY ROLLUP (m, q)"""
)
def benchmark(spark: SparkSession, d: str) -> DataFrame:
    return agreement.benchmark(agreement.with_scores(V.predictions(spark, d)))


@query(
    f"""WITH {_SCORED}, x AS (SELECT sample_id, provider, coalesce(question_type, '(unknown)') AS q, exact_correct OR partial_correct OR semantic_correct AS soft FROM sc), j AS (SELECT a.q, a.soft AS s, b.soft AS b FROM x a JOIN x b ON a.sample_id = b.sample_id AND a.provider = 'alpha' AND b.provider = 'gamma')
        SELECT CASE WHEN grouping(q) = 0 THEN q END AS question_type, count(*) AS rows, round_even(avg(s::INT), 6) AS seen_rate, round_even(avg(b::INT), 6) AS blind_rate, round_even(avg(b::INT), 6) AS text_leaky_rate FROM j GROUP BY ROLLUP (q)"""
)
def image_dependence(spark: SparkSession, d: str) -> DataFrame:
    p = V.predictions(spark, d)
    of = lambda name: agreement.with_scores(p.where(F.col("provider") == name))
    return agreement.image_dependence(of("alpha"), of("gamma"))


@query(
    f"""WITH {V.SAMPLES}, q AS (SELECT image_id, sample_id, {X.tokens("lower(question)")} AS w FROM samples WHERE question IS NOT NULL AND image_id IS NOT NULL),
        r AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY sample_id) AS pos FROM q), g AS (SELECT image_id, (pos - 1) // 4 AS part, sample_id, list_distinct(w) AS w FROM r),
        p AS (SELECT a.image_id, a.part, max(len(list_intersect(a.w, b.w)) / greatest(len(list_distinct(a.w || b.w)), 1)) AS j FROM g a JOIN g b ON a.image_id = b.image_id AND a.part = b.part AND a.sample_id < b.sample_id GROUP BY 1, 2)
        SELECT DISTINCT g.image_id, g.part, coalesce(p.j, 0) <= 0.7 AS is_distinct FROM g LEFT JOIN p USING (image_id, part)"""
)
def distinct_questions(spark: SparkSession, d: str) -> DataFrame:
    """Four questions at a time of every image: whether they differ enough."""
    from pyspark.sql import Window

    s = V.samples(spark, d).where("question is not null and image_id is not null")
    part = F.expr("(at - 1) div 4")
    groups = s.withColumn("at", F.row_number().over(Window.partitionBy("image_id").orderBy("sample_id"))).groupBy("image_id", part.alias("part")).agg(F.collect_list("question").alias("questions"))
    return groups.select("image_id", "part", S.all_distinct(F.col("questions")).alias("is_distinct"))


@query(
    f"""WITH {V.SAMPLES}, {V.TUPLES}, k(t, w) AS (VALUES ('ANCHOR_PROPERTY', 2.5), ('REVERSE_GROUND', 0.7), ('YES_NO', 0.5), ('TEXT_PROPERTY', 0.7)),
        r AS (SELECT image_id, count(*) AS final_rows, count(DISTINCT nullif(question_type, '')) AS types, list(DISTINCT question_type) FILTER (question_type IS NOT NULL) AS has FROM samples WHERE image_id IS NOT NULL GROUP BY 1),
        a AS (SELECT image_id, lower({X.strip("answer")}) AS a, count(*) AS n FROM samples WHERE image_id IS NOT NULL AND answer <> '' GROUP BY 1, 2), e AS (SELECT image_id, greatest(ln(sum(n)) - sum(n * ln(n)) / sum(n), 0) AS h FROM a GROUP BY 1),
        l AS (SELECT image_id, count(DISTINCT nullif(lower({X.strip("anchor_label")}), '')) AS labels, count(*) FILTER (lower({X.strip("anchor_label")}) <> '') AS n, count(*) FILTER (lower({X.strip("anchor_label")}) IN ({', '.join(map(X.q, L.PLAIN_ANCHORS))})) AS plain FROM tuples WHERE image_id IS NOT NULL GROUP BY 1),
        j AS (SELECT image_id, coalesce(final_rows, 0) AS final_rows, coalesce(types, 0) AS types, coalesce(has, []) AS has, coalesce(h, 0) AS h, coalesce(labels, 0) AS labels, CASE WHEN n > 0 THEN plain / n ELSE 1.0 END AS g FROM r LEFT JOIN e USING (image_id) FULL JOIN l USING (image_id)),
        s AS (SELECT *, round_even(CASE WHEN final_rows = 0 THEN 4 ELSE 0 END + 2.0 * greatest(4 - types, 0) + (SELECT coalesce(sum(w), 0) FROM k WHERE NOT list_contains(has, t))::DOUBLE + 0.6::DOUBLE * greatest(1.25 - h, 0) + 0.4::DOUBLE * greatest(2 - labels, 0) + 0.6::DOUBLE * g, 6) AS score FROM j)
        SELECT image_id, score, final_rows, types AS final_type_count, round_even(h, 6) AS answer_entropy, labels AS unique_anchor_labels FROM s WHERE score > 0 ORDER BY score DESC, types, final_rows, round_even(h, 6), image_id LIMIT 48"""
)
def rescue_images(spark: SparkSession, d: str) -> DataFrame:
    chosen = rescue.select_images(rescue.image_scores(V.samples(spark, d), V.tuples(spark, d)))
    return chosen.select("image_id", "score", "final_rows", "final_type_count", "answer_entropy", "unique_anchor_labels")


# folds


@query(
    f"""WITH RECURSIVE {V.TUPLES}, r AS (SELECT image_id, ann_id AS key, {{'x1': text_bbox[1], 'y1': text_bbox[2], 'x2': text_bbox[1] + text_bbox[3], 'y2': text_bbox[2] + text_bbox[4]}} AS box, area_fraction AS confidence, coalesce(relation, 'unknown') AS source FROM tuples WHERE image_id IS NOT NULL AND text_bbox IS NOT NULL),
        {Y.merged("r")}, u AS (SELECT image_id, unnest(st) AS k, generate_subscripts(st, 1) AS number FROM f)
        SELECT image_id, k.key AS key, k.box.x1 AS x1, k.box.y1 AS y1, k.box.x2 AS x2, k.box.y2 AS y2, k.confidence AS confidence, array_to_string(k.sources, '|') AS sources, number::INTEGER AS number FROM u WHERE number <= 128"""
)
def merged_detections(spark: SparkSession, d: str) -> DataFrame:
    t = V.tuples(spark, d).where("image_id is not null")
    rows = t.select("image_id", F.col("ann_id").alias("key"), G.from_xywh(F.col("text_bbox")).alias("box"), F.col("area_fraction").alias("confidence"), F.array(F.coalesce("relation", F.lit("unknown"))).alias("sources"))
    return folds.merge_detections(rows).select("image_id", "key", "box.*", "confidence", F.array_join("sources", "|").alias("sources"), "number")


@query(
    f"""WITH RECURSIVE {V.NODES}, {V.SEEN_TWICE}, {Y.distinct_rows("twice", f"confidence DESC NULLS LAST, length(coalesce(text, '')) DESC, greatest({X.width('box')}, 1.0) * greatest({X.height('box')}, 1.0) DESC, key", "key, text, text_normalized, confidence, box", f"key VARCHAR, text VARCHAR, text_normalized VARCHAR, confidence DOUBLE, box {Y.BOX}", f"coalesce(o.text_normalized, '') <> '' AND coalesce(k.text_normalized, '') <> '' AND (contains(o.text_normalized, k.text_normalized) OR contains(k.text_normalized, o.text_normalized)) AND {Y.like('k.box', 'o.box', 0.74, 0.6)}")}
        SELECT image_id, k.key AS key, k.text AS text, k.confidence AS confidence FROM (SELECT image_id, unnest(st) AS k FROM f)"""
)
def deduped_nodes(spark: SparkSession, d: str) -> DataFrame:
    return folds.dedupe_nodes(V.seen_twice(spark, d)).select("image_id", "key", "text", "confidence")


@query(
    f"""WITH RECURSIVE {V.ANCHORS}, {Y.distinct_rows("(SELECT image_id, anchor_id AS key, label, score, box FROM anchors WHERE box.x1 IS NOT NULL AND box.x2 IS NOT NULL)", "score DESC NULLS LAST, label NULLS FIRST, key", "key, label, score, box", f"key VARCHAR, label VARCHAR, score DOUBLE, box {Y.BOX}", f"k.label = o.label AND {Y._sides('k.box', 'o.box')[0]} >= 0.85::DOUBLE AND {Y._sides('k.box', 'o.box')[1]} >= 0.85::DOUBLE")}
        SELECT image_id, k.key AS key, k.label AS label, k.score AS score FROM (SELECT image_id, unnest(st) AS k FROM f)"""
)
def deduped_anchors(spark: SparkSession, d: str) -> DataFrame:
    return folds.dedupe_anchors(V.anchors(spark, d).withColumnRenamed("anchor_id", "key")).select("image_id", "key", "label", "score")


@query(
    f"""WITH RECURSIVE {_CANDIDATES}, {Y.CHOSEN}, lab AS ({_label_sql()}),
        r AS (SELECT image_id || chr(1) || node_id AS image_id, anchor_id AS key, relation, box, coalesce(lab.label, chosen.label) AS label, selection_score, score, support_count, source FROM chosen LEFT JOIN lab ON lab.anchor_label = chosen.label),
        {Y.exemplar_numbers("r", "selection_score DESC, score DESC, label, key", "relation, box", f"relation VARCHAR, box {Y.BOX}", f"k.relation = o.relation AND {Y.like('k.box', 'o.box', 0.78, 0.68)}")},
        w AS (SELECT *, selection_score + 0.10::DOUBLE * greatest(support_count, 1) + CASE WHEN label NOT IN ({Y._PLAIN}) THEN 0.08::DOUBLE ELSE 0 END + CASE WHEN len({X.tokens('label')}) >= 2 THEN 0.04::DOUBLE ELSE 0 END + CASE WHEN source = 'florence_region' THEN 0.03::DOUBLE ELSE 0 END AS weight FROM f_c),
        v AS (SELECT image_id, c, label, round(sum(weight), 9) AS vote FROM w GROUP BY 1, 2, 3),
        l AS (SELECT DISTINCT ON (image_id, c) * FROM v ORDER BY image_id, c, vote DESC, label NOT IN ({Y._PLAIN}) DESC, len({X.tokens('label')}) DESC, label DESC),
        s AS (SELECT image_id, c, count(*) AS size, count(DISTINCT label) - 1 AS conflicts, array_to_string(list_sort(list(DISTINCT label)), '|') AS labels FROM w GROUP BY 1, 2),
        b AS (SELECT DISTINCT ON (image_id, c) w.* FROM w JOIN l USING (image_id, c, label) ORDER BY image_id, c, selection_score DESC, score DESC, n)
        SELECT image_id, key, relation, label, selection_score, labels AS alternate_labels, conflicts::INTEGER AS label_conflict_count, size::INTEGER AS cluster_size, greatest(support_count, size) AS support_count FROM b JOIN s USING (image_id, c)"""
)
def consolidated_anchors(spark: SparkSession, d: str) -> DataFrame:
    rows = tables.mapped(_best(spark, d), "label", L.vocabulary_label, "clean")
    rows = rows.select(F.concat_ws("\u0001", "image_id", "node_id").alias("image_id"), F.col("anchor_id").alias("key"), "relation", "box", F.coalesce("clean", "label").alias("label"), "selection_score", "score", "support_count", "source")
    found = folds.consolidate(rows, L.PLAIN_ANCHORS)
    return found.select("image_id", "key", "relation", "label", "selection_score", F.array_join("alternate_labels", "|").alias("alternate_labels"), "label_conflict_count", "cluster_size", "support_count")


@query(
    f"""WITH RECURSIVE {V.ANCHORS}, r AS (SELECT image_id, anchor_id AS key, length(anchor_id) % 3 AS pass_index, {X.spaced("label")} AS label, label AS raw_label, box, score FROM anchors WHERE box.x1 IS NOT NULL AND box.x2 IS NOT NULL AND {X.spaced("label")} <> ''),
        {Y.exemplar_numbers("r", "score DESC, label, key", "label, box", f"label VARCHAR, box {Y.BOX}", f"k.label = o.label AND {Y.iou('k.box', 'o.box')} >= 0.55::DOUBLE")},
        s AS (SELECT image_id, c, count(DISTINCT pass_index) AS passes, array_to_string(list_sort(list(DISTINCT {X.strip("raw_label")})), '|') AS labels FROM f_c GROUP BY 1, 2),
        b AS (SELECT DISTINCT ON (image_id, c) * FROM f_c ORDER BY image_id, c, score DESC, raw_label DESC, n)
        SELECT image_id, key, label, round_even(score + 0.03::DOUBLE * (passes - 1), 4) AS score, passes::INTEGER AS pass_support_count, labels AS alternate_labels FROM b JOIN s USING (image_id, c)"""
)
def merged_inventory(spark: SparkSession, d: str) -> DataFrame:
    a = V.anchors(spark, d)
    rows = a.select("image_id", F.col("anchor_id").alias("key"), F.pmod(F.length("anchor_id"), F.lit(3)).alias("pass_index"), N.spaced(F.col("label")).alias("label"), F.col("label").alias("raw_label"), "box", "score")
    return folds.merge_passes(rows).select("image_id", "key", "label", "score", "pass_support_count", F.array_join("alternate_labels", "|").alias("alternate_labels"))


@query(
    f"""WITH RECURSIVE {_CANDIDATES}, {Y.CHOSEN}, r AS (SELECT image_id, node_id AS key, box, label, selection_score, score FROM ranked WHERE rank = 1 AND relation = 'on'),
        {Y.exemplar_numbers("r", "score DESC, label, key", "box", f"box {Y.BOX}", f"{Y.alike('k.box', 'o.box')} >= 0.1::DOUBLE")},
        s AS (SELECT image_id, c, min(box.x1) AS x1, min(box.y1) AS y1, max(box.x2) AS x2, max(box.y2) AS y2, string_agg(key, '|' ORDER BY n) AS member_keys, count(DISTINCT label) AS labels FROM f_c GROUP BY 1, 2),
        b AS (SELECT DISTINCT ON (image_id, c) * FROM f_c ORDER BY image_id, c, selection_score DESC, score DESC, n)
        SELECT image_id, c::INTEGER AS cluster_no, key, label, x1, y1, x2, y2, member_keys, labels::INTEGER AS labels FROM b JOIN s USING (image_id, c)"""
)
def anchor_clusters(spark: SparkSession, d: str) -> DataFrame:
    best = _first_anchors(spark, d, 1).where("relation = 'on'")
    found = folds.anchor_clusters(best.select("image_id", F.col("node_id").alias("key"), "box", "label", "selection_score", "score"))
    return found.select("image_id", "cluster_no", "key", "label", "box.*", F.array_join("member_keys", "|").alias("member_keys"), F.size("labels").alias("labels"))


def _on_anchor(spark: SparkSession, d: str) -> DataFrame:
    """The anchor of each text by relevance alone."""
    return anchoring.nearest_anchors(V.nodes(spark, d), V.anchors(spark, d))


_ON = f"{_CANDIDATES}, best AS (SELECT DISTINCT ON (image_id, node_id) * FROM cand ORDER BY image_id, node_id, relevance DESC, score DESC, anchor_id)"


@query(f"WITH {_ON} SELECT n.image_id, n.node_id, n.text, label, relation FROM nodes n LEFT JOIN best USING (image_id, node_id)")
def word_tuples(spark: SparkSession, d: str) -> DataFrame:
    return tuples.word_tuples(V.nodes(spark, d), _on_anchor(spark, d)).select("image_id", "node_id", "text", "label", "relation")


@query(
    f"""WITH {_ON}, g AS (SELECT n.image_id, label, [round_even(best.box.x1, 1), round_even(best.box.y1, 1), round_even(best.box.x2, 1), round_even(best.box.y2, 1)] AS k,
            list({{'y': (polygon[2] + polygon[4] + polygon[6] + polygon[8]) / 4, 'x': (polygon[1] + polygon[3] + polygon[5] + polygon[7]) / 4, 'node_id': n.node_id, 'text': n.text}} ORDER BY (polygon[2] + polygon[4] + polygon[6] + polygon[8]) / 4, (polygon[1] + polygon[3] + polygon[5] + polygon[7]) / 4, n.node_id) AS m
            FROM nodes n JOIN best USING (image_id, node_id) WHERE relation = 'on' GROUP BY 1, 2, 3 HAVING count(*) >= 2),
        s AS (SELECT image_id, label, array_to_string([x.node_id FOR x IN m], '|') AS node_ids, array_to_string([{X.strip("x.text")} FOR x IN m IF {X.strip("x.text")} <> ''], ' ') AS answer FROM g) SELECT * FROM s WHERE {X.valid("answer")}"""
)
def sign_groups(spark: SparkSession, d: str) -> DataFrame:
    signs = tuples.sign_groups(V.nodes(spark, d), _on_anchor(spark, d))
    return signs.select("image_id", "label", F.array_join("node_ids", "|").alias("node_ids"), "answer")


@query()
def merged_signs(spark: SparkSession, d: str) -> DataFrame:
    on = _on_anchor(spark, d).where("relation = 'on'").withColumn("selection_score", F.col("relevance"))
    clusters = written(folds.anchor_clusters(on.select("image_id", F.col("node_id").alias("key"), "box", "label", "selection_score", "score")), "clusters")
    return tuples.merged_signs(V.nodes(spark, d), clusters, tuples.WIDE)


@query(
    f"""WITH RECURSIVE {_TEXT_GROUPS}, t AS (SELECT n.image_id, gr.group_id, n.node_id AS key, n.text, n.box FROM nodes n JOIN gr USING (image_id, node_id) WHERE n.box IS NOT NULL),
        m AS (SELECT image_id, group_id, list_sort(list(greatest({X.height("box")}, 1.0))) AS hs FROM t GROUP BY 1, 2), q AS (SELECT t.*, greatest(0.6::DOUBLE * hs[len(hs) // 2 + 1], 2.0) AS reach FROM t JOIN m USING (image_id, group_id)),
        {Y.lines("q", "image_id, group_id", 1.0, "abs(o.cy - k.y / k.n) <= o.reach")}
        SELECT image_id, group_id, key, text, row_number() OVER (PARTITION BY image_id, group_id ORDER BY c, cx, n)::INTEGER AS position FROM f_c"""
)
def reading_order(spark: SparkSession, d: str) -> DataFrame:
    grouped = boxes.text_groups(V.nodes(spark, d)).withColumnRenamed("node_id", "key")
    return folds.reading_order(grouped).select("image_id", F.substring_index("group_id", "\u0001", -1).alias("group_id"), "key", "text", "position")


_LINES = f"""{V.NODES}, t AS (SELECT image_id, node_id AS key, text, box FROM nodes), {Y.lines("t", "image_id", 1e-6, "abs(o.cy - k.y / k.n) <= 0.65::DOUBLE * greatest(o.h, k.h / k.n)")},
    ln AS (SELECT image_id, key, text, box, c::INTEGER AS line_no, row_number() OVER (PARTITION BY image_id, c ORDER BY cx, n)::INTEGER AS position FROM f_c)"""


@query(f"WITH RECURSIVE {_LINES} SELECT image_id, key, text, line_no, position FROM ln")
def text_lines(spark: SparkSession, d: str) -> DataFrame:
    return folds.text_lines(V.nodes(spark, d).withColumnRenamed("node_id", "key")).select("image_id", "key", "text", "line_no", "position")


_HIGH = "greatest(b.y2 - b.y1, 1e-6)", "greatest(box.y2 - box.y1, 1e-6)"


@query(
    f"""WITH RECURSIVE {_LINES}, p AS (SELECT *, lag(box) OVER (PARTITION BY image_id, line_no ORDER BY position) AS b FROM ln),
        j AS (SELECT *, coalesce(greatest(least(b.y2, box.y2) - greatest(b.y1, box.y1), 0.0) / least({_HIGH[0]}, {_HIGH[1]}) >= 0.35::DOUBLE AND box.x1 - b.x2 BETWEEN -0.1::DOUBLE * greatest({_HIGH[0]}, {_HIGH[1]}) AND 1.6::DOUBLE * greatest({_HIGH[0]}, {_HIGH[1]}), false) AS joins FROM p),
        u AS (SELECT *, sum((NOT joins)::INT) OVER (PARTITION BY image_id, line_no ORDER BY position) AS run FROM j),
        m AS (SELECT image_id, list({{'key': key, 'text': text}}) OVER (PARTITION BY image_id, line_no, run ORDER BY position ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS m FROM u),
        x AS (SELECT image_id, m[1:k] AS m FROM m, range(2, 5) t(k) WHERE len(m) >= k),
        y AS (SELECT image_id, array_to_string([i.key FOR i IN m], '|') AS node_ids, array_to_string([{X.strip("i.text")} FOR i IN m IF {X.strip("i.text")} <> ''], ' ') AS answer FROM x WHERE len([1 FOR i IN m IF {X.blocked("i.text")}]) = 0)
        SELECT * FROM y WHERE length(answer) BETWEEN 4 AND 48"""
)
def line_windows(spark: SparkSession, d: str) -> DataFrame:
    found = tuples.line_windows(folds.text_lines(V.nodes(spark, d).withColumnRenamed("node_id", "key")))
    return found.select("image_id", F.array_join("node_ids", "|").alias("node_ids"), "answer")
