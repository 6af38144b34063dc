"""Queries of column functions and small operators over the whole tables, each with its result in SQL.

Imported for their entries in QUERIES and SQL of glyphloom.plans.queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphloom.functions import bins as B
from glyphloom.functions import geometry as G
from glyphloom.functions import labels as L
from glyphloom.functions import normalize as N
from glyphloom.functions import payloads as P
from glyphloom.functions import scoring as S
from glyphloom.functions.geometry import Box
from glyphloom.operators import agreement, boxes, folds, tables, tuples, votes
from glyphloom.plans import foldsql as Y
from glyphloom.plans import sqltext as X
from glyphloom.plans import views as V
from glyphloom.plans.queries import _COMPETING, query
from glyphloom.session import evenly, forget_later, fresh_path, table, written
from glyphloom.sources import readers, writers

# labels


def _any(words: tuple[str, ...], x: str) -> str:
    return "(" + " OR ".join(f"contains({x}, {X.q(w)})" for w in words) + ")"


def _has_words(words: tuple[str, ...]) -> str:
    return f"list_has_any({X.tokens(X.plain('anchor_label'))}, {X.listed(words)})"


_LOW = f"lower({X.strip('anchor_label')})"
_CATEGORY = " ".join(f"WHEN len([m FOR m IN {X.listed(members)} IF contains(low, m) OR contains(m, low)]) > 0 THEN {X.q(name)}" for name, members in L.CATEGORIES.items())
_ODD = "MAP {" + ", ".join(f"{X.q(k)}: {X.q(v)}" for k, v in N.IRREGULAR_PLURALS.items()) + "}"
_SHORT = "MAP {" + ", ".join(f"{X.q(k)}: {X.q(v)}" for k, v in N.SHORT_LOCATIONS.items()) + "}"
_SIDES = r"regexp_replace(s, ' (area|part) of the image', ' of the image', 'g')"
for _side in ("upper-left", "upper-right", "lower-left", "lower-right"):
    _SIDES = rf"regexp_replace({_SIDES}, '(?i)\b{_side}\b', '{_side.replace('-', ' ')}', 'g')"


@query(
    rf"""WITH l AS (SELECT DISTINCT anchor_label FROM bootstrap_tuples), a AS (SELECT *, {X.strip("anchor_label")} AS s, {_LOW} AS low, {X.tokens(_LOW)} AS lw, {X.tokens(X.strip("anchor_label"))} AS w FROM l),
        p AS (SELECT *, w[-1] AS e, lower(w[-1]) AS el, array_to_string([x FOR x IN w IF {X.plain("x")} NOT IN ({', '.join(map(X.q, L.SIMPLE_COLORS))})], ' ') AS bare,
            len([x FOR x IN w IF regexp_matches(regexp_replace(x, '[&''.]', '', 'g'), '^[^a-z]*[A-Z][^a-z]*$') AND regexp_matches(x, '^[\x00-\x7f]*$')]) AS capital, len([x FOR x IN w IF regexp_matches(x, '^\p{{L}}') AND NOT regexp_matches(x, '^\p{{Lu}}')]) = 0 AS titled,
            coalesce(list_sum([length(x) FOR x IN w]), 0) AS letters FROM a),
        o AS (SELECT *, CASE WHEN e = el THEN {_ODD}[el] WHEN e = upper(e[1]) || lower(e[2:]) THEN upper({_ODD}[el][1]) || {_ODD}[el][2:] WHEN e = upper(e) THEN upper({_ODD}[el]) ELSE {_ODD}[el] END AS odd FROM p)
        SELECT anchor_label, CASE {_CATEGORY} ELSE 'other' END AS category, length(low) <= 2 OR low IN ({', '.join(map(X.q, L.USELESS_LABELS))}) OR (len(lw) >= 2 AND lw[-1] IN ({', '.join(map(X.q, L.BACKDROPS))})) AS useless,
            low <> '' AND ((len(lw) >= 2 AND lw[-1] IN ({', '.join(map(X.q, L.TEXT_ROLES))})) OR {_any(L.TEXT_CONTENT, "low")} OR regexp_matches(low, '^({'|'.join(L.TEXT_CONTENT_STARTS)})')) AS refers_to_text,
            length(s) >= 5 AND len(w) >= 2 AND (capital >= greatest(2, len(w) - 1) OR (len(w) >= 3 AND titled AND letters / len(w) >= 5)) AS looks_copied,
            coalesce(nullif(regexp_replace(regexp_replace(bare, '(?i)\bwith$', ''), '^[ ,]+|[ ,]+$', '', 'g'), ''), s) AS without_colors,
            CASE WHEN len(w) = 0 THEN '' ELSE array_to_string(list_append(w[:-2], coalesce(odd, CASE WHEN regexp_matches(el, '[^aeiou]y$') THEN e[:-2] || 'ies' WHEN regexp_matches(el, '(s|x|z|ch|sh)$') THEN e || 'es' ELSE e || 's' END)), ' ') END AS plural,
            coalesce({_SHORT}[low], {X.strip(f"regexp_replace({_SIDES}, '{X.SPACE}+', ' ', 'g')")}) AS short_location, ['x', 'y', 'z'][(coalesce(list_sum([unicode(c) FOR c IN string_split(coalesce(anchor_label, ''), '') IF c <> '']), 0) % 3)::INTEGER + 1] AS choice FROM o"""
)
def label_forms(spark: SparkSession, d: str) -> DataFrame:
    a = F.col("anchor_label")
    options = F.array(F.lit("x"), F.lit("y"), F.lit("z"))
    return evenly(table(spark, d, "bootstrap_tuples").select(a).distinct()).select(a, L.category(a).alias("category"), L.is_useless(a).alias("useless"), L.refers_to_text(a).alias("refers_to_text"), L.looks_copied(a).alias("looks_copied"), L.without_colors(a).alias("without_colors"), N.plural_phrase(a).alias("plural"), N.short_location(a).alias("short_location"), N.stable_choice(options, a).alias("choice"))


@query()
def label_openings(spark: SparkSession, d: str) -> DataFrame:
    """Free labels and tags of captions; their rules are tested one by one on small tables."""
    a = F.col("anchor_label")
    return evenly(table(spark, d, "bootstrap_tuples").select(a).distinct()).select(a, L.open_label(a).alias("open_label"), F.array_join(L.caption_tags(a), "|").alias("caption_tags"), F.array_join(L.label_tags([a]), "|").alias("label_tags"))


_EXPECTED = " ".join(f"WHEN relation_kind = {X.q(k)} THEN {X.plain('answer')} IN ({', '.join(map(X.q, v))})" for k, v in L.EXPECTED_ANSWERS.items())


@query(
    f"""WITH {V.TUPLES}, t AS (SELECT *, CASE WHEN relation = 'on' THEN 'text_color' ELSE 'text_curvature' END AS relation_kind FROM tuples)
        SELECT ann_id, {_has_words(L.SHAPES)} AS names_shape, {_has_words(L.SIMPLE_COLORS)} AND {_has_words(L.STRUCTURES)} AS structural, {_has_words(L.CAPPED_WORDS)} AS capped,
            {_has_words(('sign', 'text', 'object'))} AS vague, CASE {_EXPECTED} ELSE false END AS expected,
            array_to_string([w FOR w IN {X.tokens("anchor_label")} IF regexp_replace(lower(w), '[.,?!]+$', '') NOT IN ({', '.join(map(X.q, (*L.SIMPLE_COLORS, *L.SHAPES)))})], ' ') AS told FROM t"""
)
def label_flags(spark: SparkSession, d: str) -> DataFrame:
    a = F.col("anchor_label")
    kind = F.when(F.col("relation") == "on", "text_color").otherwise("text_curvature")
    return V.tuples(spark, d).select("ann_id", L.names_shape(a).alias("names_shape"), L.is_structural(a).alias("structural"), L.is_capped(a).alias("capped"), L.has_words(a, ("sign", "text", "object")).alias("vague"), L.expected_answer(F.col("answer"), kind).alias("expected"), L.without_giveaways(a).alias("told"))


@query(
    rf"""WITH {V.TUPLES}, s AS (SELECT *, [anchor_label, answer, anchor_label, '  ', relation, upper(answer)] AS items FROM tuples), t AS (SELECT *, [lower({X.strip("x")}) FOR x IN items IF lower({X.strip("x")}) <> ''] AS low FROM s)
        SELECT ann_id, replace(coalesce(image_id, '') || '::' || ann_id, '::', '__') AS file_id, 'group_' || array_to_string([ann_id, coalesce(image_id, '')], '_') AS group_name, regexp_full_match(regexp_replace(coalesce(answer, ''), '{X.SPACE}+', '', 'g'), '\p{{Nd}}+') AS numeric,
            contains({X.spaced("coalesce(answer, '') || ' on ' || coalesce(anchor_label, '')")}, {X.spaced("answer")}) AS mentioned, array_to_string(list_filter(low, lambda x, i: list_position(low, x) = i)[:4], '|') AS labels, {X.strip("answer")} AS unfenced FROM t"""
)
def text_utilities(spark: SparkSession, d: str) -> DataFrame:
    a, label, image = F.col("answer"), F.col("anchor_label"), F.coalesce("image_id", F.lit(""))
    said = F.concat(F.coalesce(a, F.lit("")), F.lit(" on "), F.coalesce(label, F.lit("")))
    fenced = F.concat(F.lit("```json\n"), F.coalesce(a, F.lit("")), F.lit("\n```"))
    items = F.array(label, a, label, F.lit("  "), F.col("relation"), F.upper(a))
    return V.tuples(spark, d).select("ann_id", N.file_safe_id(F.concat(image, F.lit("::"), "ann_id")).alias("file_id"), N.group_id(F.array("ann_id", image)).alias("group_name"), N.numeric_only(a).alias("numeric"), N.mentions(said, F.array(F.coalesce(a, F.lit("")))).alias("mentioned"), F.array_join(N.distinct_labels(items, 4), "|").alias("labels"), N.without_fences(fenced).alias("unfenced"))


# geometry


def _flat(**columns) -> list:
    """Sides of boxes as columns."""
    return [F.round(c.getField(s), 6).alias(f"{name}_{s}") for name, c in columns.items() for s in ("x1", "y1", "x2", "y2")]


def _flat_sql(**boxes_) -> str:
    return ", ".join(f"round({v}, 6) AS {name}_{s}" for name, sides in boxes_.items() for s, v in zip(("x1", "y1", "x2", "y2"), sides))


def _bucket(v: str, names: str) -> str:
    a, b, c = names.split()
    return f"CASE WHEN {v} < 0.34::DOUBLE THEN '{a}' WHEN {v} <= 0.66::DOUBLE THEN '{b}' ELSE '{c}' END"


def _thousandths(v: str, size: str) -> str:
    return f"greatest(least(round_even({v} * {size} / 1000, 2), {size} - 1), 0.0)"


_CX, _CY = X.cx("box"), X.cy("box")
_T = [_thousandths(f"v[{i}]", s) for i, s in ((1, "image_width"), (2, "image_height"), (3, "image_width"), (4, "image_height"))]
_R = [_thousandths(f"(v[{i}] / 1024.0::DOUBLE * 1000)", s) for i, s in ((1, "image_width"), (2, "image_height"), (3, "image_width"), (4, "image_height"))]


@query(
    f"""WITH {V.NODES}, n AS (SELECT *, [floor(box.x1) % 1000, floor(box.y1) % 1000, floor(box.x2) % 1000, floor(box.y2) % 1000]::DOUBLE[] AS v FROM nodes WHERE box IS NOT NULL)
        SELECT image_id, node_id, {_flat_sql(
            outline=("list_min(list_filter(polygon, lambda p, i: i % 2 = 1))", "list_min(list_filter(polygon, lambda p, i: i % 2 = 0))", "list_max(list_filter(polygon, lambda p, i: i % 2 = 1))", "list_max(list_filter(polygon, lambda p, i: i % 2 = 0))"),
            wide=(f"greatest(floor({_CX} - greatest({X.width('box')} * 1.25, 8.0)), 0)", f"greatest(floor({_CY} - greatest({X.height('box')} * 1.25, 8.0)), 0)", f"least(ceil({_CX} + greatest({X.width('box')} * 1.25, 8.0)), image_width)", f"least(ceil({_CY} + greatest({X.height('box')} * 1.25, 8.0)), image_height)"),
            moved=tuple(f"round_even(box.{s} + box.{s[0]}1, 2)" for s in ("x1", "y1", "x2", "y2")),
            scaled=(f"least({_T[0]}, {_T[2]})", f"least({_T[1]}, {_T[3]})", f"greatest({_T[0]}, {_T[2]})", f"greatest({_T[1]}, {_T[3]})"),
            shares=(f"least({_R[0]}, {_R[2]})", f"least({_R[1]}, {_R[3]})", f"greatest({_R[0]}, {_R[2]})", f"greatest({_R[1]}, {_R[3]})"),
        )}, round({X.width("box")}, 6) AS w, round({X.height("box")}, 6) AS h, round(greatest({X.width("box")}, 0.0), 6) AS clamped_w, round(greatest({X.height("box")}, 0.0), 6) AS clamped_h,
        {_bucket(f"{_CY} / image_height", "upper middle lower")} || '_' || {_bucket(f"{_CX} / image_width", "left center right")} AS bucket,
        round(coalesce(greatest(abs({_CX} / greatest(image_width, 1) - 0.5), abs({_CY} / greatest(image_height, 1) - 0.5)), 0.5), 6) AS off_center FROM n"""
)
def node_boxes(spark: SparkSession, d: str) -> DataFrame:
    n = V.nodes(spark, d).where("box is not null").withColumn("v", F.array(*(F.pmod(F.floor(f"box.{s}"), F.lit(1000)).cast("double") for s in ("x1", "y1", "x2", "y2"))))
    b, w, h = Box.of("box"), F.col("image_width"), F.col("image_height")
    xywh, clamped = G.to_xywh("box"), G.to_xywh_clamped("box")
    sides = _flat(outline=G.polygon_box(F.col("polygon")), wide=G.expanded(b, w, h), moved=G.moved(b, b), scaled=G.from_thousandths(F.col("v"), w, h), shares=G.from_relative(F.transform("v", lambda x: x / 1024.0), w, h))
    return n.select("image_id", "node_id", *sides, *(F.round(xywh[i], 6).alias(x) for i, x in ((2, "w"), (3, "h"))), *(F.round(clamped[i], 6).alias(f"clamped_{x}") for i, x in ((2, "w"), (3, "h"))), G.bucket_name(b.cx / w, b.cy / h).alias("bucket"), F.round(G.center_offset(b, w, h), 6).alias("off_center"))


@query(
    f"""WITH {V.NODES}, {V.ANCHORS}, p AS (SELECT n.image_id, node_id, anchor_id, a.label, n.box AS t, a.box AS k, n.image_width AS w, n.image_height AS h FROM nodes n JOIN anchors a ON n.image_id = a.image_id AND {X.shared("n.box", "a.box")} > 0 WHERE n.box IS NOT NULL),
        v AS (SELECT *, greatest({X.area("k")}, 1.0) / greatest(w::DOUBLE * h, 1.0) AS share, greatest({X.area("k")}, 1.0) / greatest({X.area("t")}, 1.0) AS ratio, contains(coalesce(label, ''), 'sign') AS generic FROM p)
        SELECT image_id, node_id, anchor_id, share <= 0.94 AND (NOT generic OR (share <= 0.70 AND ratio <= 220)) AS viable, {X.supports("t", "k")} AS supports FROM v"""
)
def viable_anchors(spark: SparkSession, d: str) -> DataFrame:
    texts = V.nodes(spark, d).where("box is not null").select("image_id", "node_id", "box", "image_width", "image_height")
    pairs = boxes.near_pairs(texts, V.anchors(spark, d).select("image_id", "anchor_id", "label", "box"))
    t, k = Box.of("l.box"), Box.of("r.box")
    generic = F.contains(F.coalesce("r.label", F.lit("")), F.lit("sign"))
    pairs = pairs.where(G.shared_area(t, k) > 0)
    return pairs.select("image_id", "l.node_id", "r.anchor_id", G.viable_anchor(k, t, generic, F.col("l.image_width"), F.col("l.image_height")).alias("viable"), G.supports(t, k).alias("supports"))


@query(
    f"""WITH {V.NODES}, r AS (SELECT image_id, count(*) AS n, max({_CX}) - min({_CX}) AS x, max({_CY}) - min({_CY}) AS y FROM nodes WHERE box IS NOT NULL GROUP BY 1)
        SELECT image_id, n, CASE WHEN n <= 1 THEN 'singleton' WHEN y > x * 1.35::DOUBLE THEN 'vertical' WHEN x > y * 1.35::DOUBLE THEN 'horizontal' ELSE 'mixed' END AS orientation FROM r"""
)
def text_orientations(spark: SparkSession, d: str) -> DataFrame:
    b = Box.of("box")
    n = V.nodes(spark, d).where("box is not null").groupBy("image_id").agg(F.count(F.lit(1)).alias("n"), (F.max(b.cx) - F.min(b.cx)).alias("x"), (F.max(b.cy) - F.min(b.cy)).alias("y"))
    return n.select("image_id", "n", G.orientation(F.col("x"), F.col("y"), F.col("n")).alias("orientation"))


# bins and scores

_LEN = f"length({X.strip('answer')})"
_SIZE = "CASE WHEN area_fraction > 0.10 THEN 'large_>10pct' WHEN area_fraction >= 0.03 THEN 'medium_3-10pct' WHEN area_fraction >= 0.01 THEN 'small_1-3pct' WHEN area_fraction IS NOT NULL THEN 'tiny_<1pct' END"
_CROWD = "CASE WHEN valid_text_count > 5 THEN 'dense_6+' WHEN valid_text_count > 2 THEN 'moderate_3-5' WHEN valid_text_count IS NOT NULL THEN 'sparse_1-2' END"
_LENGTH = f"CASE WHEN {_LEN} > 10 THEN 'long_11+' WHEN {_LEN} > 4 THEN 'medium_5-10' WHEN {_LEN} > 1 THEN 'short_2-4' ELSE 'single_char' END"
_CONF = "CASE WHEN sc > 0.95 THEN 'high_>0.95' WHEN sc >= 0.85 THEN 'medium_0.85-0.95' WHEN sc IS NOT NULL THEN 'low_0.80-0.85' END"
_PTS = f"""(CASE size_bin WHEN 'tiny_<1pct' THEN 3 WHEN 'small_1-3pct' THEN 2 WHEN 'medium_3-10pct' THEN 1 ELSE 0 END + CASE crowd WHEN 'dense_6+' THEN 2 WHEN 'moderate_3-5' THEN 1 ELSE 0 END + (relation IS DISTINCT FROM 'on')::INT
    + (length_bin = 'long_11+')::INT + coalesce(conf_bin = 'low_0.80-0.85', false)::INT + coalesce(region_key = 'cc', false)::INT + CASE level WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END)"""
_DOUBLES = V.TUPLES.replace("'valid_text_count': valid_text_count}", "'valid_text_count': valid_text_count, 'sc': CASE WHEN isnan(score) THEN NULL ELSE score END}")


@query(
    f"""WITH {_DOUBLES}, c AS (SELECT *, {_SIZE} AS size_bin, {_CROWD} AS crowd, {_LENGTH} AS length_bin, {_CONF} AS conf_bin, text_bbox[3] AS px, coalesce(valid_text_count, 0) AS k FROM tuples),
        s AS (SELECT *, (k > 0)::INT * 3 + (k > 3)::INT * 2 + (k > 6)::INT * 2 + (k > 9)::INT * 2 + (k > 12)::INT + (k >= 4)::INT * 2 + (k = 3)::INT + (relation = 'on' AND relation IS NOT NULL)::INT * 2 + (k >= 2)::INT * 2 + (k >= 2)::INT + (k >= 4)::INT AS amb FROM c),
        l AS (SELECT *, CASE WHEN amb > 4 THEN 'high' WHEN amb > 1 THEN 'medium' ELSE 'low' END AS level FROM s)
        SELECT ann_id, CASE WHEN area_fraction >= 0.02 THEN 'large' WHEN area_fraction >= 0.005 THEN 'medium' WHEN area_fraction IS NOT NULL THEN 'small' END AS area, size_bin, crowd, length_bin, conf_bin,
            CASE WHEN sc > 0.75 THEN 'high_>0.75' WHEN sc >= 0.5 THEN 'medium_0.50-0.75' WHEN sc IS NOT NULL THEN 'low_<0.50' END AS score_bin, amb::INTEGER AS ambiguity, level,
            round(area_fraction * 100 + least({_LEN}, 16) / 16.0::DOUBLE, 6) AS size_score, CASE WHEN {_PTS} > 3 THEN 'hard' WHEN {_PTS} > 1 THEN 'medium' ELSE 'easy' END AS difficulty,
            floor((coalesce(sc, 0) * 0.38::DOUBLE + 0.5 * 0.12::DOUBLE + least(px / 96.0::DOUBLE, 1.0) * 0.23::DOUBLE + CASE WHEN relation = 'on' THEN 0.17::DOUBLE ELSE 0.17::DOUBLE * 0.45::DOUBLE END + CASE WHEN region_key = 'cc' THEN 0.18::DOUBLE ELSE 0 END - CASE WHEN k >= 12 THEN 0.12::DOUBLE ELSE 0 END - amb * 0.05::DOUBLE) * 1e9 + 0.3) / 1e9 AS quality FROM l"""
)
def tuple_bins(spark: SparkSession, d: str) -> DataFrame:
    t = V.tuples(spark, d).withColumn("sc", F.nanvl("score", F.lit(None).cast("double"))).withColumn("k", F.coalesce("valid_text_count", F.lit(0)))
    a, k, on = F.col("answer"), F.col("k"), F.coalesce(F.col("relation") == "on", F.lit(False))
    n = lambda c: c.cast("int")
    shape = F.when(on, "grid")
    scored = B.ambiguity_score(k, n(k > 3), n(k > 6), n(k > 9), n(k > 12), k, shape, k, k, k)
    named = t.select("*", B.area(F.col("area_fraction")).alias("area"), B.text_size(F.col("area_fraction")).alias("size_bin"), B.text_density(F.col("valid_text_count")).alias("crowd"), B.text_length(a).alias("length_bin"), B.confidence(F.col("sc")).alias("conf_bin"), B.anchor_score(F.col("sc")).alias("score_bin"), scored.alias("ambiguity"))
    named = named.withColumn("level", B.ambiguity(F.col("ambiguity")))
    kind = F.when(F.coalesce(F.col("region_key") == "cc", F.lit(False)), "TEXT_PROPERTY").otherwise("DIRECT_READ")
    quality = B.candidate_quality(F.coalesce("sc", F.lit(0.0)), F.lit(0.5), F.try_element_at("text_bbox", F.lit(3)), on, F.col("region_key") == "cc", k, F.col("ambiguity"))
    hard = B.difficulty(F.col("size_bin"), F.col("crowd"), on, F.col("length_bin"), F.col("conf_bin"), kind, F.col("level"))
    return named.select("ann_id", "area", "size_bin", "crowd", "length_bin", "conf_bin", "score_bin", "ambiguity", "level", F.round(B.size_score(F.col("area_fraction"), a), 6).alias("size_score"), hard.alias("difficulty"), G.snapped(quality).alias("quality"))


_TOLD = f"[w FOR w IN {{}} IF w NOT IN ({', '.join(map(X.q, S.IDLE_WORDS))}) AND length(w) > 1]"


def _f1(a: str, b: str) -> str:
    n = f"coalesce(list_sum([least(len([1 FOR y IN {a} IF y = w]), len([1 FOR y IN {b} IF y = w])) FOR w IN list_distinct({a})]), 0)"
    return f"round(CASE WHEN {n} > 0 THEN 2.0::DOUBLE * {n} / (len({a}) + len({b})) ELSE 0 END, 6)"


@query(
    f"""WITH {V.SAMPLES}, w AS (SELECT sample_id, {X.tokens("strip_accents(question)")} AS q, {X.tokens("strip_accents(question || ' ' || coalesce(answer, ''))")} AS a, {_TOLD.format(X.tokens("question"))} AS told, {_TOLD.format(X.tokens("question || ' ' || coalesce(answer, '')"))} AS both_told FROM samples WHERE question IS NOT NULL)
        SELECT sample_id, {_f1("q", "a")} AS word_f1, {_f1("told", "both_told")} AS content_f1 FROM w"""
)
def question_overlap(spark: SparkSession, d: str) -> DataFrame:
    q, a = F.col("question"), F.concat_ws(" ", "question", F.coalesce("answer", F.lit("")))
    return V.samples(spark, d).where("question is not null").select("sample_id", F.round(S.word_f1(q, a), 6).alias("word_f1"), F.round(S.content_f1(q, a), 6).alias("content_f1"))


# replies of models


@query(
    f"""WITH {V.TUPLES}, t AS (SELECT *, length(ann_id) % 4 AS form, text_bbox IS NOT NULL AND len(text_bbox) = 4 AND anchor_label IS NOT NULL AS has FROM tuples)
        SELECT ann_id, CASE WHEN has AND form < 3 THEN 1 ELSE 0 END AS boxes, CASE WHEN has AND form < 3 THEN anchor_label END AS label, CASE WHEN has AND form < 3 THEN text_bbox[1] END AS x FROM t"""
)
def salvaged_replies(spark: SparkSession, d: str) -> DataFrame:
    """Boxes out of replies that are fenced, wrapped in prose, cut off or hold none, by the id's length."""
    t = V.tuples(spark, d).withColumn("form", F.length("ann_id") % 4)
    has = F.col("text_bbox").isNotNull() & (F.size("text_bbox") == 4) & F.col("anchor_label").isNotNull()
    one = F.to_json(F.struct(F.col("text_bbox").alias("bbox_2d"), F.col("anchor_label").alias("label")))
    forms = F.when(F.col("form") == 0, F.concat(F.lit("```json\n["), one, F.lit("]\n```"))).when(F.col("form") == 1, F.concat(F.lit("I see "), one, F.lit(" there."))).when(F.col("form") == 2, F.concat(F.lit("["), one, F.lit(', {"bbox_2d": [1, 2')))
    reply = F.when(has, forms.otherwise("nothing to see")).otherwise("none")
    found = t.select("ann_id", P.salvaged_boxes(reply).alias("b"))
    first = F.try_element_at("b", F.lit(1))
    return found.select("ann_id", F.size("b").alias("boxes"), first["label"].alias("label"), F.try_element_at(first["bbox_2d"], F.lit(1)).alias("x"))


_REPLY = "length(sample_id) % 2 = 0"
_SURE = "CASE WHEN ambiguity_level = 'high' THEN 1.0 WHEN ambiguity_level = 'medium' THEN 0.25 WHEN ambiguity_level = 'low' THEN 1.0 END"
_REPLIES = f"""{V.SAMPLES}, rp AS (SELECT sample_id, coalesce(question_type, '(unknown)') AS q, CASE ambiguity_level WHEN 'high' THEN true WHEN 'medium' THEN false WHEN 'low' THEN false END AS ambiguous, {_SURE}::DOUBLE AS confidence, ambiguity_level IN ('high', 'medium', 'low') AND ambiguity_level IS NOT NULL AS parse_ok FROM samples)"""


def _replies(spark: SparkSession, d: str) -> DataFrame:
    """What a model might say of a question's ambiguity: an object, a plain word, or neither."""
    level = F.col("ambiguity_level")
    said = F.when(level == "high", 'So: {"ambiguous": true, "confidence": 1.7, "reason": "two signs"}').when(level == "medium", '{"ambiguous": false, "confidence": 0.25}').when(level == "low", "No, it is clear.").otherwise("hard to tell")
    return V.samples(spark, d).select("sample_id", "question_type", F.lit("alpha").alias("provider"), F.lit("m1").alias("model"), P.ambiguity_reply(said).alias("r")).select("sample_id", "question_type", "provider", "model", "r.*")


@query(f"WITH {_REPLIES} SELECT sample_id, ambiguous, confidence, parse_ok FROM rp")
def ambiguity_replies(spark: SparkSession, d: str) -> DataFrame:
    return _replies(spark, d).select("sample_id", "ambiguous", "confidence", "parse_ok")


@query(
    f"""WITH {_REPLIES}, x AS (SELECT *, 'alpha:m1' AS m FROM rp) SELECT CASE WHEN grouping(m) = 0 THEN m END AS model, CASE WHEN grouping(q) = 0 THEN q END AS question_type, count(*) AS rows, round_even(avg(ambiguous::INT), 6) AS ambiguous_rate, round_even(avg(parse_ok::INT), 6) AS parse_rate FROM x GROUP BY ROLLUP (m, q)"""
)
def ambiguity_rates(spark: SparkSession, d: str) -> DataFrame:
    return agreement.ambiguity_rates(_replies(spark, d))


@query(
    f"""WITH {V.TUPLES}, t AS (SELECT *, {X.strip("anchor_label")} AS l, {X.strip("answer")} AS a FROM tuples)
        SELECT ann_id, answer AS said, 'gemini' AS provider, 'm:1' AS model, CASE WHEN l = '' OR l = a THEN a WHEN a = '' THEN l ELSE l || '; ' || a END AS caption, CASE WHEN l <> '' AND text_bbox IS NOT NULL AND len(text_bbox) >= 4 THEN 1 ELSE 0 END AS regions FROM t"""
)
def reply_parts(spark: SparkSession, d: str) -> DataFrame:
    part = lambda c: F.array(F.struct(c.alias("text")))
    reply = F.to_json(F.struct(F.array(F.struct(F.struct(part(F.col("answer")).alias("parts")).alias("content"))).alias("candidates")))
    spec = P.model_spec(F.lit(" Google:m:1 "))
    rows = F.array(F.struct(F.col("anchor_label").alias("label"), F.col("text_bbox").alias("box")), F.struct(F.col("answer").alias("label"), F.array().cast("array<double>").alias("box")))
    found = V.tuples(spark, d).select("ann_id", P.first_text_part(reply).alias("said"), spec["provider"].alias("provider"), spec["model"].alias("model"), P.inventory(rows).alias("i"))
    return found.select("ann_id", "said", "provider", "model", "i.caption", F.size("i.regions").alias("regions"))


# items, gates, selections


@query(
    f"""WITH {V.SAMPLES}, i AS (SELECT sample_id, answer, [anchor_label] AS syn, question AS q1, coalesce(question, '') || ' Which word is it, please?' AS q2 FROM samples WHERE question IS NOT NULL),
        d AS (SELECT *, [x FOR x IN list_distinct({X.tokens("lower(q1)")})] AS a, list_distinct({X.tokens("lower(q2)")}) AS b FROM i),
        f AS (SELECT *, len(list_intersect(a, b)) / greatest(len(list_distinct(a || b)), 1) <= 0.7 AS ok, unnest([0, 1]) AS item_no FROM d),
        c AS (SELECT sample_id AS tuple_id, item_no::INTEGER AS item_no, CASE item_no WHEN 0 THEN {X.plain("answer")} = {X.plain("answer")} ELSE {X.plain("answer || ' x'")} = {X.plain("answer")} END AS answer_ok,
            CASE WHEN syn[1] IS NULL THEN contains({X.spaced("CASE item_no WHEN 0 THEN q1 ELSE q2 END")}, '') ELSE contains({X.spaced("CASE item_no WHEN 0 THEN q1 ELSE q2 END")}, {X.spaced("syn[1]")}) END AS anchor_ok, len({X.tokens("CASE item_no WHEN 0 THEN q1 ELSE q2 END")}) BETWEEN 5 AND 35 AS length_ok, ok AS duplicate_ok FROM f)
        SELECT *, answer_ok AND anchor_ok AND length_ok AND duplicate_ok AS accepted FROM c"""
)
def validated_items(spark: SparkSession, d: str) -> DataFrame:
    item = lambda q, a: F.struct(q.alias("question"), a.alias("answer"))
    q, a = F.col("question"), F.col("answer")
    items = F.array(item(q, a), item(F.concat(q, F.lit(" Which word is it, please?")), F.concat(a, F.lit(" x"))))
    rows = V.samples(spark, d).where("question is not null").select(F.col("sample_id").alias("tuple_id"), "answer", F.array("anchor_label").alias("anchor_synonyms"), items.alias("items"))
    return tuples.validated_items(rows)


@query(f"WITH {V.SAMPLES}, {V.TUPLES} SELECT sample_id, answer FROM samples WHERE ambiguity_level IS DISTINCT FROM 'high'")
def gated_samples(spark: SparkSession, d: str) -> DataFrame:
    s = V.samples(spark, d)
    verdicts = s.select("sample_id", (F.col("ambiguity_level") == "high").alias("leaky"))
    return agreement.gate(s, verdicts).select("sample_id", "answer")


@query(
    """WITH p AS (SELECT image_id || ':' || node_id AS sample_id, text AS answer FROM readings WHERE text <> '' AND image_id IS NOT NULL AND node_id IS NOT NULL), n AS (SELECT sample_id, answer, count(*) AS n FROM p GROUP BY 1, 2)
       SELECT sample_id, count(*) AS distinct_count, arg_max(answer, (n, answer)) AS plurality_answer, max(n) AS plurality_count, count(*) >= 2 AS ambiguous FROM n GROUP BY 1"""
)
def probe_answers(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "readings").where("image_id is not null and node_id is not null")
    return agreement.probe_plurality(r.select(F.concat_ws(":", "image_id", "node_id").alias("sample_id"), F.col("text").alias("answer")))


@query(
    """WITH r AS (SELECT image_id, node_id, coalesce(rotation, 0) AS rot, coalesce(confidence, 0.0) AS c FROM readings WHERE confidence IS NULL OR NOT isnan(confidence)),
        m AS (SELECT image_id, node_id, max(c) AS best FROM r GROUP BY 1, 2)
        SELECT r.image_id, r.node_id, max(best) AS best, min(rot) AS rotation FROM r JOIN m ON r.image_id IS NOT DISTINCT FROM m.image_id AND r.node_id IS NOT DISTINCT FROM m.node_id AND c = best GROUP BY 1, 2"""
)
def best_rotations(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "readings").where("confidence is null or not isnan(confidence)").select("image_id", "node_id", "rotation", "confidence")
    return votes.best_rotation(r, ["image_id", "node_id"]).select("image_id", "node_id", F.coalesce("confidence", F.lit(0.0)).alias("best"), F.coalesce("rotation", F.lit(0)).alias("rotation"))


@query(
    f"""WITH {_COMPETING}, r AS (SELECT image_id, relation, tuple_id, box, answer, count(*) OVER (PARTITION BY image_id, relation, label) AS n, row_number() OVER (PARTITION BY image_id, relation, label ORDER BY tuple_id) AS k, label FROM u WHERE box.x1 IS NOT NULL AND label <> ''),
        g AS (SELECT image_id, relation, label, list_sort(list(tuple_id)) AS ids, min(box.x1) AS x1, min(box.y1) AS y1, max(box.x2) AS x2, max(box.y2) AS y2 FROM r WHERE n BETWEEN 2 AND 20 GROUP BY 1, 2, 3)
        SELECT r.image_id, r.tuple_id FROM r WHERE n NOT BETWEEN 2 AND 20 UNION ALL SELECT image_id, label || '/' || relation FROM g"""
)
def unsubsumed(spark: SparkSession, d: str) -> DataFrame:
    """Tuples and, of those with a label that 2 to 20 share, merged ones that hold them."""
    t = V.tuples(spark, d).where("image_id is not null")
    one = t.select("image_id", N.text_of(F.col("relation")).alias("relation"), F.col("ann_id").alias("tuple_id"), G.from_xywh(F.col("text_bbox")).alias("box"), N.plain_answer(F.col("anchor_label")).alias("label"))
    one = written(one.where("box.x1 is not null and label <> ''"), "singles")
    side = lambda f, s: f(f"box.{s}").alias(s)
    few = one.groupBy("image_id", "relation", "label").agg(F.count(F.lit(1)).alias("n")).where("n between 2 and 20").drop("n")
    g = one.join(few, ["image_id", "relation", "label"]).groupBy("image_id", "relation", "label").agg(F.sort_array(F.collect_list("tuple_id")).alias("text_node_ids"), side(F.min, "x1"), side(F.min, "y1"), side(F.max, "x2"), side(F.max, "y2"))
    merged = g.select("image_id", "relation", F.concat_ws("/", "label", "relation").alias("tuple_id"), F.struct("x1", "y1", "x2", "y2").alias("box"), "text_node_ids", F.lit("merged").alias("group_kind"))
    single = one.select("image_id", "relation", "tuple_id", "box", F.array("tuple_id").alias("text_node_ids"), F.lit("single").alias("group_kind"))
    return boxes.not_subsumed(single.unionByName(merged)).select("image_id", "tuple_id")


@query(
    f"""WITH RECURSIVE {_DOUBLES}, r AS (SELECT image_id, ann_id AS key, coalesce(relation, '') AS relation, {{'x1': text_bbox[1], 'y1': text_bbox[2], 'x2': text_bbox[1] + text_bbox[3], 'y2': text_bbox[2] + text_bbox[4]}} AS box, coalesce(sc, 0.0) AS anchor_score FROM tuples WHERE image_id IS NOT NULL AND text_bbox IS NOT NULL),
        {Y.exemplar_numbers("r", "relation, anchor_score DESC, key", "relation, box", f"relation VARCHAR, box {Y.BOX}", f"k.relation = o.relation AND {Y.like('k.box', 'o.box', 0.78, 0.7)}")} SELECT image_id, key, c::INTEGER AS group_no FROM f_c"""
)
def relabel_groups(spark: SparkSession, d: str) -> DataFrame:
    t = V.tuples(spark, d).where("image_id is not null")
    rows = t.select("image_id", F.col("ann_id").alias("key"), F.coalesce("relation", F.lit("")).alias("relation"), G.from_xywh(F.col("text_bbox")).alias("box"), F.coalesce(F.nanvl("score", F.lit(0.0)), F.lit(0.0)).alias("anchor_score"))
    return folds.relabel_groups(rows).select("image_id", "key", "group_no")


_GAIN = "o.q[i] + CASE WHEN list_contains(f.st.texts, o.t[i]) THEN 0 ELSE 1.7::DOUBLE END + CASE WHEN list_contains(f.st.kinds, o.k[i]) THEN 0 ELSE 1.1::DOUBLE END - CASE WHEN o.cap[i] AND len(list_filter(f.st.labels, lambda z: z = o.l[i])) >= 2 THEN 0.15::DOUBLE ELSE 0 END"
_LEFT = f"[CASE WHEN list_contains(f.st.picked, i) THEN -1e9::DOUBLE ELSE {_GAIN} END FOR i IN range(1, len(o.id) + 1)]"


@query(
    f"""WITH RECURSIVE {V.SAMPLES}, c AS (SELECT image_id, sample_id, coalesce(question_type, '') AS k, coalesce({X.plain("answer")}, '') AS t, coalesce({X.plain("anchor_label")}, '') AS l, (length(coalesce(question, '')) % 64) / 64.0::DOUBLE AS q FROM samples WHERE image_id IS NOT NULL),
        s AS (SELECT *, q + CASE WHEN k = 'DIRECT_READ' THEN 0.25::DOUBLE ELSE 0 END AS qq FROM c),
        o AS (SELECT image_id, list(sample_id ORDER BY q DESC, sample_id) AS id, list(k ORDER BY q DESC, sample_id) AS k, list(t ORDER BY q DESC, sample_id) AS t, list(l ORDER BY q DESC, sample_id) AS l, list(qq ORDER BY q DESC, sample_id) AS q, list(contains(l, 'sign') ORDER BY q DESC, sample_id) AS cap FROM s GROUP BY 1),
        f AS (SELECT image_id, 0 AS n, {{'picked': []::BIGINT[], 'texts': []::VARCHAR[], 'kinds': []::VARCHAR[], 'labels': []::VARCHAR[]}} AS st FROM o
            UNION ALL SELECT image_id, n + 1, {{'picked': list_append(p.picked, pk), 'texts': list_append(texts, tt[pk]), 'kinds': list_append(kinds, kk[pk]), 'labels': list_append(labels, ll[pk])}}
            FROM (SELECT f.image_id, f.n, f.st.picked AS picked, f.st.texts AS texts, f.st.kinds AS kinds, f.st.labels AS labels, o.t AS tt, o.k AS kk, o.l AS ll, list_position({_LEFT}, list_max({_LEFT}))::BIGINT AS pk FROM f JOIN o USING (image_id) WHERE f.n < least(len(o.id), 6) AND len(o.id) > 6) p),
        x AS (SELECT * FROM f QUALIFY n = max(n) OVER (PARTITION BY image_id)), y AS (SELECT x.image_id, o.id, CASE WHEN len(o.id) <= 6 THEN range(1, len(o.id) + 1) ELSE x.st.picked END AS p FROM x JOIN o USING (image_id))
        SELECT image_id, id[pk] AS candidate_id, pick::INTEGER AS pick FROM (SELECT image_id, id, unnest(p) AS pk, generate_subscripts(p, 1) AS pick FROM y)"""
)
def selected_candidates(spark: SparkSession, d: str) -> DataFrame:
    """At most six questions of every image, greedily."""
    s = V.samples(spark, d).where("image_id is not null")
    label = N.plain_answer(F.col("anchor_label"))
    rows = s.select("image_id", F.col("sample_id").alias("candidate_id"), (F.pmod(F.length(F.coalesce("question", F.lit(""))), F.lit(64)) / 64.0).alias("quality"), F.coalesce("question_type", F.lit("")).alias("question_type"), N.plain_answer(F.col("answer")).alias("text_key"), label.alias("label"), F.contains(label, F.lit("sign")).alias("capped"))
    return folds.greedy_selection(rows, 6).select("image_id", "candidate_id", "pick")


@query(
    f"""WITH {V.PREDICTIONS} SELECT sample_id, array_to_string(list_sort(list(provider || ':' || model)), '|') AS models FROM predictions WHERE coalesce(error_type, '') = '' GROUP BY 1"""
)
def evals_index(spark: SparkSession, d: str) -> DataFrame:
    scored = agreement.with_scores(V.predictions(spark, d))
    first = agreement.evals_index(scored.where("provider <> 'gamma'"))
    both = agreement.evals_index(scored.where("provider <> 'alpha'"), first)
    return both.select("sample_id", F.array_join(F.transform("evals", lambda e: e["model"]), "|").alias("models"))


@query("""SELECT sample_id, image_id, coalesce(grounding.text_bbox, text_bbox)[1] AS x1, coalesce(grounding.text_bbox, text_bbox)[2] + coalesce(grounding.text_bbox, text_bbox)[4] AS y2, 196 AS cells, 0.0 AS target FROM ocr_qa_dataset""")
def pointing_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = agreement.pointing_rows(table(spark, d, "ocr_qa_dataset"))
    return rows.select("sample_id", "image_id", rows["bbox_xyxy"][0].alias("x1"), rows["bbox_xyxy"][3].alias("y2"), F.size("soft_target").alias("cells"), F.array_max("soft_target").alias("target"))


@query(
    f"""WITH {V.SAMPLES}, {V.TUPLES}, s AS (SELECT image_id, sample_id, row_number() OVER (PARTITION BY image_id ORDER BY sample_id) - 1 AS pos FROM samples WHERE image_id IS NOT NULL), t AS (SELECT image_id, ann_id, row_number() OVER (PARTITION BY image_id ORDER BY ann_id) - 1 AS pos FROM tuples WHERE image_id IS NOT NULL)
        SELECT s.image_id, s.sample_id, t.ann_id FROM s LEFT JOIN t ON s.image_id = t.image_id AND CASE WHEN s.pos % 2 = 0 AND EXISTS (SELECT 1 FROM t z WHERE z.image_id = s.image_id AND z.pos = s.pos // 2 AND z.pos % 2 = 0) AND s.pos // 2 % 2 = 0 THEN t.pos = s.pos // 2 ELSE t.pos = s.pos END"""
)
def placed_items(spark: SparkSession, d: str) -> DataFrame:
    """Samples with a tuple of their image: every second one names its tuple's index, the others go by place."""
    from pyspark.sql import Window

    at = lambda key: F.row_number().over(Window.partitionBy("image_id").orderBy(key)) - 1
    s = V.samples(spark, d).where("image_id is not null").select("image_id", "sample_id").withColumn("pos", at("sample_id"))
    t = V.tuples(spark, d).where("image_id is not null").select("image_id", "ann_id").withColumn("pos", at("ann_id"))
    left = s.select("image_id", F.when(F.col("pos") % 2 == 0, F.expr("pos div 2").cast("int")).alias("index"), F.col("sample_id").alias("ordinal"))
    right = t.select("image_id", F.when(F.col("pos") % 2 == 0, F.col("pos")).alias("index"), F.col("ann_id").alias("ordinal"))
    joined = tables.positional_join(left, right, "image_id", "index", "ordinal")
    return joined.select("image_id", F.col("ordinal").alias("sample_id"), F.col("item.ordinal").alias("ann_id"))


# sources and sinks


@query(f"WITH {V.SAMPLES} SELECT sample_id, image_id, question, answer, question_type FROM samples")
def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The samples, written as JSON lines and read again."""
    path = fresh_path(spark, "lines")
    forget_later(spark, path)
    rows = V.samples(spark, d).select("sample_id", "image_id", "question", "answer", "question_type")
    writers.json_lines(rows, path)
    return readers.json_lines(spark, path, rows.schema, missing="error")


@query("SELECT source_dataset, keep_whole, count(*) OVER () AS listed FROM source_registry")
def document_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The registry as one JSON document, written and read by the driver: such documents are small."""
    rows = [r.asDict() for r in table(spark, d, "source_registry").select("source_dataset", "keep_whole").collect()]
    path = fresh_path(spark, "registry") + ".json"
    forget_later(spark, path)
    writers.json_document(spark, path, {"items": rows, "listed": len(rows)})
    found = readers.json_document(spark, path)
    return spark.createDataFrame([(r["source_dataset"], r["keep_whole"], found["listed"]) for r in found["items"]], "source_dataset string, keep_whole boolean, listed long")
