"""The tables that the queries start from, each as a DataFrame and as SQL over the same files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphloom.functions import geometry as G
from glyphloom.functions.geometry import Box
from glyphloom.operators.tables import last_wins
from glyphloom.operators.votes import latest_readings
from glyphloom.session import table

MODELS = (("alpha", "m1", 3), ("beta", "m2", 4), ("gamma", "m3", 5))


def nodes(spark: SparkSession, d: str) -> DataFrame:
    """Text nodes, one row a key (rows given twice are equal)."""
    cols = ("image_id", "node_id", "text", "text_normalized", "polygon", F.col("bbox").alias("box"), "image_width", "image_height", "confidence", "resolvable", "region_key", "source_dataset")
    return table(spark, d, "text_nodes").select(*cols).dropDuplicates(["image_id", "node_id"])


NODES = "nodes AS (SELECT DISTINCT ON (image_id, node_id) image_id, node_id, text, text_normalized, polygon, bbox AS box, image_width, image_height, confidence, resolvable, region_key, source_dataset FROM text_nodes)"


def seen_twice(spark: SparkSession, d: str) -> DataFrame:
    """The text nodes and what a second, less sure pass saw of them: a little to the right, without the
    last character."""
    n = nodes(spark, d).select("image_id", F.col("node_id").alias("key"), "text", "text_normalized", "confidence", "box")
    b, t = Box.of("box"), F.col("text_normalized")
    moved = Box(b.x1 + b.width * 0.0625, b.y1, b.x2 + b.width * 0.0625, b.y2).struct()
    again = n.select("image_id", F.concat("key", F.lit("+")).alias("key"), "text", F.substring(t, F.lit(1), F.greatest(F.length(t) - 1, F.lit(0))).alias("text_normalized"), (F.col("confidence") * 0.5).alias("confidence"), moved.alias("box"))
    return n.unionByName(again)


SEEN_TWICE = """twice AS (SELECT image_id, node_id AS key, text, text_normalized, confidence, box FROM nodes WHERE box.x1 IS NOT NULL UNION ALL
    SELECT image_id, node_id || '+', text, substr(text_normalized, 1, greatest(length(text_normalized) - 1, 0)), confidence * 0.5::DOUBLE, {'x1': box.x1 + (box.x2 - box.x1) * 0.0625::DOUBLE, 'y1': box.y1, 'x2': box.x2 + (box.x2 - box.x1) * 0.0625::DOUBLE, 'y2': box.y2} FROM nodes WHERE box.x1 IS NOT NULL)"""


def tuples(spark: SparkSession, d: str) -> DataFrame:
    """Tuples, the latest version of each."""
    t = table(spark, d, "bootstrap_tuples").where("ann_id is not null")
    kept = t.select("ann_id", "image_id", "image_path", "image_width", "image_height", "source_dataset", "answer", "anchor_label", "relation", "region_key", "text_bbox", "score", "area_fraction", "valid_text_count", "density_bucket", "area_bucket", "produced_at", "ingested_at")
    return last_wins(kept, "ann_id", ["produced_at", "ingested_at", "score"])


TUPLES = "tuples AS (SELECT ann_id, unnest(arg_max(b, (produced_at, ingested_at, score))) FROM (SELECT ann_id, produced_at, ingested_at, score, {'image_id': image_id, 'image_path': image_path, 'image_width': image_width, 'image_height': image_height, 'source_dataset': source_dataset, 'answer': answer, 'anchor_label': anchor_label, 'relation': relation, 'region_key': region_key, 'text_bbox': text_bbox, 'score': score, 'area_fraction': area_fraction, 'valid_text_count': valid_text_count} AS b FROM bootstrap_tuples WHERE ann_id IS NOT NULL) GROUP BY ann_id)"


def anchors(spark: SparkSession, d: str) -> DataFrame:
    """Anchors made of the tuples: their boxes at three times the size, kept within the image."""
    t = tuples(spark, d).where("image_id is not null and anchor_label is not null")
    b = Box.of("b")
    wide = Box(F.greatest(b.x1 - b.width, F.lit(0.0)), F.greatest(b.y1 - b.height, F.lit(0.0)), F.least(b.x2 + b.width, F.col("image_width").cast("double")), F.least(b.y2 + b.height, F.col("image_height").cast("double")))
    boxed = t.withColumn("b", G.from_xywh(F.col("text_bbox")))
    score = F.coalesce(F.nanvl("score", F.lit(0.0)), F.lit(0.0))
    return boxed.select("image_id", F.col("ann_id").alias("anchor_id"), F.col("anchor_label").alias("label"), score.alias("score"), F.col("relation").alias("source"), wide.struct().alias("box"))


ANCHORS = f"""{TUPLES}, anchors AS (SELECT image_id, ann_id AS anchor_id, anchor_label AS label, CASE WHEN isnan(score) THEN 0.0 ELSE coalesce(score, 0.0) END AS score, relation AS source,
    {{'x1': greatest(b[1] - (b[1] + b[3] - b[1]), 0.0), 'y1': greatest(b[2] - (b[2] + b[4] - b[2]), 0.0), 'x2': least(b[1] + b[3] + (b[1] + b[3] - b[1]), image_width::DOUBLE), 'y2': least(b[2] + b[4] + (b[2] + b[4] - b[2]), image_height::DOUBLE)}} AS box
    FROM (SELECT *, text_bbox AS b FROM tuples WHERE image_id IS NOT NULL AND anchor_label IS NOT NULL))"""


def votes(spark: SparkSession, d: str) -> DataFrame:
    return latest_readings(table(spark, d, "readings"))


def samples(spark: SparkSession, d: str) -> DataFrame:
    """QA rows, the latest delivery of each, with the tags as columns."""
    q = table(spark, d, "ocr_qa_dataset").where("sample_id is not null")
    kept = q.select("sample_id", "image_id", "question", "answer", "anchor_label", "relation", "question_type", F.col("tags.answer_type").alias("answer_type"), F.col("tags.difficulty").alias("difficulty"), F.col("tags.ambiguity_level").alias("ambiguity_level"), "ingested_at")
    return last_wins(kept, "sample_id", ["ingested_at"]).drop("ingested_at")


SAMPLES = "samples AS (SELECT sample_id, unnest(arg_max({'image_id': image_id, 'question': question, 'answer': answer, 'anchor_label': anchor_label, 'relation': relation, 'question_type': question_type, 'answer_type': tags.answer_type, 'difficulty': tags.difficulty, 'ambiguity_level': tags.ambiguity_level}, ingested_at)) FROM ocr_qa_dataset WHERE sample_id IS NOT NULL GROUP BY sample_id)"


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """Answers of three made-up models: by the sample's number right, wrong, longer or in capitals."""
    s = samples(spark, d).where("answer is not null")
    n = F.substring("sample_id", 3, 20).cast("long")
    rows = []
    for provider, model, k in MODELS:
        said = F.when(n % k == 0, "unknown word").when(n % 7 == k, F.concat("answer", F.lit(" today"))).otherwise(F.upper("answer"))
        failed = F.when(n % 50 == k, "timeout")
        rows.append(s.select("sample_id", F.lit(provider).alias("provider"), F.lit(model).alias("model"), F.col("answer").alias("gold"), said.alias("prediction"), "question_type", "answer_type", "difficulty", "ambiguity_level", failed.alias("error_type")))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


PREDICTIONS = (
    SAMPLES
    + ", predictions AS ("
    + " UNION ALL ".join(
        f"SELECT sample_id, '{p}' AS provider, '{m}' AS model, answer AS gold, CASE WHEN substr(sample_id, 3)::BIGINT % {k} = 0 THEN 'unknown word' WHEN substr(sample_id, 3)::BIGINT % 7 = {k} THEN answer || ' today' ELSE upper(answer) END AS prediction, question_type, answer_type, difficulty, ambiguity_level, CASE WHEN substr(sample_id, 3)::BIGINT % 50 = {k} THEN 'timeout' END AS error_type FROM samples WHERE answer IS NOT NULL"
        for p, m, k in MODELS
    )
    + ")"
)
