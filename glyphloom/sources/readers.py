"""Sources: JSON lines, single documents, annotation files of nested maps, file listings, manifests."""

from __future__ import annotations

import json
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphloom.functions import bins as B
from glyphloom.functions import geometry as G
from glyphloom.functions import normalize as N
from glyphloom.functions.geometry import Box
from glyphloom.operators.tables import first_wins

BOX = "struct<x1: double, y1: double, x2: double, y2: double>"
#: Declared schemas of the stage tables; files with other columns lose them, missing ones are null.
SCHEMAS = {
    "readings": "image_id string, node_id string, model_name string, text string, confidence double, rotation int",
    "text_nodes": f"image_id string, node_id string, image_width int, image_height int, text string, text_normalized string, polygon array<double>, bbox {BOX}, bbox_xywh array<double>, confidence double, consensus_tier string, region_key string, resolvable boolean, source_dataset string",
    "anchors": f"image_id string, label string, raw_label string, box {BOX}, score double, source string",
    "predictions": "sample_id string, provider string, model string, prediction_norm string, question_type string, difficulty string, ambiguity_level string, error_type string",
    "excluded": "image_id string, dataset_source string, origin string",
}
ANNOTATIONS = "imgs map<string, struct<id: string, width: int, height: int, file_name: string>>, anns map<string, struct<id: string, image_id: string, bbox: array<double>, utf8_string: string, points: array<double>>>"

# The phrase of each cell of the picture.
REGION_PHRASES = {
    "ul": "upper-left area of the image",
    "uc": "top-center area of the image",
    "ur": "upper-right area of the image",
    "cl": "middle-left area of the image",
    "cc": "center of the image",
    "cr": "middle-right area of the image",
    "ll": "lower-left area of the image",
    "lc": "bottom-center area of the image",
    "lr": "lower-right area of the image",
}


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def json_lines(spark: SparkSession, path: str, schema: str | T.StructType, missing: str = "empty") -> DataFrame:
    """Rows of a JSON-lines file with a declared schema; blank lines are none. A path that isn't there
    gives no rows, or with missing="error" fails."""
    if missing == "empty" and not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def json_document(spark: SparkSession, path: str) -> Any | None:
    """One small JSON document, such as a manifest, on the driver; None if it isn't there."""
    if not exists(spark, path):
        return None
    return json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))


def annotated_texts(spark: SparkSession, path: str) -> DataFrame:
    """(image_id, node_id, image_width, image_height, file_name, text, text_normalized, polygon, box,
    bbox_xywh, region_key, resolvable) of files with maps imgs and anns: the valid texts on images of
    known size, with boxes larger than a pixel and polygons of four corners."""
    raw = spark.read.option("multiLine", True).schema(ANNOTATIONS).json(path)
    images = raw.select(F.explode("imgs").alias("image_id", "i")).select("image_id", F.col("i.width").alias("image_width"), F.col("i.height").alias("image_height"), F.element_at(F.split("i.file_name", "/"), -1).alias("file_name")).where("image_width > 0 and image_height > 0")
    texts = raw.select(F.explode("anns").alias("k", "a")).select(F.col("a.image_id").alias("image_id"), F.coalesce("a.id", F.lit("")).alias("node_id"), N.strip(F.col("a.utf8_string")).alias("text"), F.col("a.bbox").alias("bbox_xywh"), F.slice("a.points", 1, 8).alias("polygon"))
    texts = texts.where(N.valid_text(F.col("text")) & (F.size("bbox_xywh") == 4) & (F.size("polygon") == 8)).where("bbox_xywh[2] > 1 and bbox_xywh[3] > 1")
    joined = texts.join(images, "image_id").withColumns({"box": G.polygon_box(F.col("polygon")), "_b": G.from_xywh(F.col("bbox_xywh"))})
    w, h = F.col("image_width"), F.col("image_height")
    return joined.select("image_id", "node_id", "image_width", "image_height", "file_name", "text", N.plain_answer(F.col("text")).alias("text_normalized"), "polygon", "box", "bbox_xywh", G.region(Box.of("_b"), w, h).alias("region_key"), G.resolvability("box", w, h)["passes"].alias("resolvable"))


def region_tuples(texts: DataFrame) -> DataFrame:
    """At most one tuple an image: of the texts alone in their region the one with the greatest score,
    then the greatest area. texts as of annotated_texts."""
    from pyspark.sql import Window

    area = F.element_at("bbox_xywh", 3) * F.element_at("bbox_xywh", 4) / (F.col("image_width").cast("double") * F.col("image_height"))
    rows = texts.withColumn("area_fraction", area).withColumn("score", B.size_score(F.col("area_fraction"), F.col("text")))
    region, image = Window.partitionBy("image_id", "region_key"), Window.partitionBy("image_id")
    rows = rows.withColumns({"_alone": F.count(F.lit(1)).over(region) == 1, "valid_text_count": F.count(F.lit(1)).over(image)})
    best = image.orderBy(F.desc("score"), F.desc("area_fraction"), "node_id")
    top = rows.where("_alone").withColumn("_n", F.row_number().over(best)).where("_n = 1")
    phrase = F.element_at(N.literal_map(REGION_PHRASES), F.col("region_key"))
    return top.select("image_id", F.col("node_id").alias("ann_id"), F.col("text").alias("answer"), F.col("text_normalized").alias("answer_normalized"), "region_key", phrase.alias("anchor_label"), F.lit("in").alias("relation"), "valid_text_count", "area_fraction", "score", B.density(F.col("valid_text_count")).alias("density_bucket"), B.area(F.col("area_fraction")).alias("area_bucket"))


def image_files(spark: SparkSession, path: str, pattern: str = "*", source: str = "") -> DataFrame:
    """(image_id, image_path, dataset_source): the files below a path, without reading their content;
    the id is the name without its ending."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select(F.regexp_extract("path", r"([^/]*?)(\.[^./]*)?$", 1).alias("image_id"), F.col("path").alias("image_path"), F.lit(source).alias("dataset_source"))


def numbered_id(image_id: F.Column) -> F.Column:
    """The number after the last underscore of an id, null if there is none."""
    return F.try_to_number(F.element_at(F.split(image_id, "_"), -1), F.lit("999999999999999999")).cast("long")


def excluded_images(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(image_id, dataset_source, origin, table_no): the images of manifests of any of three shapes -
    items, image_ids, or image_ids_path - the first manifest that names an image wins."""
    found = []
    for path in paths:
        doc = json_document(spark, path) or {}
        if doc.get("image_ids_path"):
            rows = json_lines(spark, doc["image_ids_path"], SCHEMAS["excluded"], "error").select("image_id", "dataset_source")
        else:
            items = doc.get("items") or [{"image_id": i} for i in doc.get("image_ids") or []]
            rows = spark.createDataFrame([(str(i["image_id"]), i.get("dataset_source")) for i in items], "image_id string, dataset_source string")
        found.append(rows.withColumn("origin", F.lit(path)))
    if not found:
        return spark.createDataFrame([], SCHEMAS["excluded"] + ", table_no int")
    return first_wins(found, "image_id", [F.asc_nulls_last("dataset_source")])


def union_all(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
