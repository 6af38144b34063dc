"""Which images lack questions most: a deficit score for each, and the first of them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphloom.functions.labels import PLAIN_ANCHORS
from glyphloom.functions.normalize import strip
from glyphloom.operators.quality import entropy


@dataclass(frozen=True)
class Deficit:
    """Targets and weights (fixed values)."""

    types: int = 4
    answer_entropy: float = 1.25
    labels: float = 2.0
    empty: float = 4.0
    per_type: float = 2.0
    missing: tuple[tuple[str, float], ...] = (("ANCHOR_PROPERTY", 2.5), ("REVERSE_GROUND", 0.7), ("YES_NO", 0.5), ("TEXT_PROPERTY", 0.7))
    low_entropy: float = 0.6
    few_labels: float = 0.4
    generic: float = 0.6
    images: int = 48


def image_scores(rows: DataFrame, tuples: DataFrame, d: Deficit = Deficit()) -> DataFrame:
    """One row for every image of either table. rows: image_id, question_type, answer; tuples:
    image_id, anchor_label. Both are combined before the shuffle; a null image is left out."""
    asked = rows.where("image_id is not null")
    kinds = [n for n, _ in d.missing]
    types = asked.groupBy("image_id", "question_type").agg(F.count(F.lit(1)).alias("n"))
    by_type = types.groupBy("image_id").agg(F.sum("n").alias("final_rows"), F.count(F.when(F.coalesce("question_type", F.lit("")) != "", 1)).alias("final_type_count"), *(F.max((F.col("question_type") == k).cast("int")).alias(f"has_{k}") for k in kinds))
    answers = asked.where("answer is not null and answer <> ''").groupBy("image_id", F.lower(strip(F.col("answer"))).alias("a")).agg(F.count(F.lit(1)).alias("n"))
    spread = entropy(answers, "n", ["image_id"])
    label = F.lower(strip(F.col("anchor_label")))
    named = tuples.where("image_id is not null").groupBy("image_id", label.alias("label")).agg(F.count(F.lit(1)).alias("n"))
    filled = F.col("label") != ""
    labels = named.groupBy("image_id").agg(F.count(F.when(filled, 1)).alias("unique_anchor_labels"), F.sum(F.when(filled, F.col("n")).otherwise(0)).alias("labels"), F.sum(F.when(F.col("label").isin(*PLAIN_ANCHORS), F.col("n")).otherwise(0)).alias("plain"))
    both = by_type.join(spread, "image_id", "left").join(labels, "image_id", "full")
    zero = lambda c: F.coalesce(c, F.lit(0))
    missing = [zero(f"has_{k}") == 0 for k in kinds]
    generic = F.when(zero("labels") > 0, F.col("plain") / F.col("labels")).otherwise(1.0)
    h = F.coalesce("entropy", F.lit(0.0))
    score = F.when(zero("final_rows") == 0, d.empty).otherwise(0.0) + d.per_type * F.greatest(d.types - zero("final_type_count"), F.lit(0))
    score = reduce(lambda a, b: a + b, (F.when(m, w).otherwise(0.0) for m, (_, w) in zip(missing, d.missing)), score)
    score = score + d.low_entropy * F.greatest(d.answer_entropy - h, F.lit(0.0)) + d.few_labels * F.greatest(d.labels - zero("unique_anchor_labels"), F.lit(0.0)) + d.generic * generic
    gaps = F.filter(F.array(*(F.when(m, F.lit(k)) for m, k in zip(missing, kinds))), lambda x: x.isNotNull())
    return both.select("image_id", F.bround(score, 6).alias("score"), zero("final_rows").alias("final_rows"), zero("final_type_count").alias("final_type_count"), F.bround(h, 6).alias("answer_entropy"), zero("unique_anchor_labels").alias("unique_anchor_labels"), F.bround(generic, 6).alias("generic_anchor_ratio"), gaps.alias("missing_types"))


def select_images(scores: DataFrame, d: Deficit = Deficit()) -> DataFrame:
    """The images to rescue: with the greatest scores above 0, ties by fewer types, fewer rows, lower
    entropy and the smaller id. A top-k, not a sort."""
    order = [F.desc("score"), "final_type_count", "final_rows", "answer_entropy", "image_id"]
    return scores.where("score > 0").orderBy(*order).limit(d.images)


def summarize(scores: DataFrame) -> DataFrame:
    """(measure, value): means over the images and how many lack each type."""
    means = scores.agg(*(F.bround(F.avg(c), 6).alias(c) for c in ("score", "final_rows", "final_type_count", "answer_entropy", "unique_anchor_labels")))
    flat = means.select(F.inline(F.array(*(F.struct(F.lit(f"mean_{c}").alias("measure"), F.col(c).cast("double").alias("value")) for c in means.columns))))
    lacking = scores.select(F.explode("missing_types").alias("t")).groupBy("t").agg(F.count(F.lit(1)).cast("double").alias("value"))
    return flat.unionByName(lacking.select(F.concat(F.lit("missing_"), "t").alias("measure"), "value"))
