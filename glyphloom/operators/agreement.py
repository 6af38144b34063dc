"""Agreement between models, accuracy of their predictions, and what they read without the image.

A sample has one prediction of each model; they are gathered into an array (bounded by the number
of models) and compared within it, so no self-join of the predictions is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphloom.functions import scoring as S
from glyphloom.operators.tables import rates


def _model() -> Column:
    return F.concat(F.col("provider"), F.lit(":"), F.col("model"))


def by_sample(predictions: DataFrame, value: str = "prediction_norm") -> DataFrame:
    """(sample_id, question_type, difficulty, ambiguity_level, said, unanimous): samples that at least
    two models answered without an error. said: array of structs model, value, by model."""
    ok = predictions.where("sample_id is not null and coalesce(error_type, '') = ''")
    said = F.array_sort(F.collect_list(F.struct(_model().alias("model"), F.coalesce(F.col(value).cast("string"), F.lit("")).alias("value"))))
    grouped = ok.groupBy("sample_id").agg(*(F.min(c).alias(c) for c in ("question_type", "difficulty", "ambiguity_level")), said.alias("said"))
    values = F.array_distinct(F.transform("said", lambda s: s["value"]))
    return grouped.where(F.size("said") >= 2).withColumn("unanimous", F.size(values) == 1)


def pairwise(samples: DataFrame) -> DataFrame:
    """(model_a, model_b, matches, total, agreement_rate): of every two models, by name."""
    later = lambda a, i: F.transform(F.filter("said", lambda _, j: j > i), lambda b: F.struct(a["model"].alias("model_a"), b["model"].alias("model_b"), (a["value"] == b["value"]).alias("same")))
    pairs = samples.select(F.inline(F.flatten(F.transform("said", later))))
    n = F.count(F.lit(1))
    return pairs.groupBy("model_a", "model_b").agg(F.count(F.when(F.col("same"), 1)).alias("matches"), n.alias("total"), (F.count(F.when(F.col("same"), 1)) / n).alias("agreement_rate"))


def by_group(samples: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(question_type, difficulty, rows, unanimous_rate): by both, by type, and over all (null)."""
    return rates(samples, by or ["question_type", "difficulty"], {"unanimous_rate": F.col("unanimous")})


def with_scores(predictions: DataFrame, inline: bool = False) -> DataFrame:
    """Predictions (gold, prediction, question_type, answer_type) with their correctness."""
    s = S.scored(F.col("gold"), F.col("prediction"), F.col("question_type"), F.col("answer_type"), inline)
    return predictions.select("*", s.alias("_s")).select(*predictions.columns, "_s.*")


def benchmark(scored: DataFrame) -> DataFrame:
    """(model, question_type, rows, exact_rate, partial_rate, semantic_rate, soft_rate): by model and
    type, by model, and over all."""
    flags = {f"{k}_rate": F.col(f"{k}_correct") for k in ("exact", "partial", "semantic", "soft")}
    return rates(scored.withColumn("model", _model()), ["model", "question_type"], flags)


def ambiguity_rates(replies: DataFrame) -> DataFrame:
    """(model, question_type, rows, ambiguous_rate, parse_rate)."""
    return rates(replies.withColumn("model", _model()), ["model", "question_type"], {"ambiguous_rate": F.col("ambiguous"), "parse_rate": F.col("parse_ok")})


def image_dependence(seen: DataFrame, blind: DataFrame) -> DataFrame:
    """(question_type, rows, seen_rate, blind_rate, text_leaky_rate): accuracy with and without the
    image of samples scored both ways; leaky are those right without it."""
    both = seen.select("sample_id", "question_type", F.col("soft_correct").alias("seen")).join(blind.select("sample_id", F.col("soft_correct").alias("blind")), "sample_id")
    return rates(both, ["question_type"], {"seen_rate": F.col("seen"), "blind_rate": F.col("blind"), "text_leaky_rate": F.col("blind")})


def gate(rows: DataFrame, verdicts: DataFrame, key: str = "sample_id", wrong: str = "leaky") -> DataFrame:
    """Rows but those with a verdict against them; rows without one, or whose check failed, stay."""
    return rows.join(verdicts.where(F.col(wrong)).select(key), key, "left_anti")


def evals_index(predictions: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """(sample_id, evals): the predictions of each sample as an array by model; those of the same
    sample and model in index are replaced, failed ones change nothing."""
    names = ["sample_id", "model", "prediction_norm", "soft_correct"]
    new = predictions.where("coalesce(error_type, '') = ''").withColumn("model", _model()).select(*names)
    if index is not None:
        old = index.select("sample_id", F.inline("evals"))
        new = old.join(new.select("sample_id", "model"), ["sample_id", "model"], "left_anti").unionByName(new)
    return new.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct(*names[1:]))).alias("evals"))


def probe_plurality(probes: DataFrame) -> DataFrame:
    """(sample_id, distinct_count, plurality_answer, plurality_count, ambiguous) of repeated answers
    (sample_id, answer); ties by the greater answer."""
    n = probes.where("answer <> ''").groupBy("sample_id", "answer").agg(F.count(F.lit(1)).alias("n"))
    top = F.max(F.struct("n", "answer"))
    return n.groupBy("sample_id").agg(F.count(F.lit(1)).alias("distinct_count"), top.alias("t")).select("sample_id", "distinct_count", F.col("t.answer").alias("plurality_answer"), F.col("t.n").alias("plurality_count"), (F.col("distinct_count") >= 2).alias("ambiguous"))


def pointing_rows(samples: DataFrame, cells: int = 196) -> DataFrame:
    """Samples as rows of a training index: the box with its sides, and an empty soft target."""
    from glyphloom.functions.geometry import Box, from_xywh

    b = Box.of("_b")
    boxed = samples.withColumn("_b", from_xywh(F.coalesce("grounding.text_bbox", "text_bbox")))
    return boxed.select("sample_id", "image_id", "image_path", "image_width", "image_height", "question", "answer", F.array(b.x1, b.y1, b.x2, b.y2).alias("bbox_xyxy"), F.array_repeat(F.lit(0.0), cells).alias("soft_target"))
