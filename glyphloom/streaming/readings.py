"""Readings as a stream: delivered again, late or out of order, counted once.

The batch operators define the results; this is the same first step - one reading a recogniser and
node - where readings arrive continuously. State is bounded by the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_deliveries(readings: DataFrame, delay: str = "2 days") -> DataFrame:
    """Each reading (image, node, recogniser, read_at) once, as it first arrives; deliveries that come
    later than ``delay`` behind the latest ingested_at may be dropped as late."""
    keys = ["image_id", "node_id", "model_name", "read_at"]
    return readings.where(" and ".join(f"{k} is not null" for k in keys)).withWatermark("ingested_at", delay).dropDuplicatesWithinWatermark(keys)


def readings_per_window(readings: DataFrame, window: str = "1 hour", delay: str = "2 days") -> DataFrame:
    """(start, model_name, readings, mean_confidence) of the windows that the watermark has closed."""
    c = F.when(F.col("confidence") > 1, F.col("confidence") / 100).otherwise(F.col("confidence"))
    counted = readings.withWatermark("ingested_at", delay).groupBy(F.window("ingested_at", window).alias("w"), "model_name").agg(F.count(F.lit(1)).alias("readings"), F.avg(c).alias("mean_confidence"))
    return counted.select(F.col("w.start").alias("start"), "model_name", "readings", "mean_confidence")
