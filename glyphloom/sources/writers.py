"""Sinks: JSON lines, single documents, Markdown notes, partitioned tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession


def json_lines(df: DataFrame, path: str, order: list[Column] | None = None) -> None:
    """One JSON object a line, null fields included. With an order the rows are sorted across the
    files of the folder; without one their order is no one's."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def document(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, such as a manifest or notes, written by the driver to any file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def json_document(spark: SparkSession, path: str, payload: Any) -> None:
    import json

    document(spark, path, json.dumps(payload, ensure_ascii=False, indent=2) + "\n")


def markdown(spark: SparkSession, path: str, title: str, facts: dict[str, Any]) -> None:
    document(spark, path, "\n".join([f"# {title}", "", *(f"- {k}: `{v}`" for k, v in facts.items())]) + "\n")


def replace_partitions(df: DataFrame, path: str, by: str) -> None:
    """Parquet by partition; only the partitions that df has are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
