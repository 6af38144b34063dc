"""The boundary to models and services: whatever they say enters as a table of declared schema.

A backend is any object with ``table(spark, name)``. Stored reads precomputed parquet; another may run
a model in mapInPandas and return the DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphloom.sources.readers import SCHEMAS


class Backend(Protocol):
    def table(self, spark: SparkSession, name: str) -> DataFrame: ...


@dataclass(frozen=True)
class Stored:
    """Outputs that were computed before, one parquet folder each."""

    folder: str

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return conform(spark.read.parquet(f"{self.folder}/{name}.parquet"), SCHEMAS[name])


@dataclass(frozen=True)
class Given:
    """Outputs at hand as DataFrames."""

    tables: dict[str, DataFrame]

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return conform(self.tables[name], SCHEMAS[name])


def conform(df: DataFrame, schema: str) -> DataFrame:
    """df with exactly the schema's columns: others dropped, missing ones null, types cast."""
    fields = T.StructType.fromDDL(schema).fields
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))
