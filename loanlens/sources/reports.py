"""Report sinks: JSON lines and CSV with header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def as_json(df: DataFrame, name: str = "json") -> DataFrame:
    """Each row as one JSON document, null fields kept."""
    document = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(document.alias(name))
