"""Append-only run log: parameters and metrics of parent and child runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "experiment string, run_id string, parent_run_id string, kind string, key string, "
    "text_value string, number_value double"
)


def run_rows(
    experiment: str,
    run_id: str,
    params: Mapping | None = None,
    metrics: Mapping | None = None,
    parent_run_id: str | None = None,
) -> list[tuple]:
    """Log rows of one run; metrics that are not numbers are left out."""
    head = (experiment, run_id, parent_run_id)
    rows = [(*head, "param", k, None if v is None else str(v), None) for k, v in (params or {}).items()]
    for k, v in (metrics or {}).items():
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            rows.append((*head, "metric", k, None, float(v)))
    return rows


def append_runs(spark: SparkSession, path: str, rows: Sequence[tuple]) -> None:
    append_log(spark.createDataFrame(list(rows), SCHEMA), path)


def append_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def search_runs(
    log: DataFrame, experiment: str, metrics: Sequence[str] = (), params: Sequence[str] = ()
) -> DataFrame:
    """One row per run of an experiment with the chosen metrics and parameters as columns."""
    wanted = [*metrics, *params]
    numbers = (
        log.filter((F.col("experiment") == experiment) & F.col("key").isin(wanted))
        .groupBy("run_id")
        .agg(
            F.max("parent_run_id").alias("parent_run_id"),
            *[
                F.max(F.when((F.col("kind") == "metric") & (F.col("key") == m), F.col("number_value"))).alias(m)
                for m in metrics
            ],
            *[
                F.max(F.when((F.col("kind") == "param") & (F.col("key") == p), F.col("text_value"))).alias(p)
                for p in params
            ],
        )
    )
    return numbers
