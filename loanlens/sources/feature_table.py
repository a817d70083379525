"""Keyed, versioned feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.operators.project import sanitise_names
from loanlens.roles import LOAN_ROLES


def table_path(root: str, name: str, version: int) -> str:
    return f"{root.rstrip('/')}/{name}/version={int(version)}"


def write_feature_table(
    features: DataFrame,
    root: str,
    name: str,
    version: int,
    key: str = LOAN_ROLES.loan_id,
) -> dict:
    """Write one version of the table and return its name, version and counts.

    The key must be present, non-null and unique; the pass that checks it also counts the rows.
    """
    table = sanitise_names(features)
    if key not in table.columns:
        raise ValueError(f"'{key}' must exist: it is the primary key")
    path = table_path(root, name, version)
    per_key = table.groupBy(key).agg(F.count("*").alias("n"))
    repeated = F.col(key).isNull() | (F.col("n") > 1)
    found = per_key.agg(F.sum("n").alias("rows"), F.count_if(repeated).alias("bad")).first()
    if found["bad"]:
        raise ValueError(f"'{key}' must be non-null and unique: {found['bad']} values are not")
    # a version that is there already is kept: writing it again fails
    table.write.mode("errorifexists").parquet(path)
    return {
        "feature_group": name,
        "version": int(version),
        "n_rows": int(found["rows"] or 0),
        "n_features": len(table.columns),
    }


def read_feature_table(spark: SparkSession, root: str, name: str, version: int) -> DataFrame:
    return spark.read.parquet(table_path(root, name, version))
