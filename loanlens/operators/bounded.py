"""Joining a side whose size is checked first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 10_000
SALTS = 64


def bounded_rows(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> list | None:
    """The rows when there are at most ``max_rows`` of them, otherwise None."""
    rows = df.take(max_rows + 1)
    return rows if len(rows) <= max_rows else None


def attach(
    df: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join per-group values onto rows, null keys matching null keys.

    The side is broadcast only when it is found to be small.  Beyond that it is repeated once
    per salt and joined on (keys, salt), so that one hot group is spread over many tasks.
    """
    rows = bounded_rows(side, max_rows)
    names = {k: f"_side_{k}" for k in keys}
    if rows is not None:
        small = df.sparkSession.createDataFrame(rows, side.schema).withColumnsRenamed(names)
        on = [F.col(k).eqNullSafe(F.col(names[k])) for k in keys]
        return df.join(F.broadcast(small), on, how).drop(*names.values())
    spread = side.withColumnsRenamed(names).withColumn(
        "_side_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    on = [F.col(k).eqNullSafe(F.col(names[k])) for k in keys]
    on.append(F.col("_salt") == F.col("_side_salt"))
    return salted.join(spread, on, how).drop("_salt", "_side_salt", *names.values())
