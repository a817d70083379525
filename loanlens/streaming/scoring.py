"""Scoring of rows as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from loanlens.operators.features import Transformers
from loanlens.operators.scoring import score_rows
from loanlens.roles import LOAN_ROLES, RoleMap


def score_stream(
    arrivals: DataFrame,
    model,
    transformers: Transformers,
    path: str,
    checkpoint: str,
    threshold: float | None = None,
    roles: RoleMap = LOAN_ROLES,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append predictions of a stream of raw rows to a parquet table.

    The scoring plan keeps no state, so there is nothing to bound with a watermark; the
    checkpoint makes the file sink exactly-once across restarts.
    """
    scored = score_rows(arrivals, model, transformers, threshold, roles)
    return (
        scored.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
