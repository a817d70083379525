"""Key-based joins around the loan id."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.operators.bounded import attach


def lookup(df: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Left join; Spark broadcasts the side by its statistics when it is small."""
    return df.join(side, key, "left")


def keep_listed(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def attach_labels(predictions: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Labels next to predictions by id, never by row position."""
    return predictions.join(labels, key, "inner")


def code_of(c: Column, codes: Mapping[str, int], unknown: str = "unknown") -> Column:
    """Value to code through a fixed map; unseen values get the code of ``unknown``."""
    pairs = [F.lit(x) for item in codes.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), F.lit(codes[unknown]))


def lookup_with_default(
    df: DataFrame, codes: DataFrame, key: str, value: str, default_key: str
) -> DataFrame:
    """Table form of ``code_of`` for maps that live in a table (key -> value)."""
    fallback = codes.filter(F.col(key) == default_key).agg(F.max(value))
    joined = attach(df, codes.select(key, value), [key], "left")
    return joined.withColumn(value, F.coalesce(F.col(value), fallback.scalar()))


def pair_with_background(
    rows: DataFrame, background: DataFrame, slots: int, size: int, names: Sequence[str]
) -> DataFrame:
    """Each row once per slot, with the background row of that slot.

    ``background`` carries ``slot`` 0..size-1 and slot s of a row meets background row
    ``s % size``: an equality join whose output is rows x slots, both set by parameters.
    """
    side = background.select(
        F.col("slot").alias("_slot"), *[F.col(c).alias(f"base_{c}") for c in names]
    )
    expanded = rows.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    return (
        expanded.withColumn("_slot", F.col("slot") % size)
        .join(side, "_slot", "inner")
        .drop("_slot")
    )


def shared_ids(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Ids on both sides; empty when a split is disjoint."""
    return left.select(key).join(right.select(key), key, "left_semi")
