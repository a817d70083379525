"""Projections and predicates."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.functions import scalars as S
from loanlens.roles import LOAN_ROLES, RoleMap


def normalise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def sanitise_names(df: DataFrame) -> DataFrame:
    """Lower-case names with underscores; two columns must not end up with one name."""
    names = [re.sub(r"[ -]", "_", c.strip().lower()) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide after sanitising: {clashes}")
    return df.toDF(*names)


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [c for c in names if c in df.columns]


def drop_leaky(df: DataFrame, roles: RoleMap = LOAN_ROLES) -> tuple[DataFrame, list[str]]:
    """Remove performance columns that would leak the outcome; report which were found."""
    found = present(df, roles.leaky)
    return df.drop(*found), found


def drop_listed(df: DataFrame, roles: RoleMap = LOAN_ROLES) -> tuple[DataFrame, list[str]]:
    found = present(df, roles.dropped)
    return df.drop(*found), found


def drop_unused(df: DataFrame, roles: RoleMap = LOAN_ROLES) -> DataFrame:
    """Remove columns that are never features; the id stays as the row key."""
    return df.drop(*present(df, roles.not_features))


def coerce_numbers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: S.to_number(F.col(c)) for c in present(df, columns)})


def null_sentinels(df: DataFrame, sentinels: Mapping[str, Iterable]) -> DataFrame:
    return df.withColumns(
        {c: S.null_if_in(F.col(c), sentinels[c]) for c in present(df, sentinels)}
    )


def coerce_integers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: S.to_integer(F.col(c)) for c in present(df, columns)})


def parse_months(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: S.to_month(F.col(c)) for c in present(df, columns)})


def normalise_categories(df: DataFrame, roles: RoleMap = LOAN_ROLES) -> DataFrame:
    return df.withColumns(
        {
            c: S.category(F.col(c), roles.category_sentinels.get(c, ()), roles.unknown)
            for c in present(df, roles.categorical)
        }
    )


def target_flag(c: Column) -> Column:
    """Target as 0/1, a missing or unreadable target being 0."""
    return F.coalesce(S.to_number(c).cast("int"), F.lit(0))


def force_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in present(df, columns)})


def align_source(
    df: DataFrame, expected: Iterable[str], helpers: Sequence[str] = ("source",)
) -> DataFrame:
    """Add columns an extra source lacks as null and remove its helper columns."""
    missing = {c: F.lit(None).cast("string") for c in expected if c not in df.columns}
    return df.withColumns(missing).drop(*present(df, helpers))


def split_by_year(
    df: DataFrame, train_until: int, test_from: int, year: str = "year"
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by year; both are filters that reach a partitioned scan."""
    train = df.filter(F.col(year) <= train_until).drop(year)
    test = df.filter(F.col(year) >= test_from).drop(year)
    return train, test


def year_slice(df: DataFrame, years: Sequence[int], year: str = "year") -> DataFrame:
    return df.filter(F.col(year).isin(list(years)))


def align_features(
    df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """The listed features in order, absent ones as 0.0; returns the filled names too."""
    filled = [c for c in features if c not in df.columns]
    columns = [F.lit(0.0).alias(c) if c in filled else F.col(c) for c in features]
    return df.select(*present(df, keep), *columns), filled


def numeric_only(df: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Numeric and boolean columns; returns the names of the others too."""
    usable = (T.NumericType, T.BooleanType)
    dropped = [
        f.name for f in df.schema if f.name not in keep and not isinstance(f.dataType, usable)
    ]
    return df.drop(*dropped), dropped


def sanitise_numbers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Finite doubles only, everything else 0.0."""
    kinds = {f.name: f.dataType for f in df.schema}
    exprs = {}
    for c in present(df, columns):
        value = F.col(c).cast("int") if isinstance(kinds[c], T.BooleanType) else F.col(c)
        exprs[c] = S.finite_or_zero(value)
    return df.withColumns(exprs)


def range_violations(
    df: DataFrame, ranges: Mapping[str, tuple[float, float]], loan_id: str
) -> DataFrame:
    """(id, column, value) of every non-null value outside its range, in one pass."""
    checks = [
        F.struct(
            F.lit(c).alias("column"),
            F.when(~F.col(c).between(lo, hi), F.col(c).cast("double")).alias("value"),
        )
        for c, (lo, hi) in ranges.items()
        if c in df.columns
    ]
    return (
        df.select(loan_id, F.explode(F.array(*checks)).alias("v"))
        .filter(F.col("v.value").isNotNull())
        .select(loan_id, "v.column", "v.value")
    )


def badly_formatted(c: Column, pattern: str) -> Column:
    """True when the text does not match; null never matches."""
    return ~F.coalesce(c.cast("string").rlike(pattern), F.lit(False))


def flag_at(df: DataFrame, threshold: float, score: str = "probability_default") -> DataFrame:
    return df.withColumn("prediction", (F.col(score) >= F.lit(float(threshold))).cast("int"))


def flag_correct(
    df: DataFrame, prediction: str = "prediction", actual: str = "actual_default"
) -> DataFrame:
    return df.withColumn(
        "is_correct", F.col(prediction).cast("int") == F.col(actual).cast("int")
    )
