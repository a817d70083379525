"""Loan-level target from performance events, and the union of years."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.functions import scalars as S
from loanlens.operators.project import force_text
from loanlens.roles import LOAN_ROLES, RoleMap


def ever_default(performance: DataFrame, roles: RoleMap = LOAN_ROLES) -> DataFrame:
    """One row per loan: 1 when any event code is a default code.

    Codes are compared as integers, so ``'09'``, ``' 9 '`` and ``9.0`` are the same code.
    The boolean is combined on the map side, so a loan with very many events costs one row
    per task in the shuffle.
    """
    code = S.to_number(F.col(roles.event_code))
    hit = F.coalesce(F.bool_or(code.isin(*roles.default_codes)), F.lit(False))
    return (
        performance.filter(F.col(roles.loan_id).isNotNull())
        .groupBy(roles.loan_id)
        .agg(hit.cast("int").alias(roles.target))
    )


def join_target(
    origination: DataFrame, target: DataFrame, how: str = "inner", roles: RoleMap = LOAN_ROLES
) -> DataFrame:
    """``inner`` keeps labelled loans; ``left_zero`` keeps all, unlabelled ones as 0."""
    if how not in ("inner", "left_zero"):
        raise ValueError(f"how must be inner or left_zero, not {how}")
    labels = target.select(roles.loan_id, F.col(roles.target).cast("int").alias(roles.target))
    joined = origination.join(labels, roles.loan_id, "inner" if how == "inner" else "left")
    return joined.withColumn(roles.target, F.coalesce(roles.target, F.lit(0)))


def unlabelled(origination: DataFrame, target: DataFrame, roles: RoleMap = LOAN_ROLES):
    """Loans without a target row."""
    return origination.join(target, roles.loan_id, "left_anti")


def union_years(
    by_year: Mapping[int, DataFrame],
    tagged: Iterable[DataFrame] = (),
    roles: RoleMap = LOAN_ROLES,
) -> DataFrame:
    """Stack one table per year plus tables that already carry their year.

    Columns are matched by name, absent ones are null, and code columns whose type differs
    between sources become text before they meet.
    """
    frames = [
        df if roles.year in df.columns else df.withColumn(roles.year, F.lit(int(year)))
        for year, df in by_year.items()
    ]
    frames = [force_text(df, roles.mixed_text) for df in (*frames, *tagged)]
    result = frames[0]
    for df in frames[1:]:
        result = result.unionByName(df, allowMissingColumns=True)
    return result
