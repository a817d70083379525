"""Expectation suite: one aggregate pass, one row per check, and a severity gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions import scalars as S
from loanlens.roles import LOAN_ROLES, RoleMap

SCHEMA = (
    "check string, column string, success boolean, observed double, "
    "unexpected_count bigint, critical boolean"
)


@dataclass(frozen=True)
class Bounds:
    """Limits of the suite.  Fixed values: the defaults are those of the all-years table."""

    columns: int = 34
    rows: tuple[int, int] = (600_000, 900_000)
    years: tuple[int, int] = (2000, 2008)
    credit_score: tuple[int, int] = (300, 850)
    credit_score_sentinel: int = 9999
    original_ltv: tuple[float, float] = (6, 999)
    interest_rate_above: float = 0
    interest_rate_to: float = 30
    msa_present: float = 0.80


def quality_checks(
    df: DataFrame, bounds: Bounds = Bounds(), roles: RoleMap = LOAN_ROLES
) -> DataFrame:
    """(check, column, success, observed, unexpected_count, critical), one row per check.

    A check on an absent column fails instead of stopping the run.  Values that do not parse
    as numbers are unexpected; nulls are ignored except by the null-rate check.
    """
    required = [roles.loan_id, roles.target, roles.year]
    have = set(df.columns)
    rows: list[tuple] = []
    unexpected: dict[str, tuple[str, str, Column, bool]] = {}

    n_cols = len(df.columns)
    rows.append(("column_count", "", n_cols == bounds.columns, float(n_cols), 0, True))
    for c in required:
        rows.append(("column_exists", c, c in have, float(c in have), 0, True))

    def per_value(check: str, column: str, good: Column, critical: bool) -> None:
        if column not in have:
            rows.append((check, column, False, None, None, critical))
            return
        raw = F.col(column)
        bad = raw.isNotNull() & ~F.coalesce(good, F.lit(False))
        unexpected[f"u{len(unexpected)}"] = (check, column, bad, critical)

    parsed = [
        c
        for c in (
            roles.target,
            roles.year,
            "credit_score",
            "original_ltv",
            "original_cltv",
            "original_interest_rate",
            *roles.dates,
        )
        if c in have
    ]

    def num(c: str) -> Column:
        return F.col(f"_n_{c}")

    low, high = bounds.credit_score
    score = num("credit_score")
    per_value("in_set", roles.target, num(roles.target).isin(0, 1), True)
    per_value("between", roles.year, num(roles.year).between(*bounds.years), False)
    in_scores = score.between(low, high) & (score == F.floor(score))
    per_value("in_set", "credit_score", in_scores | (score == bounds.credit_score_sentinel), True)
    per_value("between", "original_ltv", num("original_ltv").between(*bounds.original_ltv), False)
    rate = num("original_interest_rate")
    in_rate = (rate > bounds.interest_rate_above) & (rate <= bounds.interest_rate_to)
    per_value("between", "original_interest_rate", in_rate, False)

    for a, b, or_equal in (
        (roles.maturity, roles.first_payment, False),
        ("original_cltv", "original_ltv", True),
    ):
        name = f"{a}>{'=' if or_equal else ''}{b}"
        if a not in have or b not in have:
            rows.append(("pair", name, False, None, None, False))
            continue
        x, y = num(a), num(b)
        good = (x >= y) if or_equal else (x > y)
        skip = F.col(a).isNull() & F.col(b).isNull()
        bad = ~skip & ~F.coalesce(good, F.lit(False))
        unexpected[f"u{len(unexpected)}"] = ("pair", name, bad, False)

    has_msa = "msa" in have
    if not has_msa:
        rows.append(("not_null", "msa", False, None, None, False))
    numbers = df.withColumns({f"_n_{c}": S.to_number(F.col(c)) for c in parsed})
    counted = numbers.agg(
        F.count("*").alias("_rows"),
        (F.count("msa") if has_msa else F.lit(0)).cast("bigint").alias("_msa"),
        *[F.count_if(v[2]).alias(k) for k, v in unexpected.items()],
    )
    n = F.col("_rows")
    checks = [
        _check("row_count", "", n.between(*bounds.rows), n, F.lit(0), False),
        *[
            _check(check, column, F.col(k) == 0, n - F.col(k), F.col(k), critical)
            for k, (check, column, _, critical) in unexpected.items()
        ],
    ]
    if has_msa:
        share = S.ratio(F.col("_msa"), n, 1.0)
        ok = share >= bounds.msa_present
        checks.append(_check("not_null", "msa", ok, share, n - F.col("_msa"), False))
    result = counted.select(F.explode(F.array(*checks)).alias("c")).select("c.*")

    if roles.loan_id in have:
        per_id = df.filter(F.col(roles.loan_id).isNotNull()).groupBy(roles.loan_id).count()
        unique = per_id.agg(
            F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count"))), F.lit(0)).alias("u"),
            F.count("*").alias("d"),
        )
        row = _check("unique", roles.loan_id, F.col("u") == 0, F.col("d"), F.col("u"), True)
        result = result.unionByName(unique.select(row.alias("c")).select("c.*"))
    else:
        rows.append(("unique", roles.loan_id, False, None, None, True))
    return result.unionByName(df.sparkSession.createDataFrame(rows, SCHEMA))


def _check(check: str, column: str, success, observed, bad, critical: bool) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        success.alias("success"),
        observed.cast("double").alias("observed"),
        bad.cast("bigint").alias("unexpected_count"),
        F.lit(critical).alias("critical"),
    )


def failed_checks(checks: DataFrame, critical: bool = True) -> DataFrame:
    return checks.filter(~F.col("success") & (F.col("critical") == critical))


class FailedChecks(ValueError):
    """The critical checks, as check(column), that a table failed."""

    def __init__(self, checks: list[str]):
        super().__init__(f"the table fails critical checks: {checks}")
        self.checks = checks


def quality_gate(
    df: DataFrame,
    bounds: Bounds = Bounds(),
    roles: RoleMap = LOAN_ROLES,
    warn: Sequence | list | None = None,
) -> DataFrame:
    """The table unchanged, or an error naming the failed critical checks.

    Failed checks that are not critical are appended to ``warn`` when it is given.
    """
    failed = quality_checks(df, bounds, roles).filter(~F.col("success")).collect()
    if warn is not None:
        warn.extend((r["check"], r["column"]) for r in failed if not r["critical"])
    critical = [f"{r['check']}({r['column']})" for r in failed if r["critical"]]
    if critical:
        raise FailedChecks(sorted(critical))
    return df
