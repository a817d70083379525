"""Counting operators: missing values, value counts, domains, dates, histograms, rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions import scalars as S
from loanlens.operators.prefix import exact_medians
from loanlens.operators.project import badly_formatted, present
from loanlens.roles import LOAN_ROLES, RoleMap


def tall(row: DataFrame, key: str = "column", value: str = "value") -> DataFrame:
    """A one-row aggregate as (key, value) rows."""
    return row.unpivot([], row.columns, key, value)


def split_summary(df: DataFrame, split: str = "split", target: str = "default") -> DataFrame:
    return df.groupBy(split).agg(
        F.count("*").alias("n_rows"), F.avg(F.col(target).cast("double")).alias("default_rate")
    )


def tag_splits(df: DataFrame, train_until: int, test_from: int, year: str = "year") -> DataFrame:
    """Rows marked train or test by year; years in neither are left out."""
    split = F.when(F.col(year) <= train_until, "train").when(F.col(year) >= test_from, "test")
    return df.withColumn("split", split).filter(F.col("split").isNotNull())


def missing(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """Missing count and percentage per column, one pass over the table."""
    counted = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    result = counted.unpivot("_rows", df.columns, "column", "missing_count").select(
        "column",
        "missing_count",
        F.round(S.ratio(F.col("missing_count") * 100, F.col("_rows")), 3).alias("missing_pct"),
    )
    return result.filter("missing_count > 0") if only_missing else result


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Counts and percentages per value, null being a value; optionally the top values."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*")).scalar()
    result = counts.withColumn("pct", F.round(S.ratio(F.col("n") * 100, total), 3))
    return result.orderBy(F.desc("n"), F.asc_nulls_first(column)).limit(top) if top else result


def value_counts_all(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts per (column, value) for several columns in one grouped pass."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return text.unpivot([], list(columns), "column", "value").groupBy("column", "value").agg(
        F.count("*").alias("n")
    )


def sentinel_summary(
    df: DataFrame, sentinels: Mapping[str, Sequence[str]] = LOAN_ROLES.summary_sentinels
) -> DataFrame:
    """Count and percentage per (column, sentinel) that occurs, one pass."""
    pairs = [(c, v) for c in present(df, sentinels) for v in sentinels[c]]
    counted = df.agg(
        F.count("*").alias("_rows"),
        *[
            F.count_if(F.trim(F.col(c).cast("string")) == v).alias(f"{c}|{v}")
            for c, v in pairs
        ],
    )
    parts = F.split("pair", "[|]")
    return (
        counted.unpivot("_rows", [f"{c}|{v}" for c, v in pairs], "pair", "n")
        .filter("n > 0")
        .select(
            parts[0].alias("column"),
            parts[1].alias("sentinel_value"),
            "n",
            F.round(S.ratio(F.col("n") * 100, F.col("_rows")), 3).alias("rate_pct"),
        )
    )


def parse_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of month columns that do not parse, nulls included."""
    checks = [F.count_if(S.to_month(F.col(c)).isNull()).alias(c) for c in columns]
    return tall(df.agg(*checks), "column", "parse_failed_count")


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first per key, null being a key."""
    per_key = df.groupBy(key).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_count"),
    )


def format_counts(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    checks = [F.count_if(badly_formatted(F.col(c), p)).alias(c) for c, p in patterns.items()]
    return tall(df.agg(*checks), "column", "invalid_count")


def range_check_columns(df: DataFrame, roles: RoleMap = LOAN_ROLES) -> dict[str, Column]:
    """Aggregates that are true when every non-null value is in range."""
    ok = {c: F.col(c).between(*roles.ranges[c]) for c in present(df, roles.ranges)}
    ok |= {c: F.col(c).isin(*roles.value_sets[c]) for c in present(df, roles.value_sets)}
    return {f"{c}_valid": F.coalesce(F.bool_and(v), F.lit(True)) for c, v in ok.items()}


def range_checks(df: DataFrame, roles: RoleMap = LOAN_ROLES) -> DataFrame:
    checks = range_check_columns(df, roles)
    return tall(df.agg(*[v.alias(k) for k, v in checks.items()]), "check", "valid")


def domain_values(df: DataFrame, roles: RoleMap = LOAN_ROLES) -> DataFrame:
    """Every observed category with its count and whether it is allowed."""
    columns = present(df, roles.allowed)
    clean = df.select(*[S.category(F.col(c)).alias(c) for c in columns])
    allowed = F.lit(False)
    for c in columns:
        allowed = allowed | ((F.col("column") == c) & F.col("value").isin(*roles.allowed[c]))
    counts = value_counts_all(clean, columns).filter(F.col("value").isNotNull())
    return counts.withColumn("allowed", allowed)


def domain_checks(df: DataFrame, roles: RoleMap = LOAN_ROLES) -> DataFrame:
    """Observed and unexpected value counts per column; valid when nothing is unexpected."""
    return (
        domain_values(df, roles)
        .groupBy("column")
        .agg(
            F.count("*").alias("n_observed"),
            F.count_if(~F.col("allowed")).alias("n_unexpected"),
            F.sum(F.when(~F.col("allowed"), F.col("n")).otherwise(0)).alias("unexpected_rows"),
        )
        .withColumn("valid", F.col("n_unexpected") == 0)
    )


def date_check_columns(first: str, maturity: str) -> dict[str, Column]:
    after = F.coalesce(F.col(maturity) > F.col(first), F.lit(False))
    return {
        f"{first}_min": F.min(first),
        f"{first}_max": F.max(first),
        f"{maturity}_min": F.min(maturity),
        f"{maturity}_max": F.max(maturity),
        "maturity_after_first_payment_all": F.coalesce(F.bool_and(after), F.lit(True)),
        "maturity_not_after_first_payment_count": F.count_if(~after),
    }


def date_checks(df: DataFrame, roles: RoleMap = LOAN_ROLES) -> DataFrame:
    """Range and order of the two dates; ``available`` is false when a column is missing."""
    if len(present(df, [*roles.dates, roles.term])) < 3:
        return df.sparkSession.range(1).select(F.lit(False).alias("available"))
    checks = date_check_columns(*roles.dates)
    return df.agg(F.lit(True).alias("available"), *[v.alias(k) for k, v in checks.items()])


def term_difference(df: DataFrame, roles: RoleMap = LOAN_ROLES) -> Column:
    months = S.month_difference(F.col(roles.maturity), F.col(roles.first_payment)) + 1
    return months - F.col(roles.term)


def term_difference_counts(df: DataFrame, roles: RoleMap = LOAN_ROLES) -> DataFrame:
    return (
        df.select(term_difference(df, roles).cast("bigint").alias("term_difference"))
        .filter(F.col("term_difference").isNotNull())
        .groupBy("term_difference")
        .agg(F.count("*").alias("n"))
    )


def date_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, exact median and maximum per date column.

    Days are few, so the median is read off the day counts: the distinct days of a column
    are a bounded domain however many rows there are.
    """
    days = df.select(*[F.unix_date(c).alias(c) for c in columns])
    result = []
    for c in columns:
        counts = days.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
        result.append(
            counts.agg(
                F.lit(c).alias("column"),
                F.date_from_unix_date(F.min(c)).alias("min_date"),
                F.percentile(c, 0.5, F.col("n")).alias("median_day"),
                F.date_from_unix_date(F.max(c)).alias("max_date"),
            )
        )
    frame = result[0]
    for df in result[1:]:
        frame = frame.unionByName(df)
    return frame


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    values = exact_medians(df, columns)
    return df.sparkSession.createDataFrame(list(values.items()), "column string, median double")


def rate_by_group(df: DataFrame, group: str, target: str = "default") -> DataFrame:
    return df.groupBy(group).agg(
        F.count("*").alias("n_loans"),
        F.sum(F.col(target).cast("bigint")).alias("n_default"),
        F.avg(F.col(target).cast("double")).alias("default_rate"),
    )


def rate_rollup(df: DataFrame, groups: Sequence[str], target: str = "default") -> DataFrame:
    """Rates of all groups, of their coarser groups and of the whole, in one aggregation.

    ``level`` is how many of the groups a row is about; a null group of its own has the same level
    as its neighbours, the nulls of coarser rows a smaller one.  Targets are added up as whole
    numbers, so that coarser rows are exact sums of finer ones.
    """
    finest = df.groupBy(*groups).agg(F.count("*").alias("n"), F.sum(F.col(target).cast("bigint")).alias("d"))
    rolled = finest.rollup(*groups).agg(
        F.sum("n").alias("n_loans"),
        F.sum("d").alias("n_default"),
        (F.lit(len(groups)) - sum(F.grouping(g).cast("int") for g in groups)).alias("level"),
    )
    return rolled.withColumn("default_rate", F.col("n_default").cast("double") / F.col("n_loans"))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between minimum and maximum; the maximum is in the last bin."""
    v = F.col(column)
    spread = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    lo, hi = spread.select("lo").scalar(), spread.select("hi").scalar()
    raw = F.floor(F.try_divide(v - lo, hi - lo) * bins) + 1
    number = F.least(F.coalesce(raw, F.lit(1)), F.lit(bins)).cast("int")
    return df.filter(v.isNotNull()).groupBy(number.alias("bin")).agg(F.count("*").alias("n"))


def monthly_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.trunc(column, "MM").alias("month")).agg(F.count("*").alias("n"))


def shape(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and columns before and after a step."""
    rows = before.agg(F.count("*")).scalar()
    return after.agg(F.count("*").alias("rows_after")).select(
        rows.alias("rows_before"),
        "rows_after",
        (rows - F.col("rows_after")).alias("rows_removed"),
        F.lit(len(before.columns)).alias("columns_before"),
        F.lit(len(after.columns)).alias("columns_after"),
    )
