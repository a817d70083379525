"""Cleaning of origination rows: one projection for the data, three passes for the statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions import scalars as S
from loanlens.operators import profile
from loanlens.operators.project import (
    badly_formatted,
    drop_leaky,
    drop_listed,
    normalise_names,
    present,
)
from loanlens.roles import LOAN_ROLES, RoleMap


def clean(df: DataFrame, roles: RoleMap = LOAN_ROLES) -> DataFrame:
    """Typed, normalised rows.  No row is removed; the target may be absent.

    Two projections, parse then settle: a parsed value is used more than once when it is
    settled, and Spark keeps them apart so that it is parsed only once.
    """
    df, _ = drop_leaky(normalise_names(df), roles)
    df, _ = drop_listed(df, roles)
    parsed = df.select(*[_parse(c, roles).alias(c) for c in df.columns])
    return parsed.select(*[_settle(c, roles).alias(c) for c in df.columns])


def _parse(name: str, roles: RoleMap) -> Column:
    c = F.col(name)
    if name in roles.categorical:
        return S.category(c)
    if name == roles.target or (name in roles.numeric and name not in roles.integer_like):
        return S.to_number(c)
    if name in roles.dates or name in roles.integer_like:
        return S.to_integer(c)
    return c


def _settle(name: str, roles: RoleMap) -> Column:
    c = F.col(name)
    if name == roles.target:
        return F.coalesce(c.cast("int"), F.lit(0))
    if name in roles.dates:
        return S.month_start(c)
    if name in roles.category_sentinels:
        hit = c.isin(*roles.category_sentinels[name])
        return F.when(hit, F.lit(roles.unknown)).otherwise(c)
    return S.null_if_in(c, roles.numeric_sentinels.get(name, ()))


def cleaning_statistics(raw: DataFrame, roles: RoleMap = LOAN_ROLES) -> DataFrame:
    """(stat, column, key, value) rows about a raw table and its cleaned form.

    Counters are conditions: a row gives the numbers of those it meets, which are counted in one
    grouped pass.  A pass over whole columns gives ranges and dates, one grouped pass the
    distributions, one per-key count the duplicates.  Domains and histograms are rows, not
    collected sets.
    """
    raw = normalise_names(raw)
    cleaned = clean(raw, roles)
    narrow, leaky = drop_leaky(raw, roles)
    _, dropped = drop_listed(narrow, roles)
    counters: dict[tuple[str, str, str], Column] = {}
    conditions: dict[tuple[str, str, str], Column] = {}

    def n(stat: str, column: str, condition: Column) -> None:
        conditions[(stat, column, "")] = condition

    needed = present(
        narrow, [*roles.numeric_sentinels, *roles.category_sentinels, roles.target]
    )

    def src(c: str) -> Column:
        """The parsed value before sentinels are taken out."""
        return F.col(f"_raw_{c}")

    for c in present(narrow, roles.numeric_sentinels):
        n("sentinel_count", c, src(c).isin(*roles.numeric_sentinels[c]))
    for c in present(narrow, roles.dates):
        n("parse_failed_count", c, F.col(c).isNull())
    for c in present(narrow, roles.category_sentinels):
        n("unknown_count", c, src(c).isin(*roles.category_sentinels[c]))
    if "msa" in cleaned.columns:
        n("missing_count", "msa", F.col("msa").isNull())
    if roles.target in cleaned.columns:
        n("missing_count", roles.target, src(roles.target).isNull())
    for c, pattern in ((roles.loan_id, roles.id_pattern), (roles.state, roles.state_pattern)):
        if c in cleaned.columns:
            n("invalid_count", c, badly_formatted(F.col(c), pattern))
    for name, value in profile.range_check_columns(cleaned, roles).items():
        counters[("range_check", name, "")] = value.cast("int")
    if len(present(cleaned, [*roles.dates, roles.term])) == 3:
        for name, value in profile.date_check_columns(*roles.dates).items():
            counters[("date_check", name, "")] = value
    for c in cleaned.columns:
        n("missing_after_cleaning", c, F.col(c).isNull())
    counters[("rows_before", "", "")] = F.count("*")
    counters[("rows_after", "", "")] = F.count("*")
    counters[("rows_removed", "", "")] = F.lit(0)
    counters[("columns_before", "", "")] = F.lit(len(raw.columns))
    counters[("columns_after", "", "")] = F.lit(len(cleaned.columns))

    parsed = narrow.select(
        *[_parse(c, roles).alias(c) for c in cleaned.columns],
        *[_parse(c, roles).alias(f"_raw_{c}") for c in needed],
    )
    both = parsed.select(
        *[_settle(c, roles).alias(c) for c in cleaned.columns],
        *[F.col(f"_raw_{c}") for c in needed],
    )
    row = both.agg(*[v.alias(f"k{i}") for i, v in enumerate(counters.values())])
    names = ("stat", "column", "key")
    items = [
        F.struct(*[F.lit(x).alias(n) for n, x in zip(names, key, strict=True)], F.col(f"k{i}").cast("string").alias("value"))
        for i, key in enumerate(counters)
    ]
    single = row.select(F.explode(F.array(*items)).alias("s")).select("s.*")
    single = single.unionByName(_condition_counts(both, conditions))

    grouped = _distributions(cleaned, roles)
    per_key = profile.duplicate_count(cleaned, roles.loan_id).select(
        F.lit("duplicate_count").alias("stat"),
        F.lit(roles.loan_id).alias("column"),
        F.lit("").alias("key"),
        F.col("duplicate_count").cast("string").alias("value"),
    )
    lists = [("leaky_dropped", c, "", "1") for c in leaky]
    lists += [("listed_dropped", c, "", "1") for c in dropped]
    result = single.unionByName(grouped).unionByName(per_key)
    if lists:
        schema = "stat string, column string, key string, value string"
        result = result.unionByName(raw.sparkSession.createDataFrame(lists, schema))
    return result


def _condition_counts(df: DataFrame, conditions: dict[tuple[str, str, str], Column]) -> DataFrame:
    """(stat, column, key, value): the rows that meet each condition, 0 included."""
    met = F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(conditions.values())])
    hits = df.select(F.explode(F.filter(met, lambda i: i.isNotNull())).alias("i"))
    counts = hits.groupBy("i").agg(F.count("*").alias("n"))
    names = df.sparkSession.createDataFrame(
        [(i, *key) for i, key in enumerate(conditions)],
        "i int, stat string, column string, key string",
    )
    value = F.coalesce("n", F.lit(0)).cast("string").alias("value")
    return names.join(counts, "i", "left").select("stat", "column", "key", value)


def _distributions(cleaned: DataFrame, roles: RoleMap) -> DataFrame:
    """Category domains, term differences and the target, counted in one grouped pass."""
    columns = {c: F.col(c).cast("string") for c in present(cleaned, roles.allowed)}
    if len(present(cleaned, [*roles.dates, roles.term])) == 3:
        columns["term_difference"] = profile.term_difference(cleaned, roles).cast("string")
    if roles.target in cleaned.columns:
        columns[roles.target] = F.col(roles.target).cast("string")
    counts = profile.value_counts_all(
        cleaned.select(*[v.alias(k) for k, v in columns.items()]), list(columns)
    ).filter(F.col("value").isNotNull())
    allowed = F.lit(False)
    for c in present(cleaned, roles.allowed):
        allowed = allowed | ((F.col("column") == c) & F.col("value").isin(*roles.allowed[c]))
    stat = (
        F.when(F.col("column") == "term_difference", "term_difference")
        .when(F.col("column") == roles.target, "target_distribution")
        .when(allowed, "observed_value")
        .otherwise("unexpected_value")
    )
    return counts.select(
        stat.alias("stat"), "column", F.col("value").alias("key"), F.col("n").cast("string").alias("value")
    )
