"""Feature drift of every year against a fixed reference, all years in one pass."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.functions.scalars import ratio
from loanlens.operators.prefix import running_sums
from loanlens.operators.project import align_features, sanitise_numbers
from loanlens.roles import LOAN_ROLES, RoleMap

# Default limits of the four tests.
DISTANCE_LIMIT = 0.1
P_LIMIT = 0.05
SPREAD_FLOOR = 0.001
#: Sample size up to which a Kolmogorov-Smirnov p-value counts all orders of the two samples.
EXACT_ROWS = 10_000
#: Bins of equal reference mass, and the least share a bin is taken to have.
STABILITY_BINS = 10
LEAST_SHARE = 1e-4


def drift_features(features: Sequence[str], roles: RoleMap = LOAN_ROLES):
    """Numeric and categorical features under watch; date features drift by themselves."""
    watched = [c for c in features if c not in roles.date_features]
    return (
        [c for c in watched if c not in roles.encoded],
        [c for c in watched if c in roles.encoded],
    )


def drift_input(
    df: DataFrame, features: Sequence[str], roles: RoleMap = LOAN_ROLES, keep: Sequence[str] = ()
) -> DataFrame:
    """Watched features as finite doubles, absent ones 0; id, target and dates removed."""
    numeric, categorical = drift_features(features, roles)
    aligned, _ = align_features(df, [*numeric, *categorical], keep)
    return sanitise_numbers(aligned, [*numeric, *categorical])


def _pooled(reference: DataFrame, current: DataFrame, columns: Sequence[str], year: str):
    marked = reference.select(F.lit(None).cast("int").alias("_year"), *columns)
    return marked.unionByName(current.select(F.col(year).cast("int").alias("_year"), *columns))


def _counters(years: Sequence[int]) -> list[Column]:
    ref = F.count_if(F.col("_year").isNull()).alias("r")
    return [ref, *[F.count_if(F.col("_year") == y).alias(f"y{y}") for y in years]]


def numeric_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    years: Sequence[int],
    year: str = "year",
) -> DataFrame:
    """Kolmogorov-Smirnov statistic and Wasserstein-1 distance per (year, feature).

    Each distinct value of a feature is one row that carries the counts of the reference and
    of every year, so all distribution functions are accumulated together and the reference
    is read once.  Years without rows give no result.
    """
    pooled = _pooled(reference, current, columns, year)
    items = [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns
    ]
    counts = (
        pooled.select("_year", F.explode(F.array(*items)).alias("i"))
        .select("_year", "i.*")
        .filter(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(*_counters(years))
    )
    names = ["r", *[f"y{y}" for y in years]]
    cdf = running_sums(counts, ["feature"], "value", names, following=True)
    step = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    f_ref = ratio(F.col("upto_r"), F.col("all_r"))
    results = []
    for y in years:
        gap = F.abs(f_ref - ratio(F.col(f"upto_y{y}"), F.col(f"all_y{y}")))
        results.append(
            F.struct(
                F.lit(y).alias("year"),
                F.max("all_r").alias("n_reference"),
                F.max(f"all_y{y}").alias("n_current"),
                F.max(gap).alias("ks"),
                F.sum(gap * step).alias("wasserstein"),
            ).alias(f"s{y}")
        )
    per_feature = cdf.groupBy("feature").agg(*results)
    spread = reference.agg(*[F.stddev_pop(c).alias(c) for c in columns]).unpivot(
        [], list(columns), "feature", "spread"
    )
    rows = per_feature.select("feature", F.explode(F.array(*[f"s{y}" for y in years])).alias("s"))
    return (
        rows.select("feature", "s.*")
        .filter("n_current > 0")
        .join(spread, "feature")
        .withColumn(
            "wasserstein_normed",
            F.col("wasserstein") / F.greatest(F.col("spread"), F.lit(SPREAD_FLOOR)),
        )
        .withColumn("ks_p_value", _ks_p_value("ks", "n_reference", "n_current"))
        .drop("spread")
    )


def ks_p_value(d: float, n: int, m: int) -> float:
    """Probability that two samples of one distribution lie at least ``d`` apart.

    Up to EXACT_ROWS rows a side all orders of the pooled sample are counted: an order is a lattice
    path from (0, 0) to (n, m), and the share of paths that stay within the distance is summed along
    diagonals.  Beyond, Kolmogorov's series.
    """
    if n < 1 or m < 1:
        return 1.0
    if max(n, m) > EXACT_ROWS:
        x = d * math.sqrt(n * m / (n + m))
        if x < 0.2:
            return 1.0
        series = sum((1.0 if k % 2 else -1.0) * math.exp(-2.0 * k * k * x * x) for k in range(1, 101))
        return min(1.0, max(0.0, 2 * series))
    # in whole numbers the distance at (i, j) is |i m - j n| = |i (n + m) - s n| on the diagonal
    # s = i + j, so a diagonal has a band of places inside, which only moves up
    n, m = min(n, m), max(n, m)
    least = round(d * n * m)
    inside = np.zeros(n + 2)  # the place before the first is always empty
    inside[1] = float(least > 0)
    before = 0
    for s in range(1, n + m + 1):
        low = max(0, s - m, (s * n - least) // (n + m) + 1)
        high = min(n, s, -((-s * n - least) // (n + m)) - 1)
        i = np.arange(low, high + 1)
        # the last step of a random path to (i, j) came from (i - 1, j) with probability i / s
        step = (inside[low + 1 : high + 2] * (s - i) + inside[low : high + 1] * i) / s
        inside[before + 1 : high + 2] = 0.0
        inside[low + 1 : high + 2] = step
        before = low
    inside = inside[1:]
    return float(min(1.0, max(0.0, 1.0 - inside[n])))


@F.pandas_udf(T.DoubleType())
def _ks_p_value(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    """One value per (year, feature), so the rows here are few."""
    return pd.Series([ks_p_value(x, int(a), int(b)) for x, a, b in zip(d, n, m, strict=True)])


def population_stability(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    years: Sequence[int],
    year: str = "year",
    bins: int = STABILITY_BINS,
) -> DataFrame:
    """Population stability index per (year, numeric feature): (q - p) ln(q / p) over the bins.

    A value's bin is the share of reference rows below it, from exact ranks, so that bins hold about
    equal reference mass and equal values stay together.  Bins without rows count as LEAST_SHARE.
    The reference is read once for all years.
    """
    pooled = _pooled(reference, current, columns, year)
    items = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    counts = (
        pooled.select("_year", F.explode(F.array(*items)).alias("i"))
        .select("_year", "i.*")
        .filter(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(*_counters(years))
    )
    summed = running_sums(counts, ["feature"], "value", ["r"])
    below = F.col("upto_r") - F.col("r")
    number = F.least(F.floor(below * bins / F.col("all_r")), F.lit(bins - 1))
    names = ["r", *[f"y{y}" for y in years]]
    binned = summed.filter("all_r > 0").groupBy("feature", number.alias("bin")).agg(*[F.sum(c).alias(c) for c in names])
    totals = binned.groupBy("feature").agg(*[F.sum(c).alias(f"all_{c}") for c in names])
    joined = binned.join(totals, "feature")
    floor = F.lit(LEAST_SHARE)
    p = F.greatest(ratio(F.col("r"), F.col("all_r")), floor)
    results = []
    for y in years:
        q = F.greatest(ratio(F.col(f"y{y}"), F.col(f"all_y{y}")), floor)
        results.append(
            F.struct(
                F.lit(y).alias("year"),
                F.max("all_r").alias("n_reference"),
                F.max(f"all_y{y}").alias("n_current"),
                F.count("*").alias("n_bins"),
                F.sum((q - p) * F.ln(q / p)).alias("psi"),
            ).alias(f"s{y}")
        )
    rows = joined.groupBy("feature").agg(*results)
    rows = rows.select("feature", F.explode(F.array(*[f"s{y}" for y in years])).alias("s"))
    return rows.select("feature", "s.*").filter("n_current > 0")


def categorical_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    years: Sequence[int],
    year: str = "year",
) -> DataFrame:
    """Jensen-Shannon distance and chi-square statistic per (year, feature)."""
    pooled = _pooled(reference, current, columns, year)
    items = [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
        for c in columns
    ]
    counts = (
        pooled.select("_year", F.explode(F.array(*items)).alias("i"))
        .select("_year", "i.feature", F.coalesce("i.value", F.lit("<NA>")).alias("value"))
        .groupBy("feature", "value")
        .agg(*_counters(years))
    )
    names = ["r", *[f"y{y}" for y in years]]
    totals = counts.groupBy("feature").agg(*[F.sum(n).alias(f"all_{n}") for n in names])
    joined = counts.join(totals, "feature")
    p = ratio(F.col("r"), F.col("all_r"))
    results = []
    for y in years:
        q = ratio(F.col(f"y{y}"), F.col(f"all_y{y}"))
        mid = (p + q) / 2
        terms = F.when(p > 0, p * F.ln(p / mid)).otherwise(0.0) + F.when(
            q > 0, q * F.ln(q / mid)
        ).otherwise(0.0)
        expected = p * F.col(f"all_y{y}")
        off = F.col(f"y{y}") - expected
        chi = F.when(expected > 0, off * off / expected).when(
            F.col(f"y{y}") > 0, F.lit(float("inf"))
        )
        either = (F.col("r") > 0) | (F.col(f"y{y}") > 0)
        results.append(
            F.struct(
                F.lit(y).alias("year"),
                F.max("all_r").alias("n_reference"),
                F.max(f"all_y{y}").alias("n_current"),
                F.sqrt(F.greatest(F.lit(0.0), F.sum(terms) / 2)).alias("jensenshannon"),
                F.coalesce(F.sum(chi), F.lit(0.0)).alias("chisquare"),
                (F.count_if(either) - 1).alias("degrees"),
            ).alias(f"s{y}")
        )
    rows = joined.groupBy("feature").agg(*results)
    rows = rows.select("feature", F.explode(F.array(*[f"s{y}" for y in years])).alias("s"))
    return rows.select("feature", "s.*").filter("n_current > 0")


def chi_square_p_value(x: float, degrees: int) -> float:
    """Upper tail of the chi-square distribution for whole degrees of freedom."""
    if degrees < 1 or x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    half = x / 2
    if degrees % 2:
        tail, k = math.erfc(math.sqrt(half)), 0.5
    else:
        tail, k = math.exp(-half), 1.0
    while k < degrees / 2:
        tail += math.exp(k * math.log(half) - half - math.lgamma(k + 1))
        k += 1
    return min(1.0, tail)


@F.pandas_udf(T.DoubleType())
def _chi_square_p(x: pd.Series, degrees: pd.Series) -> pd.Series:
    """One value per (year, feature), so the rows here are few."""
    return pd.Series([chi_square_p_value(a, int(b)) for a, b in zip(x, degrees, strict=True)])


def feature_drift(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    years: Sequence[int],
    numeric_test: str = "wasserstein",
    categorical_test: str = "jensenshannon",
    year: str = "year",
) -> DataFrame:
    """(year, feature, drift_detected, drift_score, stattest_name, n_current) rows.

    Distances are drift from 0.1 on, p-values below 0.05.
    """
    parts = []
    if numeric:
        rows = numeric_drift(reference, current, numeric, years, year)
        score = {"wasserstein": "wasserstein_normed", "ks": "ks_p_value"}[numeric_test]
        parts.append((rows.withColumn("drift_score", F.col(score)), numeric_test))
    if categorical:
        rows = categorical_drift(reference, current, categorical, years, year)
        if categorical_test == "chisquare":
            rows = rows.withColumn("drift_score", _chi_square_p("chisquare", "degrees"))
        else:
            rows = rows.withColumn("drift_score", F.col("jensenshannon"))
        parts.append((rows, categorical_test))
    frames = []
    for rows, test in parts:
        by_p = test in ("ks", "chisquare")
        hit = F.col("drift_score") < P_LIMIT if by_p else F.col("drift_score") >= DISTANCE_LIMIT
        frames.append(
            rows.select(
                "year",
                "feature",
                hit.alias("drift_detected"),
                "drift_score",
                F.lit(test).alias("stattest_name"),
                "n_reference",
                "n_current",
            )
        )
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def dataset_drift(
    per_feature: DataFrame,
    share_limit: float = 0.5,
    reference_label: str = "reference",
    excluded: Sequence[str] = LOAN_ROLES.date_features,
) -> DataFrame:
    """Drifted features per year, their share, and whether the share reaches the limit.

    The label of the reference and the features left out are kept next to the numbers.
    """
    return (
        per_feature.groupBy("year")
        .agg(
            F.max("n_reference").alias("n_reference_rows"),
            F.max("n_current").alias("n_loans"),
            F.count_if("drift_detected").alias("n_drifted_features"),
            F.count("*").alias("n_features"),
        )
        .withColumn("share_drifted", ratio(F.col("n_drifted_features"), F.col("n_features")))
        .withColumn("share_limit", F.lit(float(share_limit)))
        .withColumn("dataset_drift_detected", F.col("share_drifted") >= share_limit)
        .withColumn("reference_label", F.lit(reference_label))
        .withColumn("features_excluded", F.lit(",".join(excluded)))
    )
