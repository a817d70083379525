"""Running sums over an ordered column, and exact quantiles, without a global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlens.session import materialise

#: Distinct values that one window may hold, about.
ROWS_PER_BUCKET = 1_000_000
SMALL = 100_000
_BUCKET = "_bucket"


def with_buckets(
    counts: DataFrame, groups: Sequence[str], order: str, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Adds bucket numbers that rise with ``order`` in each group and hold about equally many rows.

    Buckets are the partitions of a range partitioning by groups and ``order``, whose number follows
    the number of rows; a row finds its own by binary search, and strings work like numbers.  They
    are written, since another run of the partitioning could draw other bounds.
    """
    parts = -(-counts.agg(F.count("*")).first()[0] // rows_per_bucket)
    if parts <= 1:
        return counts.withColumn(_BUCKET, F.lit(0))
    ranged = counts.repartitionByRange(parts, *groups, order)
    return materialise(ranged.withColumn(_BUCKET, F.spark_partition_id()), "buckets")


def running_sums(
    counts: DataFrame,
    groups: Sequence[str],
    order: str,
    counters: Sequence[str],
    descending: bool = False,
    following: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Adds ``upto_<c>`` and ``all_<c>`` for every counter, accumulated along ``order``.

    ``counts`` has one row per (groups, order) and no null in ``order``; null groups are groups
    of their own.  It is written once, so that what it comes from is read once.  Each window sees
    one bucket only; the sums of the buckets before it come from the bucket totals, a table of
    groups x buckets rows.  With ``following`` the next larger value of ``order`` in the group is
    added as ``next_<order>``.
    """
    counts = with_buckets(materialise(counts, "counts"), groups, order, rows_per_bucket)
    totals = counts.groupBy(*groups, _BUCKET).agg(
        *[F.sum(c).alias(f"_t_{c}") for c in counters], F.min(order).alias("_least")
    )
    along = F.col(_BUCKET).desc() if descending else F.col(_BUCKET).asc()
    scope = Window.partitionBy(*groups)
    earlier = scope.orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(f"_g_{g}") for g in groups],
        F.col(_BUCKET).alias("_b"),
        *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in counters],
        *[F.sum(f"_t_{c}").over(scope).alias(f"all_{c}") for c in counters],
        F.lead("_least").over(scope.orderBy(_BUCKET)).alias("_beyond"),
    )
    on = [F.col(_BUCKET) == F.col("_b"), *[F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups]]
    joined = counts.join(offsets, on, "inner")
    inside = Window.partitionBy(*groups, _BUCKET)
    sofar = inside.orderBy(F.col(order).desc() if descending else F.col(order).asc())
    sofar = sofar.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    result = joined.withColumns(
        {f"upto_{c}": F.col(f"_o_{c}") + F.sum(c).over(sofar) for c in counters}
    )
    if following:
        after = F.lead(order).over(inside.orderBy(order))
        result = result.withColumn(f"next_{order}", F.coalesce(after, F.col("_beyond")))
    helpers = [_BUCKET, "_b", "_beyond", *[f"_o_{c}" for c in counters], *[f"_g_{g}" for g in groups]]
    return result.drop(*helpers)


def exact_order_statistics(
    df: DataFrame, columns: Sequence[str], quantile: float, small: int = SMALL
) -> dict[str, tuple[float, float] | None]:
    """The two neighbouring order statistics around a quantile, per column; NaN counts as null.

    A mergeable sketch brackets the wanted rank, one counting pass checks the bracket, and
    the next round looks only at the values inside it.  Once at most ``small`` rows of a column
    are left, or the bracket does not hold both ranks, the ranks are read off running counts of
    the distinct values, without fractions.
    """
    numbers = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    counts = numbers.agg(*[F.count(c).alias(c) for c in columns]).first()
    found: dict[str, tuple[float, float] | None] = {c: None for c in columns if counts[c] == 0}
    size = {c: counts[c] for c in columns if counts[c]}
    ranks = {}
    for c, n in size.items():
        position = quantile * (n - 1)
        ranks[c] = (int(position), min(int(position) + (position > int(position)), n - 1))
    #: Strict bounds of the values still looked at; none at first, so that infinities are in.
    bounds: dict[str, tuple[float, float] | None] = dict.fromkeys(size)
    below = dict.fromkeys(size, 0)
    while size:
        names = list(size)
        inner = numbers.select(
            *[
                F.when((F.col(c) > F.lit(bounds[c][0])) & (F.col(c) < F.lit(bounds[c][1])), F.col(c)).alias(c)
                if bounds[c]
                else F.col(c)
                for c in names
            ]
        )
        ready = [c for c in names if size[c] <= small]
        if not ready:
            ready = _narrow(inner, names, ranks, bounds, below, size, found)
        if ready:
            wanted = {c: [r - below[c] for r in ranks[c]] for c in ready}
            found.update(_at_ranks(inner, wanted))
        for c in [c for c in names if c in found]:
            size.pop(c)
    return found


def _narrow(inner, names, ranks, bounds, below, size, found) -> list[str]:
    """One round of sketch and check; returns the columns whose two ranks lie apart."""
    wanted = {}
    for c in names:
        middle = (ranks[c][0] - below[c] + 0.5) / size[c]
        wanted[c] = [max(0.0, middle - 0.002), min(1.0, middle + 0.002)]
    points = sorted({p for pair in wanted.values() for p in pair})
    sketched = dict(zip(names, inner.approxQuantile(names, points, 0.001), strict=True))
    brackets = {c: [sketched[c][points.index(p)] for p in wanted[c]] for c in names}
    checks = []
    for c in names:
        lo, hi = brackets[c]
        v = F.col(c)
        checks += [
            F.count_if(v < lo).alias(f"{c}|lt"),
            F.count_if(v == lo).alias(f"{c}|lo"),
            F.count_if((v > lo) & (v < hi)).alias(f"{c}|in"),
            F.count_if(v == hi).alias(f"{c}|hi"),
        ]
    seen = inner.agg(*checks).first()
    apart = []
    for c in names:
        lo, hi = brackets[c]
        start = below[c] + seen[f"{c}|lt"]
        after_lo = start + seen[f"{c}|lo"]
        before_hi = after_lo + seen[f"{c}|in"]
        after_hi = before_hi + (seen[f"{c}|hi"] if hi != lo else 0)
        r0, r1 = ranks[c]
        if start <= r0 and r1 < after_lo:
            found[c] = (lo, lo)
        elif before_hi <= r0 and r1 < after_hi:
            found[c] = (hi, hi)
        elif after_lo <= r0 and r1 < before_hi:
            bounds[c], below[c], size[c] = (lo, hi), after_lo, seen[f"{c}|in"]
        else:
            # The two ranks straddle an edge value, or the sketch missed.
            apart.append(c)
    return apart


def _at_ranks(df: DataFrame, ranks: dict[str, list[int]]) -> dict[str, tuple[float, float]]:
    """The values at two ranks (from 0) of each column, from running counts of its values."""
    tall = df.select(*ranks).unpivot([], list(ranks), "column", "value")
    counts = tall.filter("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("n"))
    summed = running_sums(counts, ["column"], "value", ["n"])
    beyond = [F.lit(None), F.lit(None)]
    for c, pair in ranks.items():
        for i, r in enumerate(pair):
            beyond[i] = F.when((F.col("column") == c) & (F.col("upto_n") > r), F.col("value")).otherwise(beyond[i])
    rows = summed.groupBy("column").agg(*[F.min(x).alias(f"v{i}") for i, x in enumerate(beyond)])
    return {r["column"]: (r["v0"], r["v1"]) for r in rows.collect()}


def exact_medians(
    df: DataFrame, columns: Sequence[str], small: int = SMALL
) -> dict[str, float | None]:
    pairs = exact_order_statistics(df, columns, 0.5, small)
    return {c: None if pairs[c] is None else (pairs[c][0] + pairs[c][1]) / 2 for c in columns}
