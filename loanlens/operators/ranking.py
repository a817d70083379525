"""Row selection: first records, exact seeded samples, top-k and arg-max."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.functions.scalars import seeded_key
from loanlens.operators.bounded import attach
from loanlens.roles import LOAN_ROLES, RoleMap
from loanlens.session import materialise

#: Hexadecimal digits that one histogram counts, and all digits of the key and the row's hash.
PREFIX = 4
DIGITS = 64
#: Rows around a cut that one task ranks.
EDGE_ROWS = 100_000
CHUNK = 100_000


def first_coded_record(performance: DataFrame, roles: RoleMap = LOAN_ROLES) -> DataFrame:
    """Per loan, the first non-null value of each column, coded records first, then by period.

    Written as partial aggregates rather than a per-loan sort, so a loan with very many
    events never has to fit into one task.
    """
    others = [c for c in performance.columns if c != roles.loan_id]
    has_code = F.col(roles.event_code).isNotNull()
    order = F.struct((~has_code).cast("int"), F.col(roles.period))
    firsts = [
        F.min_by(
            F.struct(F.col(c).alias("v")),
            F.when(F.col(c).isNotNull(), F.struct(order, F.col(c))),
        )["v"].alias(c)
        for c in others
    ]
    return performance.filter(F.col(roles.loan_id).isNotNull()).groupBy(roles.loan_id).agg(*firsts)


def duplicate_rows(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Second and later rows per key, in the given order.

    The first row per key is a partial aggregate.  Rows that differ from it pass through the
    join; of the rows equal to it, all copies but one are given back from their count, in
    chunks, so a key made of very many copies is neither sorted nor emitted by one task.
    """
    others = [c for c in df.columns if c != key and c not in order]
    image = F.struct(*[F.col(c) for c in (*order, *others)])
    rows = df.withColumn("_image", image)
    copies = rows.groupBy(key, "_image").agg(F.count("*").alias("_copies"))
    first = (
        copies.groupBy(key)
        .agg(
            F.min(F.struct("_image", "_copies")).alias("_first"),
            F.sum("_copies").alias("_n"),
        )
        .filter("_n > 1")
        .select(F.col(key).alias("_key"), "_first._image", "_first._copies")
    )
    side = first.select("_key", F.col("_image").alias("_least"))
    later = rows.join(side, F.col(key).eqNullSafe(F.col("_key")), "inner").filter(
        F.col("_image") != F.col("_least")
    )
    chunk = F.lit(CHUNK)
    repeated = (
        first.filter("_copies > 1")
        .withColumn("_from", F.explode(F.sequence(F.lit(1), F.col("_copies") - 1, chunk)))
        .withColumn("_to", F.least(F.col("_from") + chunk - 1, F.col("_copies") - 1))
    )
    repeated = repeated.repartition("_key", "_from").withColumn(
        "_i", F.explode(F.sequence("_from", "_to"))
    )
    names = [(F.col("_key") if c == key else F.col(f"_image.{c}")).alias(c) for c in df.columns]
    return later.select(*df.columns).unionByName(repeated.select(*names))


def take_by_key(
    df: DataFrame,
    groups: Sequence[str],
    key: str,
    wanted: Column,
    seed: int = 42,
    flag: str | None = None,
    edge_rows: int = EDGE_ROWS,
) -> DataFrame:
    """The ``wanted`` rows per group with the smallest seeded key, exactly.

    ``wanted`` may use ``n``, the size of the group.  Rows are ordered by the digits of the key and,
    for equal and null ids, of a hash of the whole row.  A histogram over leading digits says which
    digit range holds the cut of each group.  Where that range has more than ``edge_rows`` rows, the
    next digits in which its rows differ are counted, and so on.  Rows before the cut are taken
    without sorting; only the rows inside the last range are ranked, equal rows as one with a count.
    With ``flag`` all rows are returned, marked 1 or 0.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in df.columns])
    keyed = df.withColumn("_key", F.concat(seeded_key(F.col(key), seed), F.md5(text)))
    whole = Window.partitionBy(*groups)
    length, marked, cut = PREFIX, keyed, None
    while True:
        prefix = F.substring("_key", 1, length)
        inside = marked if cut is None else marked.filter(F.substring("_key", 1, before_length) == F.col("_cut"))
        running = whole.orderBy("_prefix")
        wants = wanted.cast("bigint") if cut is None else F.col("_need")
        kept = [] if cut is None else ["_need"]
        histogram = (
            inside.groupBy(*groups, *kept, prefix.alias("_prefix"))
            .agg(F.count("*").alias("_c"), F.min("_key").alias("_least"), F.max("_key").alias("_most"))
            .withColumn("_upto", F.sum("_c").over(running))
            .withColumn("n", F.sum("_c").over(whole))
            .withColumn("_want", F.least(wants, F.col("n")))
        )
        before = F.col("_upto") - F.col("_c")
        cut = histogram.filter(
            (F.col("_want") > 0) & (before < F.col("_want")) & (F.col("_want") <= F.col("_upto"))
        ).select(
            *groups, F.col("_prefix").alias("_cut"), (F.col("_want") - before).alias("_need"), "_c", "_least", "_most"
        )
        cut = materialise(cut, "cut")
        marked = _with_cut(keyed, cut.drop("_c", "_least", "_most"), groups)
        # ranges that are too large and whose rows are not all equal
        same = F.size(F.filter(F.sequence(F.lit(1), F.lit(DIGITS)), _shared))
        large = cut.filter((F.col("_c") > edge_rows) & (F.col("_least") != F.col("_most")))
        shared = large.agg(F.min(same)).first()[0]
        if shared is None or shared >= DIGITS:
            break
        before_length, length = length, min(DIGITS, max(shared, length) + PREFIX)
    here = F.coalesce(F.substring("_key", 1, length) == F.col("_cut"), F.lit(False))
    # Rows away from the cut get a partition of their own kind and are not ranked.
    order = [F.col("_key"), *[F.col(c) for c in df.columns]]
    edge = marked.filter(here).groupBy(*df.columns, "_key", "_need").agg(F.count("*").alias("_copies"))
    sofar = whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_need") - F.coalesce(F.sum("_copies").over(sofar), F.lit(0))
    ranked = edge.withColumn("_left", left).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
    edge_rows_taken = ranked.withColumn("_take", (F.col("_copy") <= F.col("_left")).cast("int"))
    rest = marked.filter(~here).withColumn(
        "_take", F.coalesce((F.substring("_key", 1, length) < F.col("_cut")).cast("int"), F.lit(0))
    )
    result = rest.select(*df.columns, "_take").unionByName(edge_rows_taken.select(*df.columns, "_take"))
    if flag is not None:
        return result.withColumnRenamed("_take", flag)
    return result.filter("_take = 1").drop("_take")


def _shared(i: Column) -> Column:
    """True if the least and the largest key of a range share their first ``i`` digits."""
    return F.substring(F.col("_least"), F.lit(1), i) == F.substring(F.col("_most"), F.lit(1), i)


def _with_cut(keyed: DataFrame, cut: DataFrame, groups: Sequence[str]) -> DataFrame:
    if groups:
        return attach(keyed, cut, groups, "left")
    row = cut.first()
    return keyed.withColumns(
        {
            "_cut": F.lit(row["_cut"] if row else None).cast("string"),
            "_need": F.lit(row["_need"] if row else 0).cast("bigint"),
        }
    )


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows by seeded key; Spark keeps n candidates per task and merges them."""
    return df.orderBy(seeded_key(F.col(key), seed), key).limit(n)


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(F.col(by).desc_nulls_last(), tie).limit(k)


def best_candidates(results: DataFrame, metric: str) -> DataFrame:
    """Search table with the best candidate per family and overall marked.

    The candidate with the largest metric wins, nulls never, the earlier candidate on ties.
    """
    order = F.when(F.col(metric).isNotNull(), F.struct(F.col(metric), -F.col("candidate_idx")))
    winners = results.groupBy("model_family").agg(
        F.max_by("candidate_idx", order).alias("_best"),
        F.max(metric).alias("_family_value"),
        F.min("family_idx").alias("_family_idx"),
    )
    overall = winners.agg(
        F.max_by("model_family", F.struct("_family_value", -F.col("_family_idx")))
    ).scalar()
    best = F.coalesce(F.col("candidate_idx") == F.col("_best"), F.lit(False))
    return (
        results.join(winners, "model_family", "left")
        .withColumn("is_best_candidate", best)
        .withColumn("is_selected", best & (F.col("model_family") == overall))
        .drop("_best", "_family_value", "_family_idx")
    )


def worst_group(df: DataFrame, group: str, metric: str) -> DataFrame:
    """The group with the smallest metric."""
    return df.filter(F.col(metric).isNotNull()).agg(
        F.min_by(group, F.struct(metric, group)).alias(group), F.min(metric).alias(metric)
    )
