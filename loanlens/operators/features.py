"""Leak-free feature steps: what is learned comes from the training rows only."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark import StorageLevel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.functions import scalars as S
from loanlens.operators.bounded import attach
from loanlens.operators.prefix import exact_medians, running_sums
from loanlens.operators.project import drop_unused, present
from loanlens.operators.ranking import take_by_key
from loanlens.roles import LOAN_ROLES, RoleMap
from loanlens.session import fresh_path, materialise

UNSEEN = "unknown"
#: Classes of a column that are kept as a list and go into plans; more stay a table.
LIST_CLASSES = 10_000
#: A value that more than one row in this many has is hot; there are fewer of them than that.
HOT_SHARE = 1_000
_DICTIONARY = "column string, value string, code long"


@dataclass(frozen=True)
class Dictionary:
    """Classes of columns with many of them, as a written table of (column, value, code)."""

    path: str
    #: Code of the unseen class of each column.
    unseen: dict[str, int]

    def table(self, spark: SparkSession, column: str | None = None) -> DataFrame:
        rows = spark.read.schema(_DICTIONARY).parquet(self.path)
        return rows if column is None else rows.filter(F.col("column") == column)


@dataclass(frozen=True)
class Transformers:
    """Medians and classes learned on the training rows, those of large columns in a dictionary."""

    medians: dict[str, float | None]
    classes: dict[str, list[str]]
    dictionary: Dictionary | None = None

    def codes(self, column: str) -> dict[str, int]:
        return {value: i for i, value in enumerate(self.classes[column])}

    @property
    def columns(self) -> list[str]:
        return [*self.classes, *(self.dictionary.unseen if self.dictionary else ())]

    def save(self, spark: SparkSession, path: str) -> None:
        values = asdict(self)
        if self.dictionary:
            self.dictionary.table(spark).write.mode("overwrite").parquet(f"{path}-dictionary")
            values["dictionary"]["path"] = f"{path}-dictionary"
        row = spark.createDataFrame([(json.dumps(values),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Transformers:
        values = json.loads(spark.read.text(path).first()[0])
        if values.get("dictionary"):
            values["dictionary"] = Dictionary(**values["dictionary"])
        return Transformers(**values)


def date_features(df: DataFrame, roles: RoleMap = LOAN_ROLES) -> DataFrame:
    """Year and month of both dates and the months between them; the dates go away."""
    kinds = {f.name: f.dataType for f in df.schema}
    found = present(df, roles.dates)

    def date(c: str) -> Column:
        is_date = isinstance(kinds[c], (T.DateType, T.TimestampType, T.TimestampNTZType))
        return F.col(c).cast("date") if is_date else S.to_month(F.col(c))

    made = {}
    for c in found:
        made[f"{c}_year"] = F.year(date(c))
        made[f"{c}_month"] = F.month(date(c))
    if len(found) == 2:
        first, maturity = (date(c) for c in roles.dates)
        made["loan_term_months"] = S.month_difference(maturity, first)
    return df.withColumns(made).drop(*found)


def stateless_features(df: DataFrame, roles: RoleMap = LOAN_ROLES) -> DataFrame:
    """Cleaned rows to untransformed features; the id stays as the key."""
    return date_features(drop_unused(df, roles), roles)


def numeric_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return [
        f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def fit_classes(
    df: DataFrame, columns: Sequence[str], list_classes: int = LIST_CLASSES
) -> tuple[dict[str, list[str]], Dictionary | None]:
    """Sorted distinct values per column and the unseen class, from one grouped pass.

    The classes of a column are numbered by running counts over range partitions.  Only columns with
    at most ``list_classes`` classes, which are counted first, come to the driver.
    """
    text = df.select(*[S.or_missing_class(F.col(c)).alias(c) for c in columns])
    distinct = text.unpivot([], list(columns), "column", "value").distinct()
    distinct = materialise(distinct, "classes")
    unseen = F.max((F.col("value") == UNSEEN).cast("int")).alias("unseen")
    sizes = {r["column"]: r for r in distinct.groupBy("column").agg(F.count("*").alias("n"), unseen).collect()}
    large = [c for c in columns if c in sizes and sizes[c]["n"] > list_classes]
    small = [c for c in columns if c not in large]
    rows = distinct.filter(F.col("column").isin(small)).collect() if small else []
    found = {c: sorted(r["value"] for r in rows if r["column"] == c) for c in small}
    lists = {c: v if UNSEEN in v else [*v, UNSEEN] for c, v in found.items()}
    if not large:
        return lists, None
    ones = distinct.filter(F.col("column").isin(large)).withColumn("one", F.lit(1).cast("long"))
    ranked = running_sums(ones, ["column"], "value", ["one"])
    coded = ranked.select("column", "value", (F.col("upto_one") - 1).alias("code"))
    added = [(c, UNSEEN, sizes[c]["n"]) for c in large if not sizes[c]["unseen"]]
    coded = coded.union(df.sparkSession.createDataFrame(added, _DICTIONARY)) if added else coded
    path = fresh_path(df.sparkSession, "dictionary")
    coded.write.parquet(path)
    written = df.sparkSession.read.schema(_DICTIONARY).parquet(path)
    codes = {r["column"]: r["code"] for r in written.filter(F.col("value") == UNSEEN).collect()}
    return lists, Dictionary(path, codes)


def class_table(spark: SparkSession, t: Transformers) -> DataFrame:
    """(column, value, code) of all classes."""
    rows = [(c, v, i) for c in t.classes for v, i in t.codes(c).items()]
    listed = spark.createDataFrame(rows, _DICTIONARY)
    return listed.union(t.dictionary.table(spark)) if t.dictionary else listed


def fit_transformers(
    train: DataFrame, roles: RoleMap = LOAN_ROLES, keep: Sequence[str] = ()
) -> Transformers:
    """Exact medians of the numeric columns and the classes of the categories."""
    outside = (roles.target, roles.loan_id, *keep)
    numbers = numeric_columns(train, outside)
    categories = present(train, roles.encoded)
    # Several passes follow; the parsed columns are kept, on disk where memory is short.
    rows = train.select(*numbers, *categories).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Transformers(exact_medians(rows, numbers), *fit_classes(rows, categories))
    finally:
        rows.unpersist()


def transformer_table(spark: SparkSession, t: Transformers) -> DataFrame:
    """(kind, column, key, value) rows of the learned values."""
    rows = [("median", c, "", v) for c, v in t.medians.items()]
    medians = spark.createDataFrame(rows, "kind string, column string, key string, value double")
    code = F.col("code").cast("double").alias("value")
    return medians.union(class_table(spark, t).select(F.lit("class"), "column", "value", code))


def impute(df: DataFrame, values: dict) -> DataFrame:
    known = {c: v for c, v in values.items() if v is not None and c in df.columns}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in known.items()})


def encode_labels(df: DataFrame, t: Transformers) -> DataFrame:
    """Class position per category; unseen values get the position of the unseen class."""
    for c in present(df, t.dictionary.unseen if t.dictionary else ()):
        df = _encode_large(df, c, t.dictionary)
    columns = present(df, t.classes)
    if not columns:
        return df
    order = df.columns
    seen = {c: [v for v in t.classes[c] if v != UNSEEN or v != t.classes[c][-1]] for c in columns}
    indexer = StringIndexerModel.from_arrays_of_labels(
        [seen[c] for c in columns],
        inputCols=[f"_text_{c}" for c in columns],
        outputCols=[f"_code_{c}" for c in columns],
        handleInvalid="keep",
    )
    text = df.withColumns({f"_text_{c}": S.or_missing_class(F.col(c)) for c in columns})
    coded = indexer.transform(text)
    result = {}
    for c in columns:
        code = F.col(f"_code_{c}").cast("int")
        unseen = t.codes(c)[UNSEEN]
        result[c] = F.when(code >= len(seen[c]), F.lit(unseen)).otherwise(code)
    return coded.select(*[result[c].alias(c) if c in result else F.col(c) for c in order])


def _encode_large(df: DataFrame, column: str, dictionary: Dictionary) -> DataFrame:
    """Codes of a column by a join with its dictionary, each task getting a share of any value.

    Values that more than one row in HOT_SHARE has, fewer than HOT_SHARE by arithmetic, are counted
    first, and their codes are sent to all tasks; no other value holds more than its part of the
    rows.  Rows of a stream, which can't be counted, all meet the table.
    """
    spark, order = df.sparkSession, df.columns
    codes = dictionary.table(spark, column).select(F.col("value").alias("_text"), F.col("code").alias("_code"))
    text = df.withColumn("_text", S.or_missing_class(F.col(column)))
    unseen = F.lit(dictionary.unseen[column])
    code = F.coalesce("_code", unseen).cast("int").alias(column)
    chosen = [code if c == column else F.col(c) for c in order]
    if df.isStreaming:
        return text.join(codes, "_text", "left").select(*chosen)
    counts = text.groupBy("_text").agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = counts.filter(F.col("_n") * HOT_SHARE > total).join(codes, "_text", "left").select("_text", "_code")
    rows = hot.collect()
    if not rows:
        return text.join(codes, "_text", "left").select(*chosen)
    known = spark.createDataFrame(rows, "_text string, _code long").withColumn("_hot", F.lit(1))
    marked = text.join(F.broadcast(known), "_text", "left")
    rare = marked.filter("_hot IS NULL").drop("_code", "_hot").join(codes, "_text", "left")
    return marked.filter("_hot = 1").select(*chosen).union(rare.select(*chosen))


def apply_transformers(df: DataFrame, t: Transformers) -> DataFrame:
    """Median imputation and label encoding; nothing is learned here."""
    return encode_labels(impute(df, t.medians), t)


def one_hot(df: DataFrame, t: Transformers, columns: Sequence[str]) -> DataFrame:
    """0/1 columns ``column_VALUE`` for the classes seen in training; unseen is all zero."""
    made = {}
    for c in present(df, columns):
        if c not in t.classes:
            raise ValueError(f"{c} has too many classes for a column each")
        for v in t.classes[c]:
            if v not in (UNSEEN, S.MISSING_CLASS):
                made[f"{c}_{v}"] = F.coalesce((F.col(c) == v).cast("int"), F.lit(0))
    return df.withColumns(made).drop(*present(df, columns))


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent value per column, the smallest one on ties."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counts = (
        text.unpivot([], list(columns), "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg((-F.count("*")).alias("n"))
    )
    best = counts.groupBy("column").agg(F.min(F.struct("n", "value"))["value"].alias("value"))
    found = {r["column"]: r["value"] for r in best.collect()}
    return {c: found.get(c) for c in columns}


def standardise(df: DataFrame, columns: Sequence[str], population: bool = True) -> DataFrame:
    """Zero mean and unit variance; a constant column becomes 0."""
    spread = F.stddev_pop if population else F.stddev_samp
    row = df.agg(
        *[F.avg(c).alias(f"{c}|m") for c in columns], *[spread(c).alias(f"{c}|s") for c in columns]
    ).first()
    scaled = {}
    for c in columns:
        mean, sd = row[f"{c}|m"], row[f"{c}|s"]
        if mean is not None:
            scaled[c] = (F.col(c) - F.lit(mean)) / F.lit(sd if sd else 1.0)
    return df.withColumns(scaled)


def stratified_split(
    df: DataFrame, fraction: float, key: str, target: str, seed: int = 42, flag: str = "is_validation"
) -> DataFrame:
    """Marks ceil(fraction x class size) rows of every class as held out, exactly."""
    wanted = F.ceil(F.col("n") * F.lit(float(fraction)))
    return take_by_key(df, [target], key, wanted, seed, flag)


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Balanced weight n / (classes x class size) per class."""
    counts = df.groupBy(target).agg(F.count("*").alias("n_class"))
    total = counts.agg(F.sum("n_class")).scalar()
    classes = counts.agg(F.count("*")).scalar()
    weight = total.cast("double") / (classes * F.col("n_class"))
    return counts.withColumn("class_weight", weight)


def with_class_weights(df: DataFrame, target: str) -> DataFrame:
    return attach(df, class_weights(df, target).drop("n_class"), [target], "left")


def undersample(df: DataFrame, target: str, key: str, seed: int = 42) -> DataFrame:
    """Every class reduced to the size of the smallest, by seeded key."""
    smallest = df.groupBy(target).count().agg(F.min("count")).first()[0] or 0
    return take_by_key(df, [target], key, F.lit(smallest), seed)
