"""Frames the queries share, built by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.operators.cleaning import clean
from loanlens.operators.features import (
    Transformers,
    apply_transformers,
    fit_transformers,
    stateless_features,
)
from loanlens.operators.project import flag_at
from loanlens.operators.target import ever_default, join_target
from loanlens.plans.views import table, view
from loanlens.roles import LOAN_ROLES
from loanlens.session import fresh_path
from loanlens.sources.delimited import read_years, write_by_year

TRAIN_UNTIL = 1997
TEST_FROM = 1998
ID = LOAN_ROLES.loan_id


def origination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "origination")


def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "performance")


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ever_default(performance(spark, sf_dir))


def model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_target(origination(spark, sf_dir), target(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(model_input(spark, sf_dir))


def cleaned_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows without a target, as new loans come."""
    return clean(origination(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untransformed features with id, year and target."""
    return stateless_features(cleaned(spark, sf_dir))


def new_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stateless_features(cleaned_new(spark, sf_dir))


def fitted(spark: SparkSession, sf_dir: str) -> Transformers:
    """Learned on the train years only."""
    train = new_features(spark, sf_dir).filter(F.col("year") <= TRAIN_UNTIL)
    return fit_transformers(train, keep=("year",))


def applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transformed features of all years with id, year and target."""
    return apply_transformers(features(spark, sf_dir), fitted(spark, sf_dir))


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transformed features written once, by year, and read back.

    Fits, drift and attribution pass over the features many times; none of them repeats the
    joins and casts behind the table, and year filters prune its folders.
    """
    path = fresh_path(spark, "features")
    write_by_year(applied(spark, sf_dir), path)
    return read_years(spark, path)


def years_in(df: DataFrame) -> list[int]:
    """The years of a table stored by year, read off its folders."""
    return sorted(r["year"] for r in df.select("year").filter("year IS NOT NULL").distinct().collect())


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores with outcomes: id, year, probability, label and decision at 0.5."""
    scores = view(spark, sf_dir, "scores")
    labels = target(spark, sf_dir).withColumnRenamed("default", "actual_default")
    return flag_at(scores.join(labels, ID), 0.5)


def line_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One score per performance event, for curve operators over the largest table."""
    li = table(spark, sf_dir, "lineitem")
    hit = F.col("l_returnflag") == "R"
    raw = (F.col("l_orderkey") * 7919 + F.col("l_partkey") * 31) % 8009
    score = (raw + F.when(hit, 1500).otherwise(0)).cast("double") / 10007
    return li.select(
        F.year("l_shipdate").alias("year"),
        hit.cast("int").alias("actual_default"),
        score.alias("probability_default"),
    )


def comparable(df: DataFrame) -> DataFrame:
    """Whole numbers that may be null as doubles, which every engine hands over alike."""
    columns = [f.name for f in df.schema if f.dataType.simpleString() == "bigint"]
    return df.withColumns({c: F.col(c).cast("double") for c in columns})
