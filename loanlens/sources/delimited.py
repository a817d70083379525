"""Pipe-delimited scans with a fixed all-text schema, and parquet tables by year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.roles import (
    LIGHT_PERFORMANCE_COLUMNS,
    ORIGINATION_COLUMNS,
    PERFORMANCE_COLUMNS,
)

FILE_YEAR = r"((?:19|20)\d{2})"


def text_schema(width: int) -> T.StructType:
    return T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])


def read_pipe(spark: SparkSession, paths: str | Sequence[str], width: int = 32) -> DataFrame:
    """Positional text columns ``_c0`` ...; nothing is inferred, so types cannot drift."""
    return spark.read.schema(text_schema(width)).option("sep", "|").csv(paths)


def write_pipe(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Pipe text without header, blanks kept, one folder per value of ``partition``."""
    writer = df.write.option("sep", "|")
    for side in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
        writer = writer.option(side, False)
    (writer.partitionBy(partition) if partition else writer).csv(path)


def name_origination(raw: DataFrame) -> DataFrame:
    return raw.toDF(*ORIGINATION_COLUMNS)


def name_performance(raw: DataFrame) -> DataFrame:
    """32 names by position, or two for the light form; delinquency status is text."""
    if len(raw.columns) == len(LIGHT_PERFORMANCE_COLUMNS):
        return raw.toDF(*LIGHT_PERFORMANCE_COLUMNS)
    named = raw.toDF(*PERFORMANCE_COLUMNS)
    status = "current_loan_delinquency_status"
    return named.withColumn(status, F.col(status).cast("string"))


def scan_origination(
    spark: SparkSession,
    path: str | Sequence[str],
    years: Sequence[int] | None = None,
    year_from_file: bool = True,
) -> DataFrame:
    """Named origination rows of the wanted years in one scan.

    A ``year=`` folder is a partition column, so the filter prunes files.  Flat files carry
    the year in their name.  Without a target this is also the scan for new loans.
    """
    raw = spark.read.schema(
        T.StructType([*text_schema(len(ORIGINATION_COLUMNS)), T.StructField("year", T.IntegerType())])
        if not year_from_file
        else text_schema(len(ORIGINATION_COLUMNS))
    ).option("sep", "|").csv(path)
    if year_from_file:
        found = F.regexp_extract(F.col("_metadata.file_name"), FILE_YEAR, 1)
        raw = raw.withColumn("year", found.try_cast("int"))
    named = raw.toDF(*ORIGINATION_COLUMNS, "year")
    return named.filter(F.col("year").isin(list(years))) if years else named


def scan_performance(
    spark: SparkSession, path: str | Sequence[str], light: bool = False
) -> DataFrame:
    """Named performance rows; the light form reads two of the 32 columns."""
    raw = read_pipe(spark, path, len(PERFORMANCE_COLUMNS))
    if light:
        at = [PERFORMANCE_COLUMNS.index(c) for c in LIGHT_PERFORMANCE_COLUMNS]
        return name_performance(raw.select(*[f"_c{i}" for i in at]))
    return name_performance(raw)


def write_by_year(df: DataFrame, path: str, year: str = "year") -> None:
    df.write.partitionBy(year).mode("overwrite").parquet(path)


def read_years(
    spark: SparkSession, path: str, years: Sequence[int] | None = None, year: str = "year"
) -> DataFrame:
    df = spark.read.parquet(path)
    return df.filter(F.col(year).isin(list(years))) if years else df
