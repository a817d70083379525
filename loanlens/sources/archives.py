"""Scan of text members inside zips that are themselves members of a zip."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.roles import LIGHT_PERFORMANCE_COLUMNS, ORIGINATION_COLUMNS, PERFORMANCE_COLUMNS

LINES = 20_000
# Names of the yearly archive, its quarterly archive and the two text members.
OUTER = "historical_data_excl_{year}.zip"
INNER = "historical_data_excl_{year}{quarter}.zip"
ORIGINATION_MEMBER = "historical_data_excl_{year}{quarter}.txt"
PERFORMANCE_MEMBER = "historical_data_excl_time_{year}{quarter}.txt"
QUARTERS = ("Q1", "Q2", "Q3", "Q4")


def archive_list(
    spark: SparkSession, folder: str, years: Sequence[int], member: str = ORIGINATION_MEMBER
) -> DataFrame:
    """(archive, inner, member, year, quarter) for every year and quarter."""
    rows = [
        (
            f"{folder.rstrip('/')}/{OUTER.format(year=y)}",
            INNER.format(year=y, quarter=q),
            member.format(year=y, quarter=q),
            y,
            q,
        )
        for y in years
        for q in QUARTERS
    ]
    schema = "archive string, inner string, member string, year int, quarter string"
    return spark.createDataFrame(rows, schema)


def scan_members(archives: DataFrame) -> DataFrame:
    """Lines of every listed member as (year, quarter, line); a missing member has no lines.

    One task per archive member.  Members are streamed: the inner zip is read through the
    outer one, nothing is unpacked to disk and only a batch of lines is held.
    """
    # A given partition count is kept as it is; coalescing would queue members in one task.
    tasks = archives.repartition(max(1, archives.count()))
    return tasks.select("archive", "inner", "member", "year", "quarter").mapInPandas(
        _lines_of, "year int, quarter string, line string"
    )


def _lines_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for item in batch.itertuples(index=False):
            for lines in _stream_member(item.archive, item.inner, item.member):
                yield pd.DataFrame({"year": item.year, "quarter": item.quarter, "line": lines})


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """File system of a URI or a mounted path, and the path inside it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _stream_member(archive: str, inner: str, member: str) -> Iterator[list[str]]:
    fs, path = file_system(archive)
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        return
    with fs.open_input_file(path) as raw, zipfile.ZipFile(raw) as outer:
        if inner not in outer.namelist():
            return
        with outer.open(inner) as nested, zipfile.ZipFile(nested) as quarter:
            if member not in quarter.namelist():
                return
            with quarter.open(member) as text:
                lines: list[str] = []
                for line in text:
                    lines.append(line.decode("utf-8").rstrip("\r\n"))
                    if len(lines) == LINES:
                        yield lines
                        lines = []
                if lines:
                    yield lines


def _fields(names: Sequence[str], at: Sequence[int]) -> list[Column]:
    parts = F.split("line", "[|]", -1)
    return [
        F.when(F.get(parts, i) != "", F.get(parts, i)).alias(c)
        for c, i in zip(names, at, strict=True)
    ]


def scan_archived_origination(archives: DataFrame) -> DataFrame:
    """Named origination rows with year and quarter; absent trailing columns are null."""
    at = range(len(ORIGINATION_COLUMNS))
    return scan_members(archives).select("year", "quarter", *_fields(ORIGINATION_COLUMNS, at))


def scan_archived_performance(archives: DataFrame) -> DataFrame:
    """The light performance form with year and quarter."""
    at = [PERFORMANCE_COLUMNS.index(c) for c in LIGHT_PERFORMANCE_COLUMNS]
    return scan_members(archives).select(
        "year", "quarter", *_fields(LIGHT_PERFORMANCE_COLUMNS, at)
    )
