from __future__ import annotations

import re
import zipfile

import pytest
from pyspark.sql import functions as F

from loanlens.plans import table_queries
from loanlens.roles import LOAN_ROLES, ORIGINATION_COLUMNS, PERFORMANCE_COLUMNS
from loanlens.session import fresh_path
from loanlens.sources import archives, delimited, feature_table, reports, runlog


def raw(spark, width, rows=1):
    return spark.createDataFrame([tuple([None] * width)] * rows, delimited.text_schema(width))


def test_origination_names(spark):
    df = delimited.name_origination(raw(spark, 32))
    assert len(df.columns) == 32
    assert df.columns[0] == "credit_score"
    assert df.columns[-1] == "mi_cancellation_indicator"


def test_performance_names_full_and_light(spark):
    full = delimited.name_performance(raw(spark, 32))
    assert full.columns == list(PERFORMANCE_COLUMNS)
    assert dict(full.dtypes)["current_loan_delinquency_status"] == "string"
    light = delimited.name_performance(raw(spark, 2))
    assert light.columns == ["loan_sequence_number", "zero_balance_code"]


def test_role_lists():
    assert len(ORIGINATION_COLUMNS) == len(PERFORMANCE_COLUMNS) == 32
    assert len(LOAN_ROLES.leaky) == 31
    assert len(LOAN_ROLES.features) == 24


def test_flat_files_carry_their_year(spark, tmp_path):
    for year in (2005, 2006, 2007):
        row = "|".join(str(i) for i in range(32))
        (tmp_path / f"sample_orig_{year}.txt").write_text(f"{row}\n{row}\n")
    df = delimited.scan_origination(spark, str(tmp_path), years=[2005, 2007])
    assert {(r["year"], r["n"]) for r in df.groupBy("year").agg(F.count("*").alias("n")).collect()} == {
        (2005, 2),
        (2007, 2),
    }
    assert df.first()["credit_score"] == "0"


def test_pipe_keeps_blanks_and_nulls(spark):
    path = fresh_path(spark, "t")
    delimited.write_pipe(spark.createDataFrame([(" a ", None, "c")], "x string, y string, z string"), path)
    assert tuple(delimited.read_pipe(spark, path, 3).first()) == (" a ", None, "c")


def test_year_filter_prunes_partitions(spark):
    path = fresh_path(spark, "t")
    df = spark.range(30).select("id", (F.lit(2000) + F.col("id") % 3).cast("int").alias("year"))
    delimited.write_by_year(df, path)
    read = delimited.read_years(spark, path, [2001])
    assert read.count() == 10
    assert len(read.inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(year" in read._jdf.queryExecution().executedPlan().toString()


def nested_archive(folder, year, quarters, member=archives.ORIGINATION_MEMBER, rows=3, width=31):
    with zipfile.ZipFile(folder / archives.OUTER.format(year=year), "w", zipfile.ZIP_DEFLATED) as outer:
        for q in quarters:
            names = {"year": year, "quarter": q}
            with outer.open(archives.INNER.format(**names), "w") as f, zipfile.ZipFile(f, "w") as inner:
                line = "|".join(f"v{i}" for i in range(width))
                inner.writestr(member.format(**names), f"{line}\n" * rows)


def test_archive_scan_skips_missing_members(spark, tmp_path):
    nested_archive(tmp_path, 2001, ["Q1", "Q3"])
    listed = archives.archive_list(spark, str(tmp_path), [2000, 2001])
    df = archives.scan_archived_origination(listed)
    assert {(r["year"], r["quarter"], r["count"]) for r in df.groupBy("year", "quarter").count().collect()} == {
        (2001, "Q1", 3),
        (2001, "Q3", 3),
    }
    row = df.first()
    assert row["credit_score"] == "v0"
    assert row["interest_only_indicator"] == "v30"
    assert row["mi_cancellation_indicator"] is None


def test_archive_performance_reads_two_columns(spark, tmp_path):
    nested_archive(tmp_path, 2002, ["Q2"], archives.PERFORMANCE_MEMBER, rows=5, width=32)
    listed = archives.archive_list(spark, f"file://{tmp_path}", [2002], archives.PERFORMANCE_MEMBER)
    df = archives.scan_archived_performance(listed)
    assert df.count() == 5
    assert df.first()["zero_balance_code"] == "v8"


def test_feature_table_counts_and_key_checks(spark):
    root = fresh_path(spark, "ft")
    df = spark.createDataFrame(
        [("A", 1, 0), ("B", 0, 1)], "loan_sequence_number string, occupancy_status_O int, `channel-R` int"
    )
    info = feature_table.write_feature_table(df, root, "t", 3)
    assert info == {"feature_group": "t", "version": 3, "n_rows": 2, "n_features": 3}
    back = feature_table.read_feature_table(spark, root, "t", 3)
    assert back.columns == ["loan_sequence_number", "occupancy_status_o", "channel_r"]
    with pytest.raises(ValueError, match="primary key"):
        feature_table.write_feature_table(df.drop("loan_sequence_number"), root, "t", 3)
    with pytest.raises(ValueError, match="unique"):
        feature_table.write_feature_table(df.union(df), root, "t", 4)


def test_run_log_appends_and_pivots(spark):
    path = fresh_path(spark, "runs")
    runlog.append_runs(spark, path, runlog.run_rows("e", "r1", {"t": 0.4}, {"auc": 0.7, "ok": True}))
    runlog.append_runs(spark, path, runlog.run_rows("e", "r1", None, {"late": 0.2}))
    runlog.append_runs(spark, path, runlog.run_rows("other", "r2", {}, {"auc": 0.1}))
    rows = runlog.search_runs(runlog.read_log(spark, path), "e", ["auc", "late", "ok"], ["t"]).collect()
    assert [r.asDict() for r in rows] == [
        {"run_id": "r1", "parent_run_id": None, "auc": 0.7, "late": 0.2, "ok": None, "t": "0.4"}
    ]


def test_json_report_keeps_null_fields(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert reports.as_json(df).first()["json"] == '{"a":1,"b":null}'


def test_years_are_packed_by_quarter_and_unsorted(spark, tmp_path):
    rows = [(2000 + i % 2, f"Q{1 + i % 4}", "|" * 8 + f"{i:05d}") for i in range(3000)]
    df = spark.createDataFrame(rows, "year int, quarter string, line string")
    packed = table_queries.pack_years(df, str(tmp_path), archives.OUTER, archives.INNER, archives.PERFORMANCE_MEMBER)
    plan = packed._jdf.queryExecution().optimizedPlan().toString()
    # the lines are dealt by quarter and not sorted; the few quarters are
    assert re.search(r"RepartitionByExpression \[year#\d+, quarter#\d+\]", plan) and plan.count("Sort") == 1
    years = sorted(r.year for r in packed.collect())
    assert years == [2000, 2001]
    listed = archives.archive_list(spark, str(tmp_path), years, archives.PERFORMANCE_MEMBER)
    got = sorted(map(tuple, archives.scan_members(listed).collect()))
    assert got == sorted(rows)
