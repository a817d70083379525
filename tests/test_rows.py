"""Targets, joins, unions, cleaning and the quality gate on the small fixtures."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from loanlens.operators import cleaning, joins, profile, project, quality, ranking
from loanlens.operators.target import ever_default, join_target, union_years, unlabelled
from loanlens.roles import LOAN_ROLES, ORIGINATION_COLUMNS

ID = LOAN_ROLES.loan_id
DIRTY = dict(
    credit_score="9999", first_payment_date="200503", first_time_homebuyer_flag="9",
    maturity_date="203502", msa=None, mi_percentage="999", number_of_units="99",
    occupancy_status="p", original_cltv="999", original_dti="999", original_upb="100000",
    original_ltv="999", original_interest_rate="5.5", channel=" 9 ", prepayment_penalty_flag="N",
    amortization_type="FRM", property_state="CA", property_type="99", postal_code="94100",
    loan_sequence_number="F05Q10000001", loan_purpose="9", original_loan_term="360",
    number_of_borrowers="99", seller_name="Other sellers", servicer_name="Other servicers",
    special_eligibility_program="9", property_valuation_method="7", interest_only_indicator="N",
    mi_cancellation_indicator="9", default="0",
)
CLEAN = dict(
    credit_score="650", first_payment_date="200505.0", first_time_homebuyer_flag="N",
    maturity_date="203504", msa="17140.0", mi_percentage="0", number_of_units="1",
    occupancy_status="I", original_cltv="80", original_dti="43", original_upb="200000",
    original_ltv="77", original_interest_rate="6.0", channel="R", prepayment_penalty_flag="Y",
    amortization_type="FRM", property_state="NY", property_type="SF", postal_code="10000",
    loan_sequence_number="F05Q10000002", loan_purpose="P", original_loan_term="360",
    number_of_borrowers="2", seller_name="Some seller", servicer_name="Some servicer",
    special_eligibility_program="9", property_valuation_method="7", interest_only_indicator="N",
    mi_cancellation_indicator="9", default="1",
)


@pytest.fixture(scope="module")
def dirty(spark):
    columns = [*ORIGINATION_COLUMNS, "default"]
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in (DIRTY, CLEAN)], schema)


def events(spark, rows, kind="string"):
    return spark.createDataFrame(rows, f"loan_sequence_number string, zero_balance_code {kind}")


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_ever_default_on_numbers_and_text(spark):
    numbers = events(spark, [("A", None), ("A", 9.0), ("B", None), ("B", 1.0), ("C", None)], "double")
    assert as_dict(ever_default(numbers), ID, "default") == {"A": 1, "B": 0, "C": 0}
    text = events(spark, [("A", "09"), ("B", " 9 "), ("C", "RA"), ("D", "103"), (None, "9"), ("E", "3d")])
    assert as_dict(ever_default(text), ID, "default") == {"A": 1, "B": 1, "C": 0, "D": 0, "E": 0}
    assert ever_default(events(spark, [])).count() == 0


def test_join_modes(spark):
    origination = spark.createDataFrame(
        [("A", 700), ("B", 650), ("C", 720)], "loan_sequence_number string, credit_score int"
    )
    target = spark.createDataFrame([("A", 1), ("B", 0)], "loan_sequence_number string, default int")
    assert as_dict(join_target(origination, target), ID, "default") == {"A": 1, "B": 0}
    left = join_target(origination, target, "left_zero")
    assert as_dict(left, ID, "default") == {"A": 1, "B": 0, "C": 0}
    assert [r[ID] for r in unlabelled(origination, target).collect()] == ["C"]
    with pytest.raises(ValueError):
        join_target(origination, target, "outer")


def test_union_years_tags_and_aligns(spark):
    schema = "loan_sequence_number string, interest_only_indicator int, default int"
    one = spark.createDataFrame([("A", 1, 0), ("B", 2, 1)], schema)
    two = spark.createDataFrame([("C", 1, 0), ("D", 1, 1)], schema)
    tagged = spark.createDataFrame(
        [("E", "Y", 1, 2003)],
        "loan_sequence_number string, interest_only_indicator string, default int, year int",
    )
    df = union_years({2001: one, 2002: two.drop("default")}, [tagged])
    assert df.count() == 5
    assert as_dict(df, ID, "year") == {"A": 2001, "B": 2001, "C": 2002, "D": 2002, "E": 2003}
    assert as_dict(df, ID, "default")["C"] is None
    assert dict(df.dtypes)["interest_only_indicator"] == "string"


def test_cleaning_values(dirty):
    rows = {r[ID]: r for r in cleaning.clean(dirty).collect()}
    bad, good = rows["F05Q10000001"], rows["F05Q10000002"]
    for c in LOAN_ROLES.numeric_sentinels:
        assert bad[c] is None and good[c] is not None
    for c in LOAN_ROLES.category_sentinels:
        if c != "occupancy_status":
            assert bad[c] == "UNKNOWN"
    assert bad["occupancy_status"] == "P"
    assert bad["first_payment_date"] == datetime.date(2005, 3, 1)
    assert good["first_payment_date"] == datetime.date(2005, 5, 1)
    assert good["msa"] == 17140 and bad["msa"] is None
    assert (bad["default"], good["default"]) == (0, 1)
    assert not set(LOAN_ROLES.dropped) & set(cleaning.clean(dirty).columns)


def test_cleaning_without_target_and_with_leak(dirty):
    leaked = dirty.drop("default").withColumn(" Zero_Balance_Code ", F.lit("09"))
    out = cleaning.clean(leaked)
    assert "default" not in out.columns and "zero_balance_code" not in out.columns
    stats = cleaning.cleaning_statistics(leaked)
    assert stats.filter("stat = 'leaky_dropped' AND column = 'zero_balance_code'").count() == 1


def test_cleaning_statistics(dirty):
    stats = {(r["stat"], r["column"], r["key"]): r["value"] for r in cleaning.cleaning_statistics(dirty).collect()}
    for c in LOAN_ROLES.numeric_sentinels:
        assert stats[("sentinel_count", c, "")] == "1"
    assert sum(int(stats[("unknown_count", c, "")]) for c in LOAN_ROLES.category_sentinels) == 4
    assert stats[("term_difference", "term_difference", "0")] == "2"
    assert stats[("target_distribution", "default", "0")] == "1"
    assert stats[("target_distribution", "default", "1")] == "1"
    assert stats[("rows_removed", "", "")] == "0"
    assert stats[("duplicate_count", ID, "")] == "0"
    assert stats[("invalid_count", ID, "")] == "0"
    assert stats[("date_check", "maturity_after_first_payment_all", "")] == "true"
    assert not [k for k in stats if k[0] == "unexpected_value"]


def test_null_ids_and_states_count_as_invalid_and_duplicate(spark):
    df = spark.createDataFrame([(None, None), (None, "ca"), ("F05Q10000001", "CA")], f"{ID} string, s string")
    row = profile.duplicate_count(df, ID).first()
    assert (row["n_rows"], row["duplicate_count"]) == (3, 1)
    found = as_dict(profile.format_counts(df, {ID: LOAN_ROLES.id_pattern, "s": "^[A-Z]{2}$"}), "column", "invalid_count")
    assert found == {ID: 2, "s": 2}


def test_month_parsing_edge_values(spark):
    df = spark.createDataFrame([("200513",), ("2005",), ("abc",), (" 200512 ",), ("200501.0",), (None,)], "d string")
    out = [r["d"] for r in project.parse_months(df, ["d"]).collect()]
    assert out == [None, None, None, datetime.date(2005, 12, 1), datetime.date(2005, 1, 1), None]


def test_empty_tables(spark, dirty):
    none = dirty.filter("1 = 0")
    assert cleaning.clean(none).count() == 0
    stats = {(r["stat"], r["column"]): r["value"] for r in cleaning.cleaning_statistics(none).collect()}
    assert stats[("range_check", "credit_score_valid")] == "1"


@pytest.fixture(scope="module")
def model_input(spark, dirty):
    rows = dirty.withColumn("default", F.col("default").cast("int"))
    rows = rows.withColumn("original_cltv", F.lit("80")).withColumn("original_ltv", F.lit("77"))
    return rows.withColumn("year", F.when(F.col("default") == 1, 2001).otherwise(2002))


def test_gate_passes_and_reports_warnings(model_input):
    warnings = []
    assert quality.quality_gate(model_input, warn=warnings).columns == model_input.columns
    assert ("row_count", "") in warnings and ("not_null", "msa") in warnings


@pytest.mark.parametrize(
    "break_it",
    [
        lambda df: df.drop("default"),
        lambda df: df.withColumn("default", F.lit(3)),
        lambda df: df.drop(ID),
        lambda df: df.withColumn(ID, F.lit("F05Q10000001")),
        lambda df: df.withColumn("extra", F.lit(1)),
        lambda df: df.drop("year"),
        lambda df: df.withColumn("credit_score", F.lit("200")),
        lambda df: df.withColumn("credit_score", F.lit("n/a")),
    ],
)
def test_gate_raises(model_input, break_it):
    with pytest.raises(ValueError, match="critical"):
        quality.quality_gate(break_it(model_input))


def test_pair_check_skips_only_double_nulls(model_input):
    df = model_input.withColumn("maturity_date", F.when(F.col("default") == 1, F.col("maturity_date")))
    row = quality.quality_checks(df).filter("check = 'pair' AND column LIKE 'maturity%'").first()
    assert row["unexpected_count"] == 1
    both = df.withColumn("first_payment_date", F.when(F.col("default") == 1, F.col("first_payment_date")))
    row = quality.quality_checks(both).filter("check = 'pair' AND column LIKE 'maturity%'").first()
    assert row["unexpected_count"] == 0


def test_align_and_sanitise(spark):
    df = spark.createDataFrame([("a", float("inf"), True, "x")], "id string, v double, b boolean, t string")
    kept, dropped = project.numeric_only(df, ["id"])
    assert dropped == ["t"] and kept.columns == ["id", "v", "b"]
    aligned, filled = project.align_features(kept, ["b", "absent", "v"], ["id"])
    assert filled == ["absent"]
    assert tuple(project.sanitise_numbers(aligned, ["b", "absent", "v"]).first()) == ("a", 1.0, 0.0, 0.0)


def test_sanitised_names_must_not_collide(spark):
    with pytest.raises(ValueError, match="collide"):
        project.sanitise_names(spark.createDataFrame([(1, 2)], ["a b", "A-B"]))


def test_lookup_with_default_from_table(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    codes = spark.createDataFrame([("a", 0), ("unknown", 9)], "k string, code int")
    out = joins.lookup_with_default(df, codes, "k", "code", "unknown").collect()
    assert {r["k"]: r["code"] for r in out} == {"a": 0, "z": 9, None: 9}


def test_first_coded_record_takes_first_non_null_per_column(spark):
    df = spark.createDataFrame(
        [("A", "200502", None, 1), ("A", "200503", "09", None), ("A", "200501", None, 7), ("B", "200501", None, None)],
        "loan_sequence_number string, monthly_reporting_period string, zero_balance_code string, v int",
    )
    out = {r[ID]: r for r in ranking.first_coded_record(df).collect()}
    assert out["A"]["zero_balance_code"] == "09" and out["A"]["monthly_reporting_period"] == "200503"
    assert out["A"]["v"] == 7
    assert out["B"]["v"] is None


def test_cleaning_statistics_compile(spark, capfd):
    """The generated code of every branch is compiled, not interpreted."""
    from loanlens.operators.cleaning import cleaning_statistics
    from loanlens.plans import frames

    found = cleaning_statistics(frames.model_input(spark, "/root/testdata/sf0.001"))
    found.write.format("noop").mode("overwrite").save()
    captured = capfd.readouterr()
    assert "Failed to compile" not in captured.out + captured.err
