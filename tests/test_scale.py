"""Operators where one key, class or id holds most rows, and statistics against enumeration."""

from __future__ import annotations

import itertools
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlens.operators import drift, features, logistic, models, prefix, profile, ranking, search
from loanlens.session import fresh_path
from loanlens.sources import runlog


def test_two_million_classes_encode(spark):
    n = 2_000_000
    rows = spark.range(n).select(
        F.format_string("c%07d", F.col("id")).alias("channel"), F.lit("x").alias("occupancy_status")
    )
    fitted = features.Transformers({}, *features.fit_classes(rows, ["channel", "occupancy_status"]))
    assert list(fitted.classes) == ["occupancy_status"] and fitted.dictionary.unseen == {"channel": n}
    # a third of the rows has one value, some values are unseen or null
    hot = F.when(F.col("id") % 3 == 0, "c0000042").when(F.col("id") % 1000 == 1, F.lit(None))
    new = spark.range(n).select(
        "id",
        hot.when(F.col("id") % 1000 == 2, "new").otherwise(F.format_string("c%07d", F.col("id"))).alias("channel"),
        F.lit("y").alias("occupancy_status"),
    )
    out = features.encode_labels(new, fitted)
    assert out.columns == new.columns
    want = F.when(F.col("id") % 3 == 0, 42).when(F.col("id") % 1000 <= 2, F.when(F.col("id") % 1000 > 0, n).otherwise(F.col("id")))
    wrong = out.withColumn("want", want.otherwise(F.col("id"))).filter("channel != want OR channel IS NULL OR occupancy_status != 1")
    assert out.count() == n and wrong.count() == 0


@pytest.mark.parametrize("limit", [2, 10_000])
def test_lists_and_dictionaries_code_alike(spark, limit):
    train = spark.createDataFrame([("x",), ("unknown",), (None,), ("b",), ("b",)], "channel string")
    fitted = features.Transformers({"a": 1.0}, *features.fit_classes(train, ["channel"], limit))
    assert (fitted.dictionary is None) == (limit > 4)
    path = fresh_path(spark, "fitted")
    fitted.save(spark, path)
    again = features.Transformers.load(spark, path)
    new = spark.createDataFrame([("x",), ("new",), (None,), ("b",)], "channel string")
    assert sorted(r[0] for r in features.encode_labels(new, again).collect()) == [0, 1, 2, 3]
    table = {tuple(r) for r in features.class_table(spark, again).collect()}
    assert table == {("channel", "<NA>", 0), ("channel", "b", 1), ("channel", "unknown", 2), ("channel", "x", 3)}
    assert features.transformer_table(spark, again).count() == 5


def test_running_sums_over_strings_and_many_buckets(spark):
    rows = [(g, f"v{i:04d}", i % 7) for g in ("a", None) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v string, n long")
    out = prefix.running_sums(df, ["g"], "v", ["n"], descending=True, rows_per_bucket=30).collect()
    for r in out:
        assert r["upto_n"] == sum(i % 7 for i in range(int(r["v"][1:]), 500))
    plan = prefix.with_buckets(df, ["g"], "v", 30)._jdf.queryExecution().executedPlan().toString()
    assert "array" not in plan.lower() and "Exchange" not in plan


@pytest.mark.parametrize("edge", [100_000, 50])
def test_equal_and_null_ids_give_an_exact_sample(spark, edge):
    n = 300_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, "same").otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 50_000).alias("v"),
        (F.col("id") % 2).alias("g"),
    )
    for wanted in (0, 1, 70_001, 120_000, n):
        taken = ranking.take_by_key(rows, ["g"], "k", F.lit(wanted), flag="t", edge_rows=edge)
        got = {r["g"]: (r["n"], r["t"]) for r in taken.groupBy("g").agg(F.count("*").alias("n"), F.sum("t").alias("t")).collect()}
        assert got == {g: (n // 2, min(wanted, n // 2)) for g in (0, 1)}
    # the same rows whatever the digits looked at, and in the order of the keys
    first, second = (
        ranking.take_by_key(rows, ["g"], "k", F.lit(60_000), edge_rows=e).groupBy("g", "k", "v").count().collect()
        for e in (edge, 1_000_000)
    )
    assert sorted(map(str, first)) == sorted(map(str, second))


def test_eight_million_rows_with_one_id(spark):
    rows = spark.range(8_000_000, numPartitions=16).select(F.lit("one").alias("k"), F.col("id").alias("v"))
    taken = ranking.take_by_key(rows, [], "k", F.lit(3_000_001))
    assert taken.count() == 3_000_001


def test_ks_p_value_equals_enumeration():
    rng = np.random.default_rng(1)
    for n, m in ((3, 4), (5, 5), (2, 7), (6, 4)):
        pooled = range(n + m)
        far = []
        for own in itertools.combinations(pooled, n):
            ends = [(sum(x <= t for x in own) / n, sum(x <= t for x in pooled if x not in own) / m) for t in pooled]
            far.append(max(abs(a - b) for a, b in ends))
        for d in [*rng.choice(sorted(set(far)), 4), 1.0]:
            share = sum(x >= d - 1e-12 for x in far) / len(far)
            assert drift.ks_p_value(float(d), n, m) == pytest.approx(share, abs=1e-12)
    assert drift.ks_p_value(0.0, 4, 5) == 1.0 and drift.ks_p_value(0.5, 0, 5) == 1.0


def test_exact_and_series_p_values_meet(monkeypatch):
    for d in (0.02, 0.03, 0.05):
        exact = drift.ks_p_value(d, 6000, 5000)
        monkeypatch.setattr(drift, "EXACT_ROWS", 10)
        assert exact == pytest.approx(drift.ks_p_value(d, 6000, 5000), rel=0.1)
        monkeypatch.undo()


def test_population_stability_by_hand(spark):
    reference = spark.createDataFrame([(float(i),) for i in range(100)], "a double")
    current = spark.createDataFrame(
        [(2003, float(i)) for i in range(100)] + [(2004, 5.0)] * 30 + [(2004, 95.5)] * 10 + [(2005, -1.0)], "year int, a double"
    )
    got = {r["year"]: r for r in drift.population_stability(reference, current, ["a"], [2003, 2004, 2005, 2006]).collect()}
    assert set(got) == {2003, 2004, 2005} and got[2003]["psi"] == pytest.approx(0.0) and got[2003]["n_bins"] == 10
    shares = [0.75, *[1e-4] * 8, 0.25]
    assert got[2004]["psi"] == pytest.approx(sum((q - 0.1) * math.log(q / 0.1) for q in shares))
    assert got[2005]["psi"] == pytest.approx((1 - 0.1) * math.log(10) + 9 * (1e-4 - 0.1) * math.log(1e-3))


def test_rollup_adds_up(spark):
    rows = [(2000 + i % 3, "ab"[i % 2] if i % 5 else None, "xyz"[i % 3], int(i % 4 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "year int, type string, state string, default int")
    out = profile.rate_rollup(df, ["year", "type", "state"]).collect()
    by_level = {lvl: [r for r in out if r["level"] == lvl] for lvl in range(4)}
    assert len(by_level[0]) == 1 and len(by_level[1]) == 3
    for level in by_level.values():
        assert sum(r["n_loans"] for r in level) == 200 and sum(r["n_default"] for r in level) == 50
    null_type = [r for r in by_level[2] if r["type"] is None]
    assert sum(r["n_loans"] for r in null_type) == sum(r[1] is None for r in rows)


def test_child_runs_log_every_parameter(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=200)
    rows = [(f"L{i}", float(v), int(v + rng.normal() > 0)) for i, v in enumerate(x)]
    points = spark.createDataFrame(rows, "loan_sequence_number string, x double, default int")
    space = {"decision_tree": {"max_depth": [2, 4], "min_samples_split": [9], "class_weight": [None]}}
    path = fresh_path(spark, "runs")
    found = search.train_search(points, ["decision_tree"], n_iter=2, spaces=space, log_path=path)
    child = runlog.read_log(spark, path).filter("parent_run_id IS NOT NULL AND kind = 'param'").collect()
    logged = {r["key"]: r["text_value"] for r in child}
    best = found.metadata["selected_best_params"]
    assert json.loads(logged["best_params"]) == best and logged["param_min_samples_split"] == "9"
    assert logged["param_max_depth"] == str(best["max_depth"]) and logged["param_class_weight"] is None


def plain_newton(x, y, a, c, penalised):
    """Newton's method on the whole matrix, scaled as the operator scales."""
    z = np.column_stack([(x - x.mean(axis=0)) / x.std(axis=0), np.ones(len(x))])
    ridge = np.append(np.ones(x.shape[1]), float(penalised))
    w = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-(z @ w)))
        w = w - np.linalg.solve(np.diag(ridge) + c * (z.T * (a * p * (1 - p))) @ z, ridge * w + c * z.T @ (a * (p - y)))
    return w[:-1] / x.std(axis=0), w[-1] - (w[:-1] / x.std(axis=0)) @ x.mean(axis=0)


@pytest.mark.parametrize("weighted, penalised", [(None, True), ("balanced", True), (None, False)])
def test_newton_coefficients_match_a_closed_check(spark, weighted, penalised):
    rng = np.random.default_rng(17)
    x = np.column_stack([rng.normal(5, 3, 500), rng.integers(0, 4, 500).astype(float)])
    y = (rng.random(500) < 1 / (1 + np.exp(-(0.4 * x[:, 0] - x[:, 1] - 1.5)))).astype(int)
    frame = spark.createDataFrame([(f"L{i}", *map(float, x[i]), int(y[i])) for i in range(500)], "id string, a double, b double, default int")
    train = models.training_frame(frame, ["a", "b"], "default")
    params = {"C": 0.3, "class_weight": weighted, "solver": "liblinear"}
    found = logistic.fit_newton(train, ["a", "b"], params, penalised)
    counts = np.bincount(y)
    a = np.where(y == 1, 500 / (2 * counts[1]), 500 / (2 * counts[0])) if weighted else np.ones(500)
    coefficients, intercept = plain_newton(x, y, a, 0.3, penalised)
    assert found.coefficients == pytest.approx(coefficients, rel=1e-6) and found.intercept == pytest.approx(intercept, rel=1e-6)
    if penalised:
        model = models.fit_family("logistic_regression", train, ["a", "b"], params)
        path = fresh_path(spark, "logit")
        model.save(spark, path)
        again = models.FittedModel.load(spark, path)
        rows = again.score(frame, ["id", "a"]).collect()
        want = 1 / (1 + np.exp(-(x @ coefficients + intercept)))
        assert [r["probability_default"] for r in rows] == pytest.approx(list(want), rel=1e-6)


def test_intercept_alone_is_the_root_of_its_equation(spark):
    frame = spark.createDataFrame([(f"L{i}", 1.0, int(i < 3)) for i in range(10)], "id string, a double, default int")
    train = models.training_frame(frame, ["a"], "default")
    found = logistic.fit_newton(train, ["a"], {"C": 2.0})
    # b + C (n p(b) - 3) = 0
    b = found.intercept + found.coefficients[0]
    assert b + 2.0 * (10 / (1 + math.exp(-b)) - 3) == pytest.approx(0.0, abs=1e-6)
