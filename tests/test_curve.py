"""Prefix sums, curve metrics, thresholds and exact selections against brute force."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlens.operators import bounded, curve, prefix, ranking
from loanlens.operators.scoring import minmax_score


def scored(spark, y, s):
    rows = [(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, s, strict=True))]
    return spark.createDataFrame(rows, "id long, actual_default int, probability_default double")


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def brute_points(y, s):
    points = []
    for t in sorted(set(s), reverse=True):
        hit = s >= t
        points.append((t, int((y[hit] == 1).sum()), int((y[hit] == 0).sum())))
    return points


def brute_ap(y, s):
    total, before, ap = y.sum(), 0.0, 0.0
    for _, tp, fp in brute_points(y, s):
        ap += (tp / total - before) * tp / (tp + fp)
        before = tp / total
    return ap


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(3)
    y = (rng.random(3000) < 0.3).astype(int)
    s = np.round(np.clip(rng.normal(0.4 + 0.15 * y, 0.2), 0, 1), 2)
    s[:1000] = 0.37
    return y, s


def test_curve_matches_brute_force(spark, sample):
    y, s = sample
    rows = curve.score_curve(scored(spark, y, s)).orderBy(F.desc("score")).collect()
    assert [(r["score"], r["tp"], r["fp"]) for r in rows] == brute_points(y, s)
    assert {(r["n_pos"], r["n_neg"]) for r in rows} == {(int(y.sum()), int((1 - y).sum()))}


def test_areas_and_thresholds(spark, sample):
    y, s = sample
    c = curve.score_curve(scored(spark, y, s))
    for strategy, beta in (("maximize_f1", 1.0), ("maximize_f2", 2.0)):
        row = curve.threshold_metrics(c, strategy).first()
        b2, best = beta**2, None
        for t, tp, fp in brute_points(y, s)[::-1]:
            p, r = tp / (tp + fp), tp / y.sum()
            f = (1 + b2) * p * r / (b2 * p + r + 1e-12)
            if best is None or f > best[0]:
                best = (f, t)
        assert row["threshold"] == best[1]
        hit = s >= best[1]
        assert row["recall"] == pytest.approx(y[hit].sum() / y.sum())
        assert row["precision"] == pytest.approx(y[hit].mean())
        assert row["accuracy"] == pytest.approx((hit == (y == 1)).mean())
        assert row["roc_auc"] == pytest.approx(brute_auc(y, s), abs=1e-12)
        assert row["average_precision"] == pytest.approx(brute_ap(y, s), abs=1e-12)
    fixed = curve.threshold_metrics(c, "fixed", 0.505).first()
    assert fixed["threshold"] == 0.505
    assert fixed["recall"] == pytest.approx(y[s >= 0.505].sum() / y.sum())
    floor = curve.recall_floor_threshold(c, 0.7).first()[0]
    assert floor == max(t for t, tp, _ in brute_points(y, s) if tp / y.sum() >= 0.7)
    with pytest.raises(ValueError, match="no threshold strategy"):
        curve.threshold_metrics(c, "best")


def test_auc_does_not_change_under_a_monotone_transform(spark, sample):
    y, s = sample
    areas = [
        curve.threshold_metrics(curve.score_curve(scored(spark, y, v))).first()["roc_auc"]
        for v in (s, np.exp(3 * s) - 5)
    ]
    assert areas[0] == pytest.approx(areas[1], abs=1e-12)


def test_single_class_equal_scores_and_no_rows(spark):
    one = curve.threshold_metrics(curve.score_curve(scored(spark, [0, 0, 0], [0.1, 0.2, 0.2]))).first()
    assert one["roc_auc"] is None and one["average_precision"] is None and one["threshold"] == 0.1
    flat = curve.threshold_metrics(curve.score_curve(scored(spark, [0, 1], [0.5, 0.5]))).first()
    assert flat["roc_auc"] == 0.5 and flat["threshold"] == 0.5
    none = curve.threshold_metrics(curve.score_curve(scored(spark, [], []))).collect()
    assert none[0]["threshold"] == 0.5 and none[0]["accuracy"] == 0.0


def test_single_class_years_are_left_out(spark):
    df = spark.createDataFrame(
        [(2003, 1, 1, 0.9), (2003, 0, 0, 0.1), (2004, 0, 0, 0.2), (None, 1, 1, 0.3)],
        "year int, actual_default int, prediction int, probability_default double",
    )
    rows = curve.metrics_by_group(df).collect()
    assert [(r["year"], r["roc_auc"], r["n_loans"]) for r in rows] == [(2003, 1.0, 2)]


def test_calibration_bins_are_right_closed(spark):
    df = scored(spark, [0, 1, 0, 1, 1, 0], [0.0, 0.05, 0.050001, 0.5, 1.0, 0.3])
    rows = {r["bucket"]: r["n_loans"] for r in curve.calibration(df).collect()}
    assert rows == {0: 2, 1: 1, 4: 1, 5: 1, 6: 1}


def test_minmax_of_a_constant_is_one_half(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 2.0)], "id int, d double")
    assert {r["probability_default"] for r in minmax_score(df, "d").collect()} == {0.5}


def test_running_sums_across_buckets(spark):
    rng = np.random.default_rng(5)
    values = sorted({round(float(v), 3) for v in rng.normal(size=2000)})
    rows = [("g", v, int(rng.integers(0, 9))) for v in values] + [("h", 1.5, 4)]
    df = spark.createDataFrame(rows, "g string, v double, n long")
    out = prefix.running_sums(df, ["g"], "v", ["n"], following=True, rows_per_bucket=50)
    got = {(r["g"], r["v"]): r for r in out.collect()}
    total, expected = 0, {}
    for i, (_, v, n) in enumerate(rows[:-1]):
        total += n
        expected[v] = (total, rows[i + 1][1] if i + 2 < len(rows) else None)
    for v, (upto, following) in expected.items():
        assert (got[("g", v)]["upto_n"], got[("g", v)]["next_v"]) == (upto, following)
        assert got[("g", v)]["all_n"] == total
    assert got[("h", 1.5)]["upto_n"] == 4


@pytest.mark.parametrize("size", [1, 2, 501, 5000])
def test_exact_medians_with_hot_values_and_nulls(spark, size):
    rng = np.random.default_rng(size)
    wide = rng.normal(5e5, 1e5, size)
    hot = np.where(rng.random(size) < 0.4, 7.0, rng.integers(0, 15, size)).astype(float)
    two = np.where(np.arange(size) < size // 2, 1.0, 2.0)
    rows = [(float(a), float(b), float(c), None) for a, b, c in zip(wide, hot, two, strict=True)]
    df = spark.createDataFrame(rows, "wide double, hot double, two double, none double").repartition(5)
    got = prefix.exact_medians(df, ["wide", "hot", "two", "none"], small=40)
    assert got["wide"] == np.median(wide)
    assert got["hot"] == np.median(hot)
    assert got["two"] == np.median(two)
    assert got["none"] is None


def key(i, seed):
    return hashlib.md5(f"{i}:{seed}".encode()).hexdigest()


def test_take_by_key_is_exact_per_group(spark):
    rows = [(i, "hot" if i % 3 else ("a" if i % 2 else None)) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, g string").repartition(7)
    got = ranking.take_by_key(df, ["g"], "id", F.ceil(F.col("n") * 0.2), seed=9)
    found = {}
    for r in got.collect():
        found.setdefault(r["g"], set()).add(r["id"])
    for g in ("hot", "a", None):
        ids = sorted((i for i, v in rows if v == g), key=lambda i: key(i, 9))
        assert found[g] == set(ids[: math.ceil(len(ids) * 0.2)])


def test_take_by_key_flag_is_a_partition_and_small_groups_are_whole(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(101)], "id long, g int")
    marked = ranking.take_by_key(df, ["g"], "id", F.lit(1000), flag="held")
    assert marked.filter("held = 1").count() == 101
    marked = ranking.take_by_key(df, [], "id", F.lit(10), flag="held")
    assert marked.count() == 101 and marked.filter("held = 1").count() == 10
    assert ranking.take_by_key(df, ["g"], "id", F.lit(0)).count() == 0


def test_attach_beyond_the_broadcast_bound(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i % 50) for i in range(500)], "id long, g int")
    side = spark.createDataFrame([(g, g * 2) for g in range(50)] + [(None, -1)], "g int, v int")
    small = bounded.attach(df, side, ["g"], "left")
    large = bounded.attach(df, side, ["g"], "left", max_rows=3)
    assert sorted(small.collect()) == sorted(large.select(*small.columns).collect())
    assert small.filter("v = -1").count() == 100


def test_duplicate_rows_of_a_key_made_of_copies(spark, monkeypatch):
    monkeypatch.setattr(ranking, "CHUNK", 10)
    rows = [("x", 1, "a")] * 95 + [("x", 2, "b")] * 3 + [("y", 1, "a"), (None, 1, "a"), (None, 0, "a")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    got = sorted(map(tuple, ranking.duplicate_rows(df, "k", ["o"]).collect()), key=str)
    expected = [("x", 1, "a")] * 94 + [("x", 2, "b")] * 3 + [(None, 1, "a")]
    assert got == sorted(expected, key=str)


def test_best_candidate_rules(spark):
    rows = [
        ("a", 0, 0, 0.5), ("a", 0, 1, 0.7), ("a", 0, 2, 0.7), ("b", 1, 0, None), ("b", 1, 1, 0.7),
        ("c", 2, 0, None),
    ]
    df = spark.createDataFrame(rows, "model_family string, family_idx int, candidate_idx int, m double")
    out = {(r["model_family"], r["candidate_idx"]): r for r in ranking.best_candidates(df, "m").collect()}
    assert {k for k, r in out.items() if r["is_best_candidate"]} == {("a", 1), ("b", 1)}
    assert {k for k, r in out.items() if r["is_selected"]} == {("a", 1)}


@pytest.mark.parametrize("small", [0, 40])
def test_medians_read_ranks_not_fractions(spark, small):
    inf = float("inf")
    tails = [0.0] * 15 + [1.0] + [1e18] * 14
    ends = [-inf, -inf, -inf, 1.0, 2.0] + [None] * 25
    upper = [1.0, inf, inf, float("nan"), 0.0] + [None] * 25
    df = spark.createDataFrame(list(zip(tails, ends, upper, strict=True)), "a double, b double, c double")
    assert prefix.exact_medians(df, ["a", "b", "c"], small=small) == {"a": 0.5, "b": -inf, "c": inf}


def test_hot_score_leaves_distinct_scores_in_many_buckets(spark):
    rows = [(0.5,)] * 20_000 + [(i / 400,) for i in range(401)]
    counts = spark.createDataFrame(rows, "s double").groupBy("s").agg(F.count("*").alias("n"))
    placed = prefix.with_buckets(counts, [], "s", rows_per_bucket=20)
    sizes = [r["count"] for r in placed.groupBy("_bucket").count().collect()]
    assert len(sizes) >= 20 and max(sizes) <= 45


def test_null_group_has_a_curve_of_its_own(spark):
    rows = [("a", 0.9, 1), ("a", 0.1, 0), (None, 0.8, 1), (None, 0.2, 0)]
    df = spark.createDataFrame(rows, "g string, probability_default double, actual_default int")
    for size in (1, 1_000_000):
        got = curve.score_curve(df, groups=["g"], rows_per_bucket=size).collect()
        assert sorted((r["g"] or "", r["score"], r["tp"], r["fp"]) for r in got) == [
            ("", 0.2, 1, 1), ("", 0.8, 1, 0), ("a", 0.1, 1, 1), ("a", 0.9, 1, 0)
        ]
    df = df.withColumn("prediction", (F.col("probability_default") > 0.5).cast("int"))
    assert curve.metrics_by_group(df, "g").count() == 2


def test_reported_fbeta_keeps_its_beta(spark):
    rows = [(0.9, 1), (0.7, 0), (0.6, 1), (0.4, 0), (0.3, 1)]
    scored = spark.createDataFrame(rows, "probability_default double, actual_default int")
    points = curve.score_curve(scored)
    one = curve.threshold_metrics(points, "maximize_f1", beta=2.0).first()
    fixed = curve.threshold_metrics(points, "fixed", one["threshold"], beta=2.0).first()
    assert one["beta"] == 2.0 and one["fbeta"] == fixed["fbeta"] != one["f1"]


def test_whole_numbers_in_any_form(spark):
    from loanlens.functions.scalars import to_integer

    texts = ["1e2", "2.0e2", "1.2345678E7", "9007199254740993", "1.5", "1e30", "x", None, " 7.0 "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(to_integer(F.col("t"))).collect()]
    assert got == [100, 200, 12345678, 9007199254740993, None, None, None, None, 7]
    df = spark.createDataFrame([(12345678.0,), (0.5,)], "d double")
    assert [r[0] for r in df.select(to_integer(F.col("d"))).collect()] == [12345678, None]
