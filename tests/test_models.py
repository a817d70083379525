"""Features, models, search, attribution, drift and the stream."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from loanlens.operators import drift, features
from loanlens.operators.attribution import attribution_summary, attributions, importance
from loanlens.operators.curve import labelled_metrics
from loanlens.operators.models import SCORE, SPACES, FittedModel, candidates, fit_family, training_frame
from loanlens.operators.scoring import infer, score_rows
from loanlens.operators.search import evaluate, train_search
from loanlens.plans.model_queries import LOGIT
from loanlens.roles import LOAN_ROLES
from loanlens.session import fresh_path
from loanlens.sources import runlog
from loanlens.streaming.scoring import score_stream

ID = LOAN_ROLES.loan_id

# Small settings: the queries use the full spaces.
SMALL = {
    "logistic_regression": {"C": [0.01, 1.0], "class_weight": [None], "max_iter": [100]},
    "decision_tree": {
        "criterion": ["gini", "entropy"],
        "max_depth": [5],
        "min_samples_leaf": [10],
        "max_features": [None],
        "class_weight": ["balanced"],
    },
    "random_forest": {
        "n_estimators": [20],
        "criterion": ["gini"],
        "max_depth": [5],
        "min_samples_leaf": [5],
        "max_features": ["sqrt"],
        "bootstrap": [True],
        "class_weight": [None],
    },
    "extra_trees": {
        "n_estimators": [20],
        "criterion": ["gini"],
        "max_depth": [5],
        "min_samples_leaf": [5],
        "max_features": [2],
        "bootstrap": [False],
        "class_weight": [None],
    },
    "gradient_boosting": {
        "n_estimators": [10],
        "learning_rate": [0.2],
        "max_depth": [3],
        "min_samples_leaf": [10],
        "subsample": [0.8],
        "max_features": [None],
    },
    "hist_gradient_boosting": {
        "max_iter": [10],
        "learning_rate": [0.2],
        "max_depth": [3],
        "min_samples_leaf": [20],
    },
}


@pytest.fixture(scope="module")
def ten_rows(spark):
    scores = [700.0, None, 650.0, 720.0, None, 600.0, 710.0, 680.0, 690.0, 640.0]
    rows = [
        (f"F{i:03d}", s, 200503, 203502, "OIS"[i % 3], "s", "v", 0, int(i < 3))
        for i, s in enumerate(scores)
    ]
    return spark.createDataFrame(
        rows,
        f"{ID} string, credit_score double, first_payment_date int, maturity_date int, "
        "occupancy_status string, seller_name string, servicer_name string, msa int, default int",
    )


def test_date_features_and_id(ten_rows):
    out = features.stateless_features(ten_rows)
    row = out.first()
    assert (row["first_payment_date_year"], row["first_payment_date_month"]) == (2005, 3)
    assert row["loan_term_months"] == 359
    assert out.columns[0] == ID and "seller_name" not in out.columns and "msa" not in out.columns


def test_split_is_disjoint_and_sized(ten_rows):
    out = features.stratified_split(ten_rows.withColumn("one", F.lit(1)), 0.2, ID, "one")
    held = out.filter("is_validation = 1").count()
    assert held == 2 and out.select(ID).distinct().count() == 10


def test_transformers_learn_on_train_only(spark, ten_rows):
    train = features.stateless_features(ten_rows)
    t = features.fit_transformers(train)
    assert t.medians["credit_score"] == 685.0 and "default" not in t.medians
    assert t.classes["occupancy_status"] == ["I", "O", "S", "unknown"]
    new = train.limit(2).withColumn("occupancy_status", F.lit("Z")).drop("default")
    new = new.withColumn("credit_score", F.lit(None).cast("double"))
    row = features.apply_transformers(new, t).first()
    assert (row["occupancy_status"], row["credit_score"]) == (3, 685.0)
    path = fresh_path(spark, "t")
    t.save(spark, path)
    assert features.Transformers.load(spark, path) == t


def test_null_is_a_class_and_observed_unknown_keeps_its_place(spark):
    train = spark.createDataFrame([("x",), ("unknown",), (None,)], "channel string")
    t = features.Transformers({}, *features.fit_classes(train, ["channel"]))
    assert t.classes["channel"] == ["<NA>", "unknown", "x"]
    new = spark.createDataFrame([("x",), ("new",), (None,)], "channel string")
    assert [r[0] for r in features.encode_labels(new, t).collect()] == [2, 1, 0]


def test_one_hot_has_no_column_for_unseen(ten_rows):
    t = features.fit_transformers(features.stateless_features(ten_rows))
    new = ten_rows.withColumn("occupancy_status", F.lit("Z"))
    out = features.one_hot(new.select(ID, "occupancy_status"), t, ["occupancy_status"])
    assert out.columns == [ID, "occupancy_status_I", "occupancy_status_O", "occupancy_status_S"]
    assert out.agg(F.sum(F.col("occupancy_status_I") + F.col("occupancy_status_O"))).first()[0] == 0


def test_modes_standardise_weights_and_undersample(spark):
    df = spark.createDataFrame(
        [("a", "y", 1.0, 0), ("b", "x", 2.0, 0), ("c", "x", 3.0, 0), ("d", "y", 6.0, 1), ("e", None, 3.0, 0)],
        "id string, c string, v double, default int",
    )
    assert features.modes(df, ["c"]) == {"c": "x"}
    z = [r["v"] for r in features.standardise(df, ["v"]).orderBy("id").collect()]
    v = np.array([1.0, 2, 3, 6, 3])
    assert z == pytest.approx(list((v - v.mean()) / v.std()))
    w = {r["default"]: r["class_weight"] for r in features.class_weights(df, "default").collect()}
    assert w == {0: 5 / 8, 1: 5 / 2}
    assert features.undersample(df, "default", "id").groupBy("default").count().count() == 2
    assert features.undersample(df, "default", "id").count() == 2


def test_space_sizes_and_candidates():
    assert math.prod(len(v) for v in SPACES["logistic_regression"].values()) == 360
    drawn = candidates(SPACES["random_forest"], 5, 42)
    assert drawn == candidates(SPACES["random_forest"], 5, 42)
    assert len({str(d) for d in drawn}) == 5
    assert len(candidates({"a": [1, 2]}, 5, 1)) == 2


NAMES = ["x1", "x2", "x3"]


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(600, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(scale=0.7, size=600) > 0.6).astype(int)
    rows = [(f"L{i:04d}", *map(float, x[i]), int(y[i])) for i in range(600)]
    return spark.createDataFrame(rows, f"{ID} string, x1 double, x2 double, x3 double, default int").cache()


@pytest.mark.parametrize("family", list(SMALL))
def test_every_family_learns(points, family):
    params = {k: v[0] for k, v in SMALL[family].items()}
    model = fit_family(family, training_frame(points, NAMES, "default"), NAMES, params)
    out = model.score(points, [ID, "default"])
    row = out.groupBy("default").agg(F.avg(SCORE).alias("m")).collect()
    mean = {r["default"]: r["m"] for r in row}
    assert mean[1] > mean[0] + 0.15
    assert out.filter(f"{SCORE} < 0 OR {SCORE} > 1 OR {SCORE} IS NULL").count() == 0


def test_save_and_load_score_alike(spark, points):
    params = {k: v[0] for k, v in SMALL["extra_trees"].items()}
    model = fit_family("extra_trees", training_frame(points, NAMES, "default"), NAMES, params)
    path = fresh_path(spark, "model")
    model.save(spark, path)
    again = FittedModel.load(spark, path)
    a, b = (sorted(map(tuple, m.score(points, [ID]).collect())) for m in (model, again))
    assert a == b


def test_search_evaluate_and_log(spark, points):
    path = fresh_path(spark, "runs")
    found = train_search(
        points.withColumn("text", F.lit("t")),
        ["logistic_regression", "decision_tree"],
        n_iter=2,
        spaces=SMALL,
        log_path=path,
    )
    rows = found.results.collect()
    assert len(rows) == 4 and sum(r["is_best_candidate"] for r in rows) == 2
    best = [r for r in rows if r["is_selected"]]
    assert len(best) == 1 and best[0]["val_f1"] == max(r["val_f1"] for r in rows)
    assert found.model.threshold == best[0]["selected_threshold"]
    assert found.metadata["dropped_non_numeric_columns"] == ["text"]
    metrics, predictions = evaluate(found.model, points, log_path=path)
    assert metrics.first()["roc_auc"] > 0.8 and predictions.count() == 600
    log = runlog.search_runs(runlog.read_log(spark, path), "model_search", ["val_f1", "final_test_roc_auc"])
    got = {r["run_id"]: r for r in log.collect()}
    assert got[found.metadata["run_id"]]["final_test_roc_auc"] == metrics.first()["roc_auc"]
    children = [r for r in got.values() if r["parent_run_id"] == found.metadata["run_id"]]
    assert len(children) == 2
    scored = infer(points, found.model)
    tally, flagged = labelled_metrics(scored, points, ID)
    row = tally.first()
    assert row["true_positives"] + row["false_negatives"] == points.filter("default = 1").count()
    assert flagged.filter("is_correct").count() / 600 == pytest.approx(row["accuracy"])


def test_search_refuses_bad_input(points):
    with pytest.raises(ValueError, match="has no target"):
        train_search(points.drop("default"))
    with pytest.raises(ValueError, match="one class only"):
        train_search(points.filter("default = 1"))
    with pytest.raises(ValueError, match="no model family"):
        train_search(points, ["nearest_neighbour"])
    with pytest.raises(ValueError, match="selection_metric"):
        train_search(points, selection_metric="f1")


class Linear:
    features = NAMES
    family = "linear"
    threshold = 0.5
    slopes = dict(x1=2.0, x2=-1.0, x3=0.0)

    def score(self, df, keep=()):
        total = sum((F.col(c) * b for c, b in self.slopes.items()), F.lit(0.25))
        return df.select(*keep, total.alias(SCORE))


class Product(Linear):
    def score(self, df, keep=()):
        return df.select(*keep, (F.col("x1") * F.col("x2") + F.col("x3")).alias(SCORE))


def test_attribution_of_a_linear_model(spark, points):
    phi = attributions(points, Linear(), ID, sample_size=20, background_size=10).collect()
    rows = {r[ID]: r for r in points.collect()}
    ids = {r[ID] for r in phi}
    assert len(ids) == 20 and len(phi) == 60
    differences = {}
    for r in phi:
        base = rows[r[ID]][r["feature"]] * Linear.slopes[r["feature"]] - r["phi"]
        differences.setdefault(r["feature"], []).append(base)
    for values in differences.values():
        assert np.ptp(values) < 1e-9


def test_attributions_add_up(spark, points):
    phi = attributions(points, Product(), ID, sample_size=15, background_size=8, passes=2)
    sums = phi.groupBy(ID).agg(F.sum("phi").alias("s")).collect()
    rows = {r[ID]: r["x1"] * r["x2"] + r["x3"] for r in points.collect()}
    bases = [rows[r[ID]] - r["s"] for r in sums]
    assert len(bases) == 15 and np.ptp(bases) < 1e-9
    ranked = importance(phi).orderBy(F.desc("mean_abs_shap")).collect()
    top = attribution_summary(phi, ID, "product").first()
    assert top["top_feature"] == ranked[0]["feature"] and top["n_rows_explained"] == 15


def brute_ks_w1(a, b):
    grid = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    return np.abs(fa - fb).max(), (np.abs(fa - fb)[:-1] * np.diff(grid)).sum()


def test_numeric_drift_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    ref = rng.normal(size=(800, 2))
    cur = {2003: rng.normal(0.3, 1, (500, 2)), 2004: rng.normal(0, 2, (300, 2))}
    for m in (ref, *cur.values()):
        m[:, 1] = np.round(m[:, 1], 1)
    r = spark.createDataFrame([tuple(map(float, v)) for v in ref], "a double, b double")
    c = spark.createDataFrame(
        [(y, *map(float, v)) for y, m in cur.items() for v in m], "year int, a double, b double"
    )
    got = {(x["year"], x["feature"]): x for x in drift.numeric_drift(r, c, ["a", "b"], [2003, 2004, 2005]).collect()}
    assert len(got) == 4
    for (year, feature), row in got.items():
        i = "ab".index(feature)
        ks, w1 = brute_ks_w1(ref[:, i], cur[year][:, i])
        assert row["ks"] == pytest.approx(ks, abs=1e-12)
        assert row["wasserstein"] == pytest.approx(w1, abs=1e-9)
        assert row["wasserstein_normed"] == pytest.approx(w1 / ref[:, i].std(), abs=1e-9)
        assert row["n_current"] == len(cur[year])


def test_categorical_drift_and_p_values(spark):
    ref = ["a"] * 60 + ["b"] * 30 + ["c"] * 10
    cur = ["a"] * 20 + ["b"] * 20 + ["c"] * 10
    r = spark.createDataFrame([(v,) for v in ref], "k string")
    c = spark.createDataFrame([(2003, v) for v in cur] + [(2004, "z")], "year int, k string")
    rows = {x["year"]: x for x in drift.categorical_drift(r, c, ["k"], [2003, 2004]).collect()}
    p, q = np.array([0.6, 0.3, 0.1]), np.array([0.4, 0.4, 0.2])
    m = (p + q) / 2
    js = math.sqrt(((p * np.log(p / m)).sum() + (q * np.log(q / m)).sum()) / 2)
    assert rows[2003]["jensenshannon"] == pytest.approx(js)
    chi = (((q - p) * 50) ** 2 / (p * 50)).sum()
    assert rows[2003]["chisquare"] == pytest.approx(chi) and rows[2003]["degrees"] == 2
    assert math.isinf(rows[2004]["chisquare"])
    assert drift.chi_square_p_value(chi, 2) == pytest.approx(math.exp(-chi / 2))
    assert drift.chi_square_p_value(3.841458820694124, 1) == pytest.approx(0.05)
    assert drift.chi_square_p_value(7.814727903251179, 3) == pytest.approx(0.05)
    found = drift.feature_drift(r, c, [], ["k"], [2003, 2004], categorical_test="chisquare")
    assert {x["year"]: x["drift_detected"] for x in found.collect()} == {2003: True, 2004: True}
    summary = drift.dataset_drift(found).orderBy("year").first()
    assert summary["share_drifted"] == 1.0 and summary["dataset_drift_detected"]


RAW = [
    ("F05Q10000001", "720", "200503", "203502", "80", "P", "R"),
    ("F05Q10000002", "9999", "200505", "203504", "97", "9", "b"),
    ("F05Q10000003", "800", "2005xx", "203504", "999", "I", None),
]
RAW_SCHEMA = (
    f"{ID} string, credit_score string, first_payment_date string, maturity_date string, "
    "original_ltv string, occupancy_status string, channel string"
)


def test_stream_equals_batch_and_threshold_zero_counts(spark):
    raw = spark.createDataFrame(RAW, RAW_SCHEMA)
    t = features.Transformers({"credit_score": 700.0, "original_ltv": 75.0}, {"occupancy_status": ["I", "P", "UNKNOWN", "unknown"]})
    batch = score_rows(raw, LOGIT, t)
    assert "Exchange" not in batch._jdf.queryExecution().executedPlan().toString()
    source, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    raw.write.parquet(source)
    arrivals = spark.readStream.schema(raw.schema).parquet(source)
    score_stream(arrivals, LOGIT, t, out, fresh_path(spark, "cp")).awaitTermination()
    assert sorted(spark.read.parquet(out).collect()) == sorted(batch.collect())
    zero = score_rows(raw, LOGIT, t, threshold=0.0)
    assert {r["prediction"] for r in zero.collect()} == {1} and zero.first()["threshold"] == 0.0
    no_id = score_rows(raw.drop(ID), LOGIT, t)
    assert no_id.columns == batch.columns and {r[ID] for r in no_id.collect()} == {None}


def test_label_only_model_has_null_probability(points):
    train = training_frame(points, NAMES, "default")
    stages = Pipeline(stages=[VectorAssembler(inputCols=NAMES, outputCol="features"), LinearSVC(maxIter=10)])
    model = FittedModel("linear_svc", NAMES, stages.fit(train), [])
    rows = infer(points, model).collect()
    assert {r[SCORE] for r in rows} == {None} and {r["prediction"] for r in rows} == {0, 1}


def test_model_queries_draw_from_the_full_spaces(monkeypatch):
    import inspect
    from types import SimpleNamespace

    from loanlens.operators.models import SPACES
    from loanlens.plans import QUERIES, model_queries

    class Stop(Exception):
        pass

    def record(*args, **kwargs):
        calls.append(kwargs)
        raise Stop

    class Rows:
        def __getattr__(self, name):
            return lambda *args, **kwargs: self

    calls: list[dict] = []
    full = {k: p.default for k, p in inspect.signature(train_search).parameters.items()}
    shown = {k: p.default for k, p in inspect.signature(model_queries.explain).parameters.items()}
    assert full["spaces"] is SPACES and full["n_iter"] == 5
    assert (shown["sample_size"], shown["background_size"]) == (500, 50)
    monkeypatch.setattr(model_queries, "train_search", record)
    rows = Rows()
    rows.TRAIN_UNTIL = 0
    monkeypatch.setattr(model_queries, "V", rows)
    monkeypatch.setattr(model_queries, "_split", lambda rows: (rows, rows))
    monkeypatch.setattr(model_queries, "features", Rows())
    monkeypatch.setattr(model_queries, "fresh_path", lambda *args: "model")
    monkeypatch.setattr(model_queries, "F", SimpleNamespace(col=lambda name: 0))
    names = ["q_search", "q_evaluate", "q_model_store", "q_importance", *[f"q_train_{f}" for f in SPACES]]
    for name in names:
        with pytest.raises(Stop):
            QUERIES[name].build(None, "")
    assert [c.get("models") for c in calls[4:]] == [[f] for f in SPACES]
    # every other setting is the operator's own
    assert all(set(c) <= {"models"} for c in calls) and "models" not in calls[0]
    monkeypatch.setattr(model_queries, "_winner", lambda *args: None)
    monkeypatch.setattr(model_queries, "explain", record)
    with pytest.raises(Stop):
        QUERIES["q_importance"].build(None, "")
    assert calls[-1] == {}
