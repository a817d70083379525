"""Queries over the score curve, metrics, thresholds and attached outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.operators import curve, ranking
from loanlens.operators.scoring import minmax_score
from loanlens.plans import frames as V
from loanlens.plans.oracle import with_frames
from loanlens.plans.registry import query
from loanlens.plans.views import table, view
from loanlens.roles import LOAN_ROLES

ID = LOAN_ROLES.loan_id
SCORE = "probability_default"


def curve_sql(source: str, group: str | None = None) -> str:
    """Cumulative counts per distinct score, in window form."""
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    counts = (
        f"SELECT {g}probability_default AS score, CAST(sum(actual_default) AS BIGINT) AS "
        f"positives, CAST(sum(1 - actual_default) AS BIGINT) AS negatives FROM {source} "
        f"GROUP BY {g}probability_default"
    )
    return (
        "SELECT *, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision, "
        "coalesce(CAST(tp AS DOUBLE) / nullif(n_pos, 0), 1) AS recall FROM (SELECT *, "
        f"CAST(sum(positives) OVER ({part}ORDER BY score DESC) AS BIGINT) AS tp, "
        f"CAST(sum(negatives) OVER ({part}ORDER BY score DESC) AS BIGINT) AS fp, "
        f"CAST(sum(positives) OVER ({part}) AS BIGINT) AS n_pos, "
        f"CAST(sum(negatives) OVER ({part}) AS BIGINT) AS n_neg FROM ({counts}) c) w"
    )


AUC = (
    "sum(CAST(negatives AS DOUBLE) * (tp - positives / 2.0::DOUBLE)) / "
    "nullif(CAST(max(n_pos) AS DOUBLE) * max(n_neg), 0)"
)
AP = "sum(CAST(positives AS DOUBLE) * precision) / nullif(max(n_pos), 0)"
CELLS = (
    "count(*) FILTER (prediction = 0 AND actual_default = 0) AS tn, "
    "count(*) FILTER (prediction = 1 AND actual_default = 0) AS fp, "
    "count(*) FILTER (prediction = 0 AND actual_default = 1) AS fn, "
    "count(*) FILTER (prediction = 1 AND actual_default = 1) AS tp"
)
LABELS = {
    "accuracy": "(tp + tn) / nullif(CAST(tp + tn + fp + fn AS DOUBLE), 0)",
    "precision": "tp / nullif(CAST(tp + fp AS DOUBLE), 0)",
    "recall": "tp / nullif(CAST(tp + fn AS DOUBLE), 0)",
    "f1": "2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0)",
    "fbeta": "5 * tp / nullif(CAST(5 * tp + fp + 4 * fn AS DOUBLE), 0)",
}


def label_sql(*names: str) -> str:
    return ", ".join(f"round(coalesce({LABELS[n]}, 0), 6) AS {n}" for n in names)


def rounded(df: DataFrame, *skip: str) -> DataFrame:
    doubles = [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, 6) for c in doubles if c not in skip})


def _lines_curve(spark: SparkSession, sf_dir: str, groups=()) -> DataFrame:
    return curve.score_curve(V.line_scores(spark, sf_dir), groups=groups)


@query(
    "q_score_curve",
    with_frames(
        "SELECT year, round(score, 6) AS score, positives, negatives, tp, fp, n_pos, n_neg FROM c",
        "line_scores",
        c=curve_sql("line_scores", "year"),
    ),
)
def score_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines_curve(spark, sf_dir, ["year"]).drop("precision", "recall")
    return rounded(rows)


@query(
    "q_pr_curve",
    with_frames(
        "SELECT round(score, 6) AS score, round(precision, 6) AS precision, "
        "round(recall, 6) AS recall FROM c",
        "line_scores",
        c=curve_sql("line_scores"),
    ),
)
def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_lines_curve(spark, sf_dir).select("score", "precision", "recall"))


@query(
    "q_auc",
    with_frames(
        f"SELECT year, round({AUC}, 6) AS roc_auc FROM c GROUP BY year",
        "line_scores",
        c=curve_sql("line_scores", "year"),
    ),
)
def auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines_curve(spark, sf_dir, ["year"])
    return rounded(rows.groupBy("year").agg(curve.auc_column().alias("roc_auc")))


@query(
    "q_average_precision",
    with_frames(
        f"SELECT round({AP}, 6) AS average_precision FROM c",
        "line_scores",
        c=curve_sql("line_scores"),
    ),
)
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines_curve(spark, sf_dir)
    return rounded(rows.agg(curve.average_precision_column().alias("average_precision")))


@query(
    "q_confusion",
    with_frames(
        "SELECT year, tn AS true_negatives, fp AS false_positives, fn AS false_negatives, "
        f"tp AS true_positives FROM (SELECT year, {CELLS} FROM predictions GROUP BY year) t",
        "predictions",
    ),
)
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve.confusion(V.predictions(spark, sf_dir), groups=["year"])


@query(
    "q_label_metrics",
    with_frames(
        f"SELECT {label_sql(*LABELS)} FROM (SELECT {CELLS} FROM predictions) t", "predictions"
    ),
)
def label_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = curve.confusion(V.predictions(spark, sf_dir))
    return rounded(curve.with_label_metrics(counts).select(*LABELS))


_BY_YEAR = (
    "SELECT b.year, b.n_loans, round(b.default_rate, 6) AS default_rate, "
    "round(a.roc_auc, 6) AS roc_auc, "
    + label_sql("recall", "precision", "f1").replace("tp", "b.tp").replace("fn", "b.fn").replace("fp", "b.fp")
    + " FROM b JOIN a ON a.year = b.year WHERE a.roc_auc IS NOT NULL"
)


def _by_year(body: str) -> str:
    return with_frames(
        body,
        "predictions",
        c=curve_sql("predictions", "year"),
        a=f"SELECT year, {AUC} AS roc_auc FROM c GROUP BY year",
        b=f"SELECT year, count(*) AS n_loans, avg(actual_default) AS default_rate, {CELLS} "
        "FROM predictions GROUP BY year",
    )


@query("q_metrics_by_year", _by_year(_BY_YEAR))
def metrics_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(curve.metrics_by_group(V.predictions(spark, sf_dir)))


@query("q_argmin_year", _by_year(f"SELECT year, roc_auc FROM ({_BY_YEAR}) m ORDER BY roc_auc, year LIMIT 1"))
def argmin_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_year = rounded(curve.metrics_by_group(V.predictions(spark, sf_dir)))
    return ranking.worst_group(by_year, "year", "roc_auc")


_BINS = list(zip(curve.CALIBRATION_EDGES[:-1], curve.CALIBRATION_EDGES[1:]))
_BIN = " ".join(
    f"WHEN probability_default >{'=' if i == 0 else ''} {lo}::DOUBLE AND probability_default <= "
    f"{hi}::DOUBLE THEN {i}"
    for i, (lo, hi) in enumerate(_BINS)
)


@query(
    "q_calibration",
    with_frames(
        "SELECT CAST(bucket AS INTEGER) AS bucket, count(*) AS n_loans, "
        "round(avg(actual_default), 6) AS actual_default_rate, "
        "round(avg(probability_default), 6) AS mean_predicted_prob FROM (SELECT *, CASE "
        f"{_BIN} END AS bucket FROM line_scores) t WHERE bucket IS NOT NULL GROUP BY bucket",
        "line_scores",
    ),
)
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(curve.calibration(V.line_scores(spark, sf_dir)).drop("lower", "upper"))


def _period(years: str) -> str:
    return (
        f"SELECT {label_sql('recall', 'precision', 'f1')}, (SELECT round({AUC}, 6) FROM "
        f"({curve_sql(f'(SELECT * FROM predictions WHERE {years}) p')}) c) AS roc_auc "
        f"FROM (SELECT {CELLS} FROM predictions WHERE {years}) t"
    )


_GAP_METRICS = ("roc_auc", "recall", "precision", "f1")


@query(
    "q_gap",
    with_frames(
        " UNION ALL ".join(
            f"SELECT '{m}' AS metric, v.{m} AS validation, t.{m} AS test, "
            f"round((v.{m} - t.{m}) / v.{m} * 100, 6) AS degradation_pct FROM v CROSS JOIN t"
            for m in _GAP_METRICS
        ),
        "predictions",
        v=_period("year <= 1997"),
        t=_period("year >= 1998"),
    ),
)
def gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.predictions(spark, sf_dir)
    early = F.when(F.col("year") <= V.TRAIN_UNTIL, "validation").otherwise("test")
    periods = rows.withColumn("period", early)
    scored = curve.score_curve(periods, groups=["period"])
    measured = rounded(curve.threshold_metrics(scored, "fixed", 0.5, groups=["period"]))
    parts = [measured.filter(F.col("period") == p) for p in ("validation", "test")]
    return rounded(curve.metric_gap(*parts, _GAP_METRICS))


@query(
    "q_labelled_eval",
    with_frames(
        "SELECT tn AS true_negatives, fp AS false_positives, fn AS false_negatives, "
        "tp AS true_positives, tn + fp + fn + tp AS n_rows, "
        "round((tp + fn) / CAST(tn + fp + fn + tp AS DOUBLE), 6) AS actual_default_rate, "
        "round((tp + fp) / CAST(tn + fp + fn + tp AS DOUBLE), 6) AS predicted_default_rate, "
        f"{label_sql('accuracy', 'precision', 'recall', 'f1')}, "
        f"(SELECT round({AP}, 6) FROM c) AS average_precision, "
        f"(SELECT round({AUC}, 6) FROM c) AS roc_auc "
        f"FROM (SELECT {CELLS} FROM predictions) t",
        "predictions",
        c=curve_sql("predictions"),
    ),
)
def labelled_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = V.predictions(spark, sf_dir).select(ID, SCORE, "prediction")
    metrics, _ = curve.labelled_metrics(scored, V.target(spark, sf_dir), ID)
    return rounded(metrics)


@query(
    "q_labelled_rows",
    "SELECT d.doc_id, l.toxic AS actual_default, CASE WHEN (d.doc_id * 7919 % 1000) / "
    "1000.0::DOUBLE >= 0.5 THEN 1 ELSE 0 END AS prediction, (CASE WHEN (d.doc_id * 7919 % 1000) / "
    "1000.0::DOUBLE >= 0.5 THEN 1 ELSE 0 END) = l.toxic AS is_correct "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
)
def labelled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    score = F.pmod(F.col("doc_id") * 7919, F.lit(1000)) / 1000
    scored = docs.select("doc_id", score.alias(SCORE), (score >= 0.5).cast("int").alias("prediction"))
    _, rows = curve.labelled_metrics(scored, table(spark, sf_dir, "labels"), "doc_id", "toxic")
    return rows.select("doc_id", "actual_default", "prediction", "is_correct")


@query(
    "q_prediction_summary",
    with_frames(
        "SELECT count(*) AS n_loans, count(*) FILTER (prediction = 1) AS predicted_default, "
        "count(*) FILTER (prediction = 0) AS predicted_paid, "
        "round(avg(prediction), 6) AS predicted_default_rate, 'fixed_score' AS "
        "selected_model_family, CAST(0.5 AS DOUBLE) AS threshold FROM predictions",
        "predictions",
    ),
)
def prediction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.predictions(spark, sf_dir).withColumns(
        {"selected_model_family": F.lit("fixed_score"), "threshold": F.lit(0.5)}
    )
    return rounded(curve.prediction_summary(rows))


@query(
    "q_class_guard",
    with_frames(
        "SELECT 'all' AS slice, count(DISTINCT actual_default) >= 2 AS passed FROM predictions "
        "UNION ALL SELECT 'paid', count(DISTINCT actual_default) >= 2 FROM predictions "
        "WHERE actual_default = 0",
        "predictions",
    ),
)
def class_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the guard lets all predictions pass, and those of one class."""
    rows = V.predictions(spark, sf_dir)
    found = []
    for name, part in (("all", rows), ("paid", rows.filter("actual_default = 0"))):
        try:
            curve.require_two_classes(part, "actual_default", name)
            found.append((name, True))
        except ValueError:
            found.append((name, False))
    return spark.createDataFrame(found, "slice string, passed boolean")


# Thresholds


def _best(b2: float) -> str:
    f = f"(1 + {b2}::DOUBLE) * precision * recall / ({b2}::DOUBLE * precision + recall + 1e-12::DOUBLE)"
    return (
        f"SELECT year, score, tp, fp, n_pos, n_neg FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY year ORDER BY {f} DESC, score) AS rn FROM c) t WHERE rn = 1"
    )


def _at_threshold(b2: int, beta: float) -> str:
    return (
        f"SELECT m.year, round(m.score, 6) AS threshold, CAST({beta} AS DOUBLE) AS beta, "
        "round((tp + n_neg - fp) / CAST(n_pos + n_neg AS DOUBLE), 6) AS accuracy, "
        "round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision, "
        "round(tp / CAST(n_pos AS DOUBLE), 6) AS recall, "
        "round(2 * tp / CAST(tp + fp + n_pos AS DOUBLE), 6) AS f1, "
        f"round({1 + b2} * tp / CAST(tp + fp + {b2} * n_pos AS DOUBLE), 6) AS fbeta, "
        "round(a.ap, 6) AS average_precision, round(a.auc, 6) AS roc_auc "
        "FROM m JOIN a ON a.year = m.year"
    )


def _threshold_sql(b2: int, beta: float, best: str) -> str:
    return with_frames(
        _at_threshold(b2, beta),
        "line_scores",
        c=curve_sql("line_scores", "year"),
        a=f"SELECT year, {AP} AS ap, {AUC} AS auc FROM c GROUP BY year",
        m=best,
    )


def _thresholds(spark: SparkSession, sf_dir: str, strategy: str, **kw) -> DataFrame:
    rows = _lines_curve(spark, sf_dir, ["year"])
    return rounded(curve.threshold_metrics(rows, strategy, groups=["year"], **kw))


@query("q_threshold_f1", _threshold_sql(4, 2.0, _best(1.0)))
def threshold_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _thresholds(spark, sf_dir, "maximize_f1")


@query("q_threshold_f2", _threshold_sql(4, 2.0, _best(4.0)))
def threshold_f2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _thresholds(spark, sf_dir, "maximize_f2")


@query("q_threshold_fbeta", _threshold_sql(9, 3.0, _best(9.0)))
def threshold_fbeta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _thresholds(spark, sf_dir, "maximize_fbeta", beta=3.0)


@query(
    "q_threshold_fixed",
    _threshold_sql(
        4,
        2.0,
        "SELECT year, CAST(0.5 AS DOUBLE) AS score, max(tp) FILTER (score >= 0.5) AS tp, "
        "max(fp) FILTER (score >= 0.5) AS fp, max(n_pos) AS n_pos, max(n_neg) AS n_neg "
        "FROM c GROUP BY year",
    ),
)
def threshold_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _thresholds(spark, sf_dir, "fixed")


@query(
    "q_threshold_recall_floor",
    with_frames(
        "SELECT year, round(coalesce(max(score) FILTER (recall >= 0.7), min(score)), 6) AS "
        "threshold FROM c GROUP BY year",
        "line_scores",
        c=curve_sql("line_scores", "year"),
    ),
)
def threshold_recall_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines_curve(spark, sf_dir, ["year"])
    return rounded(curve.recall_floor_threshold(rows, 0.7, ["year"]))


@query(
    "q_minmax_score",
    with_frames(
        "SELECT loan_sequence_number, round((original_upb - lo) / (hi - lo), 6) AS "
        "probability_default FROM cleaned_new, (SELECT min(original_upb) AS lo, "
        "max(original_upb) AS hi FROM cleaned_new) b",
        "cleaned_new",
    ),
)
def minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.cleaned_new(spark, sf_dir).select(ID, "original_upb")
    return rounded(minmax_score(rows, "original_upb").select(ID, SCORE))
