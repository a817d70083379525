"""Score curve and everything read off it: AUC, average precision, thresholds, calibration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.scalars import ratio
from loanlens.operators.prefix import ROWS_PER_BUCKET, running_sums

STRATEGIES = {"maximize_f1": 1.0, "maximize_f2": 2.0, "maximize_fbeta": None, "fixed": None}
# Right-closed probability bins of the calibration table, first one closed.
CALIBRATION_EDGES = (0.0, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5, 1.0)


def score_curve(
    scored: DataFrame,
    score: str = "probability_default",
    label: str = "actual_default",
    groups: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """One row per distinct score: cumulative true and false positives from the top.

    Equal scores are one point; a null group is a group.  The counts per score are written once.  Columns: groups, score, positives, negatives (at this
    score), tp, fp (at or above it), n_pos, n_neg (in the group), precision, recall.
    """
    rows = scored.filter(
        F.col(score).isNotNull() & F.col(label).isNotNull()
    ).select(*groups, F.col(score).cast("double").alias("score"), F.col(label).cast("int").alias("y"))
    counts = rows.groupBy(*groups, "score").agg(
        F.sum("y").alias("positives"), F.sum(1 - F.col("y")).alias("negatives")
    )
    summed = running_sums(
        counts, groups, "score", ["positives", "negatives"], True, rows_per_bucket=rows_per_bucket
    )
    tp, fp = F.col("upto_positives"), F.col("upto_negatives")
    return summed.select(
        *groups,
        "score",
        "positives",
        "negatives",
        tp.alias("tp"),
        fp.alias("fp"),
        F.col("all_positives").alias("n_pos"),
        F.col("all_negatives").alias("n_neg"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, F.col("all_positives"), 1.0).alias("recall"),
    )


def auc_column() -> Column:
    """Mann-Whitney area over curve rows, ties counting half; null for a single class."""
    above = F.col("tp").cast("double") - F.col("positives") / 2.0
    pairs = F.max("n_pos").cast("double") * F.max("n_neg").cast("double")
    return ratio(F.sum(F.col("negatives").cast("double") * above), pairs, None)


def average_precision_column() -> Column:
    """Sum of precision over recall steps (no interpolation); null without positives."""
    gained = F.sum(F.col("positives").cast("double") * F.col("precision"))
    return ratio(gained, F.max("n_pos"), None)


def fbeta_column(beta: float) -> Column:
    p, r, b2 = F.col("precision"), F.col("recall"), float(beta) ** 2
    return ((1 + b2) * p * r) / (b2 * p + r + F.lit(1e-12))


def label_metrics(
    tn: Column, fp: Column, fn: Column, tp: Column, beta: float = 2.0
) -> dict[str, Column]:
    """Accuracy, precision, recall, F1 and F-beta from counts; empty denominators give 0."""
    b2 = float(beta) ** 2
    return {
        "accuracy": ratio(tp + tn, tp + tn + fp + fn),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
        "fbeta": ratio((1 + b2) * tp, (1 + b2) * tp + fp + b2 * fn),
    }


def confusion(
    predictions: DataFrame,
    prediction: str = "prediction",
    actual: str = "actual_default",
    groups: Sequence[str] = (),
) -> DataFrame:
    p, y = F.col(prediction), F.col(actual)
    return predictions.groupBy(*groups).agg(
        F.count_if((p == 0) & (y == 0)).alias("true_negatives"),
        F.count_if((p == 1) & (y == 0)).alias("false_positives"),
        F.count_if((p == 0) & (y == 1)).alias("false_negatives"),
        F.count_if((p == 1) & (y == 1)).alias("true_positives"),
    )


def with_label_metrics(counts: DataFrame, beta: float = 2.0) -> DataFrame:
    cells = [F.col(c) for c in ("true_negatives", "false_positives", "false_negatives", "true_positives")]
    return counts.withColumns(label_metrics(*cells, beta=beta))


def threshold_metrics(
    curve: DataFrame,
    strategy: str = "maximize_f1",
    fallback: float = 0.5,
    beta: float = 2.0,
    groups: Sequence[str] = (),
) -> DataFrame:
    """Decision threshold and all metrics at it, per group, from one pass over the curve.

    The maximising strategies look at every distinct score; on ties the lowest score wins.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"no threshold strategy named {strategy!r}, only {sorted(STRATEGIES)}")
    # the strategy's beta chooses the threshold; reported values keep the parameter
    sought = STRATEGIES[strategy] or beta
    score, point = F.col("score"), F.struct("score", "tp", "fp")
    if strategy == "fixed":
        chosen = F.min_by(point, F.when(score >= fallback, score))
        threshold = F.lit(float(fallback))
    else:
        chosen = F.max_by(point, F.struct(fbeta_column(sought), -score))
        threshold = F.coalesce(F.col("_at.score"), F.lit(float(fallback)))
    summary = curve.groupBy(*groups).agg(
        chosen.alias("_at"),
        F.max("n_pos").alias("n_pos"),
        F.max("n_neg").alias("n_neg"),
        auc_column().alias("roc_auc"),
        average_precision_column().alias("average_precision"),
    )
    tp = F.coalesce(F.col("_at.tp"), F.lit(0))
    fp = F.coalesce(F.col("_at.fp"), F.lit(0))
    metrics = label_metrics(F.col("n_neg") - fp, fp, F.col("n_pos") - tp, tp, beta)
    return summary.select(
        *groups,
        threshold.alias("threshold"),
        F.lit(float(beta)).alias("beta"),
        *[v.alias(k) for k, v in metrics.items()],
        "average_precision",
        "roc_auc",
    )


def recall_floor_threshold(
    curve: DataFrame, floor: float = 0.70, groups: Sequence[str] = ()
) -> DataFrame:
    """Highest score that keeps recall at the floor, else the lowest score."""
    score = F.col("score")
    kept = F.max(F.when(F.col("recall") >= floor, score))
    return curve.groupBy(*groups).agg(F.coalesce(kept, F.min(score)).alias("threshold"))


def metrics_by_group(
    predictions: DataFrame,
    group: str = "year",
    score: str = "probability_default",
    prediction: str = "prediction",
    actual: str = "actual_default",
) -> DataFrame:
    """Size, default rate, AUC and label metrics per group; single-class groups are left out."""
    rows = predictions
    curve = score_curve(rows, score, actual, [group])
    ranked = curve.groupBy(group).agg(auc_column().alias("roc_auc"))
    counts = rows.groupBy(group).agg(
        F.count("*").alias("n_loans"),
        F.avg(F.col(actual).cast("double")).alias("default_rate"),
        *_cells(prediction, actual),
    )
    measured = with_label_metrics(counts)
    ranked = ranked.filter("roc_auc IS NOT NULL").withColumnRenamed(group, "_ranked")
    return measured.join(ranked, F.col(group).eqNullSafe(F.col("_ranked"))).select(
        group, "n_loans", "default_rate", "roc_auc", "recall", "precision", "f1"
    )


def _cells(prediction: str, actual: str) -> list[Column]:
    p, y = F.col(prediction), F.col(actual)
    return [
        F.count_if((p == 0) & (y == 0)).alias("true_negatives"),
        F.count_if((p == 1) & (y == 0)).alias("false_positives"),
        F.count_if((p == 0) & (y == 1)).alias("false_negatives"),
        F.count_if((p == 1) & (y == 1)).alias("true_positives"),
    ]


def calibration(
    predictions: DataFrame,
    score: str = "probability_default",
    actual: str = "actual_default",
    edges: Sequence[float] = CALIBRATION_EDGES,
) -> DataFrame:
    """Loans, actual rate and mean probability per right-closed probability bin."""
    s = F.col(score)
    bucket = F.when((s >= edges[0]) & (s <= edges[1]), F.lit(0))
    for i in range(1, len(edges) - 1):
        bucket = bucket.when((s > edges[i]) & (s <= edges[i + 1]), F.lit(i))
    return (
        predictions.withColumn("bucket", bucket)
        .filter(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(
            F.count(actual).alias("n_loans"),
            F.avg(F.col(actual).cast("double")).alias("actual_default_rate"),
            F.avg(score).alias("mean_predicted_prob"),
        )
        .withColumns(
            {
                "lower": F.element_at(F.array(*[F.lit(float(e)) for e in edges]), F.col("bucket") + 1),
                "upper": F.element_at(F.array(*[F.lit(float(e)) for e in edges]), F.col("bucket") + 2),
            }
        )
    )


def metric_gap(validation: DataFrame, test: DataFrame, names: Sequence[str]) -> DataFrame:
    """Validation and test value of each metric with the relative loss in percent."""
    def tall(df: DataFrame, value: str) -> DataFrame:
        return df.select(*[F.col(n).cast("double").alias(n) for n in names]).unpivot(
            [], list(names), "metric", value
        )

    v, t = F.col("validation"), F.col("test")
    return (
        tall(validation, "validation")
        .join(tall(test, "test"), "metric")
        .withColumn("degradation_pct", F.try_divide(v - t, v) * 100)
    )


def require_two_classes(df: DataFrame, target: str, name: str) -> None:
    seen = df.agg(F.count_distinct(target)).first()[0]
    if seen < 2:
        raise ValueError(f"{name}: rows of one class only, two are needed")


def labelled_metrics(
    predictions: DataFrame,
    labels: DataFrame,
    key: str,
    target: str = "default",
    score: str = "probability_default",
) -> tuple[DataFrame, DataFrame]:
    """Metrics of predictions whose outcome is known, and the rows with outcome attached.

    Labels are attached by id.  Predictions without a probability are ranked by their label.
    """
    if target not in labels.columns:
        raise ValueError(f"'{target}' is missing: only labelled data can be evaluated")
    if "prediction" not in predictions.columns:
        raise ValueError("predictions must contain 'prediction'")
    joined = predictions.join(
        labels.select(key, F.col(target).cast("int").alias("actual_default")), key
    )
    rows = joined.withColumn("is_correct", F.col("prediction") == F.col("actual_default"))
    ranked_by = score if score in predictions.columns else "prediction"
    curve = score_curve(joined, ranked_by, "actual_default")
    both = (F.max("n_pos") > 0) & (F.max("n_neg") > 0)
    areas = curve.agg(
        F.when(both, average_precision_column()).alias("average_precision"),
        auc_column().alias("roc_auc"),
    )
    counts = joined.agg(
        F.count("*").alias("n_rows"),
        F.avg(F.col("actual_default").cast("double")).alias("actual_default_rate"),
        F.avg(F.col("prediction").cast("double")).alias("predicted_default_rate"),
        *_cells("prediction", "actual_default"),
    )
    # Two one-row results side by side: stack them and keep the value each column has.
    both_rows = with_label_metrics(counts).drop("fbeta").unionByName(areas, True)
    return both_rows.agg(*[F.max(c).alias(c) for c in both_rows.columns]), rows


def prediction_summary(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.count("*").alias("n_loans"),
        F.count_if(F.col("prediction") == 1).alias("predicted_default"),
        F.count_if(F.col("prediction") == 0).alias("predicted_paid"),
        F.avg(F.col("prediction").cast("double")).alias("predicted_default_rate"),
        F.max("selected_model_family").alias("selected_model_family"),
        F.max("threshold").alias("threshold"),
    )
