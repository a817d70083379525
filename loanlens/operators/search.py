"""Holdout random search over the families, refit of the winner, evaluation on later years."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.operators.curve import (
    STRATEGIES,
    require_two_classes,
    score_curve,
    threshold_metrics,
)
from loanlens.operators.features import stratified_split
from loanlens.operators.models import (
    SCORE,
    SPACES,
    TREE_FAMILIES,
    Model,
    candidates,
    fit_family,
    training_frame,
    tree_candidate,
)
from loanlens.operators.project import flag_at, numeric_only
from loanlens.operators.ranking import best_candidates
from loanlens.operators.tree_training import bin_table, candidate_scores
from loanlens.session import materialise
from loanlens.sources.runlog import append_runs, run_rows

METRICS = ("accuracy", "precision", "recall", "f1", "fbeta", "average_precision", "roc_auc")


@dataclass(frozen=True)
class SearchResult:
    model: Model
    results: DataFrame
    metadata: dict


def train_search(
    features_train: DataFrame,
    models: Sequence[str] = tuple(SPACES),
    n_iter: int = 5,
    validation_size: float = 0.2,
    seed: int = 42,
    threshold_strategy: str = "maximize_f1",
    fallback_threshold: float = 0.5,
    beta: float = 1.0,
    selection_metric: str = "val_f1",
    target: str = "default",
    key: str = "loan_sequence_number",
    spaces: Mapping[str, Mapping] = SPACES,
    parallelism: int = 2,
    experiment: str = "model_search",
    log_path: str | None = None,
) -> SearchResult:
    """Fit every candidate on the inner train rows, pick threshold and winner on the held-out
    rows, refit the winner on both.  Later years are never seen here."""
    if target not in features_train.columns:
        raise ValueError(f"features_train has no target {target!r}")
    require_two_classes(features_train, target, "features_train")
    unknown = sorted(set(models) - set(spaces))
    if unknown:
        raise ValueError(f"no model family named {unknown}")
    if selection_metric not in {f"val_{m}" for m in METRICS}:
        raise ValueError(f"selection_metric must be val_ and one of {METRICS}")
    if threshold_strategy not in STRATEGIES:
        raise ValueError(f"no threshold strategy named {threshold_strategy!r}")

    spark = features_train.sparkSession
    started = datetime.now(timezone.utc).isoformat()
    usable, dropped = numeric_only(features_train, keep=[key])
    features = [c for c in usable.columns if c not in (key, target)]
    split = stratified_split(usable, validation_size, key, target, seed)
    # Every candidate reads the split: written once, it comes back in scan-sized partitions
    # and outlives lost executors.
    split = materialise(split, "search-split")
    sizes = {r["is_validation"]: r["count"] for r in split.groupBy("is_validation").count().collect()}
    tasks = [
        (f, family, i, params)
        for f, family in enumerate(models)
        for i, params in enumerate(candidates(spaces[family], n_iter, seed))
    ]
    frames, binned = [], None
    trees = [n for n, t in enumerate(tasks) if t[1] in TREE_FAMILIES]
    if trees:
        # All trees of all candidates are grown over one binned table; only scores come back.
        binned = bin_table(split, features, key, target, "is_validation")
        wanted = [tree_candidate(tasks[n][1], tasks[n][3], binned.counts, n, seed) for n in trees]
        grown = candidate_scores(binned, wanted)
        frames.append(grown.select("candidate", "is_validation", F.col("label").alias(target), F.col("score").alias(SCORE)))
    # Class weights come from the inner train rows alone, as for any other fitted value.
    inner = training_frame(split.filter("is_validation = 0"), features, target)
    inner = inner.persist(StorageLevel.MEMORY_AND_DISK)

    def fit_and_score(n: int) -> DataFrame:
        model = fit_family(tasks[n][1], inner, features, tasks[n][3], seed, key)
        scored = model.score(split, [target, "is_validation"])
        return scored.select(F.lit(n).alias("candidate"), "is_validation", target, SCORE)

    others = [n for n in range(len(tasks)) if n not in set(trees)]
    try:
        with ThreadPool(max(1, min(parallelism, len(others)))) as pool:
            frames += pool.map(inheritable_thread_target(spark)(fit_and_score), others)
    finally:
        inner.unpersist()
    scores = frames[0]
    for f in frames[1:]:
        scores = scores.union(f)
    # One curve for all candidates, train and validation rows.
    curve = score_curve(scores, SCORE, target, ["candidate", "is_validation"])
    sides: dict[int, dict] = {}
    groups = ["candidate", "is_validation"]
    for r in threshold_metrics(curve, threshold_strategy, fallback_threshold, beta, groups).collect():
        sides.setdefault(r["candidate"], {})["val" if r["is_validation"] else "train"] = r
    rows = []
    for n, (family_idx, family, idx, params) in enumerate(tasks):
        row = {
            "model_family": family,
            "family_idx": family_idx,
            "candidate_idx": idx,
            "params_json": json.dumps(params, sort_keys=True),
            "selected_threshold": sides[n]["val"]["threshold"],
            "train_threshold": sides[n]["train"]["threshold"],
        }
        for side in ("train", "val"):
            row |= {f"{side}_{m}": sides[n][side][m] for m in METRICS}
        rows.append(row)

    numbers = ["selected_threshold", "train_threshold"]
    numbers += [f"{s}_{m}" for s in ("train", "val") for m in METRICS]
    schema = "model_family string, family_idx int, candidate_idx int, params_json string, "
    schema += ", ".join(f"{n} double" for n in numbers)
    order = ["model_family", "family_idx", "candidate_idx", "params_json", *numbers]
    table = spark.createDataFrame([tuple(r[c] for c in order) for r in rows], schema)
    results = best_candidates(table, selection_metric)
    winners = results.filter("is_best_candidate").collect()
    missing = sorted(set(models) - {w["model_family"] for w in winners})
    if missing:
        raise ValueError(f"every candidate of {missing} failed")
    best = next(w for w in winners if w["is_selected"])

    params = next(
        t[3] for t in tasks if (t[1], t[2]) == (best["model_family"], best["candidate_idx"])
    )
    both = training_frame(split, features, target)
    model = fit_family(best["model_family"], both, features, params, seed, key)
    metadata = {
        "run_id": uuid.uuid4().hex,
        "experiment": experiment,
        "target_column": target,
        "id_column": key,
        "threshold": best["selected_threshold"],
        "fallback_threshold": fallback_threshold,
        "threshold_strategy": threshold_strategy,
        "beta": beta,
        "random_state": seed,
        "n_iter": n_iter,
        "validation_size": validation_size,
        "selection_metric": selection_metric,
        "selected_model_family": best["model_family"],
        "selected_best_params": params,
        "n_train_rows": sizes.get(0, 0),
        "n_val_rows": sizes.get(1, 0),
        "n_features": len(features),
        "started_at": started,
        "finished_at": datetime.now(timezone.utc).isoformat(),
        "feature_columns": features,
        "dropped_non_numeric_columns": dropped,
        "model_summaries": [w.asDict() for w in winners],
    }
    if log_path:
        _log_search(spark, log_path, metadata, winners)
    model = replace(model, threshold=best["selected_threshold"], metadata=metadata)
    return SearchResult(model, results, metadata)


def _log_search(spark, path: str, metadata: Mapping, winners: Sequence) -> None:
    plain = {k: v for k, v in metadata.items() if isinstance(v, (str, int, float))}
    rows = run_rows(metadata["experiment"], metadata["run_id"], plain)
    for w in winners:
        child = f"{metadata['run_id']}-{w['model_family']}"
        values = w.asDict()
        # every parameter of the winner by itself, and all of them as one text
        own = {f"param_{k}": v for k, v in json.loads(values["params_json"]).items()}
        params = {k: values[k] for k in ("model_family", "params_json", "candidate_idx")} | own
        params |= {
            "child_run_name": w["model_family"],
            "best_params": values["params_json"],
            "best_candidate_idx": values["candidate_idx"],
            "best_selected_threshold": values["selected_threshold"],
        }
        rows += run_rows(metadata["experiment"], child, params, values, metadata["run_id"])
    append_runs(spark, path, rows)


def evaluate(
    model: Model,
    features_test: DataFrame,
    target: str = "default",
    key: str = "loan_sequence_number",
    beta: float | None = None,
    log_path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Metrics at the trained threshold on later years, and the predictions by loan id.

    Without ``beta`` the one the model was selected with is used.
    """
    if target not in features_test.columns:
        raise ValueError(f"features_test has no target {target!r}")
    require_two_classes(features_test, target, "features_test")
    scored = model.score(features_test, [key, target]).withColumnRenamed(target, "actual_default")
    predictions = flag_at(scored, model.threshold).withColumn(
        "selected_model_family", F.lit(model.family)
    )
    curve = score_curve(predictions)
    beta = model.metadata.get("beta", 2.0) if beta is None else beta
    metrics = threshold_metrics(curve, "fixed", model.threshold, beta)
    if log_path:
        row = metrics.first().asDict()
        named = {f"final_test_{k}": v for k, v in row.items()}
        spark = features_test.sparkSession
        meta = model.metadata
        append_runs(spark, log_path, run_rows(meta["experiment"], meta["run_id"], None, named))
    return metrics, predictions
