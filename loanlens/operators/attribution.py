"""Additive attribution of predictions by Shapley values, exact for trees and sampled for other models."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlens.functions.scalars import seeded_key
from loanlens.operators.joins import pair_with_background
from loanlens.operators.models import SCORE
from loanlens.operators.project import align_features, sanitise_numbers
from loanlens.operators.ranking import sample_rows
from loanlens.operators.tree_training import TreeModel
from loanlens.operators.trees import Tree
from loanlens.session import materialise

#: Rows that one task explains.
ROWS_PER_TASK = 8


def attributions(
    features: DataFrame,
    model,
    key: str,
    sample_size: int = 500,
    background_size: int = 50,
    passes: int = 1,
    seed: int = 42,
) -> DataFrame:
    """(id, feature, phi) of a seeded sample of rows.

    Every row meets every background row once per pass, each time with its own feature
    order.  Walking the order, one feature after the other changes from the background to
    the row's value; the change of the prediction is that feature's contribution.  All
    mixed rows are scored by one transform, and the contributions of a row sum to its
    prediction minus the mean background prediction.  The sample and background sizes bound
    the frame: sample x background x passes x (features + 1) rows.
    """
    names = list(model.features)
    aligned, _ = align_features(features, names, [key])
    rows = sample_rows(sanitise_numbers(aligned, names), key, sample_size, seed)
    rows = materialise(rows, "attribution-sample")
    ordered = Window.orderBy(seeded_key(F.col(key), seed + 1), key)
    background = sample_rows(rows, key, background_size, seed + 1).withColumn(
        "slot", F.row_number().over(ordered) - 1
    )
    size = background.count()
    slots = size * passes
    pairs = pair_with_background(rows, background, slots, size, names)
    # The id and the slot seed the order, so a recomputed task gives the same walk.
    order = F.array_sort(
        F.array(
            *[
                F.struct(F.xxhash64(F.lit(c), key, "slot", F.lit(seed)), F.lit(i).alias("i"))
                for i, c in enumerate(names)
            ]
        )
    )
    walked = pairs.withColumn("_order", F.transform(order, lambda x: x["i"])).withColumn(
        "_step", F.explode(F.sequence(F.lit(0), F.lit(len(names))))
    )
    walked = walked.repartition(F.col(key), F.col("slot"))
    mixed = walked.select(
        key,
        "_step",
        "_order",
        *[
            F.when(F.array_position("_order", F.lit(i)) <= F.col("_step"), F.col(c))
            .otherwise(F.col(f"base_{c}"))
            .alias(c)
            for i, c in enumerate(names)
        ],
    )
    scored = model.score(mixed, [key, "_step", "_order"])
    gained = F.struct(F.get("_order", F.col("_step") - 1).alias("i"), F.col(SCORE).alias("d"))
    lost = F.struct(
        F.get("_order", F.col("_step")).alias("i"), (-F.col(SCORE)).alias("d")
    )
    moves = F.array(
        F.when(F.col("_step") > 0, gained), F.when(F.col("_step") < len(names), lost)
    )
    labels = F.array(*[F.lit(c) for c in names])
    return (
        scored.select(key, F.explode(moves).alias("m"))
        .filter(F.col("m").isNotNull())
        .groupBy(key, F.element_at(labels, F.col("m.i") + 1).alias("feature"))
        .agg((F.sum("m.d") / slots).alias("phi"))
    )


def shapley_of_tree(tree: Tree, row: np.ndarray, base: np.ndarray) -> np.ndarray:
    """(pair, feature) Shapley values of one tree for pairs of (feature, pair) codes.

    Where the row and its background go different ways at a node, a coalition with the node's feature
    follows the row and one without it the background.  All pairs walk down together and part in two
    only there; a leaf that is reached with n features from the row and m from the background counts
    for each of them with the share of orders that lead to it.
    """
    total, n = row.shape
    orders = np.array([math.factorial(i) for i in range(total + 1)], dtype=np.float64)
    phi = np.zeros(n * total)
    pair, node = np.arange(n), np.zeros(n, dtype=np.int64)
    side = np.zeros((n, total), dtype=np.int8)  # 0 undecided, 1 from the row, 2 from the background
    while len(pair):
        leaf = tree.feature[node] < 0
        at, decided = node[leaf], side[leaf]
        ours, theirs = (decided == 1).sum(axis=1), (decided == 2).sum(axis=1)
        whole = orders[ours + theirs]
        gain = tree.value[at] * orders[np.maximum(ours - 1, 0)] * orders[theirs] / whole
        loss = tree.value[at] * orders[ours] * orders[np.maximum(theirs - 1, 0)] / whole
        i, f = np.nonzero(decided)
        change = np.where(decided[i, f] == 1, gain[i], -loss[i])
        phi += np.bincount(pair[leaf][i] * total + f, change, n * total)
        pair, node, side = pair[~leaf], node[~leaf], side[~leaf]
        f, cut = tree.feature[node].astype(np.int64), tree.cut[node]
        by_row, by_base = row[f, pair] > cut, base[f, pair] > cut
        state = side[np.arange(len(pair)), f]
        parts = (state == 0) & (by_row != by_base)
        also = side[parts]
        also[np.arange(len(also)), f[parts]] = 2
        side[parts, f[parts]] = 1
        left = tree.left[node]
        first, second = left + np.where(state == 2, by_base, by_row), (left + by_base)[parts]
        pair = np.concatenate([pair, pair[parts]])
        node = np.concatenate([first, second])
        side = np.concatenate([side, also])
    return phi.reshape(n, total)


def tree_attributions(
    features: DataFrame,
    model: TreeModel,
    key: str,
    sample_size: int = 500,
    background_size: int = 50,
    seed: int = 42,
) -> DataFrame:
    """(id, feature, phi) of a seeded sample of rows, exact over all orders of the features.

    Every row meets every background row.  For averaged trees the contributions are those of the
    probability.  For boosted trees they are those of the logit, scaled for each pair to add up to
    the difference of the probabilities.  The rows are spread over tasks, the background is
    ``background_size`` rows, and the trees come in slices of a checked size.
    """
    spark, names = features.sparkSession, list(model.features)
    sample = materialise(sample_rows(features, key, sample_size, seed), "attribution-sample")
    coded = model.coded(sample, [key]).withColumnRenamed("_k0", key)
    background = sample_rows(coded, key, background_size, seed + 1).select("_codes").collect()
    base = np.frombuffer(b"".join(bytes(r["_codes"]) for r in background), np.uint8)
    base = base.reshape(len(background), len(names)).T
    total, many = len(names), len(background)

    def pairs(packed: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        row = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, total).T
        return np.repeat(row, many, axis=1), np.tile(base, (1, len(packed)))

    # per row and background row: contributions, and the raw values of both
    width = many * (total + 2)
    schema = f"{key} {dict(coded.dtypes)[key]}, _codes binary, _sums array<double>"
    parts = max(1, -(-sample_size // ROWS_PER_TASK))
    zeros = F.array_repeat(F.lit(0.0), width)
    rows = coded.repartition(parts, key).withColumn("_sums", zeros)
    for packed in model.slices(spark):
        held = spark.sparkContext.broadcast(packed)

        def run(batches: Iterable[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            trees = [Tree.unpack(p) for p in held.value]
            for batch in batches:
                codes = batch.column("_codes").to_pylist()
                sums = batch.column("_sums").flatten().to_numpy().reshape(-1, total + 2).copy()
                ours, theirs = pairs(codes)
                for tree in trees:
                    sums[:, :total] += shapley_of_tree(tree, ours, theirs)
                    sums[:, total] += tree.predict(ours)
                    sums[:, total + 1] += tree.predict(theirs)
                offsets = pa.array(np.arange(len(codes) + 1) * width, pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(sums.ravel()))
                yield batch.set_column(2, "_sums", lists)

        # written after each slice, so that a task holds one and not all of them
        rows = materialise(rows.mapInArrow(run, schema), "attribution-sums")
        held.unpersist()
    start, n_trees = model.start, model.n_trees

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            sums = batch.column("_sums").flatten().to_numpy().reshape(n, many, total + 2)
            phi, raw = sums[:, :, :total], sums[:, :, total:]
            if start is None:
                phi = phi / max(n_trees, 1)
            else:
                p = 1.0 / (1.0 + np.exp(-(raw + start)))
                apart, change = raw[:, :, 0] - raw[:, :, 1], p[:, :, 0] - p[:, :, 1]
                slope = np.divide(change, apart, out=np.zeros_like(apart), where=apart != 0)
                phi = phi * slope[:, :, None]
            mean = phi.mean(axis=1).ravel()
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(n), total)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(names * n, pa.string()), pa.array(mean)], names=[key, "feature", "phi"]
            )

    return rows.mapInArrow(finish, f"{key} {dict(coded.dtypes)[key]}, feature string, phi double")


def explain(
    features: DataFrame,
    model,
    key: str,
    sample_size: int = 500,
    background_size: int = 50,
    seed: int = 42,
) -> DataFrame:
    """Attributions by the way that fits the model."""
    found = tree_attributions if isinstance(model, TreeModel) else attributions
    return found(features, model, key, sample_size, background_size, seed=seed)


def importance(phi: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature."""
    return phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_shap"))


def attribution_summary(phi: DataFrame, key: str, family: str) -> DataFrame:
    """Explained rows, features, and the feature with the largest mean attribution."""
    ranked = importance(phi)
    top = ranked.agg(
        F.max_by("feature", F.struct("mean_abs_shap", "feature")).alias("top_feature"),
        F.max("mean_abs_shap").alias("top_feature_mean_abs_shap"),
        F.count("*").alias("n_features"),
    )
    explained = phi.agg(F.count_distinct(key)).scalar()
    return top.select(
        F.lit(family).alias("selected_model_family"), explained.alias("n_rows_explained"), "*"
    )


def feature_list(phi: DataFrame, k: int) -> Sequence[str]:
    """Names of the k most important features."""
    rows = importance(phi).orderBy(F.desc("mean_abs_shap"), "feature").limit(k).collect()
    return [r["feature"] for r in rows]
