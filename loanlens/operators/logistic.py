"""Logistic regression by Newton steps on sums over the rows, with the intercept penalised or not."""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.operators.project import align_features, present, sanitise_numbers

#: Newton steps end when no part of the gradient is above this share of the rows' weight.
TOLERANCE = 1e-9


@dataclass(frozen=True)
class LogitModel:
    """Coefficients on the features as they come."""

    features: list[str]
    coefficients: list[float]
    intercept: float
    threshold: float = 0.5
    params: dict = field(default_factory=dict)
    metadata: dict = field(default_factory=dict)
    family: str = "logistic_regression"
    label_only: bool = False

    def score(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Kept columns and the positive-class probability; narrow and without Python."""
        keep = present(df, keep)
        names = [f"_k{i}" for i in range(len(keep))]
        kept = [F.col(k).alias(n) for n, k in zip(names, keep, strict=True)]
        aligned, _ = align_features(df.select(*kept, *present(df, self.features)), self.features, names)
        ready = sanitise_numbers(aligned, self.features)
        logit = F.lit(self.intercept)
        for c, w in zip(self.features, self.coefficients, strict=True):
            logit = logit + F.col(c) * F.lit(w)
        back = [F.col(n).alias(k) for n, k in zip(names, keep, strict=True)]
        return ready.select(*back, (1.0 / (1.0 + F.exp(-logit))).alias("probability_default"))

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps(self.__dict__ | {"kind": "logit"})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")

    @staticmethod
    def load(values: Mapping) -> LogitModel:
        return LogitModel(**{k: v for k, v in values.items() if k != "kind"})


def _sums(train: DataFrame, features: Sequence[str], mean, spread, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Weighted loss, gradient and Hessian of the scaled features and a constant, one pass.

    Every task adds up its rows and sends one small block; the blocks are added up by Spark.
    """
    size = len(features) + 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + size + size * size)
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in features], axis=1)
            x = np.column_stack([(x - mean) / spread, np.ones(len(x))])
            y, a = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "weight"))
            z = x @ w
            p = 1.0 / (1.0 + np.exp(-z))
            total[0] += (a * (np.logaddexp(0.0, z) - y * z)).sum()
            total[1 : 1 + size] += x.T @ (a * (p - y))
            total[1 + size :] += ((x * (a * p * (1 - p))[:, None]).T @ x).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["i", "v"])

    parts = train.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    found = np.zeros(1 + size + size * size)
    for r in parts.collect():
        found[r["i"]] = r["v"]
    return found[0], found[1 : 1 + size], found[1 + size :].reshape(size, size)


def fit_newton(
    train: DataFrame,
    features: Sequence[str],
    params: Mapping,
    penalise_intercept: bool = True,
) -> LogitModel:
    """Minimises |w|^2 / 2 + C x weighted loss over ``label``, of features scaled to unit variance.

    Rows weigh ``class_weight`` where the parameters ask for it.  Every step is one pass over the
    rows; a step that does not lower the objective is halved.
    """
    features = list(features)
    weight = F.col("class_weight") if params.get("class_weight") else F.lit(1.0)
    rows = train.select(
        *[F.col(c).cast("double").alias(c) for c in features],
        F.col("label").cast("double").alias("label"),
        weight.cast("double").alias("weight"),
    )
    row = rows.agg(
        F.sum("weight").alias("n"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(features)],
    ).first()
    mean = np.array([row[f"m{i}"] or 0.0 for i in range(len(features))])
    spread = np.array([row[f"s{i}"] or 1.0 for i in range(len(features))])
    c, n = float(params["C"]), row["n"] or 0.0
    ridge = np.ones(len(features) + 1)
    ridge[-1] = 1.0 if penalise_intercept else 0.0

    def at(w: np.ndarray):
        loss, g, h = _sums(rows, features, mean, spread, w)
        return (ridge * w) @ w / 2 + c * loss, ridge * w + c * g, np.diag(ridge) + c * h

    w = np.zeros(len(features) + 1)
    value, g, h = at(w)
    for _ in range(params.get("max_iter", 1000)):
        if np.abs(g).max() <= TOLERANCE * max(c * n, 1.0):
            break
        step = np.linalg.lstsq(h, g, rcond=None)[0]
        for _ in range(40):
            found = at(w - step)
            if found[0] <= value:
                break
            step = step / 2
        else:
            break
        if math.isclose(found[0], value, rel_tol=1e-15):
            w, (value, g, h) = w - step, found
            break
        w, (value, g, h) = w - step, found
    scaled = w[:-1] / spread
    return LogitModel(features, scaled.tolist(), float(w[-1] - scaled @ mean), params=dict(params))
