"""Six classifier families, their search spaces, and fitted models of Spark ML, with save and load."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.operators.bounded import attach
from loanlens.operators.features import class_weights
from loanlens.operators.logistic import LogitModel, fit_newton
from loanlens.operators.project import align_features, sanitise_numbers
from loanlens.operators.tree_training import BinnedTable, Candidate, TreeModel, bin_table, fit_trees
from loanlens.operators.trees import Boosting, Forest

SCORE = "probability_default"

# The search space per family.
SPACES: dict[str, dict[str, list]] = {
    "logistic_regression": {
        "C": [10 ** (-3 + 5 * i / 29) for i in range(30)],
        "solver": ["lbfgs", "liblinear"],
        "class_weight": [None, "balanced"],
        "max_iter": [1000, 2000, 4000],
    },
    "decision_tree": {
        "criterion": ["gini", "entropy"],
        "max_depth": [None, 3, 5, 10, 20, 40],
        "min_samples_split": [2, 5, 10, 25, 50],
        "min_samples_leaf": [1, 2, 5, 10, 25, 50],
        "max_features": [None, "sqrt", "log2", 0.5],
        "class_weight": [None, "balanced"],
    },
    "random_forest": {
        "n_estimators": [200, 400, 600, 800],
        "criterion": ["gini", "entropy"],
        "max_depth": [None, 5, 10, 20, 40],
        "min_samples_split": [2, 5, 10, 25],
        "min_samples_leaf": [1, 2, 5, 10, 25],
        "max_features": ["sqrt", "log2", None, 0.5],
        "bootstrap": [True, False],
        "class_weight": [None, "balanced", "balanced_subsample"],
    },
    "extra_trees": {
        "n_estimators": [200, 400, 600, 800],
        "criterion": ["gini", "entropy"],
        "max_depth": [None, 5, 10, 20, 40],
        "min_samples_split": [2, 5, 10, 25],
        "min_samples_leaf": [1, 2, 5, 10, 25],
        "max_features": ["sqrt", "log2", None, 0.5],
        "bootstrap": [False, True],
        "class_weight": [None, "balanced"],
    },
    "gradient_boosting": {
        "n_estimators": [100, 200, 400, 600],
        "learning_rate": [0.01, 0.03, 0.05, 0.1, 0.2],
        "max_depth": [2, 3, 4, 5],
        "min_samples_split": [2, 5, 10, 25],
        "min_samples_leaf": [1, 2, 5, 10, 25, 50],
        "subsample": [0.6, 0.8, 1.0],
        "max_features": [None, "sqrt", "log2"],
    },
    "hist_gradient_boosting": {
        "max_iter": [100, 200, 400, 600],
        "learning_rate": [0.01, 0.03, 0.05, 0.1, 0.2],
        "max_depth": [None, 3, 5, 10],
        "max_leaf_nodes": [15, 31, 63, 127],
        "min_samples_leaf": [10, 20, 50, 100],
        "l2_regularization": [0.0, 0.01, 0.1, 1.0],
    },
}
#: Families whose candidates are grown together over one binned table.
TREE_FAMILIES = ("decision_tree", "random_forest", "extra_trees", "gradient_boosting", "hist_gradient_boosting")


@dataclass(frozen=True)
class FittedModel:
    """Fitted stages of Spark ML with everything needed to score aligned features."""

    family: str
    features: list[str]
    stages: PipelineModel
    probabilities: list[str]
    threshold: float = 0.5
    params: dict = field(default_factory=dict)
    metadata: dict = field(default_factory=dict)

    def score(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Kept columns and the positive-class probability; narrow, so it also streams."""
        aligned, _ = align_features(df, self.features, keep)
        ready = sanitise_numbers(aligned, self.features)
        parts = [vector_to_array(F.col(p))[1] for p in self.probabilities]
        mean = parts[0]
        for p in parts[1:]:
            mean = mean + p
        return self.stages.transform(ready).select(*keep, (mean / len(parts)).alias(SCORE))

    @property
    def label_only(self) -> bool:
        """True for a family that gives a class but no probability."""
        return not self.probabilities

    def classify(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Kept columns and the predicted class."""
        aligned, _ = align_features(df, self.features, keep)
        ready = sanitise_numbers(aligned, self.features)
        label = F.col("prediction").cast("int").alias("prediction")
        return self.stages.transform(ready).select(*keep, label)

    def save(self, spark: SparkSession, path: str) -> None:
        self.stages.write().overwrite().save(f"{path}/stages")
        text = json.dumps(
            {
                "family": self.family,
                "features": self.features,
                "probabilities": self.probabilities,
                "threshold": self.threshold,
                "params": self.params,
                "metadata": self.metadata,
            }
        )
        row = spark.createDataFrame([(text,)], "value string")
        row.coalesce(1).write.mode("overwrite").text(f"{path}/metadata")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Model:
        """The model saved at a path, of whatever kind."""
        values = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        if values.get("kind") == "trees":
            return TreeModel.load(path, values)
        if values.get("kind") == "logit":
            return LogitModel.load(values)
        return FittedModel(stages=PipelineModel.load(f"{path}/stages"), **values)


#: What fitting gives: all score, save and load alike.
Model = FittedModel | TreeModel | LogitModel


def candidates(space: Mapping[str, Sequence], n_iter: int, seed: int) -> list[dict]:
    """Distinct random combinations, the whole space when it is not larger than asked."""
    names = list(space)
    size = math.prod(len(space[n]) for n in names)
    draw = random.Random(seed)
    picks = range(size) if size <= n_iter else draw.sample(range(size), n_iter)
    chosen = []
    for pick in picks:
        values = {}
        for n in names:
            pick, i = divmod(pick, len(space[n]))
            values[n] = space[n][i]
        chosen.append(values)
    return chosen


def training_frame(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Label, balanced class weight and sanitised features, ready for any family."""
    weighted = attach(df, class_weights(df, target).drop("n_class"), [target], "left")
    weighted = sanitise_numbers(weighted, features)
    return weighted.withColumn("label", F.col(target).cast("double"))


def tree_candidate(
    family: str, params: Mapping, counts: tuple[int, int], number: int = 0, seed: int = 42
) -> Candidate:
    """How a tree family with these parameters is grown, given the training rows of class 0 and 1.

    ``undersample`` draws the rows of both classes equally often into each bootstrapped tree, about
    as many as the smaller class has.
    """
    split = {k: params[k] for k in ("max_depth", "min_samples_split", "min_samples_leaf", "max_features") if k in params}
    if family == "gradient_boosting":
        spec = Boosting(
            params["n_estimators"],
            params.get("learning_rate", 0.1),
            subsample=params.get("subsample", 1.0),
            seed=seed,
            **{"max_depth": 3, **split},
        )
        return Candidate(number, spec, spec.rounds)
    if family == "hist_gradient_boosting":
        spec = Boosting(
            params["max_iter"],
            params.get("learning_rate", 0.1),
            max_leaves=params.get("max_leaf_nodes", 31),
            l2=params.get("l2_regularization", 0.0),
            early_stopping=params.get("early_stopping"),
            newton=True,
            seed=seed,
            **{"min_samples_leaf": 20, **split},
        )
        return Candidate(number, spec, spec.rounds)
    if family not in TREE_FAMILIES:
        raise ValueError(f"no tree family named {family!r}")
    rates = (1.0, 1.0)
    if params.get("undersample"):
        least = min(counts)
        rates = tuple(least / max(n, 1) for n in counts)
    spec = Forest(
        criterion=params.get("criterion", "gini"),
        bootstrap=bool(params.get("undersample")) or params.get("bootstrap", family == "random_forest"),
        class_weight=params.get("class_weight"),
        random_cuts=family == "extra_trees",
        rates=rates,
        seed=seed,
        **({"max_features": None if family == "decision_tree" else "sqrt"} | split),
    )
    return Candidate(number, spec, 1 if family == "decision_tree" else params["n_estimators"])


def fit_family(
    family: str,
    train: DataFrame,
    features: Sequence[str],
    params: Mapping,
    seed: int = 42,
    key: str = "loan_sequence_number",
    binned: BinnedTable | None = None,
) -> Model:
    """Fit one candidate on a frame made by ``training_frame``; ``key`` names its rows.

    The solver of logistic regression says whether the intercept is penalised (liblinear) or not.
    A tree family takes its bins from ``binned`` where that is given.
    """
    if family in TREE_FAMILIES:
        table = binned or bin_table(train, features, key, "label")
        return fit_trees(table, family, tree_candidate(family, params, table.counts, seed=seed), params)
    if family != "logistic_regression":
        raise ValueError(f"no model family named {family!r}")
    return fit_newton(train, features, params, params.get("solver") == "liblinear")
