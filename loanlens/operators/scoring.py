"""Batch scoring: features to predictions, and raw rows to predictions in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.scalars import ratio
from loanlens.operators.cleaning import clean
from loanlens.operators.features import Transformers, apply_transformers, stateless_features
from loanlens.operators.models import SCORE
from loanlens.operators.project import flag_at
from loanlens.roles import LOAN_ROLES, RoleMap


def prepare_features(
    cleaned: DataFrame, transformers: Transformers, roles: RoleMap = LOAN_ROLES
) -> DataFrame:
    """Cleaned rows to model features with the values learned in training; id first."""
    ready = apply_transformers(stateless_features(cleaned, roles), transformers)
    if roles.loan_id not in ready.columns:
        return ready
    return ready.select(roles.loan_id, *[c for c in ready.columns if c != roles.loan_id])


def infer(
    features: DataFrame, model, threshold: float | None = None, key: str = LOAN_ROLES.loan_id
) -> DataFrame:
    """Id, prediction, probability, threshold and family.  A threshold of 0 is a threshold.

    A model without probabilities gives its class and a null probability.
    """
    keep = [key] if key in features.columns else []
    used = float(model.threshold if threshold is None else threshold)
    if getattr(model, "label_only", False):
        decided = model.classify(features, keep)
        decided = decided.withColumn(SCORE, F.lit(None).cast("double"))
    else:
        decided = flag_at(model.score(features, keep), used)
    return decided.select(
        *keep,
        "prediction",
        SCORE,
        F.lit(used).alias("threshold"),
        F.lit(model.family).alias("selected_model_family"),
    )


def score_rows(
    raw: DataFrame,
    model,
    transformers: Transformers,
    threshold: float | None = None,
    roles: RoleMap = LOAN_ROLES,
) -> DataFrame:
    """Raw origination rows to predictions: a narrow plan without a shuffle, batch or stream.

    Rows that come without an id get a null one.
    """
    if roles.loan_id not in [c.strip().lower() for c in raw.columns]:
        raw = raw.withColumn(roles.loan_id, F.lit(None).cast("string"))
    return infer(
        prepare_features(clean(raw, roles), transformers, roles), model, threshold, roles.loan_id
    )


def minmax_score(df: DataFrame, decision: str, score: str = SCORE) -> DataFrame:
    """Decision values rescaled to 0..1 over the batch; 0.5 when all are equal."""
    bounds = df.agg(F.min(decision).alias("lo"), F.max(decision).alias("hi"))
    lo: Column = bounds.select("lo").scalar()
    hi: Column = bounds.select("hi").scalar()
    scaled = ratio(F.col(decision) - lo, hi - lo, 0.5)
    return df.withColumn(score, F.when(F.col(decision).isNotNull(), scaled))
