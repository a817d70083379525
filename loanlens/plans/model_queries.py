"""Queries over feature steps, models, scoring, attribution, drift and the stream."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.operators import drift, features
from loanlens.operators.attribution import explain, importance
from loanlens.operators.models import (
    SCORE,
    SPACES,
    FittedModel,
)
from loanlens.operators.project import align_features, sanitise_numbers, split_by_year
from loanlens.operators.scoring import infer, prepare_features, score_rows
from loanlens.operators.search import evaluate, train_search
from loanlens.plans import frames as V
from loanlens.plans.metric_queries import rounded
from loanlens.plans.oracle import CATEGORIES, NUMERIC_FEATURES, with_frames
from loanlens.plans.registry import query
from loanlens.roles import LOAN_ROLES
from loanlens.session import fresh_path
from loanlens.streaming.scoring import score_stream

ID = LOAN_ROLES.loan_id
ALL = (*NUMERIC_FEATURES, *CATEGORIES)


def _hash_order(seed: int, partition: str = "") -> str:
    return f"row_number() OVER ({partition}ORDER BY md5(concat({ID}, ':{seed}')))"


# Features


@query(
    "q_date_features",
    with_frames(
        f"SELECT {ID}, year, "
        + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC_FEATURES[10:])
        + " FROM new_features",
        "new_features",
    ),
)
def date_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.date_features(V.origination(spark, sf_dir).select(ID, "year", *LOAN_ROLES.dates))
    return rows.select(ID, "year", *[F.col(c).cast("double").alias(c) for c in LOAN_ROLES.date_features])


@query(
    "q_fit_table",
    with_frames(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            [
                f"SELECT 'median' AS kind, '{c}' AS \"column\", '' AS \"key\", {c} AS value FROM medians"
                for c in NUMERIC_FEATURES
            ]
            + ["SELECT 'class', col, v, CAST(code AS DOUBLE) FROM classes"]
        )
        + ") t",
        "medians",
        "classes",
    ),
)
def fit_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.transformer_table(spark, V.fitted(spark, sf_dir))


@query(
    "q_classes",
    with_frames('SELECT col AS "column", v AS value, code FROM classes', "classes"),
)
def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = V.new_features(spark, sf_dir).filter(F.col("year") <= V.TRAIN_UNTIL)
    fitted = features.Transformers({}, *features.fit_classes(train, list(CATEGORIES)))
    return features.class_table(spark, fitted).withColumn("code", F.col("code").cast("int"))


def _as_doubles(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in NUMERIC_FEATURES if c in df.columns})


@query(
    "q_apply_transformers",
    with_frames(f'SELECT {ID}, year, "default", {", ".join(ALL)} FROM applied', "applied"),
)
def apply_transformers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_doubles(V.applied(spark, sf_dir)).select(ID, "year", "default", *ALL)


@query(
    "q_prepare_inference",
    with_frames(f"SELECT {ID}, year, {', '.join(ALL)} FROM new_applied", "new_applied"),
)
def prepare_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = prepare_features(V.cleaned_new(spark, sf_dir), V.fitted(spark, sf_dir))
    return _as_doubles(ready).select(ID, "year", *ALL)


@query(
    "q_label_encode",
    with_frames(f"SELECT {ID}, {', '.join(CATEGORIES)} FROM new_applied", "new_applied"),
)
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.new_features(spark, sf_dir)
    train = rows.filter(F.col("year") <= V.TRAIN_UNTIL)
    fitted = features.Transformers({}, *features.fit_classes(train, list(CATEGORIES)))
    return features.encode_labels(rows.select(ID, *CATEGORIES), fitted)


_HOT = {
    "occupancy_status": ("I", "P", "S", "UNKNOWN"),
    "channel": ("B", "C", "R", "T", "UNKNOWN", "X"),
}


@query(
    "q_onehot",
    with_frames(
        f"SELECT {ID}, "
        + ", ".join(
            f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c in _HOT for v in _HOT[c]
        )
        + " FROM new_features",
        "new_features",
    ),
)
def onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.new_features(spark, sf_dir)
    train = rows.filter(F.col("year") <= V.TRAIN_UNTIL)
    fitted = features.Transformers({}, *features.fit_classes(train, list(_HOT)))
    return features.one_hot(rows.select(ID, *_HOT), fitted, list(_HOT))


@query(
    "q_mode_impute",
    with_frames(
        f"SELECT {ID}, coalesce(property_state, (SELECT property_state FROM new_features "
        "WHERE property_state IS NOT NULL GROUP BY property_state ORDER BY count(*) DESC, "
        "property_state LIMIT 1)) AS property_state FROM new_features",
        "new_features",
    ),
)
def mode_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.new_features(spark, sf_dir).select(ID, "property_state")
    return features.impute(rows, features.modes(rows, ["property_state"]))


@query(
    "q_median_impute",
    with_frames(
        f"SELECT {ID}, coalesce(f.credit_score, m.credit_score) AS credit_score, "
        "coalesce(f.original_dti, m.original_dti) AS original_dti "
        "FROM new_features f CROSS JOIN medians m",
        "new_features",
        "medians",
    ),
)
def median_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, columns = V.new_features(spark, sf_dir), ["credit_score", "original_dti"]
    train = rows.filter(F.col("year") <= V.TRAIN_UNTIL)
    return features.impute(rows.select(ID, *columns), features.exact_medians(train, columns))


@query(
    "q_standardise",
    with_frames(
        f"SELECT {ID}, round((original_upb - mu) / sd, 6) AS original_upb FROM new_features, "
        "(SELECT avg(original_upb) AS mu, stddev_pop(original_upb) AS sd FROM new_features) s",
        "new_features",
    ),
)
def standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.new_features(spark, sf_dir).select(ID, "original_upb")
    return rounded(features.standardise(rows, ["original_upb"]))


_BY_CLASS = 'PARTITION BY "default" '


@query(
    "q_stratified_split",
    with_frames(
        f'SELECT {ID}, "default", CASE WHEN rn <= ceil(0.2::DOUBLE * n) THEN 1 ELSE 0 END AS '
        f'is_validation FROM (SELECT *, {_hash_order(42, _BY_CLASS)} AS rn, '
        'count(*) OVER (PARTITION BY "default") AS n FROM target) t',
        "target",
    ),
)
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.stratified_split(V.target(spark, sf_dir), 0.2, ID, "default")


@query(
    "q_class_weights",
    with_frames(
        'SELECT "default", n_class, round(CAST(sum(n_class) OVER () AS DOUBLE) / '
        "(count(*) OVER () * n_class), 6) AS class_weight FROM (SELECT \"default\", count(*) AS "
        'n_class FROM target GROUP BY "default") t',
        "target",
    ),
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(features.class_weights(V.target(spark, sf_dir), "default"))


@query(
    "q_undersample",
    with_frames(
        f'SELECT {ID}, "default" FROM (SELECT *, {_hash_order(42, _BY_CLASS)} AS rn FROM target) t '
        'WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM target GROUP BY "default") c)',
        "target",
    ),
)
def undersample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.undersample(V.target(spark, sf_dir), "default", ID)


# Scoring with fixed coefficients: the plan is the same as with a fitted model.


@dataclass(frozen=True)
class FixedLogit:
    """Logistic score with given coefficients."""

    coefficients: dict[str, float]
    intercept: float
    threshold: float = 0.5
    family: str = "fixed_logit"
    features: list[str] = field(default_factory=list)

    def score(self, df: DataFrame, keep=()) -> DataFrame:
        names = list(self.coefficients)
        aligned, _ = align_features(df, names, keep)
        ready = sanitise_numbers(aligned, names)
        z = F.lit(self.intercept)
        for c in names:
            z = z + F.col(c) * self.coefficients[c]
        return ready.select(*keep, (1.0 / (1.0 + F.exp(-z))).alias(SCORE))


LOGIT = FixedLogit(
    {"credit_score": -0.01, "original_ltv": 0.02, "occupancy_status": 0.3, "absent": 1.0}, 4.0
)
_LOGIT = (
    "1.0::DOUBLE / (1.0::DOUBLE + exp(-(4.0::DOUBLE - credit_score * 0.01::DOUBLE + original_ltv * "
    "0.02::DOUBLE + occupancy_status * 0.3::DOUBLE)))"
)


def _logit_sql(threshold: float) -> str:
    return with_frames(
        f"SELECT {ID}, CASE WHEN {_LOGIT} >= {threshold} THEN 1 ELSE 0 END AS prediction, "
        f"round({_LOGIT}, 6) AS probability_default, CAST({threshold} AS DOUBLE) AS threshold, "
        "'fixed_logit' AS selected_model_family FROM new_applied",
        "new_applied",
    )


@query("q_logit_score", _logit_sql(0.5))
def logit_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = prepare_features(V.cleaned_new(spark, sf_dir), V.fitted(spark, sf_dir))
    return rounded(infer(ready, LOGIT))


@query("q_score_rows", _logit_sql(0.35))
def score_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = V.origination(spark, sf_dir)
    return rounded(score_rows(raw, LOGIT, V.fitted(spark, sf_dir), 0.35))


@query("q_score_stream", _logit_sql(0.35))
def score_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals, out = fresh_path(spark, "arrivals"), fresh_path(spark, "scored")
    raw = V.origination(spark, sf_dir)
    raw.write.parquet(arrivals)
    stream = spark.readStream.schema(raw.schema).parquet(arrivals)
    run = score_stream(
        stream, LOGIT, V.fitted(spark, sf_dir), out, fresh_path(spark, "progress"), 0.35
    )
    run.awaitTermination()
    return rounded(spark.read.parquet(out))


# Models: results are checked by rows and by tests, SQL cannot say them.

def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_by_year(rows, V.TRAIN_UNTIL, V.TEST_FROM)


def _fit(train: DataFrame, family: str):
    """The refit winner among five draws from the family's full space."""
    return train_search(train.select(ID, "default", *ALL), models=[family]).model


def _winner(train: DataFrame):
    """The refit winner among five draws from the full space of every family."""
    return train_search(train.select(ID, "default", *ALL)).model


def _train_query(family: str):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        train, test = _split(V.stored_features(spark, sf_dir))
        return infer(test, _fit(train, family))

    return build


for _family in SPACES:
    query(f"q_train_{_family}")(_train_query(_family))


@query("q_train_undersampled_forest")
def train_undersampled_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest whose trees each see both classes equally often, for classes of unequal size."""
    train, test = _split(V.stored_features(spark, sf_dir))
    space = SPACES["random_forest"] | {"undersample": [True], "class_weight": [None]}
    rows = train.select(ID, "default", *ALL)
    return infer(test, train_search(rows, models=["random_forest"], spaces={"random_forest": space}).model)


@query("q_search")
def search(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _split(V.stored_features(spark, sf_dir))
    return train_search(train).results


@query("q_evaluate")
def evaluate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _split(V.stored_features(spark, sf_dir))
    return evaluate(_winner(train), test)[0]


@query("q_model_store")
def model_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "model")
    fitted = V.fitted(spark, sf_dir)
    train = V.features(spark, sf_dir).filter(F.col("year") <= V.TRAIN_UNTIL)
    _winner(features.apply_transformers(train, fitted)).save(spark, path)
    fitted.save(spark, f"{path}/transformers")
    again = features.Transformers.load(spark, f"{path}/transformers")
    return score_rows(V.origination(spark, sf_dir), FittedModel.load(spark, path), again)


@query("q_importance")
def importance_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _split(V.stored_features(spark, sf_dir))
    phi = explain(test, _winner(train), ID)
    return importance(phi).orderBy(F.desc("mean_abs_shap"), "feature").limit(15)


# Drift

NUMERIC_WATCHED, CATEGORY_WATCHED = drift.drift_features(ALL)


def _drift_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = drift.drift_input(V.stored_features(spark, sf_dir), ALL, keep=["year"])
    return rows.filter(F.col("year") <= V.TRAIN_UNTIL), rows.filter(F.col("year") >= V.TEST_FROM)


def _long(columns, value: str) -> str:
    return " UNION ALL ".join(
        f"SELECT CASE WHEN year <= 1997 THEN 0 ELSE year END AS slice, '{c}' AS feature, "
        f"{value.format(c=c)} AS value FROM applied"
        for c in columns
    )


_NUMERIC_FRAMES = {
    "long": _long(NUMERIC_WATCHED, "CAST({c} AS DOUBLE)"),
    "years": "SELECT DISTINCT slice AS year FROM long WHERE slice > 0",
    "counts": "SELECT y.year, l.feature, l.value, CAST(count(*) FILTER (l.slice = 0) AS DOUBLE) "
    "AS r, CAST(count(*) FILTER (l.slice = y.year) AS DOUBLE) AS c FROM long l CROSS JOIN years y "
    "GROUP BY y.year, l.feature, l.value",
    "cdf": "SELECT *, sum(r) OVER (w ORDER BY value) / sum(r) OVER w AS fr, "
    "sum(c) OVER (w ORDER BY value) / sum(c) OVER w AS fc, "
    "lead(value) OVER (w ORDER BY value) - value AS step, sum(r) OVER w AS nr, "
    "sum(c) OVER w AS nc FROM counts WINDOW w AS (PARTITION BY year, feature)",
    "numeric": "SELECT CAST(year AS INTEGER) AS year, feature, CAST(max(nr) AS BIGINT) AS "
    "n_reference, CAST(max(nc) AS BIGINT) AS n_current, max(abs(fr - fc)) AS ks, "
    "sum(abs(fr - fc) * coalesce(step, 0)) AS w1 FROM cdf GROUP BY year, feature",
    "spread": "SELECT feature, stddev_pop(value) AS sd FROM long WHERE slice = 0 GROUP BY feature",
}
_CATEGORY_FRAMES = {
    "long_c": _long(CATEGORY_WATCHED, "CAST({c} AS VARCHAR)"),
    "years_c": "SELECT DISTINCT slice AS year FROM long_c WHERE slice > 0",
    "counts_c": "SELECT y.year, l.feature, l.value, CAST(count(*) FILTER (l.slice = 0) AS DOUBLE) "
    "AS r, CAST(count(*) FILTER (l.slice = y.year) AS DOUBLE) AS c FROM long_c l CROSS JOIN "
    "years_c y GROUP BY y.year, l.feature, l.value",
    "share": "SELECT *, r / sum(r) OVER w AS p, c / sum(c) OVER w AS q, sum(r) OVER w AS nr, "
    "sum(c) OVER w AS nc FROM counts_c WINDOW w AS (PARTITION BY year, feature)",
    "category": "SELECT CAST(year AS INTEGER) AS year, feature, CAST(max(nr) AS BIGINT) AS "
    "n_reference, CAST(max(nc) AS BIGINT) AS n_current, sqrt(greatest(0, sum("
    "CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + "
    "CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS js, "
    "sum(CASE WHEN p > 0 THEN (c - p * nc) * (c - p * nc) / (p * nc) "
    "WHEN c > 0 THEN 'inf'::DOUBLE ELSE 0 END) AS chi, "
    "count(*) FILTER (r > 0 OR c > 0) - 1 AS degrees FROM share GROUP BY year, feature",
}
_STABILITY_FRAMES = {
    "below": "SELECT *, sum(r) OVER (w ORDER BY value) - r AS below, sum(r) OVER w AS nr, sum(c) OVER w AS nc "
    "FROM counts WINDOW w AS (PARTITION BY year, feature)",
    "binned": "SELECT year, feature, least(floor(below * 10 / nr), 9) AS bin, sum(r) AS r, sum(c) AS c, "
    "max(nr) AS nr, max(nc) AS nc FROM below GROUP BY 1, 2, 3",
    "shares": "SELECT *, greatest(r / nr, 0.0001::DOUBLE) AS p, greatest(c / nc, 0.0001::DOUBLE) AS q FROM binned",
}
_BOTH = (
    "SELECT n.year, n.feature, w1 / greatest(sd, 0.001) >= 0.1 AS drift_detected, "
    "round(w1 / greatest(sd, 0.001), 6) AS drift_score, 'wasserstein' AS stattest_name, "
    "n_reference, n_current FROM numeric n JOIN spread s ON n.feature = s.feature UNION ALL "
    "SELECT year, feature, js >= 0.1, round(js, 6), 'jensenshannon', n_reference, n_current "
    "FROM category"
)


@query(
    "q_drift_numeric",
    with_frames(
        "SELECT n.year, n.feature, n_reference, n_current, round(ks, 6) AS ks, "
        "round(w1, 6) AS wasserstein, round(w1 / greatest(sd, 0.001), 6) AS wasserstein_normed "
        "FROM numeric n JOIN spread s ON n.feature = s.feature",
        "applied",
        **_NUMERIC_FRAMES,
    ),
)
def drift_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = _drift_frames(spark, sf_dir)
    rows = drift.numeric_drift(reference, current, NUMERIC_WATCHED, V.years_in(current))
    return rounded(rows.drop("ks_p_value"))


@query(
    "q_drift_stability",
    with_frames(
        "SELECT CAST(year AS INTEGER) AS year, feature, CAST(max(nr) AS BIGINT) AS n_reference, "
        "CAST(max(nc) AS BIGINT) AS n_current, count(*) AS n_bins, round(sum((q - p) * ln(q / p)), 6) AS psi "
        "FROM shares GROUP BY year, feature",
        "applied",
        **{k: _NUMERIC_FRAMES[k] for k in ("long", "years", "counts")},
        **_STABILITY_FRAMES,
    ),
)
def drift_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = _drift_frames(spark, sf_dir)
    return rounded(drift.population_stability(reference, current, NUMERIC_WATCHED, V.years_in(current)))


@query(
    "q_drift_categorical",
    with_frames(
        "SELECT year, feature, n_reference, n_current, round(js, 6) AS jensenshannon, "
        "round(chi, 6) AS chisquare, degrees FROM category",
        "applied",
        **_CATEGORY_FRAMES,
    ),
)
def drift_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = _drift_frames(spark, sf_dir)
    return rounded(drift.categorical_drift(reference, current, CATEGORY_WATCHED, V.years_in(current)))


def _feature_drift(spark: SparkSession, sf_dir: str, *tests: str) -> DataFrame:
    reference, current = _drift_frames(spark, sf_dir)
    return drift.feature_drift(
        reference, current, NUMERIC_WATCHED, CATEGORY_WATCHED, V.years_in(current), *tests
    )


@query(
    "q_drift_features",
    with_frames(_BOTH, "applied", **_NUMERIC_FRAMES, **_CATEGORY_FRAMES),
)
def drift_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_feature_drift(spark, sf_dir))


@query("q_drift_p_values")
def drift_p_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feature_drift(spark, sf_dir, "ks", "chisquare")


@query(
    "q_drift_dataset",
    with_frames(
        "SELECT year, max(n_reference) AS n_reference_rows, max(n_current) AS n_loans, "
        "count(*) FILTER (drift_detected) AS n_drifted_features, count(*) AS n_features, "
        "round(avg(CASE WHEN drift_detected THEN 1 ELSE 0 END), 6) AS share_drifted, "
        "CAST(0.5 AS DOUBLE) AS share_limit, "
        "avg(CASE WHEN drift_detected THEN 1 ELSE 0 END) >= 0.5 AS dataset_drift_detected, "
        "'train_1995_1997' AS reference_label, 'first_payment_date_year,"
        "first_payment_date_month,maturity_date_year,maturity_date_month,loan_term_months' AS "
        f"features_excluded FROM ({_BOTH}) t GROUP BY year",
        "applied",
        **_NUMERIC_FRAMES,
        **_CATEGORY_FRAMES,
    ),
)
def drift_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _feature_drift(spark, sf_dir)
    return rounded(drift.dataset_drift(found, reference_label="train_1995_1997"))
