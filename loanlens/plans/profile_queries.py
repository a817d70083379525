"""Queries over counting operators, the quality suite and the cleaning statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.operators import profile
from loanlens.operators.cleaning import cleaning_statistics
from loanlens.operators.quality import Bounds, FailedChecks, quality_checks, quality_gate
from loanlens.plans import frames as V
from loanlens.plans.oracle import NUMERIC_FEATURES, integer, num, with_frames
from loanlens.plans.registry import query
from loanlens.roles import LOAN_ROLES, ORIGINATION_COLUMNS

ID = LOAN_ROLES.loan_id
RATE = 'round(avg("default"), 6) AS default_rate'


def _stack(rows: list[str]) -> str:
    return " UNION ALL ".join(rows)


@query(
    "q_default_rate_by_year",
    with_frames(
        f'SELECT year, count(*) AS n_loans, CAST(sum("default") AS BIGINT) AS n_default, {RATE} '
        "FROM model_input GROUP BY year",
        "model_input",
    ),
)
def default_rate_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = profile.rate_by_group(V.model_input(spark, sf_dir), "year")
    return rates.withColumn("default_rate", F.round("default_rate", 6))


@query(
    "q_default_rate_by_type",
    with_frames(
        'SELECT amortization_type, count(*) AS n_loans, CAST(sum("default") AS BIGINT) AS '
        f"n_default, {RATE} FROM model_input GROUP BY amortization_type",
        "model_input",
    ),
)
def default_rate_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = profile.rate_by_group(V.model_input(spark, sf_dir), "amortization_type")
    return rates.withColumn("default_rate", F.round("default_rate", 6))


@query(
    "q_default_rate_rollup",
    with_frames(
        "SELECT * REPLACE (CAST(year AS DOUBLE) AS year) FROM ("
        'SELECT year, amortization_type, property_state, count(*) AS n_loans, CAST(sum("default") AS BIGINT) AS '
        "n_default, CAST(3 - GROUPING(year) - GROUPING(amortization_type) - GROUPING(property_state) AS INTEGER) "
        f"AS level, {RATE} FROM model_input GROUP BY ROLLUP (year, amortization_type, property_state)) t",
        "model_input",
    ),
)
def default_rate_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = ["year", "amortization_type", "property_state"]
    rates = profile.rate_rollup(V.model_input(spark, sf_dir), groups)
    # whole numbers that may be null come back as doubles
    return rates.withColumns({"default_rate": F.round("default_rate", 6), "year": F.col("year").cast("double")})


@query(
    "q_split_summary",
    with_frames(
        "SELECT CASE WHEN year <= 1997 THEN 'train' ELSE 'test' END AS split, "
        f"count(*) AS n_rows, {RATE} FROM model_input GROUP BY 1",
        "model_input",
    ),
)
def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = profile.tag_splits(V.model_input(spark, sf_dir), V.TRAIN_UNTIL, V.TEST_FROM)
    return profile.split_summary(tagged).withColumn("default_rate", F.round("default_rate", 6))


@query(
    "q_missing",
    with_frames(
        _stack(
            [
                f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing_count, "
                f"round(count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*), 3) AS missing_pct "
                "FROM origination"
                for c in (*ORIGINATION_COLUMNS, "year")
            ]
        ),
        "origination",
    ),
)
def missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing(V.origination(spark, sf_dir))


@query(
    "q_missing_report",
    with_frames(
        "SELECT * FROM ("
        + _stack(
            [
                f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing_count, "
                f"round(count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*), 3) AS missing_pct "
                "FROM features"
                for c in NUMERIC_FEATURES
            ]
        )
        + ") t WHERE missing_count > 0 ORDER BY missing_count DESC",
        "features",
    ),
)
def missing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = V.features(spark, sf_dir).select(*NUMERIC_FEATURES)
    return profile.missing(columns, only_missing=True).orderBy(F.desc("missing_count"))


@query(
    "q_value_counts",
    with_frames(
        "SELECT property_state, count(*) AS n, round(count(*) * 100.0::DOUBLE / "
        "(SELECT count(*) FROM cleaned_new), 3) AS pct FROM cleaned_new GROUP BY property_state",
        "cleaned_new",
    ),
)
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(V.cleaned_new(spark, sf_dir), "property_state")


@query(
    "q_value_counts_top",
    with_frames(
        "SELECT property_state, count(*) AS n, round(count(*) * 100.0::DOUBLE / "
        "(SELECT count(*) FROM cleaned_new), 3) AS pct FROM cleaned_new GROUP BY property_state "
        "ORDER BY n DESC, property_state NULLS FIRST LIMIT 20",
        "cleaned_new",
    ),
)
def value_counts_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(V.cleaned_new(spark, sf_dir), "property_state", top=20)


_SENTINELS = [
    f"SELECT '{c}' AS \"column\", '{v}' AS sentinel_value, count(*) AS n, "
    "round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM origination), 3) AS rate_pct "
    f"FROM origination WHERE trim({c}) = '{v}'"
    for c, values in LOAN_ROLES.summary_sentinels.items()
    for v in values
]


@query(
    "q_sentinel_summary",
    with_frames(f"SELECT * FROM ({_stack(_SENTINELS)}) t WHERE n > 0", "origination"),
)
def sentinel_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.sentinel_summary(V.origination(spark, sf_dir))


@query(
    "q_parse_failures",
    with_frames(
        _stack(
            [
                f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS parse_failed_count "
                "FROM cleaned_new"
                for c in LOAN_ROLES.dates
            ]
        ),
        "cleaned_new",
    ),
)
def parse_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.parse_failures(V.origination(spark, sf_dir), LOAN_ROLES.dates)


@query(
    "q_duplicates",
    with_frames(
        "SELECT count(*) AS n_rows, count(*) - count(DISTINCT loan_sequence_number) AS "
        "duplicate_count FROM performance",
        "performance",
    ),
)
def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicate_count(V.performance(spark, sf_dir), ID)


@query(
    "q_format_counts",
    with_frames(
        "SELECT 'loan_sequence_number' AS \"column\", count(*) FILTER (NOT coalesce("
        "regexp_matches(loan_sequence_number, '^[FA]\\d{2}Q[1-4]\\d{7}$'), false)) AS invalid_count "
        "FROM cleaned_new UNION ALL SELECT 'property_state', count(*) FILTER (NOT coalesce("
        "regexp_matches(property_state, '^[A-Z]{2}$'), false)) FROM cleaned_new",
        "cleaned_new",
    ),
)
def format_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    patterns = {ID: LOAN_ROLES.id_pattern, "property_state": LOAN_ROLES.state_pattern}
    return profile.format_counts(V.cleaned_new(spark, sf_dir), patterns)


_RANGES = [
    f"SELECT '{c}_valid' AS \"check\", coalesce(bool_and({c} BETWEEN {lo} AND {hi}), true) AS valid "
    "FROM cleaned"
    for c, (lo, hi) in LOAN_ROLES.ranges.items()
] + [
    f"SELECT '{c}_valid', coalesce(bool_and(\"{c}\" IN {v}), true) FROM cleaned"
    for c, v in LOAN_ROLES.value_sets.items()
]


@query("q_range_checks", with_frames(_stack(_RANGES), "cleaned"))
def range_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.range_checks(V.cleaned(spark, sf_dir))


_DOMAINS = _stack(
    [
        f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n, "
        f"{c} IN ({', '.join(repr(v) for v in values)}) AS allowed "
        f"FROM cleaned_new WHERE {c} IS NOT NULL GROUP BY {c}"
        for c, values in LOAN_ROLES.allowed.items()
    ]
)


@query("q_domain_values", with_frames(_DOMAINS, "cleaned_new"))
def domain_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.domain_values(V.cleaned_new(spark, sf_dir))


@query(
    "q_domain_checks",
    with_frames(
        'SELECT "column", count(*) AS n_observed, count(*) FILTER (NOT allowed) AS n_unexpected, '
        "CAST(sum(CASE WHEN allowed THEN 0 ELSE n END) AS BIGINT) AS unexpected_rows, "
        f'bool_and(allowed) AS valid FROM ({_DOMAINS}) t GROUP BY "column"',
        "cleaned_new",
    ),
)
def domain_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.domain_checks(V.cleaned_new(spark, sf_dir))


_AFTER = "coalesce(maturity_date > first_payment_date, false)"


@query(
    "q_date_checks",
    with_frames(
        "SELECT true AS available, min(first_payment_date) AS first_payment_date_min, "
        "max(first_payment_date) AS first_payment_date_max, "
        "min(maturity_date) AS maturity_date_min, max(maturity_date) AS maturity_date_max, "
        f"bool_and({_AFTER}) AS maturity_after_first_payment_all, "
        f"count(*) FILTER (NOT {_AFTER}) AS maturity_not_after_first_payment_count "
        "FROM cleaned_new",
        "cleaned_new",
    ),
)
def date_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.date_checks(V.cleaned_new(spark, sf_dir))


_TERM = (
    "(year(maturity_date) - year(first_payment_date)) * 12 + month(maturity_date) - "
    "month(first_payment_date) + 1 - original_loan_term"
)


@query(
    "q_term_diff",
    with_frames(
        f"SELECT CAST({_TERM} AS BIGINT) AS term_difference, count(*) AS n FROM cleaned_new "
        f"WHERE {_TERM} IS NOT NULL GROUP BY 1",
        "cleaned_new",
    ),
)
def term_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.term_difference_counts(V.cleaned_new(spark, sf_dir))


@query(
    "q_date_summary",
    with_frames(
        _stack(
            [
                f"SELECT '{c}' AS \"column\", min({c}) AS min_date, "
                f"median(CAST(date_diff('day', DATE '1970-01-01', {c}) AS DOUBLE)) AS median_day, "
                f"max({c}) AS max_date FROM cleaned_new"
                for c in LOAN_ROLES.dates
            ]
        ),
        "cleaned_new",
    ),
)
def date_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.date_summary(V.cleaned_new(spark, sf_dir), LOAN_ROLES.dates)


@query(
    "q_medians",
    with_frames(
        _stack([f"SELECT '{c}' AS \"column\", {c} AS median FROM medians" for c in NUMERIC_FEATURES]),
        "medians",
    ),
)
def medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = V.new_features(spark, sf_dir).filter(F.col("year") <= V.TRAIN_UNTIL)
    return profile.medians(train, NUMERIC_FEATURES)


@query(
    "q_hist50",
    with_frames(
        "SELECT CAST(least(floor((original_interest_rate - lo) / (hi - lo) * 50) + 1, 50) AS "
        "INTEGER) AS bin, count(*) AS n FROM cleaned_new, (SELECT min(original_interest_rate) AS "
        "lo, max(original_interest_rate) AS hi FROM cleaned_new) b "
        "WHERE original_interest_rate IS NOT NULL GROUP BY 1",
        "cleaned_new",
    ),
)
def hist50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.histogram(V.cleaned_new(spark, sf_dir), "original_interest_rate", 50)


@query(
    "q_monthly_counts",
    with_frames(
        "SELECT CAST(date_trunc('month', first_payment_date) AS DATE) AS month, count(*) AS n "
        "FROM cleaned_new GROUP BY 1",
        "cleaned_new",
    ),
)
def monthly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.monthly_counts(V.cleaned_new(spark, sf_dir), "first_payment_date")


@query(
    "q_shape",
    with_frames(
        "SELECT (SELECT count(*) FROM model_input) AS rows_before, count(*) AS rows_after, "
        "CAST(0 AS BIGINT) AS rows_removed, CAST(34 AS INTEGER) AS columns_before, "
        "CAST(28 AS INTEGER) AS columns_after FROM cleaned",
        "cleaned",
    ),
)
def shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.shape(V.model_input(spark, sf_dir), V.cleaned(spark, sf_dir))


def _statistics_sql() -> str:
    def one(stat: str, column: str, value: str, source: str = "cleaned") -> str:
        return (
            f"SELECT '{stat}' AS stat, '{column}' AS \"column\", '' AS \"key\", "
            f"CAST({value} AS VARCHAR) AS value FROM {source}"
        )

    rows = [
        one("sentinel_count", c, f"count(*) FILTER ({num(c)} = {v[0]})", "model_input")
        for c, v in LOAN_ROLES.numeric_sentinels.items()
    ]
    rows += [
        one("parse_failed_count", c, f"count(*) FILTER ({c} IS NULL)") for c in LOAN_ROLES.dates
    ]
    rows += [
        one("unknown_count", c, f"count(*) FILTER (upper(trim({c})) = '{v[0]}')", "model_input")
        for c, v in LOAN_ROLES.category_sentinels.items()
    ]
    rows += [
        one("missing_count", "msa", "count(*) FILTER (msa IS NULL)"),
        one("missing_count", "default", 'count(*) FILTER ("default" IS NULL)'),
        one(
            "invalid_count",
            ID,
            f"count(*) FILTER (NOT regexp_matches({ID}, '^[FA]\\d{{2}}Q[1-4]\\d{{7}}$'))",
        ),
        one(
            "invalid_count",
            "property_state",
            "count(*) FILTER (NOT coalesce(regexp_matches(property_state, '^[A-Z]{2}$'), false))",
        ),
        one("duplicate_count", ID, f"count(*) - count(DISTINCT {ID})"),
    ]
    rows += [
        one(
            "range_check",
            f"{c}_valid",
            f"CAST(coalesce(bool_and({c} BETWEEN {lo} AND {hi}), true) AS INTEGER)",
        )
        for c, (lo, hi) in LOAN_ROLES.ranges.items()
    ]
    rows += [
        one("range_check", f"{c}_valid", f'CAST(coalesce(bool_and("{c}" IN {v}), true) AS INTEGER)')
        for c, v in LOAN_ROLES.value_sets.items()
    ]
    for c in LOAN_ROLES.dates:
        rows += [one("date_check", f"{c}_{f}", f"{f}({c})") for f in ("min", "max")]
    rows += [
        one("date_check", "maturity_after_first_payment_all", f"bool_and({_AFTER})"),
        one("date_check", "maturity_not_after_first_payment_count", f"count(*) FILTER (NOT {_AFTER})"),
    ]
    kept = [c for c in ORIGINATION_COLUMNS if c not in LOAN_ROLES.dropped]
    rows += [
        one("missing_after_cleaning", c, f'count(*) FILTER ("{c}" IS NULL)')
        for c in (*kept, "year", "default")
    ]
    rows += [
        one("rows_before", "", "count(*)"),
        one("rows_after", "", "count(*)"),
        one("rows_removed", "", "0 * count(*)"),
        one("columns_before", "", "34 + 0 * count(*)"),
        one("columns_after", "", "28 + 0 * count(*)"),
    ]
    rows += [f"SELECT 'listed_dropped', '{c}', '', '1'" for c in LOAN_ROLES.dropped]
    for c, values in LOAN_ROLES.allowed.items():
        allowed = ", ".join(repr(v) for v in values)
        rows.append(
            f"SELECT CASE WHEN {c} IN ({allowed}) THEN 'observed_value' ELSE 'unexpected_value' END, "
            f"'{c}', {c}, CAST(count(*) AS VARCHAR) FROM cleaned WHERE {c} IS NOT NULL GROUP BY {c}"
        )
    rows.append(
        f"SELECT 'term_difference', 'term_difference', CAST({_TERM} AS VARCHAR), "
        f"CAST(count(*) AS VARCHAR) FROM cleaned WHERE {_TERM} IS NOT NULL GROUP BY {_TERM}"
    )
    rows.append(
        "SELECT 'target_distribution', 'default', CAST(\"default\" AS VARCHAR), "
        'CAST(count(*) AS VARCHAR) FROM cleaned GROUP BY "default"'
    )
    return _stack(rows)


@query("q_clean_stats", with_frames(_statistics_sql(), "cleaned"))
def clean_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning_statistics(V.model_input(spark, sf_dir))


# Quality suite

BOUNDS = Bounds(rows=(1, 10**15), years=(1995, 2001), msa_present=0.80)


def _quality_sql() -> str:
    def row(check, column, success, observed, bad, critical) -> str:
        return (
            f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", {success} AS success, "
            f"CAST({observed} AS DOUBLE) AS observed, CAST({bad} AS BIGINT) AS unexpected_count, "
            f"{critical} AS critical FROM model_input"
        )

    def per_value(check, column, good, critical) -> str:
        bad = f'count(*) FILTER ("{column}" IS NOT NULL AND NOT coalesce({good}, false))'
        return row(check, column, f"{bad} = 0", f"count(*) - {bad}", bad, critical)

    score, ltv, rate = num("credit_score"), num("original_ltv"), num("original_interest_rate")
    pairs = {
        "maturity_date>first_payment_date": f"{num('maturity_date')} > {num('first_payment_date')}",
        "original_cltv>=original_ltv": f"{num('original_cltv')} >= {num('original_ltv')}",
    }
    rows = [
        row("column_count", "", "count(*) >= 0", "34 + 0 * count(*)", "0 * count(*)", "true"),
        row("row_count", "", "count(*) >= 1", "count(*)", "0 * count(*)", "false"),
        *[
            row("column_exists", c, "count(*) >= 0", "1 + 0 * count(*)", "0 * count(*)", "true")
            for c in (ID, "default", "year")
        ],
        per_value("in_set", "default", '"default" IN (0, 1)', "true"),
        per_value("between", "year", "year BETWEEN 1995 AND 2001", "false"),
        per_value(
            "in_set",
            "credit_score",
            f"({score} BETWEEN 300 AND 850 AND {score} = floor({score})) OR {score} = 9999",
            "true",
        ),
        per_value("between", "original_ltv", f"{ltv} BETWEEN 6 AND 999", "false"),
        per_value("between", "original_interest_rate", f"{rate} > 0 AND {rate} <= 30", "false"),
        row(
            "not_null",
            "msa",
            "avg(CASE WHEN msa IS NULL THEN 0 ELSE 1 END) >= 0.8",
            "count(msa) / count(*)",
            "count(*) - count(msa)",
            "false",
        ),
        row("unique", ID, f"count({ID}) = count(DISTINCT {ID})", f"count(DISTINCT {ID})", 
            f"(SELECT coalesce(sum(n), 0) FROM (SELECT count({ID}) AS n FROM model_input GROUP BY {ID}) g "
            "WHERE n > 1)", "true"),
    ]
    for name, good in pairs.items():
        bad = f"count(*) FILTER (NOT coalesce({good}, false))"
        rows.append(row("pair", name, f"{bad} = 0", f"count(*) - {bad}", bad, "false"))
    return _stack(rows)


@query("q_quality_suite", with_frames(_quality_sql(), "model_input"))
def quality_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_checks(V.model_input(spark, sf_dir), BOUNDS)


def _gate_sql(state: str, repaired: str = "") -> str:
    """Failed critical checks of the table, without the one that the repair mends."""
    name = "q.check || '(' || q.\"column\" || ')'"
    return (
        f"SELECT '{state}' AS state, count(*) = 0 AS passed, coalesce(string_agg({name}, ',' "
        f"ORDER BY {name}), '') AS failed FROM ({_quality_sql()}) q "
        f"WHERE q.critical AND NOT q.success AND {name} <> '{repaired}'"
    )


@query(
    "q_quality_gate",
    with_frames(
        f"{_gate_sql('as read')} UNION ALL {_gate_sql('repaired', 'in_set(credit_score)')}",
        "model_input",
    ),
)
def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate says of the table as read, and of one whose scores outside the set became the
    sentinel."""
    rows = V.model_input(spark, sf_dir)
    score = F.col("credit_score").try_cast("bigint")
    repaired = F.when(score.between(300, 850), score).otherwise(F.lit(9999))
    found = []
    for state, given in (("as read", rows), ("repaired", rows.withColumn("credit_score", repaired))):
        try:
            quality_gate(given, BOUNDS)
            found.append((state, True, ""))
        except FailedChecks as e:
            found.append((state, False, ",".join(e.checks)))
    return spark.createDataFrame(found, "state string, passed boolean, failed string")
