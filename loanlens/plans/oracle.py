"""The shared frames in plain SQL, written apart from the operators."""

from __future__ import annotations

from loanlens.plans.views import view_sql

# Columns as the cleaning rules see them.
NUMBERS = ("original_upb", "original_interest_rate")
SENTINEL_NUMBERS = {
    "credit_score": 9999,
    "mi_percentage": 999,
    "original_cltv": 999,
    "original_dti": 999,
    "original_ltv": 999,
}
INTEGERS = {
    "number_of_units": 99,
    "number_of_borrowers": 99,
    "original_loan_term": None,
    "postal_code": None,
    "msa": None,
}
CATEGORIES = {
    "first_time_homebuyer_flag": "9",
    "occupancy_status": "9",
    "channel": "9",
    "prepayment_penalty_flag": None,
    "amortization_type": None,
    "property_state": None,
    "property_type": "99",
    "loan_purpose": "9",
    "interest_only_indicator": None,
}
TEXTS = ("loan_sequence_number", "seller_name", "servicer_name")
DATES = ("first_payment_date", "maturity_date")
NUMERIC_FEATURES = (
    "credit_score",
    "mi_percentage",
    "number_of_units",
    "original_cltv",
    "original_dti",
    "original_upb",
    "original_ltv",
    "original_interest_rate",
    "original_loan_term",
    "number_of_borrowers",
    "first_payment_date_year",
    "first_payment_date_month",
    "maturity_date_year",
    "maturity_date_month",
    "loan_term_months",
)


def num(c: str) -> str:
    return f"TRY_CAST(trim({c}) AS DOUBLE)"


def integer(c: str) -> str:
    return f"CASE WHEN {num(c)} = floor({num(c)}) THEN CAST({num(c)} AS BIGINT) END"


def month(c: str) -> str:
    return f"CAST(try_strptime(CAST({integer(c)} AS VARCHAR), '%Y%m') AS DATE)"


def cat(c: str, sentinel: str | None = None) -> str:
    text = f"upper(trim({c}))"
    return f"CASE WHEN {text} = '{sentinel}' THEN 'UNKNOWN' ELSE {text} END" if sentinel else text


def clean_column(c: str) -> str:
    if c in DATES:
        return month(c)
    if c in CATEGORIES:
        return cat(c, CATEGORIES[c])
    if c in TEXTS:
        return cat(c)
    if c in INTEGERS:
        value = integer(c)
        return f"NULLIF({value}, {INTEGERS[c]})" if INTEGERS[c] else value
    if c in SENTINEL_NUMBERS:
        return f"NULLIF({num(c)}, {SENTINEL_NUMBERS[c]})"
    return num(c)


CLEAN_COLUMNS = (*SENTINEL_NUMBERS, *NUMBERS, *INTEGERS, *DATES, *CATEGORIES, *TEXTS)
_CLEAN = ", ".join(f"{clean_column(c)} AS {c}" for c in CLEAN_COLUMNS)

_FEATURE_COLUMNS = ", ".join(
    [
        *[c for c in NUMERIC_FEATURES[:10]],
        *[f"CAST({p}({d}) AS INTEGER) AS {d}_{p}" for d in DATES for p in ("year", "month")],
        "CAST((year(maturity_date) - year(first_payment_date)) * 12 + month(maturity_date)"
        " - month(first_payment_date) AS INTEGER) AS loan_term_months",
        *CATEGORIES,
    ]
)
_MEDIANS = ", ".join(f"CAST(median({c}) AS DOUBLE) AS {c}" for c in NUMERIC_FEATURES)
_CLASSES = " UNION ALL ".join(
    f"SELECT '{c}' AS col, v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM ("
    f"SELECT DISTINCT coalesce({c}, '<NA>') AS v FROM train_features"
    f" UNION SELECT 'unknown') t"
    for c in CATEGORIES
)


def _applied(source: str, extra: str) -> str:
    numbers = ", ".join(
        f"coalesce(CAST(f.{c} AS DOUBLE), m.{c}) AS {c}" for c in NUMERIC_FEATURES
    )
    codes = ", ".join(
        f"coalesce(k{i}.code, (SELECT code FROM classes WHERE col = '{c}' AND v = 'unknown')) AS {c}"
        for i, c in enumerate(CATEGORIES)
    )
    joins = " ".join(
        f"LEFT JOIN classes k{i} ON k{i}.col = '{c}' AND k{i}.v = coalesce(f.{c}, '<NA>')"
        for i, c in enumerate(CATEGORIES)
    )
    return (
        f"SELECT f.loan_sequence_number, f.year{extra}, {numbers}, {codes} "
        f"FROM {source} f CROSS JOIN medians m {joins}"
    )


CODE = "CAST(TRY_CAST(trim(zero_balance_code) AS DOUBLE) AS BIGINT)"
SQL = {
    "origination": view_sql("origination"),
    "performance": view_sql("performance"),
    "scores": view_sql("scores"),
    "target": f"""SELECT loan_sequence_number,
        CAST(max(CASE WHEN {CODE} IN (2, 3, 9) THEN 1 ELSE 0 END) AS INTEGER) AS "default"
        FROM performance GROUP BY loan_sequence_number""",
    "model_input": """SELECT o.*, t."default" FROM origination o
        JOIN target t ON o.loan_sequence_number = t.loan_sequence_number""",
    "cleaned": f'SELECT {_CLEAN}, year, "default" FROM model_input',
    "cleaned_new": f"SELECT {_CLEAN}, year FROM origination",
    "features": f'SELECT loan_sequence_number, year, "default", {_FEATURE_COLUMNS} FROM cleaned',
    "new_features": f"SELECT loan_sequence_number, year, {_FEATURE_COLUMNS} FROM cleaned_new",
    "train_features": "SELECT * FROM new_features WHERE year <= 1997",
    "medians": f"SELECT {_MEDIANS} FROM train_features",
    "classes": _CLASSES,
    "applied": _applied("features", ', f."default"'),
    "new_applied": _applied("new_features", ""),
    "predictions": """SELECT s.loan_sequence_number, s.year, s.probability_default,
        t."default" AS actual_default,
        CASE WHEN s.probability_default >= 0.5 THEN 1 ELSE 0 END AS prediction
        FROM scores s JOIN target t ON s.loan_sequence_number = t.loan_sequence_number""",
    "line_scores": """SELECT CAST(year(l_shipdate) AS INTEGER) AS year,
        CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS actual_default,
        CAST((l_orderkey * 7919 + l_partkey * 31) % 8009
          + CASE WHEN l_returnflag = 'R' THEN 1500 ELSE 0 END AS DOUBLE) / 10007
          AS probability_default FROM lineitem""",
}
NEEDS = {
    "target": ("performance",),
    "model_input": ("origination", "target"),
    "cleaned": ("model_input",),
    "cleaned_new": ("origination",),
    "features": ("cleaned",),
    "new_features": ("cleaned_new",),
    "train_features": ("new_features",),
    "medians": ("train_features",),
    "classes": ("train_features",),
    "applied": ("features", "medians", "classes"),
    "new_applied": ("new_features", "medians", "classes"),
    "predictions": ("scores", "target"),
}


def with_frames(body: str, *names: str, **own: str) -> str:
    """``body`` over the named frames, each a common table expression; ``own`` come last."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in NEEDS.get(name, ()):
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        need(name)
    parts = [f"{n} AS ({SQL[n]})" for n in ordered] + [f"{n} AS ({s})" for n, s in own.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body
