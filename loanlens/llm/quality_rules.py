"""Quality rules in one projection of built-in functions.

A table of limits over ratios of length, symbols, stop words and lines is compiled into Spark
expressions; a document is kept when every ratio lies within its limits.

Defined results: null text counts as empty and fails the length rule; a ratio over nothing is 0;
repeated ids give one row each; other columns are not read. Windows of eight words are compared by
a 64-bit hash within one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm.frames import SPACES, ascii_lower, table, texts, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for was with as on be by this are from or an at which "
    "le la les de des du et en un une que qui pour dans par sur au ce est pas "
    "der die das und den von zu mit ist im dem nicht ein eine auf sich des auch "
    "el los las y del se por con una para su al lo como más"
).split()
#: Marks that end a word.
_END_MARKS = ".,;:!?"


@dataclass(frozen=True)
class Rule:
    """``low <= ratio <= high``; the ratio is a quotient of two of the columns of ``counts``."""

    name: str
    over: str
    under: str
    low: float
    high: float


#: The thresholds a document has to meet, beside the base rule on length and repetition.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 1.5, 20.0),
    Rule("symbols_per_char", "n_symbols", "word_chars", 0.0, 0.08),
    Rule("stop_word_share", "n_stop_words", "n_words", 0.01, 1.0),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", 0.0, 0.4),
    Rule("upper_case_share", "n_upper", "word_chars", 0.0, 0.4),
    Rule("exclaimed_words", "n_exclaimed", "n_words", 0.0, 0.3),
)


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def count_of(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are among ``chars``."""
    return (F.length(text) - F.length(without(text, chars))).cast("long")


def repeated_words(hashes: Column) -> Column:
    """Words covered by windows that occur twice or more, from the sorted (hash, place) windows."""
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    places = F.transform(
        hashes,
        lambda x, j: F.when(
            (same(x, F.get(hashes, j - 1)) & (j > 0)) | same(x, F.get(hashes, j + 1)), x["i"]
        ),
    )
    return F.aggregate(
        F.sort_array(F.filter(places, lambda p: p.isNotNull())),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).cast("long").alias("n"), p.alias("last")
        ),
        lambda a: a["n"],
    )


def counts(docs: DataFrame) -> DataFrame:
    """Counts per text of (doc_id, text)."""
    text, w = F.col("text"), F.col("w")
    lines = F.filter(F.split(text, "\n"), lambda x: without(x, SPACES) != "")
    stops = sorted(set(STOP_WORDS))
    bare = F.translate(ascii_lower(text), _END_MARKS, " " * len(_END_MARKS))
    base = docs.select(
        "doc_id",
        words(text).alias("w"),
        lines.alias("lines"),
        F.length(without(text, SPACES)).cast("long").alias("word_chars"),
        count_of(text, SYMBOLS).alias("n_symbols"),
        count_of(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
        F.size(F.filter(words(bare), lambda x: x.isin(*stops))).cast("long").alias("n_stop_words"),
    ).withColumns({
        "n_words": F.size(w).cast("long"),
        "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_exclaimed": F.size(F.filter(w, lambda x: x.endswith("!!"))).cast("long"),
        "h": F.when(
            F.size(w) >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size(w) - WINDOW + 1), lambda i: F.xxhash64(F.slice(w, i, WINDOW))
            ),
        ),
    })
    pairs = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("h")) < F.size("h")
    return (
        base.withColumn("pairs", F.when(repeats, pairs))
        .withColumn("n_repeat_words", F.coalesce(repeated_words(F.col("pairs")), F.lit(0).cast("long")))
        .drop("w", "lines", "h", "pairs")
    )


def ratio(over: str, under: str) -> Column:
    return F.when(F.col(under) > 0, F.col(over) / F.col(under)).otherwise(0.0)


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where every ratio lies within its limits."""
    out = F.lit(True)
    for r in rules:
        out = out & ratio(r.over, r.under).between(r.low, r.high)
    return out


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, ``base_failed``, ``kept`` and the first rule broken for each of (doc_id, text)."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    broken = F.coalesce(
        *(F.when(~ratio(r.over, r.under).between(r.low, r.high), F.lit(r.name)) for r in rules)
    )
    out = counts(docs).withColumn("base_failed", failed)
    return out.withColumns({"kept": ~F.col("base_failed") & verdict(rules), "broken_rule": broken})


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(texts(table(spark, sf_dir, "documents"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_stop_words", "broken_rule",
    )


def _sql_ratio(r: Rule) -> str:
    return f"CASE WHEN {r.under} > 0 THEN {r.over}::DOUBLE / {r.under} ELSE 0.0 END BETWEEN {r.low} AND {r.high}"


SQL = rf"""
WITH d AS (
  SELECT doc_id::BIGINT AS doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents
), w AS (
  SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g') <> '') AS lines
  FROM d
), win AS (
  SELECT r, i, list_slice(w, i, i + {WINDOW - 1}) AS win FROM w, unnest(range(1, len(w) - {WINDOW - 2})) AS u(i)
), dup AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM win) WHERE c > 1
), cov AS (
  SELECT r, sum(least({WINDOW}, nxt - i)) AS n
  FROM (SELECT r, i, lead(i, 1, i + {WINDOW}) OVER (PARTITION BY r ORDER BY i) AS nxt FROM dup) GROUP BY r
), c AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_upper,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    len(list_filter(w, lambda x: x LIKE '%!!'))::BIGINT AS n_exclaimed,
    len(list_filter(string_split_regex(translate(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '{_END_MARKS}', '      '), '[\x20\x09-\x0D]+'),
      lambda x: list_contains([{", ".join(repr(x) for x in sorted(set(STOP_WORDS)))}], x)))::BIGINT AS n_stop_words,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cov USING (r)
), f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(_sql_ratio(r) for r in RULES)} AS kept, n_stop_words,
  CASE {" ".join(f"WHEN NOT ({_sql_ratio(r)}) THEN '{r.name}'" for r in RULES)} END AS broken_rule
FROM f
"""
