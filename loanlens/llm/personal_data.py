"""Personal data by a semi-Markov conditional random field over whole spans.

Plain patterns give the base spans. The field reads stretches of words with digits, ``@`` or ``+``:
every run of up to MAX_WORDS words is a candidate span of every kind, scored by features of the
span as a whole (digit count, shape, check digit, octets, what stands before it), and a dynamic
program picks the best split into spans and plain words, boundaries and kinds together. Weights are
learned by gradient steps on the exact log-likelihood, from base spans of a bounded sample of
documents and from rewritten forms of them that the patterns do not know. Its spans are added where
they touch no base span.

Defined results: null and empty texts have no spans (the checksum of the empty text); equal texts
get equal results; repeated ids give a row each; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate, groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.arrays import chunks
from loanlens.llm.frames import table, texts

KINDS = ("email", "ip", "card", "phone")
MAX_WORDS = 6
#: Documents with a digit or ``@`` that the weights are learned from, at most about.
FIT_ROWS = 400
#: Of each of them, at most so many stretches of at most so many words.
FIT_STRETCHES = 30
FIT_WORDS = 40
ROUNDS = 6
#: A span of the field is added only if its log-odds against plain words reach this.
MIN_MARGIN = 1.0
_SPANS = T.ArrayType(
    T.StructType().add("kind", "string").add("start", "long").add("end", "long").add("base", "boolean")
)

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TELLING = re.compile("[0-9@+]")
_EDGE = ".,;:!?\"'<>[]{}|"


def digits(text: str) -> str:
    return _NOT_DIGIT.sub("", text)


def luhn(number: str) -> bool:
    """Check digit: from the right, every second digit doubled and its digits added."""
    total = 0
    for i, c in enumerate(reversed(number)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def octets(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(p and p.isdigit() and len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the plain patterns, by start, then kind as listed."""
    out = [(a, b, "email") for a, b in _emails(text)]
    out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if octets(m[0])]
    for m in _CARD.finditer(text):
        number = digits(m[0])
        if 12 <= len(number) <= 19 and luhn(number):
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def stretches(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of neighbouring words with a digit, ``@`` or ``+``: the places of each word."""
    run: list[tuple[int, int]] = []
    last = -2
    for m in _TELLING.finditer(text):
        if run and m.start() < run[-1][1]:
            continue
        start, end = m.start(), m.end()
        while start > 0 and not text[start - 1] in " \t\n\x0b\f\r":
            start -= 1
        end = found.end() if (found := _WORD.match(text, end)) else end
        if run and (start - last > 1 or text[last] == "\n"):
            yield run
            run = []
        run.append((start, end))
        last = end
    if run:
        yield run


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """Without punctuation at the edges; a closing bracket stays with its opening one."""
    while start < end and text[start] in _EDGE:
        start += 1
    while end > start and (text[end - 1] in _EDGE or text[end - 1] == ")" and "(" not in text[start:end]):
        end -= 1
    return start, end


def span_features(text: str, start: int, end: int, words: int) -> list[str]:
    """What is true of a candidate span as a whole."""
    s = text[start:end]
    number = digits(s)
    n = len(number)
    letters = any(c.isalpha() for c in s)
    out = [
        "bias",
        f"words={words}",
        "digits=" + ("0" if n == 0 else "1-6" if n < 7 else "7-8" if n < 9 else "9-11" if n < 12 else "12-15" if n < 16 else "16-19" if n < 20 else "20+"),
        f"letters={letters}",
        f"groups={min(len(re.findall('[0-9]+', s)), 6)}",
    ]
    if "@" in s:
        out.append("at+domain" if re.fullmatch(r"[^@\s]+@[^@\s]+\.[A-Za-z0-9-]+", s) else "at")
    if s[:1] == "+":
        out.append("plus")
    if "(" in s and ")" in s:
        out.append("brackets")
    if not letters and n >= 7 and re.search(r"[0-9]{3}[-. ][0-9]{4}$", s):
        out.append("local number")
    if not letters and octets(s):
        out.append("octets")
    if not letters and 12 <= n <= 19:
        out.append(f"check={luhn(number)}")
        # whether the digits stand together or in fours
        out.append("plain digits" if n == len(s) else "fours" if re.fullmatch("[0-9]{4}(?:[ -][0-9]{4})+", s) else "uneven")
    before = text[max(0, start - 3) : start].strip()
    if before[-1:] in ("=", '"', ":"):
        out.append("after sign")
    return out


@lru_cache(maxsize=200_000)
def _keys(features: tuple[str, ...], kind: str) -> tuple[str, ...]:
    return tuple(f"{kind}|{f}" for f in features)


Candidate = tuple[int, int, int, tuple[str, ...]]  # first word, words, label, feature keys
Weights = dict[str, float]


def candidates(text: str, run: list[tuple[int, int]]) -> list[tuple[int, int, int, int, list[str]]]:
    """All runs of up to MAX_WORDS words: first word, words, start, end, features."""
    out = []
    for i in range(len(run)):
        for k in range(1, min(MAX_WORDS, len(run) - i) + 1):
            start, end = trimmed(text, run[i][0], run[i + k - 1][1])
            if start < end:
                out.append((i, k, start, end, span_features(text, start, end, k)))
    return out


def edges(text: str, run: list[tuple[int, int]]) -> list[list[tuple[int, str, int, int, tuple[str, ...]]]]:
    """By last word: (words, kind or empty for a plain word, start, end, feature keys)."""
    out: list[list] = [[] for _ in run]
    for i in range(len(run)):
        out[i].append((1, "", *run[i], ()))
    for i, k, start, end, found in candidates(text, run):
        for kind in KINDS:
            out[i + k - 1].append((k, kind, start, end, _keys(tuple(found), kind)))
    return out


def _value(keys: tuple[str, ...], weights: Weights) -> float:
    return sum(weights.get(k, 0.0) for k in keys)


def decode(text: str, run: list[tuple[int, int]], weights: Weights) -> list[tuple[int, int, str, float]]:
    """The best split of a stretch: its spans (start, end, kind, score against plain words)."""
    best, back = [0.0], [None]
    for last, choices in enumerate(edges(text, run)):
        scored = [(best[last + 1 - k] + _value(keys, weights), k, kind, a, b) for k, kind, a, b, keys in choices]
        top = max(scored, key=lambda x: x[0])
        best.append(top[0])
        back.append(top)
    out, at = [], len(run)
    while at > 0:
        total, k, kind, a, b = back[at]
        if kind:
            out.append((a, b, kind, total - best[at - k]))
        at -= k
    return out[::-1]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + float(np.log(sum(np.exp(v - top) for v in values)))


def learn(examples: list[tuple[str, list[tuple[int, int]], dict[tuple[int, int], str]]], rounds: int = ROUNDS) -> Weights:
    """Weights from stretches with their true spans {(start, end): kind}, by scaled gradient steps
    on the log-likelihood of the whole split; forward and backward sums give the expectations."""
    weights: Weights = {}
    squares: dict[str, float] = {}
    ready = [(edges(text, run), truth) for text, run, truth in examples]
    for _ in range(rounds):
        for choices, truth in ready:
            n = len(choices)
            values = [[_value(c[4], weights) for c in own] for own in choices]
            forward = [0.0]
            for last, own in enumerate(choices):
                forward.append(_log_sum([forward[last + 1 - c[0]] + v for c, v in zip(own, values[last], strict=True)]))
            backward = [[] for _ in range(n + 1)]
            backward_sum = [0.0] * (n + 1)
            for last in range(n - 1, -1, -1):
                if last + 1 < n:
                    backward_sum[last + 1] = _log_sum(backward[last + 1])
                for c, v in zip(choices[last], values[last], strict=True):
                    backward[last + 1 - c[0]].append(backward_sum[last + 1] + v)
            gradient: dict[str, float] = {}
            for last, own in enumerate(choices):
                for (k, kind, a, b, keys), v in zip(own, values[last], strict=True):
                    if not kind:
                        continue
                    p = float(np.exp(forward[last + 1 - k] + v + backward_sum[last + 1] - forward[n]))
                    d = (truth.get((a, b)) == kind) - p
                    if abs(d) > 1e-4:
                        for key in keys:
                            gradient[key] = gradient.get(key, 0.0) + d
            for key, g in gradient.items():
                squares[key] = squares.get(key, 0.0) + g * g
                weights[key] = weights.get(key, 0.0) + 0.5 * g / (squares[key] ** 0.5 + 1e-6)
    return weights


def rewritten(kind: str, s: str) -> list[str]:
    """Forms of a span that the plain patterns do not find or cut short."""
    if kind == "phone" and "(" in s:
        return [s[s.index("(") :]]
    if kind == "card" and s.isdigit() and len(s) == 16:
        return [".".join(s[i : i + 4] for i in range(0, 16, 4))]
    return []


def examples(text: str) -> Iterator[tuple[str, list[tuple[int, int]], dict[tuple[int, int], str]]]:
    """Stretches with their base spans, then each rewritten span in place of itself."""
    base = base_spans(text)
    for run in stretches(text):
        # the words around are enough for the features
        low, high = max(0, run[0][0] - 8), run[-1][1] + 8
        part = text[low:high]
        moved = [(a - low, b - low) for a, b in run]
        inside = [(a - low, b - low, k) for a, b, k in base if a >= run[0][0] and b <= run[-1][1]]
        yield part, moved, {(a, b): k for a, b, k in inside}
        for a, b, kind in inside:
            for form in rewritten(kind, part[a:b]):
                other = part[:a] + form + part[b:]
                at = (a, a + len(form))
                for again in stretches(other):
                    if again[0][0] <= at[0] and at[1] <= again[-1][1]:
                        yield other, again, {at: kind}


def find_spans(text: str, weights: Weights) -> list[tuple[int, int, str, bool]]:
    """Base spans and added spans (start, end, kind, base) by start, then kind as listed."""
    base = base_spans(text)
    out = [(a, b, k, True) for a, b, k in base]
    starts = [a for a, _, _ in base]
    reached = list(accumulate((b for _, b, _ in base), max))  # the furthest end so far
    for run in stretches(text):
        for a, b, kind, margin in decode(text, run, weights):
            before = bisect_left(starts, b)
            if margin >= MIN_MARGIN and (before == 0 or reached[before - 1] <= a):
                out.append((a, b, kind, False))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Weights:
    """Weights from a bounded sample of the documents with a digit or ``@``."""
    telling = docs.filter(F.col("text").rlike("[0-9@]")).select("text", (F.xxhash64("text") / 2.0**64 + 0.5).alias("place"))
    n = telling.agg(F.count("*")).first()[0]

    def stretch_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            every = (islice(examples(t), FIT_STRETCHES) for t in batch.column("text").to_pylist())
            found = [x for own in every for x in own if len(x[1]) <= FIT_WORDS]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([[v for w in x[1] for v in w] for x in found], pa.list_(pa.int64())),
                    pa.array([[f"{a} {b} {k}" for (a, b), k in x[2].items()] for x in found], pa.list_(pa.string())),
                ],
                names=["part", "run", "truth"],
            )

    sample = telling.filter(F.col("place") <= min(1.0, fit_rows / max(n, 1))).select("text")
    rows = sample.mapInArrow(stretch_rows, "part string, run array<long>, truth array<string>").collect()
    ready = []
    for r in sorted(rows, key=lambda r: (r["part"], r["run"])):
        truth = {(int(a), int(b)): k for a, b, k in (x.split(" ") for x in r["truth"])}
        ready.append((r["part"], list(zip(r["run"][::2], r["run"][1::2], strict=True)), truth))
    return learn(ready)


def detect(docs: DataFrame, weights: Weights | None = None) -> DataFrame:
    """``docs`` with ``spans``; needs a column ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs.select(F.coalesce("text", F.lit("")).alias("text"))) if weights is None else weights)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_seen"):
            found = [
                [{"kind": k, "start": a, "end": b, "base": base} for a, b, k, base in find_spans(text, shared.value)]
                if text else []
                for text in batch.column("_seen").to_pylist()
            ]
            names = [c for c in batch.schema.names if c != "_seen"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(found, kind)], names=[*names, "spans"]
            )

    plain = docs.drop("spans")
    # texts without a digit or @ hold nothing to look at and stay in the JVM's columns
    seen = plain.withColumn("_seen", F.when(F.col("text").rlike("[0-9@]"), F.col("text")).otherwise(""))
    return seen.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField("spans", _SPANS)]))


def masked(text: str, spans: list[tuple[int, int, str, bool]]) -> str:
    """Every span, or stretch of overlapping spans, replaced by its kinds in square brackets."""
    out, at = [], 0
    merged: list[list] = []
    for a, b, kind, _ in spans:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
            merged[-1][2].append(kind)
        else:
            merged.append([a, b, [kind]])
    for a, b, kinds in merged:
        out += [text[at:a], "[" + "/".join(k for k, _ in groupby(x.upper() for x in kinds)) + "]"]
        at = b
    return "".join(out) + text[at:]


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every span of personal data gives way to its kind; all documents stay."""
    shared = spark.sparkContext.broadcast(fit(docs.select(F.coalesce("text", F.lit("")).alias("text"))))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            clean = [
                masked(t, find_spans(t, shared.value)) if t and _TELLING.search(t) else t
                for t in batch.column("text").to_pylist()
            ]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(clean, batch.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def _joined(spans: str) -> Column:
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(texts(table(spark, sf_dir, "documents"))).select("doc_id", "spans")
    found = found.withColumn("base", F.filter("spans", lambda x: x["base"]))
    kinds = F.transform("base", lambda x: x["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
    )
