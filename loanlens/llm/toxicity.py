"""Toxic passages as maximal scoring segments of token log-odds.

Token log-odds between toxic and clean texts are learned under a Dirichlet prior that follows the
overall word counts; tokens whose log-odds are not significant cost a small constant instead. A
linear scan finds all maximal scoring segments of a text. Segment scores follow an extreme-value
distribution on clean text, whose two parameters are solved and counted on the clean rows; the
surprise of the significant segments of a text is turned into a probability by a logistic fit.

Defined results: null and empty texts have no segments and get the score of a text without any;
labels without an id or a mark are not used, an id labelled twice is toxic if either mark is;
equal texts are learned from once; without labels of both kinds the score is the known share, or
0. Repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm.arrays import SEPARATOR, byte_view, chunks, word_hashes
from loanlens.llm.frames import fold, table, texts

#: Labelled rows learned from, at most about; taken by a hash of the id.
FIT_ROWS = 20_000
#: Weight of the Dirichlet prior, as a share of all counted words.
PRIOR_SHARE = 0.1
MIN_Z = 4.0
DRIFT = 0.2
#: A segment counts as significant from this score upwards.
MIN_SEGMENT = 2.0
_COUNTS = "token long, toxic long, clean long"
_SEGMENTS = "array<struct<first:long,last:long,score:double>>"


@dataclass(frozen=True)
class Model:
    """Significant tokens, ascending by hash, with their log-odds; and the score calibration."""

    tokens: np.ndarray
    odds: np.ndarray
    decay: float = 1.0
    log_k: float = 0.0
    intercept: float = 0.0
    slope: float = 0.0


def segments(scores: Iterable[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of runs (first place, last place, score), in linear time.

    Candidates are kept with the running totals before and after them; a new positive run is joined
    to the nearest earlier candidate that starts lower, as long as that raises its own total.
    """
    found: list[list] = []  # first, last, total before, total after, nearest lower candidate
    total = 0.0
    for first, last, score in scores:
        before, total = total, total + score
        if score <= 0:
            continue
        item = [first, last, before, total, -1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= item[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= item[3]:
                item[4] = j
                found.append(item)
                break
            item[0], item[2] = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, after - before) for a, b, before, after, _ in found]


def scored_runs(places: np.ndarray, odds: np.ndarray, n: int) -> Iterator[tuple[int, int, float]]:
    """Runs of a text of ``n`` tokens: the tokens with log-odds, and the plain stretches between."""
    at = 0
    for place, score in zip(places.tolist(), odds.tolist(), strict=True):
        if place > at:
            yield at, place - 1, -DRIFT * (place - at)
        yield place, place, score
        at = place + 1


def text_segments(
    data: np.ndarray, offsets: np.ndarray, model: Model
) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """Token count and maximal segments of every text."""
    hashes, bounds, _ = word_hashes(data, offsets, SEPARATOR)
    if len(model.tokens):
        at = np.minimum(np.searchsorted(model.tokens, hashes), len(model.tokens) - 1)
        hit = np.flatnonzero(model.tokens[at] == hashes)
        odds = model.odds[at[hit]]
    else:
        hit, odds = np.zeros(0, np.int64), np.zeros(0)
    cut = np.searchsorted(hit, bounds)
    for row in range(len(offsets) - 1):
        n = int(bounds[row + 1] - bounds[row])
        own = slice(cut[row], cut[row + 1])
        if cut[row] == cut[row + 1] or odds[own].max() <= 0:
            yield n, []
        else:
            yield n, segments(scored_runs(hit[own] - bounds[row], odds[own], n))


def surprise(n: int, found: list[tuple[int, int, float]], model: Model) -> float:
    """How far the summed score of the significant segments lies beyond what clean text brings by
    chance: 0 for none, and minus the log of the extreme-value tail beyond."""
    scores = [s for _, _, s in found if s >= MIN_SEGMENT]
    if not scores:
        return 0.0
    expected = model.log_k + math.log(max(n, 1)) - model.decay * sum(scores)
    tail = -math.expm1(-math.exp(min(expected, 30.0)))
    return -math.log(max(tail, 1e-300))


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        data, offsets = byte_view(batch.column("text"))
        hashes, bounds, _ = word_hashes(data, offsets, SEPARATOR)
        row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
        order = np.lexsort((row, hashes))
        once = np.ones(len(order), dtype=bool)
        once[1:] = (np.diff(hashes[order]) != 0) | (np.diff(row[order]) != 0)
        kept = order[once]  # a token counts once in a text, however often it is repeated there
        toxic = np.array(batch.column("toxic").to_pylist(), dtype=np.int64)[row[kept]]
        token, at = np.unique(hashes[kept], return_inverse=True)
        bad = np.bincount(at, weights=toxic, minlength=len(token)).astype(np.int64)
        every = np.bincount(at, minlength=len(token)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(token.view(np.int64)), pa.array(bad), pa.array(every - bad)],
            names=["token", "toxic", "clean"],
        )


def log_odds(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Significant tokens with their log-odds and smoothed share in clean text; at most as many as
    the bounded sample holds."""
    n = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    if not n["toxic"] or not n["clean"]:
        return np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)
    prior = (F.col("toxic") + F.col("clean")) * PRIOR_SHARE
    whole = (n["toxic"] + n["clean"]) * PRIOR_SHARE
    side = lambda c, total: F.log((c + prior) / (total + whole - c - prior))
    odds = side(F.col("toxic"), n["toxic"]) - side(F.col("clean"), n["clean"])
    spread = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    share = (F.col("clean") + prior) / (n["clean"] + whole)
    rows = (
        counts.select("token", odds.alias("odds"), (odds / spread).alias("z"), share.alias("share"))
        .filter(F.abs("z") >= MIN_Z)
        .toPandas()
    )
    tokens = rows["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], rows["odds"].to_numpy(float)[order], rows["share"].to_numpy(float)[order]


def decay_rate(odds: np.ndarray, share: np.ndarray) -> float:
    """The positive root of: the clean mean of exp(rate * score) is 1."""
    if not (odds > 0).any():
        return 1.0
    rest = max(0.0, 1.0 - share.sum())
    mean = lambda x: (share * np.exp(x * odds)).sum() + rest * math.exp(-x * DRIFT) - 1.0
    low, high = 1e-6, 1e-3
    while mean(high) < 0 and high < 20:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 0 else (low, middle)
    return high


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope (not below 0) of a logistic fit with a weak ridge."""
    a = np.stack([np.ones(len(x)), x], axis=1)
    beta = np.zeros(2)
    ridge = np.diag([1e-3, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (y - p) - ridge @ beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), max(0.0, float(beta[1]))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, fit_rows: int = FIT_ROWS) -> Model:
    """Learns from the labelled rows of (doc_id, text) where ``learn`` holds."""
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(learn & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    n = marks.count()
    place = F.xxhash64("doc_id") / 2.0**64 + 0.5
    sample = marks.filter(place <= min(1.0, fit_rows / max(n, 1)))
    # the sample has about fit_rows ids at most
    rows = docs.join(F.broadcast(sample), "doc_id").withColumn("own", F.xxhash64("text"))
    rows = rows.groupBy("own").agg(F.max("toxic").alias("toxic"), F.first("text").alias("text")).drop("own")
    rows = rows.persist()
    try:
        counts = rows.mapInArrow(_count, _COUNTS).groupBy("token").agg(
            F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
        )
        tokens, odds, share = log_odds(counts)
        model = Model(tokens, odds, decay_rate(odds, share))

        def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in chunks(batches):
                found = list(text_segments(*byte_view(batch.column("text")), model))
                best = [sum(s for _, _, s in x if s >= MIN_SEGMENT) for _, x in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("toxic"), pa.array([n for n, _ in found], pa.int64()), pa.array(best, pa.float64())],
                    names=["toxic", "n", "best"],
                )

        seen = rows.mapInArrow(measure, "toxic int, n long, best double").toPandas()
    finally:
        rows.unpersist()
    if seen.empty:
        return model
    clean = seen[seen["toxic"] == 0]
    passages = float((clean["best"] > 0).sum()) + 0.5
    log_k = math.log(passages / max(float(clean["n"].sum()), 1.0)) + model.decay * MIN_SEGMENT
    model = Model(tokens, odds, model.decay, log_k)
    x = np.array([surprise(n, [(0, 0, s)], model) for n, s in zip(seen["n"], seen["best"], strict=True)])
    return Model(tokens, odds, model.decay, log_k, *logistic(x, seen["toxic"].to_numpy(float)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Score and toxic passages (word places and scores) of each of (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))
        for batch in chunks(batches):
            values, passages = [], []
            for n, found in text_segments(*byte_view(batch.column("text")), m):
                x = m.intercept + m.slope * surprise(n, found, m)
                values.append(1 / (1 + math.exp(-max(-60.0, min(60.0, x)))))
                passages.append([
                    {"first": a, "last": b, "score": s} for a, b, s in found if s >= MIN_SEGMENT
                ])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values, pa.float64()), pa.array(passages, kind)],
                names=["doc_id", "score", "passages"],
            )

    return docs.mapInArrow(run, f"doc_id long, score double, passages {_SEGMENTS}")


def held_out() -> Column:
    return fold(F.col("doc_id"), 5) == 0


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(table(spark, sf_dir, "documents"))
    model = fit(docs, table(spark, sf_dir, "labels"), ~held_out())
    return score(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )
