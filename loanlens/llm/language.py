"""Language identification by prediction by partial matching over bytes.

Every language has a tree of byte contexts up to three bytes long, counted on a bounded sample of
its labelled rows and then frozen. A byte costs its code length: where the longest context has not
seen it, an escape is paid and the next shorter context is asked, at the end one in 256. The
language with the shortest code for the whole text wins.

Defined results: null text, no letter or no learned language give ``und`` with score 0; ties go to
the smaller language name; repeated ids give one row each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm.arrays import byte_view, chunks
from loanlens.llm.frames import fold, table

ORDER = 3
#: Labelled rows a language is learned from, at most about; rows are taken by a hash of the id.
FIT_ROWS = 400
UNDETERMINED = "und"
#: Bytes whose code lengths are looked up at once, whatever the length of a text.
SLICE = 256 << 10
#: Byte pairs whose combinations have their code lengths kept once computed, as many as fit the
#: bytes for all languages; others are computed in every slice.
MEMO_PAIRS = 2_000
MEMO_BYTES = 16 << 20
_START = "\n" * ORDER
_FIT_SCHEMA = "lang string, length int, gram long, n long"


def grams(data: np.ndarray, length: int) -> np.ndarray:
    """The number made of each byte and its ``length - 1`` predecessors, from the first full one."""
    n = len(data) - length + 1
    out = np.zeros(max(n, 0), dtype=np.uint32)
    for j in range(length):
        out <<= np.uint32(8)
        out |= data[j : j + len(out)]
    return out


def count_grams(rows: pd.DataFrame) -> pd.DataFrame:
    """Counts of one language's grams of one to ORDER + 1 bytes that follow each other in a text."""
    parts = []
    for length in range(1, ORDER + 2):
        found = [
            grams(np.frombuffer((_START + text).encode(), np.uint8)[ORDER + 1 - length :], length)
            for text in rows["text"]
        ]
        values, n = np.unique(np.concatenate(found), return_counts=True)
        parts.append(pd.DataFrame({"length": np.int32(length), "gram": values.astype(np.int64), "n": n}))
    out = pd.concat(parts, ignore_index=True)
    out.insert(0, "lang", rows["lang"].iloc[0])
    return out


class ByteModel:
    """Frozen context trees of all languages; code lengths of grams of ORDER + 1 bytes."""

    def __init__(self, rows: pd.DataFrame):
        self.langs = sorted(rows["lang"].unique())
        self.levels = [self._levels(rows[rows["lang"] == lang]) for lang in self.langs]
        pairs = min(MEMO_PAIRS, int((MEMO_BYTES / 4 / max(1, len(self.langs))) ** 0.5) - 1)
        common = rows[rows["length"] == 2].groupby("gram")["n"].sum().nlargest(pairs)
        pairs = np.sort(common.index.to_numpy(np.int64))
        self.pair_id = np.zeros(65536, dtype=np.int64)
        self.pair_id[pairs] = np.arange(1, len(pairs) + 1)
        self.width = len(pairs) + 1
        # filled as grams turn up; pages of grams that never do stay untouched
        self.memo = np.zeros((self.width * self.width, max(1, len(self.langs))), dtype=np.float32)

    @staticmethod
    def _levels(rows: pd.DataFrame) -> list[dict[str, np.ndarray]]:
        """By gram length: sorted grams with code length, sorted contexts with escape length."""
        out = []
        for length in range(1, ORDER + 2):
            part = rows[rows["length"] == length].sort_values("gram")
            gram, n = part["gram"].to_numpy(np.int64), part["n"].to_numpy(np.float64)
            context, at = np.unique(gram >> 8, return_index=True)
            total = np.add.reduceat(n, at) if len(n) else n
            kinds = np.diff(np.append(at, len(gram))).astype(np.float64)
            whole = np.repeat(total + kinds, np.diff(np.append(at, len(gram))))
            out.append(
                {
                    "gram": gram,
                    "bits": -np.log2(n / whole),
                    "context": context,
                    "escape": -np.log2(kinds / (total + kinds)),
                }
            )
        return out

    def code_lengths(self, full: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each gram given the bytes before it, for every language."""
        out = np.empty((len(full), len(self.langs)))
        for k, levels in enumerate(self.levels):
            bits = np.zeros(len(full))
            left = np.arange(len(full))
            for length in range(ORDER + 1, 0, -1):
                level, gram = levels[length - 1], full[left].astype(np.int64) & ((1 << 8 * length) - 1)
                hit, at = _find(level["gram"], gram)
                bits[left[hit]] += level["bits"][at[hit]]
                left, gram = left[~hit], gram[~hit]
                known, at = _find(level["context"], gram >> 8)
                bits[left[known]] += level["escape"][at[known]]
            bits[left] += 8.0
            out[:, k] = bits
        return out

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length of every text for every language; texts begin with the start context."""
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        for start in range(0, len(data), SLICE):
            stop = min(start + SLICE, len(data))
            first = np.searchsorted(offsets, start, side="right") - 1
            after = np.searchsorted(offsets, stop)
            own = np.maximum(offsets[first:after], start)
            cost = self._costs(data[max(0, start - ORDER) : stop], stop - start)
            for j in range(ORDER):
                at = offsets[first:after] + j
                cost[at[(at >= start) & (at < stop)] - start] = 0
            out[first:after] += np.add.reduceat(cost, own - start, axis=0, dtype=np.float64)
        return out

    def _costs(self, data: np.ndarray, n: int) -> np.ndarray:
        """Code lengths of the last ``n`` bytes; the first ones of all data have no context."""
        full = grams(data, ORDER + 1)
        full = np.concatenate([np.zeros(n - len(full), np.uint32), full])
        left, right = self.pair_id[full >> np.uint32(16)], self.pair_id[full & np.uint32(0xFFFF)]
        code = left * self.width + right
        known = (left > 0) & (right > 0)
        code[~known] = 0
        missing = known & (self.memo[code, 0] == 0)
        if missing.any():
            found, at = np.unique(code[missing], return_index=True)
            self.memo[found] = self.code_lengths(full[missing][at])
        cost = self.memo[code]
        if not known.all():
            other, back = np.unique(full[~known], return_inverse=True)
            cost[~known] = self.code_lengths(other)[back]
        return cost


def _find(ordered: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(ordered) == 0:
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values, at


def fit(docs: DataFrame, learn: Column, fit_rows: int = FIT_ROWS) -> pd.DataFrame:
    """Gram counts by language, learned from rows where ``learn`` holds and text and lang are set."""
    rows = docs.filter(learn & F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = rows.select("lang", "text", (F.xxhash64("doc_id") / 2.0**64 + 0.5).alias("place"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return pd.DataFrame({"lang": [], "length": [], "gram": [], "n": []})
    share = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, fit_rows / n)))
    sample = rows.filter(F.col("place") <= share[F.col("lang")])
    return sample.groupBy("lang").applyInPandas(count_grams, _FIT_SCHEMA).toPandas()


def identify(docs: DataFrame, learn: Column, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``bits_per_byte``; needs doc_id, text and lang.

    The score is the share of the winner when every language weighs two to the minus its code
    length, so 1 for a text that no other language explains nearly as well.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit(docs, learn, fit_rows))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = ByteModel(model.value)
        for batch in chunks(batches):
            # the start context is put before the texts of a chunk, so that each text is sent once
            texts = pc.binary_join_element_wise(_START, pc.fill_null(batch.column("text"), ""), "")
            data, offsets = byte_view(texts)
            n = batch.num_rows
            lang = np.full(n, UNDETERMINED, dtype=object)
            share, rate = np.zeros(n), np.zeros(n)
            asked = np.array(batch.column("_asked").to_pylist(), dtype=bool)
            if trees.langs and len(data):
                bits = trees.bits(data, offsets)
                best = bits.argmin(axis=1)
                least = bits[np.arange(n), best]
                lang[asked] = np.array(trees.langs, dtype=object)[best[asked]]
                share[asked] = (1 / np.exp2(least[:, None] - bits).sum(axis=1))[asked]
                rate[asked] = (least / np.maximum(np.diff(offsets) - ORDER, 1))[asked]
            names = [c for c in batch.schema.names if c != "_asked"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(lang, pa.string()), pa.array(share), pa.array(rate)],
                names=[*names, "lang_pred", "score", "bits_per_byte"],
            )

    asked = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    sent = docs.drop("lang_pred", "score", "bits_per_byte").withColumn("_asked", asked)
    schema = docs.drop("lang_pred", "score", "bits_per_byte").schema
    schema = schema.add("lang_pred", "string").add("score", "double").add("bits_per_byte", "double")
    return sent.mapInArrow(score, schema)


def held_out() -> Column:
    return fold(F.col("doc_id"), 4) == 2


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: keeps documents with a language; those without any letter go."""
    found = identify(docs, ~held_out())
    return found.filter(F.col("lang_pred") != UNDETERMINED).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    return identify(docs, ~held_out()).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte"
    )
