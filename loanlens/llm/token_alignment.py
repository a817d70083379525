"""Alignment of the tokens of two tokenizers over the same bytes, by merge-path partitioning.

A byte-level BPE (A) and a SentencePiece model (B) cut the same bytes. The ends of A's and of B's
tokens are two sorted lists. Merging them visits every byte at which a token ends, and each such byte
ends exactly one stretch that belongs to one token of A and one of B: a link. Bytes where tokens of
both end close a group. The merge is divided by diagonals: for every PIECE-th step a binary search
finds how many ends of A and of B come before it, all diagonals at once. Each piece then merges its
own ends and knows nothing of the others; where a boundary falls between two equal ends, the piece
before and the piece after are stitched into one link that closes a group. Documents of a chunk lie
behind one another, so that pieces are of equal work whatever the documents' lengths.

How many documents hold a pair of ids linked is counted over the corpus: each task adds up a chunk
first, so that one row per chunk and distinct pair is shuffled, then one per pair. Documents keep
their distinct pairs as places in their chunk's list; the counts come back as one list per chunk and
meet the chunk's documents in a sorted stream.

Defined results: null and empty texts, and texts that either tokenizer does not give back byte for
byte, have zeros and an empty hash; null and repeated ids are documents of their own; an empty table
gives no rows; a very long text is a chunk of its own, held by one task with its tokens. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm.arrays import chunks
from loanlens.llm.frames import shuffle_width, table, texts
from loanlens.session import materialise

#: Steps of the merge in a piece.
PIECE = 1 << 15
CHUNK = 2 << 20
#: A pair of ids as one number: A's id above these bits, B's id in them.
B_BITS = 20
_SCHEMA = (
    "chunk long, kind int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, pairs array<long>, times array<long>"
)
_OUT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string"
)
# How GPT-style byte-level vocabularies are split, and write bytes as letters.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_AS_WRITTEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: The fast encoder's stack does not hold the look-ahead over longer blanks.
_LONG_BLANK = re.compile(r"\s{20000}")


def byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies."""
    others = [b for b in range(256) if b not in set(_AS_WRITTEN)]
    return {chr(b): b for b in _AS_WRITTEN} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokens:
    """Ids by a byte-level BPE file; special tokens inside texts are plain text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        special = {t.content for t in self.plain.get_added_tokens_decoder().values() if t.special}
        letters = byte_letters()
        vocabulary = self.plain.get_vocab(with_added_tokens=True)
        ranks = {bytes(letters[c] for c in w): i for w, i in vocabulary.items() if w not in special}
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for word, i in ranks.items():
            self.bytes[i] = word
        self.fast = tiktoken.Encoding("byte", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if _LONG_BLANK.search(text):
            return self.plain.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class PieceTokens:
    """Ids by a SentencePiece model, which puts a blank before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._piece(i) for i in range(self.model.get_piece_size())]

    def _piece(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


@lru_cache(maxsize=2)
def _byte_tokens(path: str) -> ByteTokens:
    return ByteTokens(path)


@lru_cache(maxsize=2)
def _piece_tokens(path: str) -> PieceTokens:
    return PieceTokens(path)


def default_byte_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def default_piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def merge_path(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """How many of ``a`` and of ``b`` the merge has taken after every ``piece`` steps, from none to
    all; of equal values those of ``a`` come first."""
    steps = np.append(np.arange(0, len(a) + len(b), piece, dtype=np.int64), len(a) + len(b))
    low, high = np.maximum(steps - len(b), 0), np.minimum(steps, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        # a[middle] is taken before the step's last value of b if it is not larger
        other = np.where(open_, steps - middle - 1, 0)
        more = open_ & (a[np.minimum(middle, len(a) - 1)] <= b[np.clip(other, 0, len(b) - 1)])
        low = np.where(more, middle + 1, low)
        high = np.where(open_ & ~more, middle, high)
    return low, steps - low


@dataclass
class Overlaps:
    """Links in byte order: number of the token of A and of B, and whether the link closes a group."""

    a: np.ndarray
    b: np.ndarray
    closes: np.ndarray


def _merge_piece(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ends of a piece, the tokens they end or lie in, and which of them both lists have."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    last = np.ones(len(both), dtype=bool)
    last[:-1] = both[1:] != both[:-1]
    twice = np.zeros(len(both), dtype=bool)
    twice[1:] = ~last[:-1]
    ends = both[last]
    return ends, np.searchsorted(a, ends), np.searchsorted(b, ends), twice[last]


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray, piece: int = PIECE) -> Overlaps:
    """All links of two tokenizations of the same bytes, given by their increasing ends."""
    if len(a_ends) == 0:
        none = np.zeros(0, dtype=np.int64)
        return Overlaps(none, none, np.zeros(0, dtype=bool))
    at_a, at_b = merge_path(a_ends, b_ends, piece)
    parts, before = [], -1
    for i, i_to, j, j_to in zip(at_a[:-1], at_a[1:], at_b[:-1], at_b[1:], strict=True):
        ends, in_a, in_b, closes = _merge_piece(a_ends[i:i_to], b_ends[j:j_to])
        in_a, in_b = in_a + i, in_b + j
        if ends[0] == before:
            parts[-1][2][-1] = True
            ends, in_a, in_b, closes = ends[1:], in_a[1:], in_b[1:], closes[1:]
        if len(ends):
            parts.append((in_a, in_b, closes))
            before = ends[-1]
    a, b, closes = (np.concatenate(x) for x in zip(*parts, strict=True))
    return Overlaps(a, b, closes)


@lru_cache(maxsize=2)
def _decimals(size: int) -> list[bytes]:
    """Ids with a comma, with a bar and with a semicolon behind them."""
    return [b"%d%c" % (i, mark) for mark in b",|;" for i in range(size)]


def group_texts(
    a_ids: np.ndarray, b_ids: np.ndarray, links: Overlaps, a_from: np.ndarray, b_from: np.ndarray
) -> Iterator[bytes]:
    """The groups of each document as text; documents start at the given tokens."""
    size = int(max(a_ids.max(initial=0), b_ids.max(initial=0))) + 1
    marks = _decimals(1 << size.bit_length())
    size = len(marks) // 3
    a_to, b_to = links.a[links.closes] + 1, links.b[links.closes] + 1  # tokens up to each group's end
    a_group = np.searchsorted(a_to, np.arange(len(a_ids)), side="right")
    b_group = np.searchsorted(b_to, np.arange(len(b_ids)), side="right")
    before_b = np.concatenate([[0], b_to])[:-1]
    order = np.empty(len(a_ids) + len(b_ids), dtype=np.int64)
    a_place = np.arange(len(a_ids)) + before_b[a_group]
    b_place = np.arange(len(b_ids)) + a_to[b_group]
    order[a_place] = a_ids
    order[b_place] = b_ids
    order[a_place[a_to - 1]] += size
    order[b_place[b_to - 1]] += 2 * size
    cuts = a_from + b_from
    for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
        yield b"".join(map(marks.__getitem__, order[start:stop].tolist()))[:-1]


def _encode_chunk(batch: pa.RecordBatch, chunk: int, first: ByteTokens, second: PieceTokens) -> pa.RecordBatch:
    """One row per document and one for the chunk's distinct pairs and their document counts."""
    n = batch.num_rows
    a_ids, b_ids = [], []
    a_count, b_count = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for row, text in enumerate(batch.column("text").to_pylist()):
        if not text:
            continue
        a, b, raw = first.encode(" " + text), second.encode(text), (" " + text).encode()
        if b"".join(map(first.bytes.__getitem__, a)) == raw == b"".join(map(second.bytes.__getitem__, b)):
            a_ids.append(np.array(a, dtype=np.int64))
            b_ids.append(np.array(b, dtype=np.int64))
            a_count[row], b_count[row] = len(a), len(b)
    a = np.concatenate([np.zeros(0, np.int64), *a_ids])
    b = np.concatenate([np.zeros(0, np.int64), *b_ids])
    a_from, b_from = np.append(0, np.cumsum(a_count)), np.append(0, np.cumsum(b_count))
    links = overlaps(np.cumsum(_lengths(first)[a]), np.cumsum(_lengths(second)[b]))
    link_from = np.searchsorted(links.a, a_from)
    pairs, place = np.unique((a[links.a] << B_BITS) | b[links.b], return_inverse=True)
    document = np.repeat(np.arange(n), np.diff(link_from))
    held, times = np.unique(document * max(len(pairs), 1) + place, return_counts=True)
    own, held = np.divmod(held, max(len(pairs), 1))
    held_from = np.searchsorted(own, np.arange(n + 1))
    closed = np.concatenate([[0], np.cumsum(links.closes)])
    groups = closed[link_from[1:]] - closed[link_from[:-1]]
    hashes = [
        hashlib.sha256(x).hexdigest() if x else "" for x in group_texts(a, b, links, a_from, b_from)
    ]
    offsets = np.append(held_from, len(held) + len(pairs)).astype(np.int32)
    every = [np.concatenate([held, pairs]), np.concatenate([times, np.bincount(held, minlength=len(pairs))])]
    none = pa.nulls(1, pa.int64())
    numbers = [a_count, b_count, groups, np.diff(link_from)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n + 1, chunk), pa.int64()),
            pa.array(np.append(np.ones(n), 0), pa.int32()),
            pa.chunked_array([batch.column("doc_id"), none]).combine_chunks(),
            *[pa.chunked_array([pa.array(x, pa.int64()), none]).combine_chunks() for x in numbers],
            pa.array([*hashes, None], pa.string()),
            *[pa.ListArray.from_arrays(pa.array(offsets), pa.array(x, pa.int64())) for x in every],
        ],
        names=_columns(_SCHEMA),
    )


def _lengths(tokens: ByteTokens | PieceTokens) -> np.ndarray:
    return np.array([len(x) for x in tokens.bytes], dtype=np.int64)


def _columns(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _with_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each document's counts, in a partition where a chunk's counts precede its documents."""
    chunk, counts, best = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        numbers = batch.column("chunk").to_numpy()
        columns = [batch.column(c) for c in ("pairs", "times")]
        ends = [c.offsets.to_numpy() for c in columns]
        values = [c.values.to_numpy() for c in columns]
        n_best, count_sum = np.zeros(len(kind), np.int64), np.zeros(len(kind), np.int64)
        for row in range(len(kind)):
            first, second = (v[e[row] : e[row + 1]] for v, e in zip(values, ends, strict=True))
            if kind[row] == 0:
                chunk, counts, best = numbers[row], first.copy(), second.copy()
            elif len(first):
                if chunk != numbers[row]:
                    raise ValueError(f"the counts of chunk {numbers[row]} are missing")
                count_sum[row] = counts[first] @ second
                n_best[row] = best[first] @ second
        keep = pa.array(kind == 1)
        found = {c: batch.column(c) for c in _columns(_OUT) if c in batch.schema.names}
        found |= {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
        yield pa.RecordBatch.from_arrays([found[c] for c in _columns(_OUT)], names=_columns(_OUT)).filter(keep)


def align(docs: DataFrame, byte_tokenizer: str | None = None, piece_model: str | None = None) -> DataFrame:
    """Per document the numbers of tokens, groups and links, and what the corpus says of its links."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = _byte_tokens(byte_tokenizer or default_byte_tokenizer())
        second = _piece_tokens(piece_model or default_piece_model())
        base = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(chunks(batches, max_bytes=CHUNK)):
            yield _encode_chunk(batch, base + number, first, second)

    width = shuffle_width(docs.sparkSession)
    encoded = materialise(texts(docs).mapInArrow(encode, _SCHEMA), "aligned")
    held = encoded.filter("kind = 0").select("chunk", F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "x"))
    held = held.select("chunk", "place", F.col("x.pairs").alias("pair"), F.col("x.times").alias("documents"))
    counts = held.groupBy("pair").agg(F.sum("documents").alias("n"))
    counts = materialise(counts.withColumn("a", F.shiftright("pair", B_BITS)), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    marked = counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("highest")).cast("long").alias("best"))
    answers = (
        held.join(marked, "pair")
        .groupBy("chunk")
        .agg(F.sort_array(F.collect_list(F.struct("place", "n", "best"))).alias("x"))
        .withColumns({"kind": F.lit(0), "pairs": F.col("x.n"), "times": F.col("x.best")})
        .drop("x")
    )
    together = encoded.filter("kind = 1").unionByName(answers, allowMissingColumns=True)
    in_order = together.repartition(width, "chunk").sortWithinPartitions("chunk", "kind")
    return in_order.mapInArrow(_with_counts, _OUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
