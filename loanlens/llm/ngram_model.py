"""Texts scored by an n-gram model in Elias-Fano tries.

A word is predicted from the word before it, whatever that is, or from the start of the text.
Probabilities are smoothed towards single words by the number of different followers of the context
(Witten and Bell). Every pair of words of the training texts is counted, and so are words, contexts
and followers, exactly.

Pairs are dealt to shards by the hashes of both words, so that no word makes a shard large. First
every chunk of documents sends its different pairs with their training counts; a shard adds them up,
and what it found of every word is added up over the shards, dealt by word, and sent back to the
shards that hold the word. Then every chunk sends its pairs with the documents they are in; a shard
codes its trie, answers the chunks from it and returns sums per document. Only three totals reach the
driver.

Defined results: null text is empty and consists of the end alone; repeated ids give one row each;
a null id belongs to the held-out part; without training rows every token has the same probability.
Words are told apart by 64-bit hashes. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm.arrays import byte_view, chunks, mix, word_hashes
from loanlens.llm.elias_fano import Trie
from loanlens.llm.frames import fold, shuffle_width, table, texts
from loanlens.session import materialise

#: The start of a text as a context, and the end as a token.
START = np.uint64(0xD1B54A32D192ED03)
END = np.uint64(0x8F5C28F5C28F5C29)
ADD = 0.1
_CHUNK_DOCS = 30_000
#: Words that are sent as two bytes, and documents they are looked for in.
MOST_CODES = 65_535
CODED_DOCS = 8_000


@dataclass(frozen=True)
class Totals:
    """Tokens, documents and different tokens of the training texts."""

    n_tokens: int
    n_docs: int
    n_words: int

    @property
    def whole(self) -> float:
        return self.n_tokens + ADD * (self.n_words + 1)

    def base(self, count: np.ndarray) -> np.ndarray:
        """Smoothed probability of single tokens by their counts."""
        return (count + ADD) / self.whole


@dataclass(frozen=True)
class Known:
    """Of every word of a shard (ascending hashes): how often it stands in training, and how many
    different tokens follow it."""

    hashes: np.ndarray
    count: np.ndarray
    followers: np.ndarray
    totals: Totals

    def at(self, hashes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.hashes, hashes)

    def word_count(self, words: np.ndarray) -> np.ndarray:
        """Training counts of tokens. A word is a context as often as it is a token."""
        return np.where(words == END, self.totals.n_docs, self.count[self.at(words)]).astype(np.float64)


def _small_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        for at in range(0, batch.num_rows, _CHUNK_DOCS):
            yield batch.slice(at, _CHUNK_DOCS)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every token, ends included: its hash, the hash of its context, and its row."""
    hashes, bounds, _ = word_hashes(data, offsets)
    n_rows = len(offsets) - 1
    sizes = np.diff(bounds) + 1
    ends = np.cumsum(sizes) - 1
    out = np.full(int(sizes.sum()), END, dtype=np.uint64)
    inner = np.ones(len(out), dtype=bool)
    inner[ends] = False
    out[inner] = hashes
    context = np.empty_like(out)
    context[1:] = out[:-1]
    context[ends - sizes + 1] = START
    return out, context, np.repeat(np.arange(n_rows), sizes)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted keys begins."""
    new = np.zeros(len(keys[0]), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _sizes(first: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(first, n))


@dataclass(frozen=True)
class Numbered:
    """The tokens of a chunk as numbers of its different words: their hashes and codes, the start last."""

    hashes: np.ndarray
    codes: np.ndarray

    @staticmethod
    def of(token: np.ndarray, context: np.ndarray, tail: np.ndarray, width: int, codes: Codes) -> tuple[Numbered, np.ndarray]:
        """And, ascending, a key for each token: the numbers of word and context, and ``tail`` in ``width`` bits."""
        hashes, at = np.unique(token, return_inverse=True)
        own = Numbered(np.append(hashes, START), codes.of(np.append(hashes, START)))
        before = np.empty_like(at)
        before[1:] = at[:-1]
        before[context == START] = len(hashes)
        # a chunk of many rows has fewer than 2**23 tokens, one of a single row needs no bits for rows
        key = (at.astype(np.uint64) << own.bits | before.astype(np.uint64)) << np.uint64(width) | tail.astype(np.uint64)
        key.sort()
        return own, key

    @property
    def bits(self) -> np.uint64:
        return np.uint64((len(self.hashes) - 1).bit_length())

    def split(self, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of word and context."""
        return (pair >> self.bits).astype(np.int64), (pair & ((np.uint64(1) << self.bits) - np.uint64(1))).astype(np.int64)

    def words(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.hashes[at], self.codes[at]

    def dealt(self, pair: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """The shard of each pair, ascending, and the places the pairs had."""
        token, context = self.split(pair)
        dealt = _dealt(self.hashes[token], self.hashes[context], shards)
        # two bytes are sorted by radix
        order = np.argsort(dealt.astype(np.uint16) if shards <= 1 << 16 else dealt, kind="stable")
        return dealt[order], order


def _learns(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(batch.column("learn").to_pylist(), dtype=bool)


def _dealt(token: np.ndarray, context: np.ndarray, shards: int) -> np.ndarray:
    return (mix(token ^ mix(context)) % np.uint64(shards)).astype(np.int32)


@dataclass(frozen=True)
class Codes:
    """Two bytes for each of some frequent words (ascending hashes); others are written out behind them.

    Which words have codes decides how much is sent, and nothing else.
    """

    hashes: np.ndarray

    def of(self, words: np.ndarray) -> np.ndarray:
        """The code of each word, or MOST_CODES."""
        at = np.searchsorted(self.hashes, words)
        known = np.zeros(len(words), dtype=bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == words[inside]
        return np.where(known, at, MOST_CODES).astype("<u2")

    def pack(self, words: np.ndarray, codes: np.ndarray | None = None) -> bytes:
        """Words as bytes; ``codes`` are theirs, where they were looked up already."""
        codes = self.of(words) if codes is None else codes
        return len(words).to_bytes(4, "little") + codes.tobytes() + words[codes == MOST_CODES].astype("<u8").tobytes()

    def unpack(self, packed: bytes) -> np.ndarray:
        n = int.from_bytes(packed[:4], "little")
        codes = np.frombuffer(packed, "<u2", n, 4)
        out, known = np.empty(n, dtype=np.uint64), codes < MOST_CODES
        out[known] = self.hashes[codes[known]]
        out[~known] = np.frombuffer(packed, "<u8", offset=4 + 2 * n)
        return out


def pack_small(x: np.ndarray) -> bytes:
    """Whole numbers in a byte each; those from 255 on are written out behind them."""
    large = x >= 255
    return len(x).to_bytes(4, "little") + np.where(large, 255, x).astype(np.uint8).tobytes() + x[large].astype("<u8").tobytes()


def unpack_small(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:4], "little")
    large = np.frombuffer(packed, "<u8", offset=4 + n)
    out = np.frombuffer(packed, np.uint8, n, 4).astype(np.uint64 if large.max(initial=0) >> np.uint64(32) else np.uint32)
    out[out == 255] = large
    return out


def _frequent(docs: DataFrame) -> Codes:
    """The most frequent words of a sample of at most about CODED_DOCS documents, taken by hashes."""
    every = max(1, docs.count() // CODED_DOCS)
    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).limit(2 * CODED_DOCS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, count = np.zeros(0, dtype=np.uint64), np.zeros(0)
        for batch in _small_chunks(batches):
            token, _, _ = tokens(*byte_view(batch.column("text")))
            hashes, of = np.unique(np.concatenate([hashes, token]), return_inverse=True)
            count = np.bincount(of, np.concatenate([count, np.ones(len(token))]))
            most = np.argsort(-count, kind="stable")[: 8 * MOST_CODES]
            hashes, count = hashes[most], count[most]
        yield pa.RecordBatch.from_arrays([pa.array([hashes[:MOST_CODES].tobytes()], pa.binary())], names=["hashes"])

    found = sample.select("text").repartition(1).mapInArrow(run, "hashes binary").collect()
    return Codes(np.sort(np.frombuffer(b"".join(bytes(r["hashes"]) for r in found), np.uint64)))


def _packed(arrays: Iterable[np.ndarray | tuple[np.ndarray, np.ndarray]], kinds: Iterable[str], codes: Codes) -> list[bytes]:
    return [
        codes.pack(*(x if isinstance(x, tuple) else (x,))) if k == "word" else pack_small(x) if k == "small" else x.astype(k).tobytes()
        for x, k in zip(arrays, kinds, strict=True)
    ]


def _unpacked(packed: Iterable[bytes], kinds: Iterable[str], codes: Codes) -> list[np.ndarray]:
    return [
        codes.unpack(x) if k == "word" else unpack_small(x) if k == "small" else np.frombuffer(x, k)
        for x, k in zip(packed, kinds, strict=True)
    ]


def _batch(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, (_, k) in zip(columns, schema, strict=True)], names=[n for n, _ in schema]
    )


_COUNT = ["word", "per_word", "context", "n"]
_COUNT_KINDS = ["word", "small", "word", "small"]
_COUNTED = [("shard", pa.int32()), *[(c, pa.binary()) for c in _COUNT]]
_FOUND = ["hash", "count", "followers"]
_FOUND_KINDS = ["word", "small", "small"]
_ASKED = [("dealt", pa.int32()), ("shard", pa.int32()), *[(c, pa.binary()) for c in _FOUND]]
_TOTALS = ["tokens", "docs", "words"]
_TOLD = [("shard", pa.int32()), *[(c, pa.binary()) for c in _FOUND], *[(c, pa.int64()) for c in _TOTALS]]


def _ddl(schema: list[tuple[str, pa.DataType]]) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.list_(pa.int64()): "array<long>"}
    return ", ".join(f"{n} {names[k]}" for n, k in schema)


def _by_shard(rows: DataFrame, key: str, *then: str) -> DataFrame:
    return rows.repartition(shuffle_width(rows.sparkSession), key).sortWithinPartitions(key, *then)


def _count(docs: DataFrame, shards: int, codes: Broadcast) -> DataFrame:
    """For every chunk and shard the different pairs with their training counts, which may be 0."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            token, context, row = tokens(*byte_view(batch.column("text")))
            own, key = Numbered.of(token, context, _learns(batch)[row], 1, codes.value)
            pair = key >> np.uint64(1)
            at = _runs(pair)
            n = np.add.reduceat((key & np.uint64(1)).astype(np.int64), at)
            dealt, order = own.dealt(pair[at], shards)
            n, (token, context) = n[order], own.split(pair[at][order])
            cuts = np.append(_runs(dealt), len(dealt)).tolist()
            rows = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                first = _runs(token[a:b])
                arrays = (own.words(token[a:b][first]), _sizes(first, b - a), own.words(context[a:b]), n[a:b])
                rows.append((int(dealt[a]), *_packed(arrays, _COUNT_KINDS, codes.value)))
            yield _batch(rows, _COUNTED)

    return docs.mapInArrow(run, _ddl(_COUNTED))


def _pairs(
    words: list[np.ndarray], per_word: list[np.ndarray], contexts: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs of several chunks, each word written once for its contexts: the ascending hashes of words
    and contexts, the different pairs, ascending, as place of the word times number of hashes plus place
    of the context, and for each pair its place among these."""
    context = np.concatenate(contexts)
    hashes, at = np.unique(np.concatenate([context, *words]), return_inverse=True)
    word = np.repeat(at[len(context) :], np.concatenate(per_word))
    pair, of = np.unique(word * len(hashes) + at[: len(context)], return_inverse=True)
    return hashes, pair, of


def _ask(counted: DataFrame, shards: int, codes: Broadcast) -> DataFrame:
    """For every shard its words and contexts, dealt by their hash, with what its pairs say of them:
    training count as a context, and different followers. No other shard holds these pairs."""

    def ask(shard: int, held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        hashes, pair, of = _pairs([h[0] for h in held], [h[1] for h in held], [h[2] for h in held])
        n = np.bincount(of, weights=np.concatenate([h[3] for h in held]))
        # the end has the count of the start
        of = pair % len(hashes)
        count = np.bincount(of, weights=n, minlength=len(hashes))
        followers = np.bincount(of, weights=n > 0, minlength=len(hashes))
        dealt = (mix(hashes) % np.uint64(shards)).astype(np.int32)
        order = np.argsort(dealt, kind="stable")
        dealt, hashes, count, followers = dealt[order], hashes[order], count[order], followers[order]
        cuts = np.append(_runs(dealt), len(dealt)).tolist()
        yield _batch(
            [
                (int(dealt[a]), shard, *_packed((hashes[a:b], count[a:b], followers[a:b]), _FOUND_KINDS, codes.value))
                for a, b in zip(cuts[:-1], cuts[1:], strict=True)
            ],
            _ASKED,
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        at = -1
        for batch in batches:
            columns = [batch.column(c) for c in ("shard", *_COUNT)]
            for i in range(batch.num_rows):
                shard, *packed = (c[i].as_py() for c in columns)
                if shard != at:
                    yield from ask(at, held)
                    held, at = [], shard
                held.append(_unpacked(packed, _COUNT_KINDS, codes.value))
        yield from ask(at, held)

    return _by_shard(counted, "shard").mapInArrow(run, _ddl(_ASKED))


def _tell(asked: DataFrame, codes: Broadcast) -> DataFrame:
    """The sums over all shards, for every shard that asked; and, once for each hash, its share of
    the totals."""

    def tell(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        hashes, of = np.unique(np.concatenate([h[1] for h in held]), return_inverse=True)
        count, followers = (
            np.bincount(of, weights=np.concatenate([h[k] for h in held])).astype(np.int64) for k in (2, 3)
        )
        start = hashes == START
        # the start is counted for the end: both stand once in a document
        totals = int(count.sum()), int(count[start].sum()), int((count > 0).sum())
        to = 0
        for shard, own, _, _ in held:
            at, to = to, to + len(own)
            arrays = (own, count[of[at:to]], followers[of[at:to]])
            yield _batch([(shard, *_packed(arrays, _FOUND_KINDS, codes.value), *totals)], _TOLD)
            totals = 0, 0, 0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at = -1
        for batch in batches:
            columns = [batch.column(c) for c in ("dealt", "shard", *_FOUND)]
            for i in range(batch.num_rows):
                dealt, shard, *packed = (c[i].as_py() for c in columns)
                if dealt != at:
                    yield from tell(held)
                    held, at = [], dealt
                held.append((shard, *_unpacked(packed, _FOUND_KINDS, codes.value)))
        yield from tell(held)

    return _by_shard(asked, "dealt").mapInArrow(run, _ddl(_TOLD))


_PAIR = ["word", "per_word", "context", "per_pair", "row", "n"]
_PAIR_KINDS = ["word", "small", "word", "small", "<u2", "small"]
_SENT = [
    ("shard", pa.int32()), ("chunk", pa.int64()), ("learn", pa.binary()), *[(c, pa.binary()) for c in _PAIR],
    ("ids", pa.list_(pa.int64())), ("sizes", pa.binary()),
]
_SUM = ["row", "base", "score", "known"]
_SUM_KINDS = ["<u2", "<f8", "<f4", "small"]
_SUMS = [("chunk", pa.int64()), *[(c, pa.binary()) for c in _SUM], ("ids", pa.list_(pa.int64())), ("sizes", pa.binary())]


def _send(docs: DataFrame, shards: int, codes: Broadcast) -> DataFrame:
    """For every chunk and shard the pairs with their rows; and one row of ids for every chunk."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 40
        for batch in _small_chunks(batches):
            token, context, row = tokens(*byte_view(batch.column("text")))
            sizes = np.bincount(row, minlength=batch.num_rows).astype("<u4").tobytes()
            width = max(batch.num_rows - 1, 0).bit_length()
            own, key = Numbered.of(token, context, row, width, codes.value)
            at = _runs(key)
            n, key = _sizes(at, len(key)), key[at]
            dealt, order = own.dealt(key >> np.uint64(width), shards)
            n, key = n[order], key[order]
            row = (key & np.uint64((1 << width) - 1)).astype(np.uint16)
            token, context = own.split(key >> np.uint64(width))
            cuts = np.append(_runs(dealt), len(dealt)).tolist()
            bits = np.packbits(_learns(batch)).tobytes()
            rows: list[tuple] = [(chunk % shards, chunk, *[None] * 7, batch.column("doc_id").to_pylist(), sizes)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                pair = _runs(token[a:b], context[a:b])
                words = token[a:b][pair]
                first = _runs(words)
                arrays = (
                    own.words(words[first]), _sizes(first, len(pair)), own.words(context[a:b][pair]), _sizes(pair, b - a), row[a:b], n[a:b]
                )
                rows.append((int(dealt[a]), chunk, bits, *_packed(arrays, _PAIR_KINDS, codes.value), None, None))
            yield _batch(rows, _SENT)
            chunk += 1

    return docs.mapInArrow(run, _ddl(_SENT))


def _answer(sent: DataFrame, told: DataFrame, totals: Totals, codes: Broadcast) -> DataFrame:
    """Sums of every chunk's rows from each shard's trie."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        found: list[list[np.ndarray]] = []
        at = None
        for batch in batches:
            documents = batch.filter(pc.is_valid(batch.column("ids")))
            if documents.num_rows:
                n = documents.num_rows
                yield pa.RecordBatch.from_arrays(
                    [documents.column("chunk"), *[pa.nulls(n, pa.binary())] * 4, documents.column("ids"), documents.column("sizes")],
                    names=[c for c, _ in _SUMS],
                )
            batch = batch.filter(pc.is_null(batch.column("ids")))
            columns = [batch.column(c) for c in ("shard", "chunk", "learn", *_PAIR, *_FOUND)]
            for i in range(batch.num_rows):
                shard, chunk, learn, *packed = (c[i].as_py() for c in columns)
                if shard != at:
                    yield from shard_sums(held, found, totals, codes.value)
                    held, found, at = [], [], shard
                pairs, words = packed[: len(_PAIR)], packed[len(_PAIR) :]
                if learn is None:
                    found.append(_unpacked(words, _FOUND_KINDS, codes.value))
                    continue
                knows = np.unpackbits(np.frombuffer(learn, np.uint8)).astype(bool)
                held.append((chunk, *_unpacked(pairs, _PAIR_KINDS, codes.value), knows))
        yield from shard_sums(held, found, totals, codes.value)

    told = told.select("shard", F.lit(-1).cast("long").alias("chunk"), *_FOUND)
    both = sent.unionByName(told, allowMissingColumns=True)
    return _by_shard(both, "shard", "chunk").mapInArrow(run, _ddl(_SUMS))


def build_shard(word: np.ndarray, context: np.ndarray, n: np.ndarray, known: Known) -> Trie:
    """The trie of a shard from its different pairs, ascending, with their training counts; words and
    contexts are given by their place among the shard's hashes, which numbers the contexts."""
    taught = n > 0
    word, context, pair = word[taught], context[taught], n[taught]
    first = _runs(word)
    words = known.hashes[word[first]]
    base = np.repeat(known.totals.base(known.word_count(words)), _sizes(first, len(word)))
    p = pair + known.followers[context] * base
    log_p = np.log10(p / (known.count[context] + known.followers[context]))
    return Trie.mapped(Trie.build(words, np.append(first, len(word)), context, log_p, len(known.hashes)))


def shard_sums(held: list[tuple], found: list[list[np.ndarray]], totals: Totals, codes: Codes) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    hashes, count, followers = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(hashes)
    known = Known(hashes[order], count[order].astype(np.int64), followers[order].astype(np.int64), totals)
    hashes, pair, at = _pairs([h[1] for h in held], [h[2] for h in held], [h[3] for h in held])
    place = known.at(hashes)
    word, context = place[pair // len(hashes)], place[pair % len(hashes)]
    # every pair has a row
    n = np.concatenate([np.add.reduceat(h[6] * h[7][h[5]], np.cumsum(h[4], dtype=np.int64) - h[4]) for h in held])
    trie = build_shard(word, context, np.bincount(at, weights=n), known)
    # each pair is looked up once, in order
    first = _runs(word)
    words = known.hashes[word[first]]
    of = np.repeat(np.arange(len(first)), _sizes(first, len(word)))
    log_p = trie.log_p(trie.find_words(words), of, context)
    c = known.word_count(words)
    f, total = known.followers[context], known.count[context]
    unseen = np.isnan(log_p)
    share = np.where(total[unseen] > 0, f[unseen] / np.maximum(total[unseen] + f[unseen], 1), 1.0)
    log_p[unseen] = np.log10(share * totals.base(c)[of[unseen]])
    base, counted = np.log10(c + ADD)[of], (c > 0)[of]
    to = 0
    for chunk, _, _, own, per_pair, row, n, _ in held:
        here, to = at[to : to + len(own)], to + len(own)
        here = np.repeat(here, per_pair)
        rows = np.flatnonzero(np.bincount(row))
        add = lambda x: np.bincount(row, weights=x)[rows]  # noqa: B023, E731
        sums = (rows, add(n * base[here]), add(n * log_p[here]), add(n * counted[here]))
        yield _batch([(chunk, *_packed(sums, _SUM_KINDS, codes), None, None)], _SUMS)


def _add_up(sums: DataFrame, codes: Broadcast) -> DataFrame:
    """(doc_id, n_tokens, n_known, base, score): the sums of all shards for every document."""
    schema = "doc_id long, n_tokens long, n_known long, base double, score double"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, sizes, parts = None, [], b"", []

        def flush() -> Iterator[pa.RecordBatch]:
            n = len(ids)
            total = np.zeros((3, n))
            for row, *values in parts:
                for out, x in zip(total, values, strict=True):
                    out[row] += x
            base, score, known = total
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(np.frombuffer(sizes, "<u4").astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score)],
                    names=["doc_id", "n_tokens", "n_known", "base", "score"],
                )

        for batch in batches:
            columns = [batch.column(c) for c in ("chunk", "ids", "sizes", *_SUM)]
            for i in range(batch.num_rows):
                chunk, own, size, *packed = (c[i].as_py() for c in columns)
                if chunk != at:
                    yield from flush()
                    at, ids, sizes, parts = chunk, [], b"", []
                if own is not None:
                    ids, sizes = own, size
                else:
                    parts.append(_unpacked(packed, _SUM_KINDS, codes.value))
        yield from flush()

    return _by_shard(sums, "chunk").mapInArrow(run, schema)


def score(docs: DataFrame) -> DataFrame:
    """n_tokens, n_known, train_tokens, base_score and score of each of (doc_id, text, learn)."""
    shards = 2 * shuffle_width(docs.sparkSession)
    codes = docs.sparkSession.sparkContext.broadcast(_frequent(docs))
    told = materialise(_tell(_ask(_count(docs, shards, codes), shards, codes), codes), "words")
    found = told.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in _TOTALS]).first()
    totals = Totals(*found)
    sums = _add_up(_answer(_send(docs, shards, codes), told, totals, codes), codes)
    return sums.select(
        "doc_id",
        "n_tokens",
        "n_known",
        F.lit(totals.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * float(np.log10(totals.whole))).alias("base_score"),
        "score",
    )


def held_out() -> Column:
    return fold(F.col("doc_id"), 10) == 0


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(table(spark, sf_dir, "documents")).withColumn("learn", ~held_out())
    return score(docs).select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
