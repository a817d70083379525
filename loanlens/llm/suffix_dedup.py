"""Removal of passages that occur elsewhere, by sparse suffix arrays in a logarithmic family.

A string of WIDTH bytes that occurs twice holds, both times at the same place, the same anchor: the
place with the smallest hash of GRAM bytes among its first WIDTH - KEY + 1 places. Suffixes are
indexed at anchors only, by the KEY bytes that follow, in the order of their 64-bit hashes; equal
prefixes stand side by side in that order as in the alphabetical one.

Every chunk of documents brings its sorted suffixes, dealt by key range to independent families. A
family holds sorted levels; the new suffixes are merge-scanned against each level, which finds the
long matches, and are then kept as a level, equal-sized levels merging. What matched is settled on
bytes of the texts: an anchor owns the WIDTH-byte strings whose anchor it is. Where all bytes of the
strings it owns occur again, they are all repeated; at the edges of a passage each string is hashed
(128 bits) and counted.

Defined results: null text is empty; texts under WIDTH bytes lose nothing; equal texts count as
many times as there are rows; ids may be null or repeated; other columns are not read. The bytes
that stay need not be valid UTF-8; the pipeline stage leaves out the cut characters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm.arrays import byte_view, chunks, mix
from loanlens.llm.frames import shuffle_width, table, texts
from loanlens.session import materialise

WIDTH = 400
#: Bytes of a repeated passage in the pipeline, whose rule is its own: fewer than 50 words have.
PASSAGE = 200
GRAM = 16
#: Bytes whose anchors are sought at once.
SLICE = 512 << 10
_SEED = 7
#: The text a row stands for: 96 bits of hashes.
TEXT_ID = ["t1", "t2"]


def key_bytes(width: int) -> int:
    """KEY for strings of ``width`` bytes."""
    return width // 2


def anchors(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all strings of ``width`` bytes of the rows, with the first and last start they serve.

    The bytes are worked on in slices, so that memory does not grow with a chunk or a text; an anchor
    that serves starts on both sides of a slice's edge is put together again.
    """
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for start in range(0, len(data), SLICE):
        place, first, last = _slice_anchors(data, offsets, start, min(start + SLICE, len(data)), width)
        if parts and len(place) and place[0] == parts[-1][0][-1] and first[0] == parts[-1][2][-1] + 1:
            row_start = offsets[np.searchsorted(offsets, first[0], side="right") - 1]
            if first[0] != row_start:
                parts[-1][2][-1] = last[0]
                place, first, last = place[1:], first[1:], last[1:]
        if len(place):
            parts.append((place, first, last))
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _slice_anchors(
    data: np.ndarray, offsets: np.ndarray, start: int, stop: int, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the strings that start in a slice; the bytes they reach into are read along."""
    n, span = stop - start, width - key_bytes(width) + 1
    own = data[start : stop + width + GRAM]
    m = len(own)
    padded = np.concatenate([own, np.zeros(GRAM + 8, np.uint8)])
    eight = np.empty(m + 8, dtype=np.uint64)
    for k in range(8):
        eight[k::8] = np.frombuffer(padded, "<u8", offset=k, count=len(eight[k::8]))
    rank = mix(eight[:m] * np.uint64(0x9E3779B97F4A7C15) ^ eight[8 : m + 8]) >> np.uint64(32)
    # of equal hashes the last place
    rank = (rank << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(m, dtype=np.uint64))
    blocks = np.full((-(-m // span) + 1, span), np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks.ravel()[:m] = rank
    head = np.minimum.accumulate(blocks, axis=1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(tail[:n], head[span - 1 : span - 1 + n])
    place = start + (np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))).astype(np.int64)
    first_row = np.searchsorted(offsets, start, side="right") - 1
    after = np.searchsorted(offsets, stop)
    row_starts, row_ends = offsets[first_row:after], offsets[first_row + 1 : after + 1]
    sizes = np.minimum(row_ends, stop) - np.maximum(row_starts, start)
    whole = np.arange(start, stop) + width <= np.repeat(row_ends, sizes)
    begins = np.ones(n, dtype=bool)
    begins[1:] = place[1:] != place[:-1]
    begins[row_starts[(row_starts >= start) & (row_starts < stop)] - start] = True
    first = np.flatnonzero(begins & whole)
    ends = np.append(np.flatnonzero(begins | ~whole), n)
    last = ends[np.searchsorted(ends, first, side="right")] - 1
    return place[first], start + first, start + last


def _dealt(frame: DataFrame, run: Callable, schema: str) -> DataFrame:
    """Runs over packed rows, the rows of a shard one after another in the order they were made."""
    width = shuffle_width(frame.sparkSession)
    return frame.repartition(width, "shard").sortWithinPartitions("shard").mapInArrow(run, schema)


def _packed(shard: np.ndarray, arrays: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """Rows of arrays dealt to shards: one row for each shard, every array as its bytes."""
    order = np.argsort(shard, kind="stable")
    shard, arrays = shard[order], [a[order] for a in arrays]
    at = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
    cuts = list(zip(at, [*at[1:], len(shard)], strict=True)) if len(shard) else []
    columns = [pa.array([a[x:y].tobytes() for x, y in cuts], pa.binary()) for a in arrays]
    return pa.RecordBatch.from_arrays([pa.array(shard[at].astype(np.int32)), *columns], names=["shard", *names])


def _by_shard(batches: Iterable[pa.RecordBatch], names: list[str], kinds: list[str]) -> Iterator[tuple[int, list[np.ndarray]]]:
    for batch in batches:
        columns = [batch.column(c) for c in names]
        for i, shard in enumerate(batch.column("shard").to_pylist()):
            yield shard, [np.frombuffer(c[i].as_py(), dtype=k) for c, k in zip(columns, kinds, strict=True)]


def with_text_id(docs: DataFrame) -> DataFrame:
    t2 = F.xxhash64(F.lit(_SEED), "text").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
    return docs.withColumns({"t1": F.xxhash64("text"), "t2": t2})


#: Anchor place, how far before it the first and the last string it owns start: one number.
def _spot(place: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return place << 20 | (place - first) << 10 | (place - last)


def _unspot(spot: int) -> tuple[int, int, int]:
    place = spot >> 20
    return place, place - (spot >> 10 & 1023), place - (spot & 1023)


_SUFFIX = ["key", "t1", "t2", "spot"]
_SUFFIX_KINDS = ["<u8", "<i8", "<i4", "<i8"]


class Family:
    """Sorted levels of suffixes (key, text, spot), each level twice the next one or more.

    ``add`` takes the sorted suffixes of a batch and returns those, old and new, that are now known
    to share their key; every suffix is returned once.
    """

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, list[np.ndarray], np.ndarray]] = []

    def add(self, key: np.ndarray, rest: list[np.ndarray]) -> list[np.ndarray]:
        same = np.append(False, key[1:] == key[:-1])
        matched = same | np.append(same[1:], False)
        known = np.zeros(len(key), dtype=bool)
        out = []
        for keys, columns, told in self.levels:
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[at] == key
            known |= hit
            fresh = np.unique(at[hit])
            fresh = fresh[~told[fresh]]
            told[fresh] = True
            out.append([keys[fresh], *(c[fresh] for c in columns)])
        matched |= known
        out.append([key[matched], *(c[matched] for c in rest)])
        kept = ~known & ~same  # one suffix stands for its key
        if kept.any():
            self._insert(key[kept], [c[kept] for c in rest], matched[kept])
        return [np.concatenate(c) for c in zip(*out, strict=True)]

    def _insert(self, key: np.ndarray, rest: list[np.ndarray], told: np.ndarray) -> None:
        while self.levels and len(self.levels[-1][0]) < 2 * len(key):
            keys, columns, before = self.levels.pop()
            key = np.concatenate([keys, key])
            order = np.argsort(key, kind="stable")
            key = key[order]
            rest = [np.concatenate(c)[order] for c in zip(columns, rest, strict=True)]
            told = np.concatenate([before, told])[order]
        self.levels.append((key, rest, told))


def _matches(docs: DataFrame, shards: int, width: int) -> DataFrame:
    """(t1, t2, spot, key) of every suffix whose key occurs again; docs with text id."""

    def suffixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            data, offsets = byte_view(batch.column("text"))
            place, first, last = anchors(data, offsets, width)
            raw = memoryview(data)
            key = np.fromiter((xxhash.xxh3_64_intdigest(raw[p : p + key_bytes(width)]) for p in place.tolist()), np.uint64, len(place))
            row = np.searchsorted(offsets, first, side="right") - 1
            start = offsets[row]
            t1 = batch.column("t1").to_numpy(zero_copy_only=False)[row]
            t2 = batch.column("t2").to_numpy(zero_copy_only=False)[row]
            order = np.argsort(key, kind="stable")
            columns = [key, t1, t2, _spot(place - start, first - start, last - start)]
            columns = [c[order].astype(k) for c, k in zip(columns, _SUFFIX_KINDS, strict=True)]
            yield _packed((mix(columns[0]) % np.uint64(shards)).astype(np.int64), columns, _SUFFIX)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, at = Family(), None
        for shard, (key, *rest) in _by_shard(batches, _SUFFIX, _SUFFIX_KINDS):
            if shard != at:
                family, at = Family(), shard
            key, t1, t2, spot = family.add(key, rest)
            yield pa.RecordBatch.from_arrays(
                [pa.array(t1), pa.array(t2), pa.array(spot), pa.array(key.view(np.int64))], names=["t1", "t2", "spot", "key"]
            )

    sent = docs.select("text", *TEXT_ID).filter(F.octet_length("text") >= width)
    packed = sent.mapInArrow(suffixes, "shard int, key binary, t1 binary, t2 binary, spot binary")
    return _dealt(packed, scan, "t1 long, t2 int, spot long, key long")


def _zipped_texts(docs: DataFrame, width: int) -> DataFrame:
    """(t1, t2, zipped): long enough texts, compressed, once a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        pack = zstandard.ZstdCompressor(level=1)
        for batch in chunks(batches):
            if len(seen) > 1_000_000:
                seen.clear()
            ids = list(zip(batch.column("t1").to_pylist(), batch.column("t2").to_pylist(), strict=True))
            new = [i for i, x in enumerate(ids) if x not in seen and not seen.add(x)]
            kept = batch.take(pa.array(new, pa.int64()))
            data, offsets = byte_view(kept.column("text"))
            raw = memoryview(data)
            zipped = [pack.compress(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([kept.column("t1"), kept.column("t2"), pa.array(zipped, pa.binary())], names=["t1", "t2", "zipped"])

    sent = docs.select("text", *TEXT_ID).filter(F.octet_length("text") >= width)
    return sent.mapInArrow(run, "t1 long, t2 int, zipped binary")


_OWNED = ["key", "own", "t1", "t2", "spot", "n"]
_OWNED_KINDS = ["<u8", "<u8", "<i8", "<i4", "<i8", "<i8"]


def _owned(matched_texts: DataFrame, shards: int, width: int) -> DataFrame:
    """(t1, t2, spot, edge): anchors whose strings are all repeated (edge 0), and anchors whose
    strings have to be counted one by one: 1 for a lone one, 2 for one that stands for others."""

    def strings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows: list[tuple] = []
            for t1, t2, zipped, marks in zip(*(batch.column(c).to_pylist() for c in ("t1", "t2", "zipped", "marks")), strict=True):
                text = unpack.decompress(zipped)
                for mark in marks:
                    place, first, last = _unspot(mark["spot"])
                    own = xxhash.xxh3_64_intdigest(text[first : last + width], seed=place - first)
                    rows.append((mark["key"], own, t1, t2, mark["spot"], mark["n"]))
            if rows:
                columns = list(zip(*rows, strict=True))
                key = np.array(columns[0], np.int64).view(np.uint64)
                arrays = [key, np.array(columns[1], "<u8"), *(np.array(c, k) for c, k in zip(columns[2:], _OWNED_KINDS[2:], strict=True))]
                yield _packed((mix(key) % np.uint64(shards)).astype(np.int64), arrays, _OWNED)

    def settle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        at = None
        for shard, arrays in _by_shard(batches, _OWNED, _OWNED_KINDS):
            if shard != at:
                yield from flush(held)
                held, at = [], shard
            held.append(arrays)
        yield from flush(held)

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        key, own, t1, t2, spot, n = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((spot, t1, own, key))
        key, own, t1, t2, spot, n = (x[order] for x in (key, own, t1, t2, spot, n))
        new_key = np.append(True, key[1:] != key[:-1])
        new_own = new_key | np.append(True, own[1:] != own[:-1])
        group = np.cumsum(new_own) - 1
        total = np.bincount(group, weights=n)[group]
        several = np.bincount(np.cumsum(new_key) - 1, weights=new_own)[np.cumsum(new_key) - 1] > 1
        for kept, edge in ((total > 1, 0), (several & (total == 1), 1), (several & (total > 1) & new_own, 2)):
            m = int(kept.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(t1[kept]), pa.array(t2[kept]), pa.array(spot[kept]), pa.array(np.full(m, edge, np.int32))],
                names=["t1", "t2", "spot", "edge"],
            )

    binary = ", ".join(f"{c} binary" for c in _OWNED)
    packed = matched_texts.mapInArrow(strings, f"shard int, {binary}")
    return _dealt(packed, settle, "t1 long, t2 int, spot long, edge int")


_STRING = ["h1", "h2", "t1", "t2", "start", "lone"]
_STRING_KINDS = ["<u8", "<u8", "<i8", "<i4", "<i4", "<u1"]


def _edge_strings(matched_texts: DataFrame, owned: DataFrame, shards: int, width: int) -> DataFrame:
    """(t1, t2, start) of every repeated string at an edge."""

    def strings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for part in range(0, batch.num_rows, 200):
                yield from some(unpack, batch.slice(part, 200))

    def some(unpack: zstandard.ZstdDecompressor, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found, t1s, t2s, starts, lone = bytearray(), [], [], [], []
        for t1, t2, zipped, edges in zip(*(batch.column(c).to_pylist() for c in ("t1", "t2", "zipped", "edges")), strict=True):
            text = memoryview(unpack.decompress(zipped))
            for edge in edges:
                _, first, last = _unspot(edge["spot"])
                for s in range(first, last + 1):
                    found += xxhash.xxh3_128_digest(text[s : s + width])
                n = last + 1 - first
                starts.append(np.arange(first, last + 1))
                t1s.append(np.full(n, t1))
                t2s.append(np.full(n, t2))
                lone.append(np.full(n, edge["edge"] == 1))
        if found:
            h = np.frombuffer(bytes(found), "<u8").reshape(-1, 2)
            arrays = [h[:, 0], h[:, 1], *(np.concatenate(x) for x in (t1s, t2s, starts, lone))]
            arrays = [a.astype(k) for a, k in zip(arrays, _STRING_KINDS, strict=True)]
            yield _packed((arrays[0] % np.uint64(shards)).astype(np.int64), arrays, _STRING)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        at = None
        for shard, arrays in _by_shard(batches, _STRING, _STRING_KINDS):
            if shard != at:
                yield from flush(held)
                held, at = [], shard
            held.append(arrays)
        yield from flush(held)

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        h1, h2, t1, t2, start, lone = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((h2, h1))
        h1, h2 = h1[order], h2[order]
        group = np.cumsum(np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))) - 1
        # one that stands for others counts as two
        repeated = np.bincount(group, weights=2 - lone[order])[group] > 1
        kept = order[repeated & (lone[order] == 1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(t1[kept]), pa.array(t2[kept]), pa.array(start[kept])], names=["t1", "t2", "start"]
        )

    edges = owned.filter("edge > 0").groupBy(*TEXT_ID).agg(F.collect_list(F.struct("spot", "edge")).alias("edges"))
    binary = ", ".join(f"{c} binary" for c in _STRING)
    sent = matched_texts.select(*TEXT_ID, "zipped").join(edges, TEXT_ID)
    return _dealt(sent.mapInArrow(strings, f"shard int, {binary}"), count, "t1 long, t2 int, start int")


def covered_runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of intervals that overlap or touch."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > reach[:-1])
    return starts[new], reach[np.append(new[1:], True)]


def _cut(matched_texts: DataFrame, owned: DataFrame, at_edges: DataFrame, width: int) -> DataFrame:
    """(t1, t2, n_removed, n_spans, kept) of every text that loses bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            removed, spans, left = [], [], []
            for zipped, spots, starts in zip(*(batch.column(c).to_pylist() for c in ("zipped", "spots", "starts")), strict=True):
                text = unpack.decompress(zipped)
                owned_by = [_unspot(x) for x in spots]
                a = np.array([x[1] for x in owned_by] + starts, np.int64)
                b = np.array([x[2] for x in owned_by] + starts, np.int64) + width
                a, b = covered_runs(a, b)
                stay = zip([0, *b.tolist()], [*a.tolist(), len(text)], strict=True)
                removed.append(int((b - a).sum()))
                spans.append(len(a))
                left.append(b"".join(text[x:y] for x, y in stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column("t1"), batch.column("t2"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(left, pa.binary())],
                names=["t1", "t2", "n_removed", "n_spans", "kept"],
            )

    spans = (
        owned.filter("edge = 0").select(*TEXT_ID, "spot", F.lit(None).cast("int").alias("start"))
        .unionByName(at_edges.select(*TEXT_ID, F.lit(None).cast("long").alias("spot"), "start"))
        .groupBy(*TEXT_ID).agg(F.collect_list("spot").alias("spots"), F.collect_list("start").alias("starts"))
    )
    return matched_texts.select(*TEXT_ID, "zipped").join(spans, TEXT_ID).mapInArrow(
        run, "t1 long, t2 int, n_removed long, n_spans long, kept binary"
    )


def cut_texts(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(t1, t2, n_removed, n_spans, kept) of every distinct text of (doc_id, text) that loses bytes."""
    shards = 4 * shuffle_width(docs.sparkSession)
    named = with_text_id(docs)
    matches = materialise(_matches(named, shards, width), "matches")
    marks = matches.groupBy(*TEXT_ID, "key", "spot").agg(F.count("*").alias("n"))
    marks = marks.groupBy(*TEXT_ID).agg(F.collect_list(F.struct("key", "spot", "n")).alias("marks"))
    once = _zipped_texts(named, width).join(marks, TEXT_ID).groupBy(*TEXT_ID)
    matched = materialise(once.agg(F.first("zipped").alias("zipped"), F.first("marks").alias("marks")), "texts")
    owned = materialise(_owned(matched, shards, width), "owned")
    at_edges = materialise(_edge_strings(matched, owned, shards, width), "edges")
    return materialise(_cut(matched, owned, at_edges, width), "cut")


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: passages of PASSAGE bytes that are repeated go from the texts; characters cut in
    two go with them. All documents stay, some of them empty."""

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = [x.decode("utf-8", errors="ignore") for x in batch.column("kept").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("t1"), batch.column("t2"), pa.array(left, pa.string())], names=["t1", "t2", "left"]
            )

    cut = cut_texts(texts(docs), PASSAGE).select(*TEXT_ID, "kept").mapInArrow(whole, "t1 long, t2 int, left string")
    given = docs.withColumn("text", F.coalesce("text", F.lit("")))
    joined = with_text_id(given).join(cut, TEXT_ID, "left").withColumn("text", F.coalesce("left", "text"))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.length("text").cast("long"))
    return joined.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(table(spark, sf_dir, "documents"))
    cut = cut_texts(docs).select(*TEXT_ID, "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    whole = with_text_id(docs).select(
        "doc_id", *TEXT_ID, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")
    )
    return whole.join(cut, TEXT_ID, "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )
