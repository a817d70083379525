"""Grouped prefix join: documents whose sets of word shingles overlap by a share or more.

Shingles are ordered by how often their slot of a fixed-size counting sketch over all documents was
hit, then by hash; of a document with n shingles only the first n - ceil(share * n) + 1 can be the
first that a similar document also has. Documents with the same prefix and size form one group, and
only groups go through the exchange. Prefix shingles of a single group end there; the others give
candidate pairs, filtered by size and by the places of the shingle, which are then expanded to
members and verified on whole sets.

A prefix shingle shared by more than SMALL groups does not give all their pairs: each of them is
verified against one pivot first. After that only members of different components are compared,
which loses no link between components, and only those pass whose bitmaps differ in no more places
than the sets of a similar pair may.

Defined results: null text and text without words have an empty set, no links and are their own
component; texts with equal sets are one class, whatever their number; repeated ids are one node
with each of their rows returned; other columns are not read. Sets are told apart by 128 bits; pairs
are verified on 48 bits of each shingle's hash, on all 64 where two shingles of a set would meet.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm.arrays import byte_view, chunks, mix, shingle_hashes, word_hashes
from loanlens.llm.components import components
from loanlens.llm.frames import shuffle_width, table, texts
from loanlens.session import materialise

SIZE = 5
#: Two sets are linked from this share of their union upwards, as a fraction.
SHARE = (4, 5)
#: Counters of the sketch, whatever the number of documents; and the pieces it is merged in.
SKETCH = 1 << 20
SKETCH_PARTS = 16
_STEP = np.log(1.08)
#: Groups that share a shingle are paired outright up to this number.
SMALL = 8
#: Bits of the bitmap of a set: each shingle sets the bit its hash names.
BITMAP = 4096
_TOKEN_BITS = 48


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SIZE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    hashes, bounds, _ = word_hashes(data, offsets)
    runs, starts = shingle_hashes(hashes, bounds, size)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        own = np.sort(runs[a:b])
        yield own[np.append(True, own[1:] != own[:-1])] if b - a > 1 else own


def _sketch(docs: DataFrame) -> np.ndarray:
    """By slot, a class that rises with the number of documents that have a shingle there.

    One byte for each of SKETCH slots, whatever the input, is what reaches the driver.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, dtype=np.int64)
        for batch in chunks(batches):
            own = list(shingle_sets(*byte_view(batch.column("text"))))
            slots = (np.concatenate(own) & np.uint64(SKETCH - 1)).astype(np.int64)
            total += np.bincount(slots, minlength=SKETCH)
        parts = np.split(total, SKETCH_PARTS)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(SKETCH_PARTS), pa.int32()),
                pa.array([zlib.compress(x.astype("<u4").tobytes(), 1) for x in parts], pa.binary()),
            ],
            names=["part", "counts"],
        )

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                own = np.frombuffer(zlib.decompress(counts), dtype="<u4")
                sums[part] = sums[part] + own if part in sums else own.astype(np.int64)
        for part, total in sums.items():
            level = np.minimum(np.log1p(total) / _STEP, 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([level.tobytes()], pa.binary())], names=["part", "level"]
            )

    counted = docs.mapInArrow(count, "part int, counts binary")
    rows = counted.repartition(SKETCH_PARTS, "part").mapInArrow(add, "part int, level binary").collect()
    out = np.zeros(SKETCH, dtype=np.uint8)
    width = SKETCH // SKETCH_PARTS
    for r in rows:
        out[r["part"] * width : (r["part"] + 1) * width] = np.frombuffer(r["level"], dtype=np.uint8)
    return out


def prefix(own: np.ndarray, level: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the common order that a similar set must share one of."""
    n = len(own)
    keep = n - (n * SHARE[0] + SHARE[1] - 1) // SHARE[1] + 1
    rank = (level[(own & np.uint64(SKETCH - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (own >> np.uint64(8))
    return own[np.argsort(rank, kind="stable")[:keep]]


_PACKED = "shard int, doc_id long, n long, set1 long, set2 long, gid long, tokens binary, gids binary, sizes binary, places binary"
_FLAT = "doc_id long, n long, set1 long, set2 long, gid long, token long, place int, other long"


def _pack(docs: DataFrame, level: np.ndarray, shards: int) -> DataFrame:
    """A row per document, and for every chunk and shard the prefix shingles of its groups."""
    shared = docs.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _PACKED.split(", ")]
        kinds = [pa.int32(), *[pa.int64()] * 5, *[pa.binary()] * 4]

        def rows(columns: list) -> pa.RecordBatch:
            n = len(columns[0])
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) if c is not None else pa.nulls(n, k) for c, k in zip(columns, kinds, strict=True)],
                names=names,
            )

        for batch in chunks(batches):
            documents, tokens, gids, sizes, places = [], [], [], [], []
            seen: set[int] = set()
            for own in shingle_sets(*byte_view(batch.column("text"))):
                n = len(own)
                if n == 0:
                    documents.append((0, 0, 0, None))
                    continue
                first = prefix(own, shared.value)
                gid = int(mix(mix(first).sum(keepdims=True) ^ np.uint64(n))[0].astype(np.int64))
                pair = (mix(own).sum(), mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum())
                documents.append((n, int(pair[0].astype(np.int64)), int(pair[1].astype(np.int64)), gid))
                if gid not in seen:
                    seen.add(gid)
                    tokens.append(first >> np.uint64(64 - _TOKEN_BITS))
                    gids.append(np.full(len(first), gid, dtype=np.int64))
                    sizes.append(np.full(len(first), n, dtype="<u4"))
                    places.append(np.minimum(np.arange(len(first)), 65535).astype("<u2"))
            n, set1, set2, gid = zip(*documents, strict=True)
            ids = batch.column("doc_id")
            spread = [i % shards for i in range(len(n))]
            yield rows([spread, ids, n, set1, set2, gid, None, None, None, None])
            if not tokens:
                continue
            t, *rest = (np.concatenate(x) for x in (tokens, gids, sizes, places))
            shard = (mix(t) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            t, *rest = (x[order] for x in (t, *rest))
            at = np.flatnonzero(np.diff(shard[order], prepend=-1))
            ends = [*at[1:].tolist(), len(t)]
            packed = [
                (int(shard[order[a]]), _six(t[a:b]), *(x[a:b].tobytes() for x in rest))
                for a, b in zip(at.tolist(), ends, strict=True)
            ]
            s, *columns = zip(*packed, strict=True)
            yield rows([s, None, None, None, None, None, *columns])

    return docs.mapInArrow(run, _PACKED)


def _six(values: np.ndarray) -> bytes:
    """48-bit numbers as six bytes each."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(data: bytes) -> np.ndarray:
    six = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), dtype=np.uint8)
    out[:, :6] = six
    return out.view("<u8").ravel()


def _group_pairs(t: np.ndarray, g: np.ndarray, n: np.ndarray, p: np.ndarray) -> Iterator[pa.RecordBatch]:
    """From (shingle, group, size, place), sorted by shingle: the possible pairs of groups of each
    shingle, and the rows of shingles shared by more than SMALL groups."""
    start = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
    k = np.diff(np.append(start, len(t)))
    pairs = []
    for j in range(1, SMALL):  # the pairs that are j rows apart
        at = np.arange(len(t) - j)
        pairs.append(at[(t[j:] == t[:-j]) & (np.repeat(k, k)[:-j] <= SMALL)] + np.array([[0], [j]]))
    for a, size in zip(start[k > SMALL].tolist(), k[k > SMALL].tolist(), strict=True):
        # the one with the fewest shingles of its own before this one is likest to most others
        others = np.arange(a, a + size)
        pivot = a + int(np.lexsort((mix(g[others].view(np.uint64)), p[others]))[0])
        pairs.append(np.stack([np.full(size, pivot), others])[:, others != pivot])
    x, y = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
    low, high = np.minimum(n[x], n[y]).astype(np.int64), np.maximum(n[x], n[y]).astype(np.int64)
    most = np.minimum(n[x].astype(np.int64) - p[x], n[y].astype(np.int64) - p[y])
    fits = (SHARE[1] * low >= SHARE[0] * high) & (most * (SHARE[0] + SHARE[1]) >= (low + high) * SHARE[0])
    x, y = g[x[fits]], g[y[fits]]
    found = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
    m, empty = found.shape[1], lambda m, k: pa.nulls(m, k)
    yield pa.RecordBatch.from_arrays(
        [*(empty(m, pa.int64()) for _ in range(4)), pa.array(found[0]), empty(m, pa.int64()), empty(m, pa.int32()), pa.array(found[1])],
        names=_names(_FLAT),
    )
    many = np.repeat(k, k) > SMALL
    m = int(many.sum())
    yield pa.RecordBatch.from_arrays(
        [empty(m, pa.int64()), pa.array(n[many].astype(np.int64)), empty(m, pa.int64()), empty(m, pa.int64()), pa.array(g[many]),
         pa.array(t[many].view(np.int64)), pa.array(p[many].astype(np.int32)), empty(m, pa.int64())],
        names=_names(_FLAT),
    )


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _pair_up(packed: DataFrame) -> DataFrame:
    """The document rows, the pairs of groups that share a prefix shingle, and the groups of
    shingles that many share."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _names(_FLAT)

        def flush(held: list) -> Iterator[pa.RecordBatch]:
            if not held:
                return
            t, g, n, p = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((g, t))
            t, g, n, p = (x[order] for x in (t, g, n, p))
            new = np.append(True, (t[1:] != t[:-1]) | (g[1:] != g[:-1]))
            t, g, n, p = (x[new] for x in (t, g, n, p))
            again = np.append(False, t[1:] == t[:-1])
            kept = again | np.append(again[1:], False)
            if kept.any():
                yield from _group_pairs(t[kept], g[kept], n[kept], p[kept].astype(np.int64))

        held, at = [], None
        for batch in batches:
            documents = batch.filter(pc.is_valid(batch.column("n")))
            if documents.num_rows:
                n = documents.num_rows
                columns = [documents.column(c) for c in names[:5]]
                columns += [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=names)
            rest = batch.filter(pc.is_valid(batch.column("tokens")))
            for shard, t, *others in zip(*(rest.column(c).to_pylist() for c in ("shard", "tokens", "gids", "sizes", "places")), strict=True):
                if shard != at:
                    yield from flush(held)
                    held, at = [], shard
                held.append((_from_six(t), *(np.frombuffer(x, k) for x, k in zip(others, ("<i8", "<u4", "<u2"), strict=True))))
        yield from flush(held)

    width = shuffle_width(packed.sparkSession)
    return packed.repartition(width, "shard").sortWithinPartitions("shard").mapInArrow(run, _FLAT)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, own, bits): the sorted shingle set of each wanted document, six bytes each, and its
    bitmap."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            own, bits = [], []
            for x in shingle_sets(*byte_view(batch.column("text"))):
                six = np.unique(x >> np.uint64(16))
                # two shingles may meet in six bytes; such a set stays whole
                own.append(b"6" + _six(six) if len(six) == len(x) else b"8" + x.tobytes())
                marked = np.zeros(BITMAP, dtype=bool)
                marked[(x & np.uint64(BITMAP - 1)).astype(np.int64)] = True
                bits.append(np.packbits(marked).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(own, pa.binary()), pa.array(bits, pa.binary())], names=["cls", "own", "bits"]
            )

    # by merging at every size: the ids grow with the documents
    ids = wanted.select(F.col("cls").alias("doc_id")).hint("merge")
    return docs.join(ids, "doc_id", "left_semi").mapInArrow(run, "cls long, own binary, bits binary")


def _values(own: bytes, six: bool) -> np.ndarray:
    if own[:1] == b"6":
        return _from_six(own[1:])
    whole = np.frombuffer(own, dtype=np.uint64, offset=1)
    return np.unique(whole >> np.uint64(16)) if six else whole


def similar(x: bytes, y: bytes) -> bool:
    six = x[:1] == b"6" or y[:1] == b"6"
    a, b = _values(x, six), _values(y, six)
    if len(a) > len(b):
        a, b = b, a
    if len(a) == 0:
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return SHARE[1] * common >= SHARE[0] * (len(a) + len(b) - common)


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = pa.array(
                [similar(x.as_py(), y.as_py()) for x, y in zip(batch.column("x"), batch.column("y"), strict=True)], pa.bool_()
            )
            yield batch.select(["a", "b"]).filter(hit)

    left = sets.select(F.col("cls").alias("a"), F.col("own").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("own").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _partners(n: np.ndarray, place: np.ndarray, component: np.ndarray, i: int) -> np.ndarray:
    """Of rows sorted by size, those after ``i`` that are not too large, of another component, and
    may have enough in common when this shingle is the first common one."""
    end = int(np.searchsorted(n, n[i] * SHARE[1] // SHARE[0], side="right"))
    j = np.arange(i + 1, max(end, i + 1))
    most = np.minimum(n[i] - place[i], n[j] - place[j])
    return j[(component[j] != component[i]) & (most * (SHARE[0] + SHARE[1]) >= (n[i] + n[j]) * SHARE[0])]


def _open_rows(keyed: DataFrame) -> DataFrame:
    """The rows of (key, cls, n, place, component) that have a possible partner under their key, so
    that bitmaps are fetched for them alone."""

    def marked(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        columns = np.array(held, dtype=np.int64).reshape(-1, 5)
        columns = columns[np.argsort(columns[:, 2], kind="stable")]
        n, place, component = columns[:, 2], columns[:, 3], columns[:, 4]
        some = np.zeros(len(n), dtype=bool)
        for i in range(len(n) - 1):
            j = _partners(n, place, component, i)
            some[j] = True
            some[i] |= len(j) > 0
        if some.any():
            yield pa.RecordBatch.from_arrays([pa.array(columns[some, c].copy()) for c in range(5)], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if held and row[0] != held[0][0]:
                    yield from marked(held)
                    held = []
                held.append(row)
        yield from marked(held)

    names = ["key", "cls", "n", "place", "component"]
    width = shuffle_width(keyed.sparkSession)
    rows = keyed.select(*[F.col(c).cast("long") for c in names]).repartition(width, "key").sortWithinPartitions("key")
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _cross_pairs(keyed: DataFrame) -> DataFrame:
    """Pairs (a, b) of (key, cls, n, place, component, bits) that share a key, are of different
    components, and may be similar by size, by the most that can be common when this shingle is
    the first common one, and by their bitmaps."""

    def pairs(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if len(held) < 2:
            return
        cls, n, place, component, bits = (list(x) for x in zip(*held, strict=True))
        cls, n, place, component = (np.array(x, dtype=np.int64) for x in (cls, n, place, component))
        order = np.argsort(n, kind="stable")
        cls, n, place, component = (x[order] for x in (cls, n, place, component))
        maps = np.frombuffer(b"".join(bits), dtype=np.uint64).reshape(len(n), -1)[order]
        found = []
        for i in range(len(n) - 1):
            j = _partners(n, place, component, i)
            if len(j):
                differ = np.bitwise_count(maps[j] ^ maps[i]).sum(axis=1, dtype=np.int64)
                j = j[differ * (SHARE[0] + SHARE[1]) <= (n[i] + n[j]) * (SHARE[1] - SHARE[0])]
            if len(j):
                found.append(np.stack([np.minimum(cls[i], cls[j]), np.maximum(cls[i], cls[j])]))
        if found:
            a, b = np.concatenate(found, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at = None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("key", "cls", "n", "place", "component", "bits"))
            for key, *row in zip(*columns, strict=True):
                if key != at:
                    yield from pairs(held)
                    held, at = [], key
                held.append(tuple(row))
        yield from pairs(held)

    width = shuffle_width(keyed.sparkSession)
    rows = keyed.select("key", "cls", "n", F.col("place").cast("long"), "component", "bits")
    return rows.repartition(width, "key").sortWithinPartitions("key").mapInArrow(run, "a long, b long").distinct()


def link_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (doc_id, n, cls) and components (node, component) of the linked classes; a class is
    named by the smallest id among its texts."""
    shards = 4 * shuffle_width(docs.sparkSession)
    flat = materialise(_pair_up(_pack(docs, _sketch(docs), shards)), "prefixes")
    rows = flat.filter(F.col("n").isNotNull() & F.col("token").isNull())
    classes = materialise(
        rows.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
        .groupBy("set1", "set2", "n", "gid").agg(F.min("doc_id").alias("cls")), "classes",
    )
    of_class = classes.select("set1", "set2", "n", "cls")
    members = rows.select("doc_id", "n", "set1", "set2").join(of_class, ["set1", "set2", "n"], "left").select("doc_id", "n", "cls")
    groups = classes.groupBy("gid").agg(F.count("*").alias("k"), F.min("cls").alias("cls"), F.min("n").alias("n"))
    group_pairs = flat.filter(F.col("other").isNotNull()).select("gid", "other").distinct()
    one, two = groups.select("gid", F.col("cls").alias("x"), F.col("k").alias("kx")), groups.select(F.col("gid").alias("other"), F.col("cls").alias("y"), F.col("k").alias("ky"))
    paired = materialise(group_pairs.join(one, "gid").join(two, "other"), "pairs")
    single = (F.col("kx") == 1) & (F.col("ky") == 1)
    pairs = paired.filter(single).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    # groups of several members: all members of the pair, and of each group, share a key
    wide = paired.filter(~single)
    own = groups.filter("k > 1").select("gid", F.xxhash64("gid", F.lit(0)).alias("key"))
    wide = wide.select(F.col("gid"), F.xxhash64("gid", "other").alias("key")).unionByName(
        wide.select(F.col("other").alias("gid"), F.xxhash64("gid", "other").alias("key"))
    )
    shared = flat.filter(F.col("token").isNotNull()).select("gid", F.col("token").alias("key"), "place")
    shared = shared.unionByName(own.unionByName(wide).withColumn("place", F.lit(0)))
    keyed = materialise(shared.join(classes.select("gid", "n", "cls"), "gid").select("key", "cls", "n", "place"), "keyed")
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).union(keyed.select("cls")).distinct()
    sets = materialise(_sets(docs, wanted), "sets")
    links = materialise(_verify(pairs, sets), "verified")
    found = components(links)
    now = keyed.join(found.withColumnRenamed("node", "cls"), "cls", "left")
    now = now.withColumn("component", F.coalesce("component", "cls"))
    mixed = now.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_ = materialise(_open_rows(now.join(mixed.filter("low <> high").select("key"), "key")), "open")
    rest = open_.join(sets.select("cls", "bits"), "cls")
    new = materialise(_cross_pairs(rest).join(pairs, ["a", "b"], "left_anti"), "pairs")
    more = materialise(_verify(new, sets), "verified")
    if more.take(1):
        found = components(links.unionByName(more))
    return members, found


def near_duplicates(docs: DataFrame) -> DataFrame:
    """n_shingles and component_id for each of (doc_id, text)."""
    members, found = link_classes(docs)
    return members.join(found.withColumnRenamed("node", "cls"), "cls", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "cls", "doc_id").alias("component_id"),
    )


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of every component the document with the smallest id stays; where ids are
    repeated, one of their rows does."""
    found = materialise(near_duplicates(texts(docs)), "components")
    kept = found.filter(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").agg(F.count("*").alias("rows"))
    out = docs.join(kept.select("doc_id"), "doc_id", "left_semi").unionByName(docs.filter(F.col("doc_id").isNull()))
    if kept.filter("rows > 1").take(1):
        out = out.dropDuplicates(["doc_id"])
    return out.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(texts(table(spark, sf_dir, "documents")))
