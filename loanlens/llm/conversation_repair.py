"""Cheapest repair of conversations to ``(s?(ua)+)?`` by Hirschberg's divide and conquer.

A repair keeps, reroles or deletes every row and may insert empty ones. Between two rows it is in one
of four states (nothing yet, after system, after user, after assistant), so a run of rows is a four by
four table of costs. Cost vectors run forward from the start of a run and backward from its end and
meet in the middle; of the states where their sum is least, the one with the ASCII-least audit so far
is crossed, and both halves are solved likewise. Only vectors are held, whatever the length.

The same crossing is used twice. Rows are sorted by conversation and turn over range partitions, so
that a long conversation spreads over many tasks, and are cut into blocks of at most BLOCK rows. Each
block's table goes to one task of its conversation (144 bytes a block), which finds the states
between blocks; then all blocks are solved on their own. Texts are read and moved once, at the end,
when a task streams each conversation's rows in order past its audit; a hash over a whole
conversation allows no other way, but nothing of it is held but the audit, one byte a row.

Why the meeting is exact: inserts stand directly before the row that follows them, so every audit up
to a row ends in that row's edit. Two such audits with the same number of rows are never prefixes of
each other, and differ if their states do; so comparing them settles which whole audit is less.

Defined results: null role, text, id or turn is one space where it is written or hashed; null turns
come first; a null id is a conversation of its own; rows of one turn are ordered by role, then by the
md5 of their text; a role whose first character is not s, u or a can't be kept; equal rows are
duplicates; a conversation all of whose rows were dropped has zeros, no audit and the hash of nothing;
an empty table gives no rows; a very long text is held alone, a very long conversation never. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm.frames import SPACES, shuffle_width, table
from loanlens.session import materialise

BLOCK = 4096
START, SYSTEM, USER, ASSISTANT = range(4)
# What the edits cost.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: A row's code: 0 must be deleted, else 1 + 2 x place of its initial (4th: none of them) + truncated.
INITIALS = "sua"
_FAR = 1 << 60
#: Inserts that end a conversation in each state.
_TAIL = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}

Step = tuple[int, int, int]  # state after, cost, place among the audits from the same state
Item = tuple[tuple[Step, ...], ...]  # steps from each state


def _turn(state: int) -> int:
    """State after a row that takes the role that is due."""
    return ASSISTANT if state == USER else USER


def _row_edits(code: int) -> list[dict[int, tuple[int, str]]]:
    """From each state: state after the row -> (cost, edits), inserts before the row included."""
    out = []
    for start in range(4):
        found: dict[int, tuple[int, str]] = {start: (DELETE, "D")}
        if code:
            initial, truncated = divmod(code - 1, 2)
            state = start
            for k in range(3):
                cost, edits = k * INSERT + truncated * TRUNCATED, "I" * k
                options = [(_turn(state), cost + REROLE, edits + "R")]
                kept = initial + 1
                if kept == SYSTEM and state == START or kept in (USER, ASSISTANT) and kept == _turn(state):
                    options.append((kept, cost + KEEP, edits + "K"))
                for after, total, text in options:
                    found[after] = min(found.get(after, (_FAR, "")), (total, text))
                state = _turn(state)
        out.append(found)
    return out


EDITS = [_row_edits(code) for code in range(9)]


def _item(costs: Sequence[Sequence[int]], order: Sequence[Sequence]) -> Item:
    return tuple(
        tuple((s, costs[x][s], rank) for rank, s in enumerate(sorted(range(4), key=lambda s: order[x][s])) if costs[x][s] < _FAR)
        for x in range(4)
    )


ROWS: list[Item] = [
    _item(
        [[e[s][0] if s in e else _FAR for s in range(4)] for e in edits],
        [[e[s][1] if s in e else "~" for s in range(4)] for e in edits],
    )
    for edits in EDITS
]


def forward(items: Iterable[Item], start: int) -> list[tuple[int, int]]:
    """(cost, place of the least audit among the four) of reaching every state from ``start``."""
    vector = [(0, 0) if s == start else (_FAR, 4) for s in range(4)]
    for item in items:
        best: list[tuple[int, int, int]] = [(_FAR, 4, 4)] * 4
        for p, (cost, rank) in enumerate(vector):
            if cost < _FAR:
                for s, step, place in item[p]:
                    found = (cost + step, rank, place)
                    if found < best[s]:
                        best[s] = found
        order = sorted(range(4), key=lambda s: best[s][1:])
        vector = [(_FAR, 4)] * 4
        for place, s in enumerate(order):
            if best[s][0] < _FAR:
                vector[s] = (best[s][0], place)
    return vector


def backward(items: Sequence[Item], end: int) -> list[int]:
    """Cost of reaching ``end`` from every state."""
    vector = [0 if s == end else _FAR for s in range(4)]
    for item in reversed(items):
        vector = [min((step + vector[s] for s, step, _ in item[p]), default=_FAR) for p in range(4)]
    return vector


def crossings(items: Sequence[Item], start: int, end: int) -> list[int]:
    """States before, between and after the items on the cheapest way, ASCII-least on ties."""
    if len(items) < 2:
        return [start, end]
    middle = len(items) // 2
    there, back = forward(items[:middle], start), backward(items[middle:], end)
    state = min(range(4), key=lambda s: (there[s][0] + back[s], there[s][1]))
    return crossings(items[:middle], start, state)[:-1] + crossings(items[middle:], state, end)


@lru_cache(maxsize=100_000)
def _short_table(codes: bytes) -> bytes:
    items = [ROWS[c] for c in codes]
    return b"".join(struct.pack("<qb", *v) for x in range(4) for v in forward(items, x))


def block_table(codes: bytes) -> bytes:
    """Costs and places of a block's rows from every state to every state."""
    return _short_table(codes) if len(codes) <= 64 else _short_table.__wrapped__(codes)


def unpack_table(packed: bytes) -> Item:
    cells = list(struct.iter_unpack("<qb", packed))
    rows = [cells[4 * x : 4 * x + 4] for x in range(4)]
    return _item([[c for c, _ in r] for r in rows], [[p for _, p in r] for r in rows])


@lru_cache(maxsize=100_000)
def _short_audit(codes: bytes, start: int, end: int) -> tuple[int, str]:
    states = crossings([ROWS[c] for c in codes], start, end)
    steps = [EDITS[c][a][b] for c, a, b in zip(codes, states[:-1], states[1:], strict=True)]
    return sum(cost for cost, _ in steps), "".join(text for _, text in steps)


def audit(codes: bytes, start: int, end: int) -> tuple[int, str]:
    """Least cost and ASCII-least edits that lead over a block's rows from ``start`` to ``end``."""
    return (_short_audit if len(codes) <= 64 else _short_audit.__wrapped__)(codes, start, end)


def ending(vector: Sequence[tuple[int, int]]) -> int:
    """The state to end in, with the inserts it needs, cheapest and then ASCII-least."""
    return min(range(4), key=lambda s: (vector[s][0] + INSERT * _TAIL[s], vector[s][1]))


def repair(codes: bytes) -> tuple[int, str]:
    """Cost and audit of one whole conversation given by its codes."""
    items = [ROWS[c] for c in codes]
    end = ending(forward(items, START))
    cost, text = audit(codes, START, end) if codes else (0, "")
    return cost + INSERT * _TAIL[end], text + "I" * _TAIL[end]


_ID = "has_conv boolean, conv long"
_PLACE = ["has_conv", "conv", "has_turn", "turn", "role", "digest"]
_BLOCKS = (
    f"{_ID}, has_turn boolean, turn long, role string, digest binary, block long, codes binary, "
    "costs binary, n_blank long, n_duplicate long, n_truncated long"
)
_CHAIN = f"{_ID}, block long, entry int, exit int, tail int"
_PIECES = (
    f"{_ID}, has_turn boolean, turn long, role string, digest binary, kind int, block long, audit string, "
    "cost long, n_blank long, n_duplicate long, n_truncated long, copies int, body binary"
)
_OUT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def _kind(declared: str) -> pa.DataType:
    return {
        "boolean": pa.bool_(),
        "long": pa.int64(),
        "int": pa.int32(),
        "string": pa.string(),
        "binary": pa.binary(),
    }[declared]


def _batch(rows: Sequence[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _kind(k)) for c, k in zip(columns, kinds, strict=True)], names=list(names)
    )


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batches(rows: Iterable[tuple], schema: str, most: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield _batch(held, schema)
            held = []
    yield _batch(held, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with what the check rows of a conversation suffer: dropped, emptied, stripped of its
    stops, repeated, or said by the user."""
    written = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    fault = F.crc32(F.concat_ws(":", written("conv_id"), written("turn")).cast("binary")) % 20
    return rows.withColumn("fault", fault).select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault").isin(0, 1), "")
        .when(F.col("fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1).alias("copies"),
    )


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with the columns they are ordered by."""
    return rows.select(
        F.col("conv_id").isNotNull().alias("has_conv"),
        F.coalesce("conv_id", F.lit(0)).alias("conv"),
        F.col("turn").isNotNull().alias("has_turn"),
        F.coalesce("turn", F.lit(0)).alias("turn"),
        "role",
        F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"),
        "text",
        "copies",
    )


def _marked(placed: DataFrame) -> DataFrame:
    """One row per turn, role and text with its number of copies and what is wrong with it."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    own = (
        placed.filter("copies > 0")
        .withColumns(
            {
                "blank": trimmed == "",
                "cut": ~F.substring(trimmed, -1, 1).isin(".", "!", "?"),
            }
        )
        .groupBy(*_PLACE)
        .agg(F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    )
    said = ["has_conv", "conv", "role", "digest"]
    first = own.groupBy(*said).agg(F.min(F.struct("has_turn", "turn")).alias("first"))
    repeated = F.struct("has_turn", "turn") > F.col("first")
    return own.join(first, said).select(*_PLACE, "copies", "blank", "cut", repeated.alias("repeated"))


def _code(role: str, cut: bool) -> int:
    return 1 + 2 * (INITIALS.find(role[0]) if role and role[0] in INITIALS else 3) + cut


def _cut_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the codes of each conversation's rows in a sorted partition."""
    base = TaskContext.get().partitionId() << 40

    def blocks() -> Iterator[tuple]:
        number = base
        for _, own in groupby(_rows(batches), key=lambda r: r[:2]):
            codes, counts, place = bytearray(), [0, 0, 0], None
            for row in own:
                copies, blank, cut, repeated = row[6:]
                first = 0 if blank or repeated else _code(row[4], cut)
                while copies:
                    place = place or row[:6]
                    n = min(copies, BLOCK - len(codes))
                    codes += bytes([first]) + bytes(n - 1)
                    if blank:
                        counts[0] += n
                    else:
                        counts[1] += n - (first > 0)
                        counts[2] += first > 0 and cut
                    copies, first = copies - n, 0
                    if len(codes) == BLOCK:
                        yield *place, number, bytes(codes), block_table(bytes(codes)), *counts
                        number += 1
                        codes, counts, place = bytearray(), [0, 0, 0], None
            if codes:
                yield *place, number, bytes(codes), block_table(bytes(codes)), *counts
                number += 1

    return _batches(blocks(), _BLOCKS, 500)


def _chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """State before and after each block, by the tables of all blocks of its conversation."""

    def states() -> Iterator[tuple]:
        for conv, own in groupby(_rows(batches), key=lambda r: r[:2]):
            numbers, packed = zip(*(r[2:] for r in own), strict=True)
            items = [unpack_table(x) for x in packed]
            end = ending(forward(items, START))
            way = crossings(items, START, end)
            for i, number in enumerate(numbers):
                yield *conv, number, way[i], way[i + 1], _TAIL[end] if i + 1 == len(numbers) else 0

    return _batches(states(), _CHAIN)


def _solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every block's edits and their cost."""

    def pieces() -> Iterator[tuple]:
        for row in _rows(batches):
            codes, entry, out, tail = row[7:11]
            cost, text = audit(codes, entry, out)
            yield *row[:6], 0, row[6], text + "I" * tail, cost + INSERT * tail, *row[11:], None, None

    return _batches(pieces(), _PIECES, 500)


class _Repaired:
    """What is known of one conversation while its rows pass in order."""

    def __init__(self) -> None:
        self.edits: list[str] = []
        self.piece, self.at, self.state = 0, 0, START
        self.hash, self.written = hashlib.sha256(), False
        self.cost = self.illegal = self.turns = 0
        self.faults = [0, 0, 0]
        self.lowest = self.highest = self.before = None

    def _next(self) -> str:
        while self.piece < len(self.edits) and self.at == len(self.edits[self.piece]):
            self.piece, self.at = self.piece + 1, 0
        if self.piece == len(self.edits):
            return ""
        self.at += 1
        return self.edits[self.piece][self.at - 1]

    def _write(self, role: bytes, body: bytes) -> None:
        if self.written:
            self.hash.update(b"\n")
        self.written = True
        self.hash.update(role + b":")
        self.hash.update(body)

    def _write_due(self, body: bytes) -> None:
        self.state = _turn(self.state)
        self._write(b"user" if self.state == USER else b"assistant", body)

    def add_row(self, has_turn: bool, turn: int, role: str, body: bytes) -> None:
        if has_turn and (self.highest is None or turn != self.highest):
            self.lowest = turn if self.lowest is None else self.lowest
            self.highest, self.turns = turn, self.turns + 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        while (edit := self._next()) == "I":
            self._write_due(b"")
        if edit == "K":
            self.state = INITIALS.index(role[0]) + 1
            self._write(role.encode(), body)
        elif edit == "R":
            self._write_due(body)

    def result(self) -> tuple:
        while self._next():
            self._write_due(b"")
        gaps = 0 if self.highest is None else self.highest - self.lowest + 1 - self.turns
        return gaps, *self.faults, self.illegal, self.cost, "".join(self.edits), self.hash.hexdigest()


def _apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired conversations of a partition where each block's edits come before its rows."""

    def results() -> Iterator[tuple]:
        for (has_conv, conv), own in groupby(_rows(batches), key=lambda r: r[:2]):
            now = _Repaired()
            for row in own:
                if row[6] == 0:
                    now.edits.append(row[8])
                    now.cost += row[9]
                    now.faults = [a + b for a, b in zip(now.faults, row[10:13], strict=True)]
                else:
                    for _ in range(row[13]):
                        now.add_row(row[2], row[3], row[4], row[14])
            yield conv if has_conv else None, *now.result()

    return _batches(results(), _OUT, 200)


def _columns(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text, copies) with its faults and repair.

    ``copies`` is how often a row stands there, 0 for one that only names its conversation.
    """
    spark = rows.sparkSession
    width = shuffle_width(spark)
    placed = _placed(rows)
    marked = materialise(_marked(placed), "conversation-rows")
    sorted_rows = marked.repartitionByRange(width, *_PLACE).sortWithinPartitions(*_PLACE)
    blocks = materialise(sorted_rows.mapInArrow(_cut_blocks, _BLOCKS), "conversation-blocks")
    key = ["has_conv", "conv"]
    tables = blocks.select(*key, "block", "costs").repartition(width, *key).sortWithinPartitions(*key, "block")
    chained = blocks.join(tables.mapInArrow(_chain, _CHAIN), [*key, "block"])
    solved = chained.select(
        *_PLACE, "block", "codes", "entry", "exit", "tail", "n_blank", "n_duplicate", "n_truncated"
    ).mapInArrow(_solve, _PIECES)

    def absent(name: str, kind: str) -> Column:
        return F.lit(None).cast(kind).alias(name)

    bodies = placed.select(
        *_PLACE,
        F.lit(1).alias("kind"),
        F.lit(0).cast("long").alias("block"),
        absent("audit", "string"),
        *[absent(c, "long") for c in ("cost", "n_blank", "n_duplicate", "n_truncated")],
        F.col("copies").cast("int").alias("copies"),
        F.col("text").cast("binary").alias("body"),
    )
    together = solved.select(*_columns(_PIECES)).union(bodies)
    in_order = together.repartition(width, *key).sortWithinPartitions(*_PLACE, "kind", "block")
    return in_order.mapInArrow(_apply, _OUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(table(spark, sf_dir, "conversations")))


#: The contract in SQL: faults by a table-driven crc32, and the cheapest edits by a recursion over the
#: rows that keeps the best (cost, audit) of every state with what it writes.
SQL = r"""
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS entry FROM bits WHERE k = 8
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations
), faulty AS (
  SELECT k.*, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(name) + 1), lambda i: CAST(ascii(substr(name, i, 1)) AS BIGINT))),
    lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fault
  FROM keyed k, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
  FROM faulty WHERE fault <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS mark
  FROM damaged
), faults AS (
  SELECT *, mark = '' AS blank,
         mark <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS duplicate,
         substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM placed
), marked AS (
  SELECT *, NOT blank AND NOT duplicate AND mark NOT IN ('.', '!', '?') AS cut FROM faults
), inserts(state, mid, edits, lines) AS (
  VALUES (0, 0, '', ''), (1, 1, '', ''), (2, 2, '', ''), (3, 3, '', ''), (0, 2, 'I', chr(10) || 'user:'),
         (1, 2, 'I', chr(10) || 'user:'), (3, 2, 'I', chr(10) || 'user:'), (2, 3, 'I', chr(10) || 'assistant:'),
         (0, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
), steps AS (
  SELECT conv_id, pos, state, state AS after, 2 AS cost, 'D' AS edits, '' AS lines FROM marked, range(4) t(state)
  UNION ALL
  SELECT conv_id, pos, state, CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END,
         5 * length(edits) + CASE WHEN cut THEN 5 ELSE 0 END, edits || 'K', lines || chr(10) || role || ':' || text
  FROM marked, inserts WHERE NOT blank AND NOT duplicate
    AND (initial = 's' AND mid = 0 OR initial = 'u' AND mid <> 2 OR initial = 'a' AND mid = 2)
  UNION ALL
  SELECT conv_id, pos, state, CASE WHEN mid = 2 THEN 3 ELSE 2 END, 5 * length(edits) + CASE WHEN cut THEN 6 ELSE 1 END,
         edits || 'R', lines || chr(10) || CASE WHEN mid = 2 THEN 'assistant:' ELSE 'user:' END || text
  FROM marked, inserts WHERE NOT blank AND NOT duplicate
), way(conv_id, pos, state, best) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), CAST(0 AS BIGINT), {'cost': CAST(0 AS BIGINT), 'edits': '', 'lines': ''} FROM marked
  UNION ALL
  SELECT s.conv_id, s.pos, CAST(s.after AS BIGINT),
         min({'cost': CAST(w.best.cost + s.cost AS BIGINT), 'edits': w.best.edits || s.edits, 'lines': w.best.lines || s.lines})
  FROM way w JOIN steps s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.pos = w.pos + 1 AND s.state = w.state
  GROUP BY s.conv_id, s.pos, s.after
), sizes AS (
  SELECT conv_id, max(pos) AS pos, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
         count(*) FILTER (cut) AS truncated, count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM marked GROUP BY conv_id
), ends AS (
  SELECT z.conv_id, min({'cost': CAST(w.best.cost + 5 * length(i.edits) AS BIGINT), 'edits': w.best.edits || i.edits,
         'lines': w.best.lines || i.lines}) AS best
  FROM sizes z JOIN way w ON w.conv_id IS NOT DISTINCT FROM z.conv_id AND w.pos = z.pos
  JOIN inserts i ON i.state = w.state AND (i.mid = 3 OR w.state = 0 AND i.mid = 0)
  GROUP BY z.conv_id
), named AS (SELECT DISTINCT conv_id FROM conversations)
SELECT n.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
       coalesce(best.edits, '') AS audit, sha256(coalesce(substr(best.lines, 2), '')) AS repaired_sha256
FROM named n LEFT JOIN sizes z ON z.conv_id IS NOT DISTINCT FROM n.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM n.conv_id
"""
