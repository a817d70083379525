"""SentencePiece encoding and decoding with seeded merge dropout.

Text is encoded by merging neighbouring pieces: an agenda holds every pair of neighbours that forms
a piece of the vocabulary, best score first, then the leftmost; a merge adds the pairs with the new
neighbours. Each candidate, a piece at a place of the text, is skipped when a keyed hash of the seed,
the stream of the document and the candidate's number in the text falls under the dropout rate: a
word is drawn anew wherever it stands. Equal keys give equal results, on any machine and in any
order; other seeds and streams give other segmentations.
Blanks are part of pieces, characters outside the vocabulary become byte pieces, and so do marks in
the text that stand for a blank in pieces: decoding gives back the text exactly.

Pieces of this vocabulary never cross from a non-blank to a blank, so the agenda runs over one
word with the blanks before it at a time, cut once more where no piece holds two neighbours side by
side. A part takes one merge after another, many parts in step: arrays hold the pairs of the parts of
equal size, and each round merges the best pair of every part. A skipped candidate that no merge
forms changes nothing; so a worker keeps, for each word, the ids without skips and which candidates
were merged, and merges again only the parts that lost one of these.

Defined results: null text is encoded as the empty text, without ids; equal rows are encoded each,
by the stream of their id, a 64-bit hash; a null id has stream 0; other columns are not read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm.arrays import chunks, mix
from loanlens.llm.frames import table, texts

SEED = 17
DROPOUT = 0.1
#: Runs that a worker keeps; beyond that it starts afresh.
CACHE_RUNS = 250_000
#: Bytes of text whose runs are merged side by side, and characters of the largest part that is.
SIDE_BY_SIDE = 1 << 20
LONGEST_PART = 32
BLANK = "▁"
#: A word with the blanks before it, or the blanks at the end.
_RUNS = re.compile(" *[^ ]+| +")
_LIMIT = 1 << 64
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: No symbol, and the place in an order that no pair has.
_NONE = 0xFFFFFFFF
_LAST = (1 << 31) - 1


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)


def _gather(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of an array that start at ``first``, one behind the other."""
    to = np.cumsum(size)
    return flat[np.arange(to[-1] if len(to) else 0) + np.repeat(first - to + size, size)]


class Table:
    """Numbers of pairs of numbers, -1 for others: open addressing, many lookups at a time."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        left, right = np.array(list(pairs), dtype=np.uint64).reshape(-1, 2).T
        keys, values = _joined(left, right), np.array(list(pairs.values()), dtype=np.int32)
        self.mask = np.uint64((1 << max(4, (4 * len(keys)).bit_length())) - 1)
        self.keys = np.full(int(self.mask) + 1, _LIMIT - 1, dtype=np.uint64)
        self.values = np.full(len(self.keys), -1, dtype=np.int32)
        at, left_over = self._place(keys), np.arange(len(keys))
        while len(left_over):
            free = self.keys[at] == _LIMIT - 1
            self.keys[at[free]] = keys[left_over[free]]
            done = self.keys[at] == keys[left_over]
            self.values[at[done]] = values[left_over[done]]
            at, left_over = (at[~done] + np.uint64(1)) & self.mask, left_over[~done]

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys * _STEP >> np.uint64(32)) & self.mask

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = _joined(left, right)
        at = self._place(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], np.int32(-1))
        other = np.flatnonzero((held != keys) & (held != _LIMIT - 1))
        while len(other):
            at[other] = (at[other] + np.uint64(1)) & self.mask
            held = self.keys[at[other]]
            hit = held == keys[other]
            out[other[hit]] = self.values[at[other[hit]]]
            other = other[~hit & (held != _LIMIT - 1)]
        return out


class Runs(dict):
    """Runs numbered as they come."""

    def __missing__(self, run: str) -> int:
        self[run] = n = len(self)
        return n


class Vocabulary:
    """Pieces, scores and byte pieces of a SentencePiece model of the merge type."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        self.pieces = {model.id_to_piece(i): i for i in ids if i not in special}
        self.scores = {p: model.get_score(i) for p, i in self.pieces.items()}
        self.bytes_of = [b""] * len(ids)
        for b, i in self.bytes.items():
            self.bytes_of[i] = bytes([b])
        for p, i in self.pieces.items():
            self.bytes_of[i] = p.replace(BLANK, " ").encode()
        self.mark = np.array([self.bytes[b] for b in BLANK.encode()], dtype="<u4").tobytes()
        #: Neighbouring characters within pieces: no merge joins any others.
        self.pairs = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        self.longest = max(map(len, self.pieces), default=0)
        self._tables(len(ids))
        self._forget()

    def _tables(self, n: int) -> None:
        """The vocabulary in arrays. Symbols are pieces by their ids and, behind them, other characters."""
        self.names = [""] * n
        for p, i in self.pieces.items():
            self.names[i] = p
        self.symbol_of = np.full(0x110000, -1, dtype=np.int32)
        self.ids_first, self.ids_size = np.arange(n), np.ones(n, dtype=np.int64)
        self.ids_flat = np.arange(n, dtype="<u4")
        single = {p: i for p, i in self.pieces.items() if len(p) == 1}
        for p, i in single.items():
            self.symbol_of[ord(p)] = i
        others = sorted({c for p in self.pieces for c in p} - set(single))
        self._characters(others)
        # a blank is a mark in pieces; a mark in the text is never part of one
        self.symbol_of[ord(" ")] = self.symbol_of[ord(BLANK)]
        self.symbol_of[ord(BLANK)] = -1
        self._characters([BLANK])
        symbols = single | {c: n + i for i, c in enumerate(others)}
        self.sizes = np.array([max(len(x), 1) for x in self.names[:n]] + [1], dtype=np.uint64)
        order = np.unique(-np.array([self.scores.get(x, 0.0) for x in self.names[:n]]), return_inverse=True)[1]
        self.order = np.append(order * 64, _LAST).astype(np.int32)
        formed, trie, ends = {}, {}, [-1]
        for p, i in self.pieces.items():
            state = 0
            for k, c in enumerate(p):
                left, right = p[:k], p[k:]
                if k and (left in self.pieces or left in symbols) and (right in self.pieces or right in symbols):
                    formed[self.pieces.get(left, symbols.get(left)), self.pieces.get(right, symbols.get(right))] = i
                key = state, symbols[c]
                state = trie.setdefault(key, len(ends))
                if state == len(ends):
                    ends.append(-1)
            ends[state] = i
        self.formed, self.trie, self.ends = Table(formed), Table(trie), np.array(ends, dtype=np.int32)
        self.side_by_side = Table({(symbols[a], symbols[b]): 1 for a, b in self.pairs})

    def _characters(self, new: Iterable[str]) -> None:
        """Symbols for characters that are no pieces: their ids are those of their bytes."""
        ids = [[self.bytes[b] for b in c.encode()] for c in new]
        self.symbol_of[[ord(c) for c in new]] = len(self.names) + np.arange(len(ids))
        self.names += new
        size = np.array([len(x) for x in ids], dtype=np.int64)
        self.ids_first = np.append(self.ids_first, len(self.ids_flat) + np.cumsum(size) - size)
        self.ids_size = np.append(self.ids_size, size)
        self.ids_flat = np.append(self.ids_flat, np.array([x for y in ids for x in y], dtype="<u4"))

    def _forget(self) -> None:
        """No runs. Of runs their first parts; of parts their first symbols, candidates and ids; of
        candidates their place in the part, size, and whether it is merged where none is skipped."""
        none = np.zeros(0, dtype=np.int64)
        self.known, self.n_known = Runs(), 0
        self.run_part = self.part_symbol = self.part_candidate = self.part_id = np.zeros(1, dtype=np.int64)
        self.symbols, self.ids = none.astype(np.int32), none.astype("<u4")
        self.place, self.size, self.merged = none, none.astype(np.uint8), none.astype(bool)

    def candidates(self, run: str) -> list[tuple[int, str]]:
        """All places and pieces of a run that a merge may form."""
        scores, n = self.scores, len(run)
        found = []
        for left in range(n - 1):
            for end in range(left + 2, min(left + self.longest, n) + 1):
                if run[left:end] in scores:
                    found.append((left, run[left:end]))
        return found

    def merge_run(self, run: str, skip: frozenset[tuple[int, str]] = frozenset()) -> list[str]:
        """A run of characters merged without the candidates to skip."""
        symbols = list(run)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        after[-1:] = [-1]
        agenda: list[tuple[float, int, str]] = []
        scores = self.scores

        def propose(left: int, right: int) -> None:
            piece = symbols[left] + symbols[right]
            score = scores.get(piece)
            if score is None:
                return
            if (left, piece) in skip:
                return
            heapq.heappush(agenda, (-score, left, piece))

        for i in range(n - 1):
            propose(i, i + 1)
        while agenda:
            _, left, piece = heapq.heappop(agenda)
            right = after[left]
            # the pair may have been merged otherwise meanwhile
            if not symbols[left] or right < 0 or symbols[left] + symbols[right] != piece:
                continue
            symbols[left], symbols[right] = piece, ""
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
                propose(left, after[left])
            if before[left] >= 0:
                propose(before[left], left)
        return [x for x in symbols if x]

    def encode_run(self, run: str, skip: frozenset[tuple[int, str]] = frozenset()) -> list[int]:
        """Ids of a run of characters in which blanks are written as BLANK."""
        out: list[int] = []
        for s in self.merge_run(run, skip):
            if s in self.pieces:
                out.append(self.pieces[s])
            else:
                out += [self.bytes[b] for b in s.encode()]
        return out

    def encode(self, text: str, stream: int, seed: int = SEED, dropout: float = DROPOUT) -> bytes:
        """Ids as bytes of little-endian unsigned 32-bit numbers; a blank is put in front."""
        return self.encode_all([text], [stream], seed, dropout)[0].tobytes()

    def encode_all(
        self, texts: list[str], streams: list[int], seed: int = SEED, dropout: float = DROPOUT
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's begin and end."""
        if len(self.known) > CACHE_RUNS:
            self._forget()
        found = [_RUNS.findall(" " + t) if t else [] for t in texts]
        run = np.fromiter(map(self.known.__getitem__, chain.from_iterable(found)), np.int64)
        self._learn()
        bounds = np.concatenate([[0], np.cumsum(list(map(len, found)), dtype=np.int64)])
        first, n_parts = self.run_part[run], self.run_part[run + 1] - self.run_part[run]
        part = _gather(np.arange(self.run_part[-1]), first, n_parts)
        part_bounds = np.concatenate([[0], np.cumsum(n_parts)])[bounds]
        n = self.part_candidate[part + 1] - self.part_candidate[part]
        ends = np.cumsum(n)
        draws = np.diff(np.concatenate([[0], ends])[part_bounds]).tolist()
        drop = [dropped(k, stream, seed, dropout) for k, stream in zip(draws, streams, strict=True)]
        hit = np.flatnonzero(np.concatenate([np.zeros(0, dtype=bool), *drop]))
        at = np.searchsorted(ends, hit, side="right")
        candidate = self.part_candidate[part[at]] + hit - (ends - n)[at]
        again = np.zeros(len(part), dtype=bool)
        again[at[self.merged[candidate]]] = True
        start, size = self.part_id[part], self.part_id[part + 1] - self.part_id[part]
        new, new_size = self._merge_again(part[again], (np.cumsum(again) - 1)[at[again[at]]], candidate[again[at]])
        start[again], size[again] = len(self.ids) + np.cumsum(new_size) - new_size, new_size
        ids = _gather(np.concatenate([self.ids, new]), start, size)
        return ids, np.concatenate([[0], np.cumsum(size)])[part_bounds]

    def _merge_again(self, part: np.ndarray, row: np.ndarray, candidate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts, and their number for each, where the candidates of rows of them are skipped."""
        size = self.part_symbol[part + 1] - self.part_symbol[part]
        first = np.cumsum(size) - size
        skip = np.zeros(int(size.sum()), dtype=np.uint64)
        few = size[row] <= LONGEST_PART
        where, bit = first[row] + self.place[candidate], np.uint64(1) << self.size[candidate].astype(np.uint64)
        np.bitwise_or.at(skip, where[few], bit[few])
        long: dict[int, set[tuple[int, int]]] = {}
        for r, c in zip(row[~few].tolist(), candidate[~few].tolist(), strict=True):
            long.setdefault(r, set()).add((int(self.place[c]), int(self.size[c])))
        merged, count, _ = self._merge(_gather(self.symbols, self.part_symbol[part], size), first, size, skip, long)
        return self._ids(merged, count)

    def _ids(self, symbols: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols, and how many each part of ``count`` symbols has."""
        size = self.ids_size[symbols]
        total = np.concatenate([[0], np.cumsum(size)])
        to = np.cumsum(count)
        return _gather(self.ids_flat, self.ids_first[symbols], size), total[to] - total[to - count]

    def _learn(self) -> None:
        """Takes up the runs that are new."""
        new = list(islice(self.known, self.n_known, None))
        if not new:
            return
        self.n_known = len(self.known)
        code = np.frombuffer("".join(new).encode("utf-32-le"), "<u4")
        unknown = np.unique(code[self.symbol_of[code] < 0])
        if len(unknown):
            self._characters([chr(c) for c in unknown.tolist()])
        symbols, n = self.symbol_of[code], len(code)
        run_ends = np.cumsum(list(map(len, new)))
        cut = np.ones(n, dtype=bool)
        cut[1:] = self.side_by_side.get(symbols[:-1], symbols[1:]) < 0
        cut[run_ends[:-1]] = True
        first = np.flatnonzero(cut)
        size = np.diff(np.append(first, n))
        part = np.repeat(np.arange(len(first)), size)
        at, length = self._candidates(symbols, (first + size)[part])
        merged, count, formed = self._merge(symbols, first, size)
        ids, n_ids = self._ids(merged, count)
        # which candidates of a long part were merged is not kept: it is merged again after any skip
        used = (formed[at] >> length.astype(np.uint64)) & np.uint64(1) > 0
        used |= size[part[at]] > LONGEST_PART

        def bounds(old: np.ndarray, ends: np.ndarray) -> np.ndarray:
            return np.concatenate([old, old[-1] + ends])

        self.run_part = bounds(self.run_part, np.searchsorted(first, run_ends))
        self.part_symbol = bounds(self.part_symbol, first + size)
        self.part_candidate = bounds(self.part_candidate, np.searchsorted(at, first + size))
        self.part_id = bounds(self.part_id, np.cumsum(n_ids))
        self.symbols, self.ids = np.append(self.symbols, symbols), np.append(self.ids, ids)
        self.place, self.size = np.append(self.place, at - first[part[at]]), np.append(self.size, length.astype(np.uint8))
        self.merged = np.append(self.merged, used)

    def _candidates(self, symbols: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and size of every candidate, in order; ``end`` is where the part of each symbol ends."""
        at = np.arange(len(symbols))
        state = np.zeros(len(symbols), dtype=np.int32)
        places, sizes = [at[:0]], [np.zeros(0, dtype=np.int64)]
        for size in range(1, self.longest + 1):
            inside = at + size <= end[at]
            at = at[inside]
            state = self.trie.get(state[inside], symbols[at + size - 1])
            at, state = at[state >= 0], state[state >= 0]
            if size > 1:
                places.append(at[self.ends[state] >= 0])
                sizes.append(np.full(len(places[-1]), size))
        place, size = np.concatenate(places), np.concatenate(sizes)
        order = np.argsort(place, kind="stable")
        return place[order], size[order]

    def _merge(
        self,
        symbols: np.ndarray,
        first: np.ndarray,
        size: np.ndarray,
        skip: np.ndarray | None = None,
        long: dict[int, set[tuple[int, int]]] | None = None,
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Parts merged: their symbols, the number of each part's, and for every place of a part a
        bit for each size that was merged there. ``skip`` has such bits for what is skipped."""
        formed = np.zeros(len(symbols), dtype=np.uint64)
        start, count = np.zeros(len(first), dtype=np.int64), np.zeros(len(first), dtype=np.int64)
        found, n = [np.zeros(0, dtype=np.int32)], 0
        order = np.argsort(size, kind="stable")
        cuts = np.searchsorted(size[order], np.arange(1, LONGEST_PART + 2))
        for k in range(1, LONGEST_PART + 1):
            rows = order[cuts[k - 1] : cuts[k]]
            if not len(rows):
                continue
            places = first[rows] + np.arange(k)[:, None]
            if k == 1:
                out, counts = symbols[places[0]], np.ones(len(rows), dtype=np.int64)
            else:
                out, counts, bits = self._in_step(symbols[places], None if skip is None else skip[places])
                formed[places] = bits
            start[rows], count[rows] = n + np.cumsum(counts) - counts, counts
            found.append(out)
            n += len(out)
        for row in order[cuts[-1] :].tolist():
            own = symbols[first[row] : first[row] + size[row]].tolist()
            text = "".join([self.names[s] for s in own])
            without = frozenset((at, text[at : at + m]) for at, m in (long or {}).get(row, ()))
            pieces = self.merge_run(text, without)
            out = np.array([self.pieces[x] if x in self.pieces else self.symbol_of[ord(x)] for x in pieces], dtype=np.int32)
            start[row], count[row] = n, len(out)
            found.append(out)
            n += len(out)
        return _gather(np.concatenate(found), start, count), count, formed

    def _in_step(self, symbols: np.ndarray, skip: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The columns of an array merged, the best pair of every column in each round."""
        k, n = symbols.shape
        held = np.full((k + 2, n), _NONE, dtype=np.uint32)
        held[1:-1] = symbols
        held = held.ravel()
        before, after = np.arange(len(held)) - n, np.arange(len(held)) + n
        live = np.zeros(len(held), dtype=bool)
        live[n:-n] = True
        bits, without = np.zeros(len(held), dtype=np.uint64), None
        if skip is not None:
            without = np.zeros((k + 2, n), dtype=np.uint64)
            without[1:-1] = skip
            without = without.ravel()
        line = np.repeat(np.arange(k + 2, dtype=np.int32), n)
        piece = np.full(len(held), -1, dtype=np.int32)
        best = np.full(len(held), _LAST, dtype=np.int32)

        def propose(left: np.ndarray, right: np.ndarray) -> None:
            p = self.formed.get(held[left], held[right])
            rank = self.order[p] | line[left]
            rank[p < 0] = _LAST
            if without is not None:
                rank[(without[left] >> self.sizes[p]) & np.uint64(1) > 0] = _LAST
            piece[left], best[left] = p, rank

        # the first line stands for no symbol, and neither does the last
        propose(np.arange(n, len(held) - 2 * n), np.arange(2 * n, len(held) - n))
        table, columns = best.reshape(k + 2, n), np.arange(n)
        while len(columns):
            least = (table if len(columns) == n else table[:, columns]).min(axis=0)
            going = least < _LAST
            columns = columns[going]
            left = (least[going] & 63).astype(np.int64) * n + columns
            right = after[left]
            then, made = after[right], piece[left]
            held[left] = made
            after[left], before[then] = then, left
            live[right], best[right] = False, _LAST
            bits[left] |= np.uint64(1) << self.sizes[made]
            previous = before[left]
            propose(np.concatenate([left, previous]), np.concatenate([then, left]))
        live, held = live.reshape(k + 2, n), held.reshape(k + 2, n)
        return held.T[live.T].astype(np.int32), live.sum(axis=0), bits.reshape(k + 2, n)[1:-1]

    def _run(self, run: str) -> list[tuple[str, int, bytes]]:
        """One run alone: its parts, the number of their candidates, and their ids where none is skipped."""
        out: list[tuple[str, int, bytes]] = []
        for i, x in enumerate(run.split(BLANK)):
            if i:
                # a mark in the text that stands for a blank in pieces becomes bytes
                out.append(("", 0, self.mark))
            for part in self._parts(x.replace(" ", BLANK)):
                ids = np.array(self.encode_run(part), dtype="<u4").tobytes()
                out.append((part, len(self.candidates(part)), ids))
        return out

    def _skipping(self, part: str, drop: bytes) -> bytes:
        """One part alone: its ids without the candidates to skip."""
        skip = frozenset(c for c, d in zip(self.candidates(part), drop, strict=True) if d)
        return np.array(self.encode_run(part, skip), dtype="<u4").tobytes()

    def _parts(self, run: str) -> list[str]:
        """The run cut where no merge can join: neighbours that no piece holds side by side."""
        pairs, out, start = self.pairs, [], 0
        for i in range(1, len(run)):
            if run[i - 1 : i + 1] not in pairs:
                out.append(run[start:i])
                start = i
        return [*out, run[start:]] if run else []

    def decode(self, ids: Iterable[int]) -> str:
        """The text, without the blank put in front."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")[1:]


def dropped(n: int, stream: int, seed: int, dropout: float) -> np.ndarray:
    """Which of the n candidates of a text are skipped."""
    limit = int(dropout * _LIMIT)
    if limit <= 0 or limit >= _LIMIT:
        return np.full(n, limit > 0)
    key = np.uint64(xxhash.xxh3_64_intdigest(f"{seed} {stream}"))
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _STEP + key) < np.uint64(limit)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, seed: int = SEED, dropout: float = DROPOUT, path: str | None = None) -> DataFrame:
    """``ids`` of each of (doc_id, text), and the text decoded from them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path or default_vocabulary())
        for batch in chunks(batches, max_bytes=SIDE_BY_SIDE):
            flat, cuts = v.encode_all(batch.column("text").to_pylist(), batch.column("stream").to_pylist(), seed, dropout)
            flat = flat.astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat))
            decoded = [v.decode(flat[a:b].tolist()) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

    stream = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.xxhash64("doc_id", F.lit(seed)))
    sent = texts(docs).withColumn("stream", stream)
    return sent.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
