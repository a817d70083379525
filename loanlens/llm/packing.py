"""Sum-of-squares online packing of documents into windows of a fixed number of tokens.

Every task packs the documents it reads, in order, with a level array: how many open windows are
filled to each level. A document goes to the level, or a new window, that makes the sum of the
squared counts smallest. Documents longer than a window fill whole windows first. When more than
MAX_OPEN windows are open, and at the end, the open ones are filled up by cutting documents; the
last remainder is cut at powers of two, which need no padding. A task holds at most MAX_OPEN + 1
windows.

Defined results: null text is empty and has the end id alone; a null id is a document like any
other; equal rows are packed each; an empty table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm.arrays import byte_view, chunks
from loanlens.llm.frames import table, texts

WINDOW = 2048
END_ID = 1
MAX_OPEN = 1024
#: Words whose ids a worker keeps from one chunk to the next.
CACHE_WORDS = 300_000
_SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)
#: Words of Latin letters with ASCII marks behind: letters and marks are split before merging.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@[-`{-~]*)")


def _strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


def _binary(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Ids up to each end as an entry of bytes."""
    offsets = 4 * np.append(0, ends).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))]
    return pa.Array.from_buffers(pa.large_binary(), len(ends), buffers)


class Known:
    """Words and their ids, two columns of equal length; when there are more than CACHE_WORDS, only
    the words of the last chunk stay."""

    def __init__(self) -> None:
        self.words, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())

    def ids_of(self, words: pa.Array, encode: Callable[[pa.Array], pa.Array]) -> pa.Array:
        """Ids of different words, of which those that are not known are encoded."""
        at = pc.index_in(words, value_set=self.words)
        missing = at.is_null().to_numpy(zero_copy_only=False)
        new = words.filter(pa.array(missing))
        at = at.fill_null(0).to_numpy().astype(np.int64)
        at[missing] = len(self.words) + np.arange(len(new))
        ids = pa.concat_arrays([self.ids, encode(new)]) if len(new) else self.ids
        found = ids.take(pa.array(at))
        if len(ids) > CACHE_WORDS:
            self.words, self.ids = words, found
        elif len(new):
            self.words, self.ids = pa.concat_arrays([self.words, new]), ids
        return found


class WordIds:
    """Ids of texts as bytes of little-endian unsigned 32-bit numbers, one word at a time.

    The tokenizer never merges across a blank or a line feed, so the ids of a text are those of its
    parts between them. Of a chunk every different part is looked up once.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # lower-case words of letters, a blank between them, are as the tokenizer's own steps leave them
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.known, self.cores = Known(), Known()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True

    def _encode(self, parts: pa.Array) -> pa.Array:
        found = [np.zeros(0, "<u4")]
        for part in _strings(parts):
            found.append(np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4"))
        return _binary(np.concatenate(found), np.cumsum([len(x) for x in found])[1:])

    def _encode_cores(self, cores: pa.Array) -> pa.Array:
        """Ids of words of letters alone, many to a text: each ends with the first piece that ends
        a word. The empty word has none."""
        found, words = [np.zeros(0, "<u4")], _strings(cores)
        for i in range(0, len(words), 500):
            (x,) = self.letters.encode_batch_fast([" ".join(words[i : i + 500])], add_special_tokens=False)
            found.append(np.array(x.ids, "<u4"))
        ids = np.concatenate(found)
        count = np.append(0, np.flatnonzero(self.ends_word[ids]) + 1)
        some = pc.binary_length(cores).to_numpy(zero_copy_only=False) > 0
        if some.sum() != len(count) - 1:
            raise ValueError("words do not end where the tokenizer ends them")
        return _binary(ids, count[np.cumsum(some)])

    def _learn(self, words: pa.Array) -> pa.Array:
        plain = pc.ascii_is_alpha(words)
        lower = pc.ascii_lower(words.filter(plain))
        cores, marks = [], []
        for w in _strings(words.filter(pc.invert(plain))):
            m = _PLAIN.fullmatch(w)
            cores.append(m[1].lower() if m else "")
            marks.append(m[2] if m else w)
        letters = pa.concat_arrays([lower, pa.array(cores, pa.string())]).dictionary_encode()
        ids = self.cores.ids_of(letters.dictionary, self._encode_cores).take(letters.indices)
        behind = pa.array(marks, pa.string()).dictionary_encode()
        behind = self._encode(behind.dictionary).take(behind.indices)
        whole = pc.binary_join_element_wise(ids.slice(len(lower)), behind, pa.scalar(b"", pa.large_binary()))
        # the plain words come first here
        rank = np.argsort(np.argsort(~plain.to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
        return pa.concat_arrays([ids.slice(0, len(lower)), whole]).take(pa.array(rank))

    def encode(self, found: pa.Array | list[str]) -> Iterator[bytes]:
        column = found if isinstance(found, pa.Array) else pa.array(found, pa.string())
        data, offsets = byte_view(column)
        # words with the blank or line feed that ends them, and the word number each row ends at
        cuts = np.flatnonzero((data == 32) | (data == 10)) + 1
        ends = np.sort(np.concatenate([offsets, cuts]), kind="stable").astype(np.int32)
        rows = np.searchsorted(cuts, offsets, side="right") + np.arange(len(offsets))
        words = pa.Array.from_buffers(pa.string(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])
        words = words.dictionary_encode()
        bare = pc.ascii_rtrim(words.dictionary, characters=" \n").dictionary_encode()
        ids = self.known.ids_of(bare.dictionary, self._learn).take(bare.indices).take(words.indices)
        packed, at = byte_view(ids)
        raw, at = memoryview(packed), at[rows].tolist()
        for a, b in zip(at[:-1], at[1:], strict=True):
            yield bytes(raw[a:b])


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


class Packer:
    """Level array and open windows of one task; closed windows come out as rows of pieces.

    A piece is (doc_id, start, ids, doc_tokens), ids as bytes.
    """

    def __init__(self, size: int = WINDOW, first_sequence: int = 0, max_open: int = MAX_OPEN):
        self.size, self.max_open, self.sequence = size, max_open, first_sequence
        self.level = np.zeros(size + 1, dtype=np.int64)  # the last entry stays 0: full windows
        self.open: dict[int, list[list[tuple]]] = {}
        self.n_open = 0

    def best_level(self, tokens: int) -> int:
        """The level, 0 for a new window, whose use adds least to the sum of squares; on ties the
        fullest."""
        top = self.size - tokens
        n = self.level
        change = 2 * (n[tokens : self.size + 1] - n[: top + 1]) + 2
        change[0] += -1 + 2 * n[0]
        change[top] -= 1  # a window filled up leaves the array
        usable = n[: top + 1] > 0
        usable[0] = True
        change[~usable] = np.iinfo(np.int64).max
        return top - int(change[::-1].argmin())

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        total = len(ids) // 4
        whole = total // self.size * self.size
        for start in range(0, whole, self.size):
            yield from self._close([(doc_id, start, ids[4 * start : 4 * (start + self.size)], total)])
        if total == whole:
            return
        tokens = total - whole
        at = self.best_level(tokens)
        window = self.open[at].pop() if at else []
        if at:
            self.level[at] -= 1
            self.n_open -= 1
        window.append((doc_id, whole, ids[4 * whole :], total))
        if at + tokens == self.size:
            yield from self._close(window)
            return
        self.level[at + tokens] += 1
        self.n_open += 1
        self.open.setdefault(at + tokens, []).append(window)
        if self.n_open > self.max_open:
            yield from self.fill_up(last=False)

    def fill_up(self, last: bool = True) -> Iterator[tuple]:
        """Cuts what is open into full windows; the remainder stays open, or is cut at powers of two."""
        pieces = [p for at in sorted(self.open, reverse=True) for w in self.open[at] for p in w]
        self.open.clear()
        self.level[:] = 0
        self.n_open = 0
        left = sum(len(p[2]) // 4 for p in pieces)
        window, room = [], self._next_size(left)
        for doc_id, start, ids, total in pieces:
            while ids:
                head, ids = ids[: 4 * room], ids[4 * room :]
                window.append((doc_id, start, head, total))
                n = len(head) // 4
                start, room, left = start + n, room - n, left - n
                if room == 0:
                    yield from self._close(window)
                    window, room = [], self._next_size(left)
                if not last and left < self.size and not window:
                    room = self.size
        if window:
            used = sum(len(p[2]) // 4 for p in window)
            self.open[used] = [window]
            self.level[used] = 1
            self.n_open = 1

    def _next_size(self, left: int) -> int:
        return self.size if left >= self.size else 1 << max(left, 1).bit_length() - 1

    def _close(self, window: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, ids, total in window:
            n = len(ids) // 4
            yield doc_id, start, n, ids, total, self.sequence, offset
            offset += n
        self.sequence += 1


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack(docs: DataFrame, tokenizer: str | None = None, size: int = WINDOW) -> DataFrame:
    """Pieces of each of (doc_id, text) with their ids, window number and place in the window."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer or default_tokenizer())
        end = np.array([END_ID], dtype="<u4").tobytes()
        packer = Packer(size, TaskContext.get().partitionId() << 40)
        names = [x.split()[0] for x in _SCHEMA.split(", ")]
        kinds = [pa.binary() if x == "ids" else pa.int64() for x in names]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

        for batch in chunks(batches):
            rows: list[tuple] = []
            encoded = words.encode(batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                rows += packer.add(doc_id, ids + end)
            yield out(rows)
        yield out(list(packer.fill_up()))

    return texts(docs).mapInArrow(run, _SCHEMA)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the pieces of every document, their ids as a checksum."""
    return _digest(pack(docs))


def _digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(pack(table(spark, sf_dir, "documents")))
