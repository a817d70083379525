"""Alignment of two tokenizers against two plain pointers, and the merge path by itself."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from loanlens.llm import token_alignment as align


@pytest.fixture(scope="module")
def tokenizers():
    return align.ByteTokens(align.default_byte_tokenizer()), align.PieceTokens(align.default_piece_model())


def test_merge_path_cuts_equal_work():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = (np.sort(rng.choice(60, rng.integers(1, 40), replace=False)) for _ in range(2))
        piece = int(rng.integers(1, 12))
        at_a, at_b = align.merge_path(a, b, piece)
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        for i, j in zip(at_a, at_b, strict=True):
            assert [s for _, s in merged[: i + j]].count(0) == i
        work = np.diff(at_a + at_b)
        assert (work[:-1] == piece).all() and 0 <= work[-1] <= piece


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1 << 15])
def test_pieces_give_all_overlaps(piece):
    rng = np.random.default_rng(5)
    for _ in range(80):
        size = int(rng.integers(1, 50))
        a, b = (np.append(np.sort(rng.choice(size, rng.integers(0, size), replace=False)) + 0, size) for _ in range(2))
        a, b = np.unique(a[a > 0]), np.unique(b[b > 0])
        spans = [list(zip(np.append(0, x[:-1]), x, strict=True)) for x in (a, b)]
        want = [
            (i, j, min(p[1], q[1]) in set(a) & set(b))
            for i, p in enumerate(spans[0]) for j, q in enumerate(spans[1]) if max(p[0], q[0]) < min(p[1], q[1])
        ]
        got = align.overlaps(a, b, piece)
        assert list(zip(got.a.tolist(), got.b.tolist(), got.closes.tolist(), strict=True)) == want


def test_fast_ids_equal_the_file(tokenizers):
    first = tokenizers[0]
    odd = ["<|endoftext|> <s> </s> <0x41> ▁ ▁x \x00 ﻿ é \U0001f600 don't I'LL", " " * 30_000 + "x", "a" * 20_000, "\n\n \t x\r\n", "１２３ ½ ٣", "한국어 日本語 ไทย"]
    for text in odd:
        assert first.encode(text) == first.plain.encode(text, add_special_tokens=False).ids
        assert b"".join(first.bytes[i] for i in first.encode(text)) == text.encode()


def plain_links(first, second, text):
    a, b = first.encode(" " + text), second.encode(text)
    raw = (" " + text).encode()
    parts = [[t.bytes[i] for i in ids] for t, ids in ((first, a), (second, b))]
    if not text or any(b"".join(p) != raw for p in parts):
        return None
    links, groups, own = [], [], ([], [])
    i = j = at_a = at_b = 0
    while i < len(a):
        links.append((a[i], b[j]))
        end_a, end_b = at_a + len(parts[0][i]), at_b + len(parts[1][j])
        if end_a <= end_b:
            own[0].append(a[i])
            i, at_a = i + 1, end_a
        if end_b <= end_a:
            own[1].append(b[j])
            j, at_b = j + 1, end_b
        if end_a == end_b:
            groups.append("|".join(",".join(map(str, x)) for x in own))
            own = ([], [])
    return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


@pytest.mark.parametrize("chunk, piece", [(align.CHUNK, align.PIECE), (300, 5)])
def test_query_equals_two_pointers(spark, sf_dir, rows, tokenizers, monkeypatch, chunk, piece):
    monkeypatch.setattr(align, "CHUNK", chunk)
    monkeypatch.setattr(align.overlaps, "__defaults__", (piece,))
    found = {r[0]: plain_links(*tokenizers, r[1] or "") for r in rows}
    pairs = Counter(p for x in found.values() if x for p in set(x[3]))
    highest = defaultdict(int)
    for (a, _), n in pairs.items():
        highest[a] = max(highest[a], n)
    want = [
        (i, *x[:3], len(x[3]), sum(pairs[p] == highest[p[0]] for p in x[3]), sum(pairs[p] for p in x[3]), x[4])
        if x
        else (i, 0, 0, 0, 0, 0, 0, "")
        for i, x in found.items()
    ]
    got = align.query(spark, sf_dir).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sum(x is None for x in found.values()) >= 2
