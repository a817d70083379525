"""The registered queries against brute force on odd documents and on empty tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from loanlens.llm.registry import ORACLES, QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_id(spark, name, sf_dir):
    return {r["doc_id"]: r for r in QUERIES[name](spark, sf_dir).collect()}


def texts_of(rows):
    return {r[0]: r[1] or "" for r in rows}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).count() == 0


#: Queries whose rows are not one per document.
OTHER_ROWS = {"op9_packing", "op11_line_blocks", "op12_conversation_repair"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - OTHER_ROWS))
def test_every_document_gets_one_row(spark, sf_dir, rows, name):
    found = QUERIES[name](spark, sf_dir).select("doc_id").collect()
    assert sorted(r["doc_id"] for r in found) == sorted(r[0] for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_gives_the_same_rows(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    order = sorted(got.columns)
    got = got.sort_values(order).reset_index(drop=True)
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet/*.parquet'")
    want = con.execute(ORACLES[name]).df().sort_values(order).reset_index(drop=True)
    assert sorted(got.columns) == sorted(want.columns)
    for c in got.columns:
        if got[c].dtype.kind == "f" or want[c].dtype.kind == "f":
            # whole numbers with nulls among them
            got[c], want[c] = got[c].astype(float), want[c].astype(float)
        assert got[c].astype(str).replace("None", "nan").tolist() == want[c].astype(str).replace("None", "nan").tolist(), c


def test_quality_counts(spark, sf_dir, rows):
    got = by_id(spark, "op2_quality_rules", sf_dir)
    for i, t in texts_of(rows).items():
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
        r = got[i]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert not (r.base_failed and r.kept)


def test_ngram_base_scores(spark, sf_dir, rows):
    got = by_id(spark, "op3_ngram_model", sf_dir)
    tokens = {i: WORD.findall(t.translate(LOWER)) + ["\n"] for i, t in texts_of(rows).items()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    c = Counter(w for i, own in tokens.items() if not held[i] for w in own)
    n, v = sum(c.values()), len(c)
    for i, own in tokens.items():
        r = got[i]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(own), sum(c[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score <= 0


def test_toxicity_scores(spark, sf_dir, rows):
    got = by_id(spark, "op4_toxicity", sf_dir)
    for i in texts_of(rows):
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= got[i].score <= 1 and got[i].predicted == int(got[i].score >= 0.5)


def test_language_without_letters_is_undetermined(spark, sf_dir, rows):
    got = by_id(spark, "op5_language_id", sf_dir)
    for i, t in texts_of(rows).items():
        assert (got[i].lang_pred == "und") == (not any(c.isalpha() for c in t))
        assert got[i].lang_pred in ("und", "en", "fr", "de") and 0 <= got[i].score <= 1


def test_repeated_bytes(spark, sf_dir, rows):
    got = by_id(spark, "op6_suffix_dedup", sf_dir)
    bodies = {r[0]: (r[1] or "").encode() for r in rows}
    seen = Counter(b[s : s + 400] for b in bodies.values() for s in range(len(b) - 399))
    for i, b in bodies.items():
        gone = bytearray(len(b))
        for s in range(len(b) - 399):
            if seen[b[s : s + 400]] > 1:
                gone[s : s + 400] = b"\1" * 400
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(b), sum(gone), spans)
        assert r.kept_sha256 == hashlib.sha256(left).hexdigest()


def test_base_spans_of_personal_data(spark, sf_dir, rows):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    def good(kind, s):
        d = re.sub("[^0-9]", "", s)
        return {
            "email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in s.split(".")),
            "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15,
        }[kind]

    got = by_id(spark, "op7_personal_data", sf_dir)
    for i, t in texts_of(rows).items():
        want = [
            (m.start(), k, kind, m.end())
            for k, (kind, p) in enumerate(patterns.items()) for m in re.finditer(p, t) if good(kind, m[0])
        ]
        base = [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(want)]
        assert got[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in patterns] == [sum(x[2] == k for x in want) for k in patterns]
        assert set(base) <= set(got[i].spans.split(",")) | {""}


def test_near_duplicate_components(spark, sf_dir, rows):
    got = by_id(spark, "op8_jaccard_join", sf_dir)
    sets = {}
    for i, t in texts_of(rows).items():
        w = WORD.findall(t.translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(s), find(i)) for i, s in sets.items()}
    assert len({find(i) for i in sets}) < len(sets) - 3


def test_pieces_hold_every_id_once(spark, sf_dir, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = QUERIES["op9_packing"](spark, sf_dir).collect()
    own, windows = defaultdict(list), defaultdict(list)
    for p in pieces:
        own[p.doc_id].append(p)
        windows[p.sequence_id].append(p)
    for i, t in texts_of(rows).items():
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for p in sorted(own[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    padding = total = 0
    for window in windows.values():
        at = 0
        for p in sorted(window, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= 0.02 * total


def test_edited_texts_and_fingerprints(spark, sf_dir, rows):
    got = by_id(spark, "op10_imatch", sf_dir)
    texts = texts_of(rows)
    ids = sorted(texts)
    prints = {}
    for i, following in zip(ids, [*ids[1:], ids[0]], strict=True):
        t, m = texts[i], len(texts[i]) // 4
        edited = t[: len(t) - m] + texts[following][:m]
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(t, got[i].fingerprint) == got[i].fingerprint
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        if texts[following] == t:
            assert got[i].near_next == 1
    assert np.mean([r.near_edited for r in got.values()]) > np.mean([r.near_next for r in got.values()])


def test_subwords_decode_to_the_text(spark, sf_dir, rows):
    got = by_id(spark, "op1_subwords", sf_dir)
    for i, t in texts_of(rows).items():
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
        assert got[i].n_ids == len(got[i].ids) and (got[i].n_ids > 0) == bool(t)


def test_ngram_scores_do_not_depend_on_the_partitions(spark, sf_dir):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for parts in ("2", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            found.append({i: (r.score, r.base_score) for i, r in by_id(spark, "op3_ngram_model", sf_dir).items()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0].keys() == found[1].keys()
    # parts of a score travel as 4-byte floats
    for i in found[0]:
        assert found[0][i] == pytest.approx(found[1][i], rel=1e-6)
