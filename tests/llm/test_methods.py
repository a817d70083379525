"""The parts of the text operators by themselves."""

from __future__ import annotations

import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanlens.llm import components as comp
from loanlens.llm import jaccard_join, language, ngram_model, packing, personal_data, subwords, suffix_dedup, toxicity
from loanlens.llm.arrays import shingle_hashes, word_hashes
from loanlens.llm.elias_fano import EliasFano, Trie


def test_word_hashes_follow_words():
    texts = ["The cat", "", "the  CAT\n", "cat", "\x0b"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    h, bounds, starts = word_hashes(data, offsets)
    assert bounds.tolist() == [0, 2, 2, 4, 5, 5] and starts.tolist() == [0, 4, 7, 12, 16]
    assert h[0] == h[2] and h[1] == h[3] == h[4] and h[0] != h[1]
    runs, at = shingle_hashes(h, bounds, 2)
    assert at.tolist() == [0, 1, 1, 2, 3, 3] and runs[0] == runs[1] != runs[2]


@pytest.mark.parametrize("top", [1, 70, 10_000, 2**40, 2**63])
def test_elias_fano_reads_back(top):
    rng = np.random.default_rng(3)
    values = np.sort(rng.integers(0, top, 500, dtype=np.uint64))
    coded, _ = EliasFano.view(memoryview(EliasFano.encode(values).to_bytes()))
    assert (coded.access(np.arange(500)) == values).all()
    wanted = np.append(values[::7], [0, top - 1]).astype(np.uint64)
    n = len(wanted)
    at = coded.first_not_less(wanted, np.zeros(n, np.int64), np.full(n, 500))
    assert (at == np.searchsorted(values, wanted)).all()


def test_trie_finds_pairs_within_their_word():
    words = np.array([5, 9, 2**50], dtype=np.uint64)
    first, context = np.array([0, 2, 3, 6]), np.array([1, 4, 0, 1, 2, 7])
    log_p = np.linspace(-6, -1, 6)
    trie = Trie.mapped(Trie.build(words, first, context, log_p, 8))
    rank = trie.find_words(np.array([9, 6, 2**50], dtype=np.uint64))
    assert rank.tolist() == [1, -1, 2]
    got = trie.log_p(rank, np.array([0, 0, 1, 2, 2]), np.array([0, 1, 0, 7, 6]))
    assert np.isnan(got).tolist() == [False, True, True, False, True]
    assert got[[0, 3]] == pytest.approx([-4, -1], abs=0.02)


def test_every_word_is_a_context(spark):
    rng = random.Random(3)
    # each rare word has its own follower, 6,000 of them
    texts = [" ".join(f"a{i} b{i} the w{rng.randint(0, 40)}" for i in range(k, k + 60)) for k in range(0, 6_000, 60)]
    rows = [(i, t, i % 10 > 0) for i, t in enumerate(texts + texts[:50] + ["a17 b17 the a5 zz b5", "", "the the"])]
    frame = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    got = {r["doc_id"]: r for r in ngram_model.score(frame.repartition(3)).collect()}
    said = {i: ["<s>", *t.split(), "</s>"] for i, t, _ in rows}
    pairs = Counter(p for i, _, learn in rows if learn for p in zip(said[i], said[i][1:], strict=False))
    total, count, follow = Counter(), Counter(), Counter()
    for (c, w), n in pairs.items():
        total[c] += n
        count[w] += n
        follow[c] += 1
    whole = sum(total.values()) + ngram_model.ADD * (len(count) + 1)
    for i, own in said.items():
        want = 0.0
        for c, w in zip(own, own[1:], strict=False):
            base = (count[w] + ngram_model.ADD) / whole
            want += math.log10((pairs[c, w] + follow[c] * base) / (total[c] + follow[c]) if total[c] else base)
        # one byte holds a probability
        assert got[i]["score"] == pytest.approx(want, abs=0.015 * (len(own) - 1))
        assert got[i]["base_score"] == pytest.approx(sum(math.log10((count[w] + ngram_model.ADD) / whole) for w in own[1:]))


def test_segments_match_their_definition():
    """Every maximal segment by divide and conquer: best run, then the same left and right of it."""

    def slow(scores, offset=0):
        best, at = 0, None
        for i in range(len(scores)):
            for j in range(i, len(scores)):
                if sum(scores[i : j + 1]) > best:
                    best, at = sum(scores[i : j + 1]), (i, j)
        if at is None:
            return []
        i, j = at
        return [*slow(scores[:i], offset), (offset + i, offset + j, best), *slow(scores[j + 1 :], offset + j + 1)]

    rng = random.Random(1)
    for _ in range(200):
        # powers of two apart: no two runs have equal sums
        scores = [rng.choice((-1, 1)) * (rng.random() + 0.01) for _ in range(rng.randint(0, 14))]
        got = toxicity.segments((i, i, s) for i, s in enumerate(scores))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in slow(scores)]


def test_byte_model_code_lengths_are_those_of_a_plain_walk():
    import pandas as pd

    rows = pd.DataFrame({"lang": ["xx"] * 2, "text": ["abracadabra", "abc cab"]})
    model = language.ByteModel(language.count_grams(rows))
    from collections import Counter

    grams = Counter()
    for t in rows["text"]:
        full = b"\n\n\n" + t.encode()
        for i in range(3, len(full)):
            for k in range(4):
                grams[full[i - k : i + 1]] += 1

    def bits(history, b):
        total = 0.0
        for k in range(3, -1, -1):
            context = history[len(history) - k :]
            seen = {g[-1]: n for g, n in grams.items() if len(g) == k + 1 and g[:-1] == context}
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if b in seen:
                return total - np.log2(seen[b] / whole)
            total -= np.log2(len(seen) / whole)
        return total + 8

    text = "\n\n\nabraxcabé".encode()
    want = sum(bits(text[i - 3 : i], text[i]) for i in range(3, len(text)))
    got = model.bits(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert got[0, 0] == pytest.approx(want, rel=1e-6)


def test_anchors_are_the_same_wherever_a_string_stands():
    rng = random.Random(2)
    passage = bytes(rng.choices(b"abcdef ", k=900))
    found = []
    for before in (b"", b"xyz" * 100, bytes(rng.choices(b"abcdef ", k=777))):
        data = before + passage + b"tail" * 50
        place, first, last = suffix_dedup.anchors(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        owner = {s: p for p, a, b in zip(place, first, last, strict=True) for s in range(a, b + 1)}
        assert sorted(owner) == list(range(len(data) - 399))
        found.append([owner[len(before) + s] - len(before) for s in range(501)])
    assert found[0] == found[1] == found[2]


def test_family_returns_every_shared_suffix_once():
    rng = np.random.default_rng(7)
    family, given, got = suffix_dedup.Family(), [], []
    for batch in range(12):
        key = np.sort(rng.integers(0, 300, 40, dtype=np.uint64))
        number = np.arange(40) + 40 * batch
        given += list(zip(key.tolist(), number.tolist(), strict=True))
        keys, numbers = family.add(key, [number])
        got += list(zip(keys.tolist(), numbers.tolist(), strict=True))
    sizes = [len(level[0]) for level in family.levels]
    assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False))
    many = {k for k, n in zip(*np.unique([k for k, _ in given], return_counts=True), strict=True) if n > 1}
    assert sorted(got) == sorted(x for x in given if x[0] in many)


def test_pivots_lose_no_link(spark, monkeypatch):
    """Many near copies that share most shingles, some of them linked through others only."""
    monkeypatch.setattr(jaccard_join, "SMALL", 2)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"v{rng.randrange(10_000)}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [{tuple(t.split(" ")[k : k + 5]) for k in range(56)} for _, t in rows]
    root = list(range(60))
    for _ in range(60):
        for a in range(60):
            for b in range(60):
                if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    assert got == dict(enumerate(root))


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 3), (200, 201)]
    got = {r.node: r.component for r in comp.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30)) and got[201] == 200


def test_level_choice_adds_least_to_the_squares():
    rng = random.Random(4)
    packer = packing.Packer(size=16, max_open=10**6)
    for i in range(300):
        tokens = rng.randint(1, 15)
        n = packer.level.copy()

        def squares(at, n=n, tokens=tokens):
            m = n.copy()
            if at:
                m[at] -= 1
            if at + tokens < 16:
                m[at + tokens] += 1
            return int((m[:16] ** 2).sum())

        usable = [h for h in range(0, 17 - tokens) if h == 0 or n[h]]
        assert squares(packer.best_level(tokens)) == min(map(squares, usable))
        list(packer.add(i, b"\0" * 4 * tokens))
        assert sum(len(v) for v in packer.open.values()) == packer.n_open == packer.level.sum()
    left = list(packer.fill_up())
    assert packer.n_open == 0 and all(p[2] > 0 for p in left)


def test_packer_flushes_when_many_windows_are_open():
    packer, rows = packing.Packer(size=64, max_open=3), []
    for i in range(50):
        rows += packer.add(i, bytes(range(4)) * 40)
        assert packer.n_open <= 4
    rows += packer.fill_up()
    assert sum(r[2] for r in rows) == 50 * 40


def test_field_splits_what_one_pattern_runs_together(spark):
    rng = random.Random(6)
    number = lambda k: "".join(str(rng.randrange(10)) for _ in range(k))

    def card():
        body = number(15)
        return next(body + str(d) for d in range(10) if personal_data.luhn(body + str(d)))

    texts = []
    for i in range(120):
        texts.append(f"pay {card()} now, call +1 ({number(3)}) 555-{number(4)} or write to u{i}@mail.example.com from 10.{i}.0.9 item {number(5)}")
    weights = personal_data.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    c = card()
    two = f"cards {number(12)} {c} here"
    assert not [k for _, _, k in personal_data.base_spans(two) if k == "card"]
    spans = personal_data.find_spans(two, weights)
    assert (two.index(c), two.index(c) + 16, "card", False) in spans
    assert personal_data.find_spans("chapter 12 of 300 and 2024", weights) == []
    assert personal_data.masked("a x@y.z b", personal_data.find_spans("a x@y.z b", weights)) == "a [EMAIL] b"


@pytest.mark.parametrize("dropout", [0.0, 0.1, 1.0])
def test_merge_dropout(dropout):
    from sentencepiece import SentencePieceProcessor

    path = subwords.default_vocabulary()
    texts = ["Hello  world, this is a test.\n\nünïcode 日本語 \U0001f600", " lead", "▁ mark \0 zero", " ", "x" * 200, "\ttab   "]
    v = subwords.Vocabulary(path)
    coded = [np.frombuffer(v.encode(t, 1, 5, dropout), "<u4").tolist() for t in texts]
    assert [v.decode(x) for x in coded] == texts
    again = subwords.Vocabulary(path)
    assert [np.frombuffer(again.encode(t, 1, 5, dropout), "<u4").tolist() for t in texts] == coded
    if dropout == 0:
        model = SentencePieceProcessor(model_file=path)
        for t, x in zip(texts, coded, strict=True):
            if "▁" not in t:
                assert model.encode(t) == x
    if dropout == 0.1:
        other = subwords.Vocabulary(path)
        long = " ".join(["something interesting happened"] * 3)
        kinds = {subwords.Vocabulary(path).encode(long, 0, seed, 0.3) for seed in range(5)}
        assert len(kinds) > 1 and all(other.decode(np.frombuffer(k, "<u4").tolist()) == long for k in kinds)


def test_dropout_draws_a_word_anew_wherever_it_stands(spark):
    rows = [(i, "interesting " * 50) for i in range(60)]
    got = subwords.encode(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["decoded"] == rows[0][1] for r in got)
    assert len({tuple(r["ids"]) for r in got}) == len(rows)
    v = subwords.Vocabulary(subwords.default_vocabulary())
    word = subwords.BLANK + "interesting"
    (_, n, plain), *rest = v._run(" interesting")
    assert not rest and n == len(v.candidates(word))
    seen = Counter()
    for r in got:
        text = v.encode(rows[0][1], r["doc_id"])
        assert v.decode(np.frombuffer(text, "<u4").tolist()) == rows[0][1]
        at = 0
        drop = subwords.dropped(50 * n, r["doc_id"], subwords.SEED, subwords.DROPOUT)
        for k in range(50):
            own = v._skipping(word, drop[k * n : k * n + n].tobytes())
            assert text[at : at + len(own)] == own
            seen[own] += 1
            at += len(own)
    assert len(seen) > 10 and seen[plain] >= sum(seen.values()) * 0.9**n * 0.8
    drops = subwords.dropped(100_000, 3, 5, 0.1)
    assert 0.095 < drops.mean() < 0.105 and 0.008 < (drops[1:] & drops[:-1]).mean() < 0.012


def test_words_are_merged_side_by_side(monkeypatch):
    rng = random.Random(3)
    path = subwords.default_vocabulary()
    plain, v = subwords.Vocabulary(path), subwords.Vocabulary(path)
    words = ["interesting", "misunderstanding,", "the", "\u2581", "a\u2581b", "na\u00efve", "\u65e5\u672c\u8a9e", "", "x1=y2", "\U0001f600\n\nend"]
    words += ["".join(rng.choices("abcdehilnorstu", k=rng.randint(1, 31))) for _ in range(300)]
    texts = ["", " ", *(" ".join(rng.choices(words, k=rng.randint(1, 200))) for _ in range(30))]

    def alone(text: str, stream: int, dropout: float) -> bytes:
        parts = [p for run in subwords._RUNS.findall(" " + text) for p in plain._run(run)] if text else []
        drop, at, out = subwords.dropped(sum(p[1] for p in parts), stream, 7, dropout), 0, b""
        for part, n, ids in parts:
            out += plain._skipping(part, drop[at : at + n].tobytes()) if n else ids
            at += n
        return out

    expected = {d: [alone(t, i, d) for i, t in enumerate(texts)] for d in (0.0, 0.1, 0.5, 1.0)}
    long = "a" * 100 + " " + "interesting" * 9
    long_ids = {d: alone(long, 4, d) for d in expected}
    assert v.encode(long, 4, 7, 0.3) == alone(long, 4, 0.3)
    assert all(v.encode(long, 4, 7, d) == x for d, x in long_ids.items())

    def one_by_one(*_):
        raise AssertionError("a word merged by itself")

    monkeypatch.setattr(subwords.Vocabulary, "encode_run", one_by_one)
    monkeypatch.setattr(subwords.Vocabulary, "merge_run", one_by_one, raising=False)
    for d, ids in expected.items():
        assert [v.encode(t, i, 7, d) for i, t in enumerate(texts)] == ids
        flat, cuts = v.encode_all(texts, list(range(len(texts))), 7, d)
        assert [flat[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == ids


def test_ngram_pairs_of_many_chunks_are_looked_up_once(monkeypatch):
    rng = np.random.default_rng(8)
    hashes = np.sort(rng.integers(1, 1 << 63, 40, dtype=np.uint64))
    codes = ngram_model.Codes(hashes[:5])
    held, pairs = [], set()
    for chunk in range(6):
        own = sorted({(int(w), int(c)) for w, c in rng.integers(0, 40, (60, 2))})
        pairs |= set(own)
        words, per_word = np.unique([w for w, _ in own], return_counts=True)
        row = np.arange(len(own)) % 7
        context, ones = hashes[[c for _, c in own]], np.ones(len(own), np.uint32)
        knows = np.array([True, True, False, True, True, True, True])
        held.append((chunk, hashes[words], per_word.astype(np.uint32), context, ones, row.astype(np.uint16), ones * 2, knows))
    found = [[hashes, np.arange(40, dtype=np.uint32) + 9, np.full(40, 4, np.uint32)]]
    totals = ngram_model.Totals(1000, 10, 40)
    asked, look_up = [], ngram_model.Trie.log_p

    def counting(trie, rank, word, context):
        asked.append(len(context))
        return look_up(trie, rank, word, context)

    monkeypatch.setattr(ngram_model.Trie, "log_p", counting)
    sums = list(ngram_model.shard_sums(held, found, totals, codes))
    assert sum(asked) == len(pairs)
    taught = Counter()
    for _, words, per_word, context, _, row, n, knows in held:
        for w, c, r, k in zip(np.repeat(words, per_word), context, row, n, strict=True):
            taught[w, c] += int(k) * bool(knows[r])
    place = {h: i for i, h in enumerate(hashes)}
    for batch, (chunk, words, per_word, context, _, row, n, _) in zip(sums, held, strict=True):
        rows, base, score, known = ngram_model._unpacked([batch.column(c)[0].as_py() for c in ngram_model._SUM], ngram_model._SUM_KINDS, codes)
        expected = np.zeros((2, 7))
        for w, c, r, k in zip(np.repeat(words, per_word), context, row, n, strict=True):
            p = (place[w] + 9 + 0.1) / totals.whole
            q = (taught[w, c] + 4 * p) / (place[c] + 9 + 4)
            expected[:, r] += k * math.log10(place[w] + 9 + 0.1), k * math.log10(q)
        assert batch.column("chunk")[0].as_py() == chunk and rows.tolist() == list(range(7))
        assert np.allclose(base, expected[0]) and np.allclose(score, expected[1], atol=0.02)
        assert known.tolist() == [2 * int((row == r).sum()) for r in range(7)]


def test_stages_keep_columns_and_clean_documents(spark, docs, rows, sf_dir):
    import corpus_pipeline

    now = docs.drop("score", "token")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf_dir)
        assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        now = spark.createDataFrame(now.collect(), now.schema)
    kept = {r.doc_id: r for r in now.collect()}
    by_text = {}
    for r in rows:
        by_text.setdefault(r[1], []).append(r[0])
    first = next(v for k, v in by_text.items() if len(v) == 2)
    assert first[0] in kept and first[1] not in kept
    assert all(r.n_chars == len(r.text) for r in kept.values())
    assert "@" not in "".join(r.text for r in kept.values() if "555" in r.text)
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, sf_dir)
    assert pieces.select("doc_id").distinct().count() == len(kept)


def test_stages_take_an_empty_table(spark, empty, sf_dir):
    import corpus_pipeline

    now = empty
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf_dir)
        assert now.count() == 0
        now = empty


def test_repeated_rows(spark):
    text = " ".join(f"word{i}" for i in range(150))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (2, "other words here now ok fine")], "doc_id long, text string")
    found = jaccard_join.near_duplicates(docs.select("doc_id", "text")).collect()
    assert len(found) == 4 and {r.component_id for r in found if r.n_shingles == 146} == {1}
    kept = jaccard_join.near_duplicate_stage(spark, docs, "")
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2]
    cut = suffix_dedup.cut_texts(docs.select("doc_id", F.col("text")))
    assert [r.n_removed for r in cut.collect()] == [len(text)]


def test_slices_change_no_anchor(monkeypatch):
    rng = np.random.default_rng(8)
    texts = [rng.integers(97, 101, n, dtype=np.uint8) for n in (0, 300, 400, 2500, 0, 401, 5000, 10)]
    texts.append(np.full(3000, 97, np.uint8))
    data, offsets = np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    whole = suffix_dedup.anchors(data, offsets)
    for size in (100, 401, 1777):
        monkeypatch.setattr(suffix_dedup, "SLICE", size)
        parts = suffix_dedup.anchors(data, offsets)
        assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    starts = [s for a, b in zip(whole[1], whole[2], strict=True) for s in range(a, b + 1)]
    assert starts == [s for a, b in zip(offsets[:-1], offsets[1:], strict=True) for s in range(a, b - 399)]


def test_slices_change_no_code_length(monkeypatch):
    texts = ["\n" * language.ORDER + t for t in ("the cat sat on the mat " * 30, "", "le chat " * 50, "x", "zz top " * 9)]
    rows = [language.count_grams(pd.DataFrame({"lang": [n], "text": [t]})) for n, t in (("en", texts[0]), ("fr", texts[2]))]
    model = language.ByteModel(pd.concat(rows))
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    whole = model.bits(data, offsets)
    assert (whole[1] == 0).all() and whole[0, 0] < whole[0, 1] and whole[2, 1] < whole[2, 0]
    for size in (4, 50, 333):
        monkeypatch.setattr(language, "SLICE", size)
        assert model.bits(data, offsets) == pytest.approx(whole, rel=1e-9)
    # many languages keep fewer pairs, not more bytes
    many = pd.concat([r.assign(lang=f"l{i}") for i in range(40) for r in rows[:1]])
    monkeypatch.setattr(language, "MEMO_BYTES", 40 * 4 * 100)
    assert language.ByteModel(many).memo.nbytes <= 40 * 4 * 100


def test_pipeline_cuts_passages_of_just_over_fifty_words(spark):
    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 4)) for _ in range(2000)]
    own = [" ".join(words[300 * k : 300 * k + 200]) for k in range(4)]
    passage = " ".join(words[1500:1551])
    made = [(0, f"{own[0]} {passage}"), (1, f"{passage} {own[1]}"), (2, own[2]), (3, own[3])]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    left = {r.doc_id: r.text for r in suffix_dedup.suffix_stage(spark, docs, "").collect()}
    assert {k: t.strip() for k, t in left.items()} == dict(enumerate(own))
    # the 400 bytes of the registered operator hold
    assert suffix_dedup.cut_texts(docs.select("doc_id", "text")).count() == 0


def test_ngram_words_are_sent_as_codes_and_come_back():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    codes = ngram_model.Codes(np.sort(words[:2000]))
    sent = words[rng.integers(0, 3000, 5000)]
    packed = codes.pack(sent)
    assert (codes.unpack(packed) == sent).all() and len(packed) < 5 * len(sent)
    assert (ngram_model.Codes(np.zeros(0, np.uint64)).unpack(ngram_model.Codes(np.zeros(0, np.uint64)).pack(sent)) == sent).all()
    for numbers in (np.array([0, 1, 254, 255, 256, 2**40]), np.zeros(0, np.int64)):
        assert ngram_model.unpack_small(ngram_model.pack_small(numbers)).tolist() == numbers.tolist()


def test_ngram_shuffles_are_small_and_codes_change_no_score(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{int(w)}" for w in rng.zipf(1.3, 300) % 5000), i % 7 > 0) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(2).localCheckpoint()

    def sent(frequent):
        codes = spark.sparkContext.broadcast(frequent)
        pairs = ngram_model._send(docs, 4, codes).select(*[F.length(c) for c in ngram_model._PAIR]).collect()
        return sum(x or 0 for r in pairs for x in r)

    assert sent(ngram_model._frequent(docs)) < 0.5 * 28 * 60_200
    coded = sorted(ngram_model.score(docs).collect())
    monkeypatch.setattr(ngram_model, "MOST_CODES", 10)
    assert sorted(ngram_model.score(docs).collect()) == coded


def test_packing_matches_no_pattern_for_words_of_plain_letters(monkeypatch):
    plain, asked = packing._PLAIN, []

    class Counted:
        @staticmethod
        def fullmatch(word):
            asked.append(word)
            return plain.fullmatch(word)

    monkeypatch.setattr(packing, "_PLAIN", Counted)
    ids = packing.WordIds(packing.default_tokenizer())
    texts = ["Some plain Words and WORDS\nonly some", "naïve, Word! x1 ÀB (some) 日本 a", ""]
    want = [np.array(ids.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert list(ids.encode(texts)) == want
    assert sorted(asked) == sorted({"", "naïve,", "Word!", "x1", "ÀB", "(some)", "日本"})


def test_packing_keeps_few_bytes_a_word_and_forgets_without_another_id(monkeypatch):
    rng = np.random.default_rng(6)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 9)) for _ in range(40_000)]
    words = [w.upper() if k % 5 == 0 else w + "é,"[: k % 3] for k, w in enumerate(words)]
    texts = [" ".join(words[k : k + 400]) for k in range(0, len(words), 400)]
    ids = packing.WordIds(packing.default_tokenizer())
    want = [np.array(x.ids, "<u4").tobytes() for x in ids.tokenizer.encode_batch(texts, add_special_tokens=False)]
    list(ids.encode(["warm up"]))
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes()
        assert sum(x == y for x, y in zip(ids.encode(texts), want, strict=True)) == len(texts)
        kept = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    finally:
        tracemalloc.stop()
    assert kept < 120 * len(words)
    monkeypatch.setattr(packing, "CACHE_WORDS", 1000)
    few = packing.WordIds(packing.default_tokenizer())
    for k in [*range(0, 100, 10), 0, 50]:
        assert list(few.encode([*texts[k : k + 10], "", " \n", texts[k]])) == [*want[k : k + 10], b"", b"", want[k]]


def test_language_stage_sends_a_text_to_python_once(spark, docs):
    found = language.identify(docs, ~language.held_out())
    sent = found._jdf.queryExecution().analyzed().children().head().schema().fieldNames()
    assert sorted(sent) == sorted({*docs.columns, "_asked"} - {"score"})
    text = "the quick brown fox and the dog"
    odd = spark.createDataFrame([(0, text, "en"), (1, None, "en"), (2, "", "en"), (3, text, None), (4, "...", "en")], "doc_id long, text string, lang string")
    rows = {r.doc_id: r for r in language.identify(odd.coalesce(1), F.lit(True)).collect()}
    assert [rows[k].lang_pred for k in range(5)] == ["en", "und", "und", "en", "und"]
    assert rows[0].bits_per_byte == rows[3].bits_per_byte > 0 and [rows[k].bits_per_byte for k in (1, 2, 4)] == [0, 0, 0]


def test_successor_search_compares_few_numbers(monkeypatch):
    rng = np.random.default_rng(5)
    read, access = [], EliasFano.access
    monkeypatch.setattr(EliasFano, "access", lambda self, at: read.append(len(at)) or access(self, at))
    for top in (2**63, 50_000, 300):
        values = np.sort(rng.integers(0, top, 20_000, dtype=np.uint64))
        wanted = np.concatenate([values[::20], rng.integers(0, top + 9, 1000, dtype=np.uint64), [np.uint64(2**64 - 1), np.uint64(0)]])
        ends = np.sort(rng.integers(0, 20_001, (2, len(wanted))), axis=0)
        coded = EliasFano.encode(values)
        whole = np.zeros(len(wanted), np.int64), np.full(len(wanted), 20_000)
        for start, end in (whole, ends):
            want = np.clip(np.searchsorted(values, wanted), start, end)
            assert (coded.first_not_less(wanted, start, end) == want).all()
        if top == 2**63:
            assert sum(read) < 8 * len(wanted)
