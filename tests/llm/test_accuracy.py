"""What the learned operators say of rows they did not learn from, and fingerprints by their definition."""

from __future__ import annotations

import hashlib
import math
import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loanlens.llm import imatch
from loanlens.llm.registry import QUERIES

SF_DIR = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PUNCTUATION = str.maketrans(dict.fromkeys((chr(c) for c in range(33, 127) if not chr(c).isalnum()), " "))


@needs_tables
def test_languages_of_unseen_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op5_language_id"](spark, SF_DIR).join(docs, "doc_id")
    unseen = found.filter("held_out AND lang IS NOT NULL AND lang_pred != 'und'").collect()
    right = sum(r.lang == r.lang_pred for r in unseen)
    assert len(unseen) > 100 and right >= 0.97 * len(unseen)
    assert sum(r.score for r in unseen) / len(unseen) > 0.9


@needs_tables
def test_toxicity_of_unseen_documents(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op4_toxicity"](spark, SF_DIR).join(labels, "doc_id").filter("held_out AND toxic IS NOT NULL").collect()
    toxic, clean = ([r for r in rows if r.toxic == k] for k in (1, 0))
    above = sum((a.score > b.score) + 0.5 * (a.score == b.score) for a in toxic for b in clean)
    # some labelled documents have nothing that the learned ones have in common
    assert toxic and clean and above >= 0.8 * len(toxic) * len(clean)
    assert sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows)


def terms_of(text: str) -> list[str]:
    return list(dict.fromkeys(WORD.findall(text.translate(LOWER).translate(PUNCTUATION))))


def test_fingerprints_by_their_definition(spark, sf_dir, rows):
    texts = {r[0]: r[1] or "" for r in rows}
    df = Counter(t for text in texts.values() for t in terms_of(text))
    low, high = imatch.IDF_BAND
    band = sorted(t for t, n in df.items() if n > 1 and low <= math.log(len(texts) / n) <= high)
    # the keyed hash of (term, subset) is Spark's; which subsets keep a term follows from it
    hashed = spark.createDataFrame([(t,) for t in band], "term string").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(imatch.PARTS - 1))))
    keyed = hashed.select("term", "part", F.xxhash64("term", "part").alias("h")).collect()
    kept = {(r.term, r.part) for r in keyed if r.h % imatch.RARITIES[r.part % len(imatch.RARITIES)] == 0}

    def fingerprint(text: str) -> str:
        own, parts = sorted(terms_of(text), key=lambda t: t.encode()), []
        for part in range(imatch.PARTS):
            some = [t for t in own if (t, part) in kept]
            if some:
                parts.append(f"{part:02d}:{hashlib.sha1(' '.join(some).encode()).hexdigest()[:8]}")
        if parts:
            return ",".join(parts)
        return hashlib.sha1(" ".join(own).encode()).hexdigest() if own else hashlib.sha224(text.encode()).hexdigest()

    def alike(a: str, b: str) -> float:
        if a == b:
            return 1.0
        one, other = a.split(","), b.split(",")
        return len(set(one) & set(other)) / len({x[:2] for x in one} | {x[:2] for x in other})

    ids = sorted(texts)
    got = {r.doc_id: r for r in QUERIES["op10_imatch"](spark, sf_dir).collect()}
    for i, following in zip(ids, [*ids[1:], ids[0]], strict=True):
        text, m = texts[i], len(texts[i]) // 4
        edited = text[: len(text) - m] + texts[following][:m]
        want, changed = fingerprint(text), fingerprint(edited)
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (want, changed)
        assert got[i].near_edited == pytest.approx(alike(want, changed))
        assert got[i].near_next == pytest.approx(alike(want, fingerprint(texts[following])))
    assert any("," in r.fingerprint for r in got.values())
