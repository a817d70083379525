"""The compiled loops against the numpy code, and what they move."""

from __future__ import annotations

import math
from dataclasses import replace

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loanlens.operators import tree_kernel, tree_training, trees
from loanlens.operators.attribution import explain
from loanlens.operators.models import fit_family, training_frame, tree_candidate
from loanlens.operators.trees import Boosting
from loanlens.roles import LOAN_ROLES
from tests.test_trees import SPECS, bins_of, toy

ID = LOAN_ROLES.loan_id
NAMES = list("abcdef")
BOOSTED = [
    Boosting(8, max_depth=3),
    Boosting(9, max_depth=4, subsample=0.6, max_features="sqrt", min_samples_leaf=5),
    Boosting(30, newton=True, max_leaves=15, min_samples_leaf=20, l2=0.1, early_stopping=True),
    Boosting(5, newton=True, min_samples_leaf=20, learning_rate=0.3),
]


@pytest.fixture(scope="module")
def rows():
    """(feature, row) codes, labels, hashes and flags in the order of the hashes."""
    codes, labels, hashes = toy(3000, 21)
    order = np.argsort(hashes)
    return codes[:, order], labels[order], hashes[order], (np.arange(3000) % 5 == 0).astype(np.int32)


@pytest.fixture(scope="module")
def table(spark, rows):
    codes, labels, hashes, held = rows
    cells = [c.tobytes() for c in np.ascontiguousarray(codes.T)]
    plain = list(zip(hashes.tolist(), labels.tolist(), held.tolist(), cells, strict=True))
    df = spark.createDataFrame(plain, "row long, label int, held int, codes binary")
    bins = bins_of(codes)
    counts = tuple(np.bincount(labels[held == 0], minlength=2).tolist())
    return tree_training.BinnedTable(df, bins, NAMES, counts, tree_kernel.load(df, 3000, bins.flat()), 3000)


def plain_trees(rows, table, spec, many):
    codes, labels, hashes, held = rows
    own = held == 0
    codes, labels, hashes = np.ascontiguousarray(codes[:, own]), labels[own], hashes[own]
    if isinstance(spec, Boosting):
        return trees.boost(codes, labels, hashes, spec)
    keys = trees.tree_keys(spec.seed, range(many))
    drawn = [trees.row_weights(spec, k, hashes, labels) for k in keys]
    weights = np.array([trees.class_weights(spec, table.counts, np.bincount(labels, w, 2)) for w in drawn])
    return 0.0, trees.grow_trees(codes, labels, drawn, keys, weights, spec, table.bins.flat())


def test_trees_and_scores_equal_the_numpy_ones(spark, rows, table):
    forests = [*SPECS, *(replace(s, criterion="entropy") for s in SPECS)]
    asked = [tree_training.Candidate(i, s, 23) for i, s in enumerate(forests)]
    asked += [tree_training.Candidate(100 + i, s, s.rounds) for i, s in enumerate(BOOSTED)]
    found = {}
    for r in tree_kernel.grown(spark, table.matrix, tree_training._work(table, asked), True).collect():
        found[r["candidate"], r["number"]] = (r["extra"], bytes(r["bytes"]))
    scores = {}
    for r in tree_training.candidate_scores(table, asked).collect():
        scores.setdefault(r["candidate"], []).append((r["is_validation"], r["label"], r["score"]))
    codes, labels, _, held = rows
    for c in asked:
        start, made = plain_trees(rows, table, c.spec, c.n_trees)
        assert [found.pop((c.number, i)) for i in range(len(made))] == [(start, t.pack()) for t in made]
        if isinstance(c.spec, Boosting):
            raw = start + sum(t.predict(codes) for t in made)
            want = 1 / (1 + np.exp(-raw))
        else:
            want = sum(t.predict(codes) for t in made) / len(made)
        given = sorted(scores.pop(c.number))
        assert [x[:2] for x in given] == sorted(zip(held.tolist(), labels.tolist(), strict=True))
        want = sorted(zip(held.tolist(), labels.tolist(), want.tolist(), strict=True))
        assert [x[2] for x in given] == pytest.approx([x[2] for x in want], abs=1e-9)
    assert not found and not scores


def test_large_nodes_are_counted_in_blocks(spark):
    """More rows than fit the fields of one number, weights up to the largest."""
    codes, labels, hashes = toy(150_000, 4)
    order = np.argsort(hashes)
    codes, labels, hashes = codes[:, order], labels[order], hashes[order]
    cells = [c.tobytes() for c in np.ascontiguousarray(codes.T)]
    df = spark.createDataFrame(list(zip(hashes.tolist(), labels.tolist(), [0] * len(labels), cells, strict=True)), "row long, label int, held int, codes binary")
    bins, counts = bins_of(codes), tuple(np.bincount(labels, minlength=2).tolist())
    own = tree_training.BinnedTable(df, bins, NAMES, counts, tree_kernel.load(df, len(labels), bins.flat()), len(labels))
    specs = [replace(SPECS[2], max_depth=6, rates=(25.0, 25.0)), replace(BOOSTED[0], rounds=2), replace(BOOSTED[2], rounds=2)]
    for spec in specs:
        made = tree_training.Candidate(0, spec, 2)
        found = tree_kernel.grown(spark, own.matrix, tree_training._work(own, [made]), True).orderBy("number").collect()
        whole = codes, labels, hashes, np.zeros(len(labels), np.int32)
        assert [bytes(r["bytes"]) for r in found] == [t.pack() for t in plain_trees(whole, own, spec, 2)[1]]


def test_scores_are_dealt_as_sums_and_not_as_rows(spark, table):
    made = tree_training.Candidate(0, SPECS[2], 45)
    sums = tree_kernel.grown(spark, table.matrix, tree_training._work(table, [made]), False).collect()
    # 3,000 rows are one part, 45 trees three tasks
    assert sorted(r["extra"] for r in sums) == [5, 20, 20] and {len(r["bytes"]) for r in sums} == {8 * 3000}


def test_rows_with_one_key_are_scored_as_one(spark, table):
    twice = table.rows.filter("held = 0").limit(40)
    df = twice.union(twice).union(table.rows.filter("held = 1").limit(7))
    n = df.count()
    own = replace(table, rows=df, matrix=tree_kernel.load(df, n, table.bins.flat()))
    scores = tree_training.candidate_scores(own, [tree_training.Candidate(3, SPECS[0], 2)]).collect()
    assert n == 87 and len(scores) == 47 and {r["candidate"] for r in scores} == {3}


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 40, (600, 3)).astype(float)
    y = (x[:, 0] + rng.normal(scale=9, size=600) > 22).astype(int)
    given = [(f"L{i:04d}", *x[i].tolist(), int(y[i])) for i in range(600)]
    return spark.createDataFrame(given, f"{ID} string, a double, b double, c double, default int").cache()


def test_tree_files_and_attribution_hold_few_trees(spark, points, monkeypatch):
    monkeypatch.setattr(tree_training, "_FILES", tree_training._FILES | {"parquet.block.size": "4000"})
    model = fit_family("random_forest", training_frame(points, ["a", "b", "c"], "default"), ["a", "b", "c"], {"n_estimators": 30})
    groups = [pq.ParquetFile(f).metadata for f in spark.read.parquet(model.path).inputFiles() for f in [f.removeprefix("file:").replace("///", "/")]]
    assert sum(g.num_rows for g in groups) == 30 and sum(g.num_row_groups for g in groups) > 5
    whole = sorted(map(tuple, model.score(points, [ID]).collect()))
    monkeypatch.setattr(tree_training, "SLICE_BYTES", model.n_bytes // 6)
    assert sorted(map(tuple, model.score(points, [ID]).collect())) == whole
    phi = explain(points, model, ID, sample_size=5, background_size=4)
    assert phi._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1 and phi.count() == 15


def test_logarithms_need_no_library():
    x = np.random.default_rng(2).random(2000)
    assert trees.log2(x) == pytest.approx([math.log2(v) for v in x], abs=1e-14, rel=1e-14)
    assert trees.log2(np.array([1.0, 0.5, 0.25])).tolist() == [0.0, -1.0, -2.0]


def test_work_keeps_every_tree_in_few_tasks(table):
    asked = [tree_candidate("random_forest", {"n_estimators": 800}, table.counts, i) for i in range(5)]
    lines = [x.split(" ") for x in tree_training._work(table, asked)]
    assert len(lines) <= tree_training.MOST_TASKS + len(asked)
    for c in asked:
        own = sorted((int(x[1]), int(x[2])) for x in lines if x[0] == str(c.number))
        assert [t for a, n in own for t in range(a, a + n)] == list(range(800))
