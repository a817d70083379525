"""Trees against plain recursions over the same rows, and both ways of growing against each other."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlens.operators import tree_training, trees
from loanlens.operators.attribution import attributions, explain, shapley_of_tree
from loanlens.operators.models import SCORE, FittedModel, fit_family, training_frame, tree_candidate
from loanlens.operators.trees import Bins, Boosting, Forest
from loanlens.roles import LOAN_ROLES
from loanlens.session import fresh_path

ID = LOAN_ROLES.loan_id
VALUES = [20, 5, 2, 30, 1, 11]


def toy(n: int, seed: int):
    """Codes of six features, one of them constant, labels that depend on three, and row hashes."""
    rng = np.random.default_rng(seed)
    codes = np.stack([rng.integers(0, v, n) for v in VALUES]).astype(np.uint8)
    p = 0.1 + 0.5 * (codes[0] > 9) + 0.3 * (codes[1] == 2) - 0.1 * (codes[3] % 3 == 0)
    labels = (rng.random(n) < p).astype(np.uint8)
    return codes, labels, rng.integers(-(2**63), 2**63 - 1, n)


def bins_of(codes) -> Bins:
    values = [[math.sqrt(b) * 3 for b in range(int(c.max()) + 1)] for c in codes]
    return Bins(values, values)


def impurity(criterion, zeros, ones):
    total = zeros + ones
    shares = [x / total for x in (zeros, ones) if x > 0]
    return 1 - sum(s * s for s in shares) if criterion == "gini" else -sum(s * math.log2(s) for s in shares)


def check_node(tree, node, codes, labels, weight, key, a, spec, bins, depth=0):
    """A node against all splits it may choose from, by impurities; then its children.

    Splits may tie to the last bits, so any of the best is right.
    """
    rows = np.flatnonzero(weight)
    z, o = (a[y] * weight[rows][labels[rows] == y].sum() for y in (0, 1))
    assert tree.value[node] == pytest.approx(o / (z + o))
    least = max(spec.min_samples_split, 2 * spec.min_samples_leaf, 2)
    if len(rows) < least or z == 0 or o == 0 or (spec.max_depth is not None and depth >= spec.max_depth):
        assert tree.feature[node] == -1
        return 1
    total = len(codes)
    k = spec.n_features(total)
    order = list(range(total))
    if k < total:
        order = np.argsort(trees.salted(np.full(total, key), "feature", np.arange(total)), kind="stable").tolist()
    varying = [i for i, f in enumerate(order) if len(set(codes[f, rows])) > 1]
    found = {}
    for f in order[: max(k, varying[0] + 1 if varying else 0)]:
        seen = sorted(set(codes[f, rows].tolist()))
        cuts = seen[:-1]
        if spec.random_cuts and cuts:
            low, high = bins.lows[f][seen[0]], bins.highs[f][seen[-1]]
            u = trees.uniform(trees.salted(np.array([key], np.uint64), "cut", f))[0]
            cuts = [max(c for c in cuts if bins.highs[f][c] <= low + u * (high - low) or c == cuts[0])]
        for c in cuts:
            left = codes[f, rows] <= c
            if min(left.sum(), (~left).sum()) < max(spec.min_samples_leaf, 1):
                continue
            found[f, c] = 0.0
            for side in (left, ~left):
                w, y = weight[rows][side], labels[rows][side]
                sz, so = a[0] * w[y == 0].sum(), a[1] * w[y == 1].sum()
                found[f, c] -= (sz + so) * impurity(spec.criterion, sz, so)
    if not found:
        assert tree.feature[node] == -1
        return 1
    f, c = int(tree.feature[node]), int(tree.cut[node])
    assert found[f, c] >= max(found.values()) - 1e-9
    sides = [np.where(codes[f] <= c, weight, 0), np.where(codes[f] > c, weight, 0)]
    return 1 + sum(
        check_node(tree, int(tree.left[node]) + i, codes, labels, w, trees.salted(np.uint64(key), s), a, spec, bins, depth + 1)
        for i, (s, w) in enumerate(zip(("left", "right"), sides, strict=True))
    )


def as_nested(tree, node=0):
    if tree.feature[node] < 0:
        return float(tree.value[node])
    left = int(tree.left[node])
    return int(tree.feature[node]), int(tree.cut[node]), as_nested(tree, left), as_nested(tree, left + 1)


SPECS = [
    Forest(),
    Forest(criterion="entropy", max_depth=4, min_samples_split=12),
    Forest(bootstrap=True, max_features="sqrt", min_samples_leaf=3, class_weight="balanced_subsample"),
    Forest(max_features=0.5, class_weight="balanced", max_depth=40),
    Forest(bootstrap=True, rates=(0.3, 1.0), max_features="log2"),
    Forest(random_cuts=True, max_features=None),
    Forest(random_cuts=True, max_features=1, bootstrap=True, min_samples_leaf=2),
]


@pytest.mark.parametrize("spec", SPECS)
def test_trees_equal_a_plain_recursion(spec):
    codes, labels, rows = toy(160, 5)
    bins = bins_of(codes)
    keys = trees.tree_keys(spec.seed, range(6))
    drawn = [trees.row_weights(spec, k, rows, labels) for k in keys]
    whole = np.bincount(labels, minlength=2)
    weights = [trees.class_weights(spec, whole, np.bincount(labels, w, 2)) for w in drawn]
    grown = trees.grow_trees(codes, labels, drawn, keys, np.array(weights), spec, bins.flat())
    for tree, w, k, a in zip(grown, drawn, keys, weights, strict=True):
        assert check_node(tree, 0, codes, labels, w, k, a, spec, bins) == len(tree.feature)
        again = trees.Tree.unpack(tree.pack())
        assert (again.predict(codes) == tree.predict(codes)).all()


def test_trees_side_by_side_equal_trees_alone():
    codes, labels, rows = toy(300, 6)
    spec, flat = SPECS[2], bins_of(codes).flat()
    keys = trees.tree_keys(1, range(5))
    drawn = [trees.row_weights(spec, k, rows, labels) for k in keys]
    together = trees.grow_trees(codes, labels, drawn, keys, np.ones((5, 2)), spec, flat)
    for i in range(5):
        alone = trees.grow_trees(codes, labels, drawn[i : i + 1], keys[i : i + 1], np.ones((1, 2)), spec, flat)[0]
        assert as_nested(alone) == as_nested(together[i])


def test_bootstrap_weights_follow_poisson():
    rows = np.arange(200_000)
    labels = (rows % 10 == 0).astype(np.uint8)
    drawn = trees.row_weights(Forest(bootstrap=True, rates=(1 / 9, 1.0)), np.uint64(9), rows, labels)
    assert drawn[labels == 1].mean() == pytest.approx(1.0, abs=0.03) and drawn[labels == 1].var() == pytest.approx(1.0, abs=0.05)
    assert drawn[labels == 0].sum() == pytest.approx(drawn[labels == 1].sum(), rel=0.05)


def plain_boost(codes, labels, spec):
    """Newton boosting by exhaustive search, one leaf after the other, in floating point."""
    n = len(labels)
    score = np.full(n, trees.prior(int(labels.sum()), n))
    start = score[0]
    for _ in range(spec.rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = p - labels, p * (1 - p)
        leaves = [(np.arange(n), 0)]

        def best(rows, depth, g=g, h=h):
            found = None
            if spec.max_depth is not None and depth >= spec.max_depth:
                return None
            for f in range(len(codes)):
                for c in sorted(set(codes[f, rows]))[:-1]:
                    low = codes[f, rows] <= c
                    if min(low.sum(), (~low).sum()) < spec.min_samples_leaf:
                        continue
                    gain = -g[rows].sum() ** 2 / (h[rows].sum() + spec.l2)
                    for side in (rows[low], rows[~low]):
                        gain += g[side].sum() ** 2 / (h[side].sum() + spec.l2)
                    if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                        found = (gain, rows[low], rows[~low], depth + 1)
            return found

        while len(leaves) < (spec.max_leaves or n):
            options = [(b[0], i, b) for i, (r, d) in enumerate(leaves) if (b := best(r, d))]
            if not options:
                break
            _, i, (_, left, right, depth) = max(options, key=lambda x: (x[0], -x[1]))
            leaves[i] = (left, depth)
            leaves.append((right, depth))
        for rows, _ in leaves:
            score[rows] -= spec.learning_rate * g[rows].sum() / (h[rows].sum() + spec.l2)
    return start, score


@pytest.mark.parametrize("spec", [Boosting(3, 0.3, max_leaves=6, min_samples_leaf=5, l2=0.5, newton=True), Boosting(2, 0.2, max_depth=2, min_samples_leaf=4, l2=1.0, newton=True)])
def test_boosting_equals_exhaustive_search(spec):
    codes, labels, rows = toy(150, 7)
    start, grown = trees.boost(codes, labels, rows, spec)
    want_start, want = plain_boost(codes, labels, spec)
    got = start + sum(t.predict(codes) for t in grown)
    assert start == want_start and got == pytest.approx(want, abs=1e-5)
    if spec.max_leaves:
        assert all((t.feature < 0).sum() <= spec.max_leaves for t in grown)


def test_two_leaves_by_hand():
    """Eight rows, one feature: prior 0, gradients +-0.5, hessians 0.25."""
    codes = np.array([[0, 0, 0, 0, 1, 1, 1, 1]], np.uint8)
    labels = np.array([0, 0, 0, 1, 0, 1, 1, 1], np.uint8)
    spec = Boosting(1, 1.0, max_leaves=31, min_samples_leaf=1, l2=1.0, newton=True)
    start, (tree,) = trees.boost(codes, labels, np.arange(8), spec)
    # left: G = 3 x 0.5 - 0.5 = 1, H = 1, leaf -1 / (1 + 1)
    assert start == 0.0 and tree.predict(codes[:, [0, 7]]).tolist() == [-0.5, 0.5]
    _, (squares,) = trees.boost(codes, labels, np.arange(8), Boosting(1, 1.0, max_depth=1))
    assert squares.predict(codes[:, [0, 7]]).tolist() == [-1.0, 1.0]


def test_early_stopping_needs_ten_flat_rounds():
    assert not trees.should_stop([1.0] * 10) and trees.should_stop([1.0] * 11)
    assert not trees.should_stop([1.0] * 10 + [0.5])


NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def loans(spark):
    rng = np.random.default_rng(13)
    x = np.round(rng.normal(size=(900, 3)), 2)
    x[:, 1] = rng.integers(0, 4, 900)
    y = (x[:, 0] + 0.6 * (x[:, 1] > 1) + rng.normal(scale=0.8, size=900) > 0.7).astype(int)
    rows = [(f"L{i:04d}", *map(float, x[i]), int(y[i]), int(i % 5 == 0)) for i in range(900)]
    return spark.createDataFrame(rows, f"{ID} string, a double, b double, c double, default int, is_validation int").cache()


def test_bins_are_values_or_quantiles(loans):
    found = tree_training.fit_bins(loans.select(*NAMES), NAMES)
    values = sorted({r["a"] for r in loans.collect()})
    assert found.lows[1] == found.highs[1] == [0.0, 1.0, 2.0, 3.0]
    if len(values) > trees.BINS:
        assert len(found.lows[0]) <= trees.BINS and found.lows[0][0] == values[0] and found.highs[0][-1] == values[-1]
        assert all(a <= b for a, b in zip(found.lows[0], found.highs[0], strict=True))
    codes = found.codes([np.array(values), np.zeros(len(values)), np.zeros(len(values))])[0]
    assert (np.diff(codes.astype(int)) >= 0).all() and set(np.diff(codes.astype(int))) <= {0, 1}


WAYS = [
    ("random_forest", {"n_estimators": 5, "max_depth": 6, "class_weight": "balanced_subsample", "min_samples_leaf": 2}),
    ("extra_trees", {"n_estimators": 4, "max_features": None}),
    ("decision_tree", {"min_samples_split": 8}),
    ("random_forest", {"n_estimators": 3, "undersample": True, "max_depth": 3}),
    ("gradient_boosting", {"n_estimators": 4, "subsample": 0.7, "max_features": "sqrt"}),
    ("hist_gradient_boosting", {"max_iter": 4, "max_leaf_nodes": 7, "l2_regularization": 0.1, "early_stopping": True}),
]


@pytest.mark.parametrize("family, params", WAYS)
def test_a_table_beyond_one_task_gives_the_same_trees(spark, loans, monkeypatch, family, params):
    def scores():
        table = tree_training.bin_table(loans, NAMES, ID, "default", "is_validation")
        made = tree_candidate(family, params, table.counts, 3)
        rows = tree_training.candidate_scores(table, [made])
        assert (table.matrix is None) == (tree_training.LOCAL_CELLS < 900)
        model = tree_training.fit_trees(table, family, made, params)
        return sorted(map(tuple, rows.collect())), sorted(map(tuple, model.score(loans, [ID]).collect()))

    whole = scores()
    monkeypatch.setattr(tree_training, "LOCAL_CELLS", 3 * 150)
    monkeypatch.setattr(tree_training, "OPEN_NODES", 4)
    monkeypatch.setattr(tree_training, "ROUNDS_PER_WRITE", 3)
    monkeypatch.setattr(tree_training, "SLICE_BYTES", 3000)
    parts = scores()
    assert [x[:3] for x in whole[0]] == [x[:3] for x in parts[0]] and len(whole[0]) == 900
    assert [x[3] for x in whole[0]] == pytest.approx([x[3] for x in parts[0]], abs=1e-9)
    assert [x[1] for x in whole[1]] == pytest.approx([x[1] for x in parts[1]], abs=1e-9)


def test_scores_are_those_of_the_saved_trees(spark, loans):
    frame = training_frame(loans.withColumn("is_validation", F.lit(0)), NAMES, "default")
    for family, params in (("random_forest", {"n_estimators": 7}), ("hist_gradient_boosting", {"max_iter": 5})):
        model = fit_family(family, frame, NAMES, params)
        path = fresh_path(spark, "model")
        model.save(spark, path)
        again = FittedModel.load(spark, path)
        a, b = (sorted(map(tuple, m.score(loans, [ID, "b"]).collect())) for m in (model, again))
        assert a == b and len(a) == 900 and all(0 <= r[-1] <= 1 for r in a)
        plan = model.score(loans, [ID])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and SCORE in model.score(loans, [ID]).columns


def all_orders(predict, row, base):
    """Shapley values by every coalition."""
    n = len(row)
    value = {}
    for mask in range(1 << n):
        mixed = np.array([row[f] if mask >> f & 1 else base[f] for f in range(n)], np.uint8)
        value[mask] = predict(mixed[:, None])[0]
    out = np.zeros(n)
    for f in range(n):
        for mask in range(1 << n):
            if not mask >> f & 1:
                k = mask.bit_count()
                share = math.factorial(k) * math.factorial(n - k - 1) / math.factorial(n)
                out[f] += share * (value[mask | 1 << f] - value[mask])
    return out


def test_tree_attribution_equals_all_orders():
    codes, labels, rows = toy(200, 8)
    spec = Forest(max_features=2, random_cuts=True)
    keys = trees.tree_keys(3, range(3))
    ones = [np.ones(200, np.int64)] * 3
    for tree in trees.grow_trees(codes, labels, ones, keys, np.ones((3, 2)), spec, bins_of(codes).flat()):
        phi = shapley_of_tree(tree, codes[:, :25], codes[:, 25:50])
        for i in range(25):
            assert phi[i] == pytest.approx(all_orders(tree.predict, codes[:, i], codes[:, 25 + i]), abs=1e-12)


@pytest.mark.parametrize("family, params", [("random_forest", {"n_estimators": 6}), ("gradient_boosting", {"n_estimators": 5})])
def test_tree_attributions_add_up(loans, monkeypatch, family, params):
    model = fit_family(family, training_frame(loans, NAMES, "default"), NAMES, params)
    monkeypatch.setattr(tree_training, "SLICE_BYTES", 2000)
    phi = explain(loans, model, ID, sample_size=20, background_size=10).collect()
    scores = {r[ID]: r[SCORE] for r in model.score(loans, [ID]).collect()}
    sums = {}
    for r in phi:
        sums[r[ID]] = sums.get(r[ID], 0.0) + r["phi"]
    # what is left of a prediction is the mean prediction of the background, the same for all rows
    bases = [scores[i] - s for i, s in sums.items()]
    assert len(phi) == 60 and len(bases) == 20 and np.ptp(bases) < 1e-9
    if family == "random_forest":
        sampled = attributions(loans, model, ID, sample_size=20, background_size=10, passes=40)
        other = {(r[ID], r["feature"]): r["phi"] for r in sampled.collect()}
        # the same rows and background: 400 walks a row come near the exact values
        apart = np.array([other[r[ID], r["feature"]] - r["phi"] for r in phi])
        assert np.abs(apart).mean() < 0.02 and np.abs(apart).max() < 0.12


@pytest.mark.parametrize("even", [False, True])
def test_cells_are_the_same_counted_and_sorted(even):
    rng = np.random.default_rng(5)
    size = np.array([3000, 1, 0, 700])
    node, n = np.repeat(np.arange(4), size), int(size.sum())
    code, label = rng.integers(0, 255, n).astype(np.uint8), rng.integers(0, 2, n)
    weight = np.ones(n, int) if even else rng.integers(1, 31, n)
    low = (weight << 1 | label).astype(np.uint8)
    counted = trees._cells(np.arange(10, 14), size, code, low, even)
    # so many empty nodes that a table would be larger than the rows
    wide = np.concatenate([size, np.zeros(5000, int)])
    by_sorting = trees._cells(np.arange(10, 10 + len(wide)), wide, code, low, even)
    want = sorted(set(zip(node.tolist(), code.tolist(), strict=True)))
    rows = [[(node < a) | (node == a) & (code <= b) for a, b in want]]
    sums = [[int((x * r).sum()) for r in rows[0]] for x in (np.ones(n, int), weight, weight * label)]
    for found in (counted, by_sorting):
        assert [(a - 10, b) for a, b in zip(found[0].tolist(), found[1].tolist(), strict=True)] == want
        assert [x.tolist() for x in found[2:]] == sums


def test_a_wave_moves_only_drawn_rows_and_loses_no_tree(spark, loans, monkeypatch):
    monkeypatch.setattr(tree_training, "LOCAL_CELLS", 3 * 150)
    table = tree_training.bin_table(loans, NAMES, ID, "default", "is_validation")
    # one level, so that every tree is finished above: all leaves are closed by their depth
    params = {"n_estimators": 3, "max_depth": 1, "bootstrap": False}
    model = tree_training.fit_trees(table, "random_forest", tree_candidate("random_forest", params, table.counts), params)
    assert model.n_trees == 3
    tops = [tree_training._Top(tree_candidate("random_forest", {"n_estimators": 1, "undersample": True}, table.counts), 0, trees.tree_keys(1, [0])[0])]
    tree_training._grow_tops(table, tops)
    plan = tree_training._finish_wave(table, tops)._jdf.queryExecution().optimizedPlan().toString()
    # no row ids and held-out flags are dealt, and no group of rows becomes a frame
    assert "top#" in plan and "held#" not in plan.split("RepartitionByExpression")[0] and plan.count("FlatMapGroupsInPandas") == 1


def test_boosting_of_blocks_stops_where_one_task_stops(spark, loans, monkeypatch):
    """Without a split the loss never falls, so the loss before the first tree has to count too."""
    still = loans.select(ID, "default", "is_validation", *[F.lit(1.0).alias(c) for c in NAMES])
    params = {"max_iter": 20, "early_stopping": True}

    def grown():
        table = tree_training.bin_table(still, NAMES, ID, "default", "is_validation")
        return tree_training.fit_trees(table, "hist_gradient_boosting", tree_candidate("hist_gradient_boosting", params, table.counts), params).n_trees

    whole = grown()
    monkeypatch.setattr(tree_training, "LOCAL_CELLS", 3 * 150)
    assert grown() == whole == trees.PATIENCE


def test_boosting_passes_read_blocks_and_leave_nothing_cached(spark, loans, monkeypatch):
    monkeypatch.setattr(tree_training, "LOCAL_CELLS", 3 * 150)
    table = tree_training.bin_table(loans, NAMES, ID, "default", "is_validation")
    held = set(spark.sparkContext._jsc.getPersistentRDDs())
    read = []
    plain = tree_training._histogram_pass
    monkeypatch.setattr(tree_training, "_histogram_pass", lambda rows, *a: read.append(rows.count()) or plain(rows, *a))
    made = tree_candidate("gradient_boosting", {"n_estimators": 3}, table.counts)
    _, grown, scored = tree_training._boost_rows(table, made.spec)
    assert len(grown) == 3 and scored.count() == 900
    assert max(read) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= held
