"""Growing trees over binned features: many trees at once, level by level or best leaf first.

Every feature is a code of at most BINS bins.  All random draws (bootstrap weights, features of a
node, cuts) are hashes of the seed, the tree, the path to the node and the row, so that a tree is
the same whether its nodes are grown together, apart or on another machine.  Counts are whole
numbers and gradients are rounded to whole units, so that sums do not depend on their order.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np

BINS = 255
#: Whole units of a gradient.
UNITS = float(1 << 24)
#: A row's weight in one tree is below 32; a Poisson draw of mean 1 reaches that once in 10^35 rows.
_WEIGHT_BITS = 5
#: A row of a tree in one number: its place, its weight and its label in the lowest _BITS bits.
_BITS = _WEIGHT_BITS + 1
_LOW = (1 << _BITS) - 1
#: Weight and, if the label is 1, weight again of the lowest bits: sums of both run in one number.
_HALF, _FLOAT_HALF = 32, 26
_drawn = np.arange(_LOW + 1) >> 1
_ones = _drawn * (np.arange(_LOW + 1) & 1)
_PAIR = _drawn + (_ones << _HALF)
_FLOAT_PAIR = (_drawn + (_ones << _FLOAT_HALF)).astype(np.float64)
_SALT = {"tree": 1, "row": 2, "feature": 3, "cut": 4, "left": 5, "right": 6}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over the whole word."""
    x = np.asarray(x, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salted(x: np.ndarray, what: str, number: np.ndarray | int = 0) -> np.ndarray:
    with np.errstate(over="ignore"):
        step = np.asarray(number, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix(np.asarray(x, dtype=np.uint64) + step + np.uint64(_SALT[what] << 56))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from hashes."""
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


@dataclass(frozen=True)
class Bins:
    """Smallest and largest training value of every bin of every feature."""

    lows: list[list[float]]
    highs: list[list[float]]

    def edges(self, f: int) -> np.ndarray:
        """Midpoints between neighbouring bins; a value up to edge b has a code up to b."""
        return (np.array(self.highs[f][:-1]) + np.array(self.lows[f][1:])) / 2

    def codes(self, values: Sequence[np.ndarray]) -> np.ndarray:
        """(feature, row) codes of columns of values."""
        found = [np.searchsorted(self.edges(f), v, side="left") for f, v in enumerate(values)]
        return np.array(found, dtype=np.uint8).reshape(len(self.lows), -1)

    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        """Lows and highs by feature x 256 + code."""
        out = np.zeros((2, len(self.lows), 256))
        for f, pair in enumerate(zip(self.lows, self.highs, strict=True)):
            for side, values in enumerate(pair):
                out[side, f, : len(values)] = values
        return out[0].ravel(), out[1].ravel()


@dataclass(frozen=True)
class Tree:
    """Nodes in arrays: a row whose code of ``feature`` is at most ``cut`` goes to ``left``, others
    to the node after it; leaves have feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def pack(self) -> bytes:
        n = len(self.feature)
        parts = [np.array([n]), self.value, self.left, self.feature, self.cut]
        kinds = ["<i8", "<f8", "<i4", "<i2", "u1"]
        return b"".join(np.ascontiguousarray(p, k).tobytes() for p, k in zip(parts, kinds, strict=True))

    @staticmethod
    def unpack(packed: bytes) -> Tree:
        n = int(np.frombuffer(packed, "<i8", 1)[0])
        value = np.frombuffer(packed, "<f8", n, 8)
        left = np.frombuffer(packed, "<i4", n, 8 + 8 * n)
        feature = np.frombuffer(packed, "<i2", n, 8 + 12 * n)
        return Tree(feature, np.frombuffer(packed, "u1", n, 8 + 14 * n), left, value)

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        """Leaf of every row of (feature, row) codes."""
        n = codes.shape[1]
        out = np.zeros(n, dtype=np.int64)
        rows, now, cells = np.arange(n), np.zeros(n, dtype=np.int32), codes.ravel()
        start = self.feature.astype(np.int64) * n
        while True:
            inner = self.feature.take(now) >= 0
            if not inner.all():
                ends = ~inner
                out[rows[ends]] = now[ends]
                rows, now = rows[inner], now[inner]
            if not len(rows):
                return out
            right = cells.take(start.take(now) + rows) > self.cut.take(now)
            now = self.left.take(now) + right

    def predict(self, codes: np.ndarray) -> np.ndarray:
        return self.value[self.leaves(codes)]


@dataclass(frozen=True)
class Forest:
    """How the trees of one candidate are grown."""

    criterion: str = "gini"
    max_depth: int | None = None
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    max_features: str | float | int | None = None
    bootstrap: bool = False
    class_weight: str | None = None
    random_cuts: bool = False
    #: Poisson rates of class 0 and 1; equal classes are drawn by rates in inverse proportion.
    rates: tuple[float, float] = (1.0, 1.0)
    seed: int = 42

    def n_features(self, total: int) -> int:
        return feature_count(self.max_features, total)


def feature_count(max_features: str | float | int | None, total: int) -> int:
    """How many features a node draws; roots and logarithms are rounded down, fractions are shares."""
    if max_features is None:
        return total
    if max_features == "sqrt":
        return max(1, int(math.sqrt(total)))
    if max_features == "log2":
        return max(1, int(math.log2(total)))
    if isinstance(max_features, int):
        return min(max(1, max_features), total)
    return max(1, int(float(max_features) * total))


def tree_keys(seed: int, trees: Sequence[int]) -> np.ndarray:
    return salted(salted(np.full(len(trees), seed), "tree"), "tree", np.array(trees))


def poisson_steps(rate: float) -> np.ndarray:
    """Chances of 0, at most 1, at most 2 and so on."""
    steps = [math.exp(-rate)]
    for k in range(1, 2**_WEIGHT_BITS - 1):
        steps.append(steps[-1] * rate / k)
    return np.cumsum(steps)


def poisson(u: np.ndarray, rate: float) -> np.ndarray:
    """Poisson draws by inversion."""
    return np.searchsorted(poisson_steps(rate), u, side="right").astype(np.int64)


def row_weights(spec: Forest, key: np.uint64, row_hash: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """How often each row is drawn for a tree."""
    if not spec.bootstrap:
        return np.ones(len(row_hash), dtype=np.int64)
    u = uniform(salted(row_hash.astype(np.uint64) ^ key, "row"))
    out = poisson(u, spec.rates[0])
    if spec.rates[1] != spec.rates[0]:
        out = np.where(labels == 1, poisson(u, spec.rates[1]), out)
    return out


def class_weights(spec: Forest, whole: Sequence[int], drawn: Sequence[int]) -> tuple[float, float]:
    """Weights of class 0 and 1, balanced over all rows or over those drawn for the tree."""
    if spec.class_weight is None:
        return 1.0, 1.0
    counts = drawn if spec.class_weight == "balanced_subsample" else whole
    return tuple(sum(counts) / (2.0 * max(c, 1)) for c in counts)


def log2(x: np.ndarray) -> np.ndarray:
    """Logarithms by sums, products and quotients alone, so that they are the same on every machine."""
    m, e = np.frexp(x)
    small = m < 0.7071067811865476
    m, e = np.where(small, m * 2.0, m), e - small
    s = (m - 1.0) / (m + 1.0)
    z, p = s * s, 1.0 / 23.0
    for k in range(21, 0, -2):
        p = p * z + 1.0 / k
    return e + 2.8853900817779268 * s * p


def _entropy_terms(part: np.ndarray, total: np.ndarray) -> np.ndarray:
    return part * log2(np.where(part > 0, part / np.maximum(total, 1e-300), 1.0))


def split_score(criterion: str, l0, l1, r0, r1) -> np.ndarray:
    """Larger is better; differs from the impurity decrease by what is the same for a node's splits."""
    left, right = l0 + l1, r0 + r1
    if criterion == "gini":
        return (l0 * l0 + l1 * l1) / left + (r0 * r0 + r1 * r1) / right
    terms = ((l0, left), (l1, left), (r0, right), (r1, right))
    return sum(_entropy_terms(p, t) for p, t in terms)


@dataclass
class Level:
    """Open nodes of many trees at one depth, with class counts of their rows."""

    tree: np.ndarray
    key: np.ndarray
    rows: np.ndarray  # how many rows, whatever their weights
    zeros: np.ndarray  # weights of class 0
    ones: np.ndarray


class Chooser:
    """Best split of each of some nodes, from the counts of (node, code) cells of one feature after
    another."""

    def __init__(self, spec: Forest, level: Level, weights: np.ndarray, bins: tuple[np.ndarray, np.ndarray], total: int):
        m = len(level.tree)
        self.spec, self.level, self.weights, self.bins = spec, level, weights, bins
        self.score = np.full(m, -np.inf)
        self.feature, self.cut = np.full(m, -1, dtype=np.int64), np.zeros(m, dtype=np.int64)
        self.varies = np.zeros(m, dtype=bool)
        k = spec.n_features(total)
        self.order = None
        self.first = k
        self.wanted = np.ones((m, total), dtype=bool)
        if k < total:
            hashes = salted(level.key[:, None], "feature", np.arange(total)[None, :])
            self.order = np.argsort(hashes, axis=1, kind="stable")
            self.wanted[:] = False
            np.put_along_axis(self.wanted, self.order[:, :k], True, axis=1)

    def rounds(self, total: int) -> Iterator[np.ndarray]:
        """(node, feature) marks to look at: the drawn features, then one more at a time for nodes
        in which all features so far have one value."""
        yield self.wanted
        if self.order is not None:
            for place in range(self.first, total):
                left = np.flatnonzero(~self.varies)
                if len(left) == 0:
                    return
                more = np.zeros_like(self.wanted)
                more[left, self.order[left, place]] = True
                yield more

    def offer(self, f: int, node: np.ndarray, code: np.ndarray, rows: np.ndarray, weight: np.ndarray, ones: np.ndarray) -> None:
        """Cells of feature ``f`` sorted by node and code; the counts run on over all cells."""
        if len(node) == 0:
            return
        begin = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        size = np.diff(np.append(begin, len(node)))
        who = node[begin]
        self.varies[who[size > 1]] = True

        def within(total: np.ndarray) -> np.ndarray:
            return total - np.repeat(np.append(0, total[begin[1:] - 1]), size)

        n_left, w_left, ones_left = within(rows), within(weight), within(ones)
        at = np.arange(len(node))
        if self.spec.random_cuts:
            low, high = self.bins
            cell = f * 256 + code
            first, last = low[cell[begin]], high[cell[begin + size - 1]]
            drawn = first + uniform(salted(self.level.key[who], "cut", f)) * (last - first)
            below = np.add.reduceat((high[cell] <= np.repeat(drawn, size)).astype(np.int64), begin)
            at = begin + np.clip(below, 1, np.maximum(size - 1, 1)) - 1
            n_left, w_left, ones_left = n_left[at], w_left[at], ones_left[at]
        own = node[at]
        a = self.weights[self.level.tree[own]]
        l1, l0 = ones_left * a[:, 1], (w_left - ones_left) * a[:, 0]
        r1 = (self.level.ones[own] - ones_left) * a[:, 1]
        r0 = (self.level.zeros[own] - (w_left - ones_left)) * a[:, 0]
        n_right = self.level.rows[own] - n_left
        least = max(self.spec.min_samples_leaf, 1)
        allowed = (n_left >= least) & (n_right >= least)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(allowed, split_score(self.spec.criterion, l0, l1, r0, r1), -np.inf)
        if self.spec.random_cuts:
            best, place = score, at
            better = best > self.score[who]
            place = place[better]
        else:
            best = np.maximum.reduceat(score, begin)
            better = best > self.score[who]
            place = np.where(score == np.repeat(best, size), at, len(node))
            place = np.minimum.reduceat(place, begin)[better]
        self.score[who[better]] = best[better]
        self.feature[who[better]] = f
        self.cut[who[better]] = code[place]


def closed(spec: Forest, level: Level, depth: int) -> np.ndarray:
    """Nodes that become leaves whatever their splits."""
    least = max(spec.min_samples_split, 2 * spec.min_samples_leaf, 2)
    done = (level.rows < least) | (level.zeros == 0) | (level.ones == 0)
    return done | (spec.max_depth is not None and depth >= spec.max_depth)


def leaf_values(level: Level, weights: np.ndarray) -> np.ndarray:
    a = weights[level.tree]
    ones = level.ones * a[:, 1]
    return ones / np.maximum(ones + level.zeros * a[:, 0], 1e-300)


def child_keys(keys: np.ndarray) -> np.ndarray:
    """Keys of the left and right children, one behind the other."""
    return np.stack([salted(keys, "left"), salted(keys, "right")], axis=1).ravel()


class NodeLog:
    """Nodes of many trees as they come, level by level, and the trees they make."""

    def __init__(self, n_trees: int):
        self.n_trees, self.size = n_trees, 0
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, tree, value, feature, cut) -> None:
        """Nodes of one level; split ones find their children two by two in the next level."""
        split = feature >= 0
        left = np.where(split, self.size + len(tree) + 2 * (np.cumsum(split) - 1), -1)
        self.parts.append((tree, value, feature, cut, left))
        self.size += len(tree)

    def trees(self) -> list[Tree]:
        tree, value, feature, cut, left = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(tree, kind="stable")
        place = np.empty(len(tree), dtype=np.int64)
        place[order] = np.arange(len(tree))
        ends = np.searchsorted(tree[order], np.arange(self.n_trees + 1))
        out = []
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            own = order[a:b]
            into = np.where(left[own] >= 0, place[left[own]] - a, -1)
            out.append(Tree(feature[own].astype(np.int16), cut[own].astype(np.uint8), into.astype(np.int32), value[own]))
        return out


def _cells(nodes: np.ndarray, size: np.ndarray, code: np.ndarray, low: np.ndarray, even: bool) -> tuple[np.ndarray, ...]:
    """Cells of rows by node and code with running counts of rows, weights and ones.

    Rows come node by node, ``size`` of each of ``nodes``; ``even`` says that all weights are 1.
    Cells are counted in a table where the nodes are large, and found by sorting where they are small.
    """
    m, n = len(nodes), len(code)
    if m * 256 <= 2 * n < 1 << _FLOAT_HALF:
        cell = np.repeat(np.arange(m) << 8, size)
        cell += code
        sums = np.bincount(cell, _FLOAT_PAIR[low], m << 8)
        rows = sums if even else np.bincount(cell, minlength=m << 8)
        some = np.flatnonzero(rows)
        sums = sums[some].astype(np.int64)
        drawn = sums & ((1 << _FLOAT_HALF) - 1)
        weights, ones = np.cumsum(drawn), np.cumsum(sums >> _FLOAT_HALF)
        return nodes[some >> 8], some & 255, weights if even else np.cumsum(rows[some]), weights, ones
    wide = np.uint64 if m >> 32 - 8 - _BITS else np.uint32
    packed = np.repeat(np.arange(m, dtype=wide) << wide(8 + _BITS), size)
    packed |= code.astype(wide) << wide(_BITS)
    packed |= low
    packed.sort()
    cell = packed >> wide(_BITS)
    last = np.append(np.flatnonzero(cell[1:] != cell[:-1]), n - 1) if n else np.zeros(0, np.int64)
    sums = np.cumsum(_PAIR[packed & wide(_LOW)])[last]
    cell = cell[last].astype(np.int64)
    return nodes[cell >> 8], cell & 255, last + 1, sums & ((1 << _HALF) - 1), sums >> _HALF


def grow_trees(
    codes: np.ndarray,
    labels: np.ndarray,
    drawn: Sequence[np.ndarray],
    keys: np.ndarray,
    weights: np.ndarray,
    spec: Forest,
    bins: tuple[np.ndarray, np.ndarray],
    depth: int = 0,
) -> list[Tree]:
    """Trees (or subtrees that start at ``depth``) over (feature, row) codes, grown side by side.

    ``drawn`` has each tree's row weights, ``keys`` its root's key, ``weights`` its class weights.
    """
    total = codes.shape[0]
    wide = np.uint64 if codes.shape[1] >> 32 - _BITS else np.uint32
    rows = [np.flatnonzero(w) for w in drawn]
    size = np.array([len(r) for r in rows])
    even = all((w[r] == 1).all() for w, r in zip(drawn, rows, strict=True))
    item = [r.astype(wide) << wide(_BITS) | (w[r] << 1 | labels[r]).astype(wide) for w, r in zip(drawn, rows, strict=True)]
    item = np.concatenate(item)
    log = NodeLog(len(drawn))
    tree, key = np.arange(len(drawn)), np.asarray(keys, dtype=np.uint64)
    if (size == 0).any():
        # a tree without rows is one leaf
        log.add(tree[size == 0], np.zeros((size == 0).sum()), np.full((size == 0).sum(), -1), np.zeros((size == 0).sum(), int))
        tree, key, size = tree[size > 0], key[size > 0], size[size > 0]
    while len(tree):
        sums = np.add.reduceat(_PAIR[item & wide(_LOW)], np.cumsum(size) - size)
        ones = sums >> _HALF
        level = Level(tree, key, size, (sums & ((1 << _HALF) - 1)) - ones, ones)
        value = leaf_values(level, weights)
        feature, cut = np.full(len(tree), -1, dtype=np.int64), np.zeros(len(tree), dtype=np.int64)
        stays = ~closed(spec, level, depth)
        open_ = np.flatnonzero(stays)
        if len(open_) < len(tree):
            item = item[np.repeat(stays, size)]
        size = size[open_]
        begin = np.cumsum(size) - size
        level = Level(tree[open_], key[open_], size, level.zeros[open_], level.ones[open_])
        row, low = (item >> wide(_BITS)).astype(np.int64), (item & wide(_LOW)).astype(np.uint8)
        chooser = Chooser(spec, level, weights, bins, total)
        for wanted in chooser.rounds(total) if len(open_) else ():
            for f in np.flatnonzero(wanted.any(axis=0)):
                nodes = np.flatnonzero(wanted[:, f])
                own, at, drew = size, row, low
                if len(nodes) < len(open_):
                    own = size[nodes]
                    before = np.cumsum(own) - own
                    place = np.repeat(begin[nodes] - before, own) + np.arange(own.sum())
                    at, drew = row[place], low[place]
                chooser.offer(f, *_cells(nodes, own, codes[f].take(at), drew, even))
        feature[open_], cut[open_] = chooser.feature, chooser.cut
        log.add(tree, value, feature, cut)
        parts = chooser.feature >= 0
        split = np.flatnonzero(parts)
        if len(split) < len(open_):
            keep = np.repeat(parts, size)
            item, row = item[keep], row[keep]
        size = size[split]
        asked = np.repeat(chooser.feature[split] * codes.shape[1], size)
        left = codes.ravel().take(asked + row) <= np.repeat(chooser.cut[split].astype(np.uint8), size)
        item, size = _part(left, item, size)
        tree, key, depth = np.repeat(level.tree[split], 2), child_keys(level.key[split]), depth + 1
    return log.trees()


def _part(left: np.ndarray, item: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of every node with those that go left first, and the sizes of both sides."""
    if len(item) == 0:
        return item, np.zeros(0, dtype=np.int64)
    begin = np.cumsum(size) - size
    n_left = np.add.reduceat(left.astype(np.int64), begin)
    both = np.stack([n_left, size - n_left], axis=1)
    start = np.cumsum(both.ravel()).reshape(-1, 2) - both
    # the rows of one side keep their order, so the places of a side are its runs, one behind the other
    moved = np.empty_like(item)
    for side, goes in ((0, left), (1, ~left)):
        n = both[:, side]
        moved[np.repeat(start[:, side] - (np.cumsum(n) - n), n) + np.arange(n.sum())] = item[goes]
    return moved, both.ravel()


# Boosting


@dataclass(frozen=True)
class Boosting:
    """How boosted trees are grown: by squared error of the residuals (``newton`` false) or by
    gradients and hessians with an l2 weight."""

    rounds: int
    learning_rate: float = 0.1
    max_depth: int | None = None
    max_leaves: int | None = None
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    max_features: str | None = None
    subsample: float = 1.0
    l2: float = 0.0
    newton: bool = False
    #: With newton: stop when the loss on a tenth of the rows has not fallen for ten rounds; None
    #: does so beyond 10,000 rows.
    early_stopping: bool | None = None
    seed: int = 42


LEAST_HESSIAN = 1e-3
PATIENCE, HELD_OUT, TOLERANCE = 10, 0.1, 1e-7


def _best_split(spec: Boosting, hist: np.ndarray, key: np.uint64) -> tuple[float, int, int] | None:
    """(gain, feature, code) of a node's histogram (3, feature, code) of rows, gradients and hessians."""
    total = hist.shape[1]
    rows, g, h = (np.cumsum(x, axis=1) for x in hist)
    n, sum_g, sum_h = rows[0, -1], g[0, -1] / UNITS, h[0, -1] / UNITS
    g, h = g / UNITS, h / UNITS
    if n < max(spec.min_samples_split, 2 * spec.min_samples_leaf):
        return None
    allowed = (rows >= max(spec.min_samples_leaf, 1)) & (n - rows >= max(spec.min_samples_leaf, 1)) & (hist[0] > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        if spec.newton:
            allowed &= (h >= LEAST_HESSIAN) & (sum_h - h >= LEAST_HESSIAN)
            gain = g * g / (h + spec.l2) + (sum_g - g) ** 2 / (sum_h - h + spec.l2) - sum_g * sum_g / (sum_h + spec.l2)
            allowed &= gain > 0
        else:
            apart = g / rows - (sum_g - g) / (n - rows)
            gain = rows * (n - rows) / n * apart * apart
    k = feature_count(spec.max_features, total)
    if k < total:
        order = np.argsort(salted(np.full(total, key), "feature", np.arange(total)), kind="stable")
        varies = (hist[0] > 0).sum(axis=1) > 1
        more = np.flatnonzero(varies[order])
        k = max(k, int(more[0]) + 1 if len(more) else total)
        allowed[order[k:]] = False
    gain = np.where(allowed, gain, -np.inf)
    at = int(gain.argmax())
    return None if gain.flat[at] == -np.inf else (float(gain.flat[at]), at // hist.shape[2], at % hist.shape[2])


def _leaf(spec: Boosting, hist: np.ndarray) -> float:
    g, h = hist[1, 0].sum() / UNITS, hist[2, 0].sum() / UNITS
    if spec.newton:
        return -g / (h + spec.l2) if h + spec.l2 > 0 else 0.0
    return -g / h if h > 1e-150 else 0.0


#: Gives histograms of some nodes' left children, as (node number, feature, code, left's number,
#: right's number), and keeps in mind which rows went where.
Splitter = Callable[[list[tuple[int, int, int, int, int]]], list[np.ndarray]]


def grow_best_first(spec: Boosting, root: np.ndarray, split: Splitter, key: np.uint64) -> Tree:
    """One tree, always splitting the leaf that gains most, until no leaf gains or there are enough.

    The children of a leaf are known by one histogram and the difference to their parent's.  All
    leaves that may still be split are divided in one request, so that requests are about as many
    as levels; divisions that are not needed in the end are left out of the tree.
    """
    hist, keys, depth = {0: root}, {0: key}, {0: 0}
    best = {0: _best_split(spec, root, key)}
    children: dict[int, int] = {}
    feature, cut, left = {}, {}, {}
    leaves = [0]
    most = spec.max_leaves or 1 << 60

    def can(i: int) -> bool:
        return best[i] is not None and (spec.max_depth is None or depth[i] < spec.max_depth)

    while len(leaves) < most:
        ready = [i for i in leaves if can(i)]
        if not ready:
            break
        now = max(ready, key=lambda i: (best[i][0], -i))
        if now not in children:
            asked = sorted((i for i in ready if i not in children), key=lambda i: -best[i][0])[: most - len(leaves)]
            request = []
            for i in asked:
                children[i] = len(hist) + 2 * len(request)
                request.append((i, best[i][1], best[i][2], children[i], children[i] + 1))
            for (i, _, _, a, b), found in zip(request, split(request), strict=True):
                hist[a], hist[b] = found, hist[i] - found
                for j, side in ((a, "left"), (b, "right")):
                    keys[j], depth[j] = salted(keys[i], side), depth[i] + 1
                    best[j] = _best_split(spec, hist[j], keys[j])
        a = children[now]
        feature[now], cut[now], left[now] = best[now][1], best[now][2], a
        leaves[leaves.index(now)] = a
        leaves.append(a + 1)
    # renumber the nodes that are in the tree, children side by side
    order, place = [0], {0: 0}
    for i in order:
        if i in feature:
            for j in (left[i], left[i] + 1):
                place[j] = len(order)
                order.append(j)
    return Tree(
        np.array([feature.get(i, -1) for i in order], np.int16),
        np.array([cut.get(i, 0) for i in order], np.uint8),
        np.array([place[left[i]] if i in left else -1 for i in order], np.int32),
        np.array([0.0 if i in feature else spec.learning_rate * _leaf(spec, hist[i]) for i in order]),
    )


def gradients(score: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the log loss in whole units."""
    p = 1.0 / (1.0 + np.exp(-score))
    return np.rint((p - labels) * UNITS), np.rint(p * (1 - p) * UNITS)


def log_loss(score: np.ndarray, labels: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, score) - labels * score


def prior(ones: int, n: int) -> float:
    share = min(max(ones / max(n, 1), 1e-9), 1 - 1e-9)
    return math.log(share / (1 - share))


def histogram(codes: np.ndarray, rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """(3, feature, code) sums over rows of (row, feature) codes."""
    total = codes.shape[1]
    at = (codes[rows].astype(np.int64) + np.arange(total) * 256).ravel()
    out = [np.bincount(at, minlength=total * 256).astype(np.float64)]
    out += [np.bincount(at, np.repeat(x[rows], total), total * 256) for x in (g, h)]
    return np.stack(out).reshape(3, total, 256)


def in_round(spec: Boosting, row_hash: np.ndarray, key: np.uint64) -> np.ndarray:
    """Rows that a round's tree is grown on."""
    if spec.subsample >= 1.0:
        return np.ones(len(row_hash), dtype=bool)
    return uniform(salted(row_hash.astype(np.uint64) ^ key, "row")) < spec.subsample


def stops_early(spec: Boosting, n: int) -> bool:
    return bool(spec.newton and (n > 10_000 if spec.early_stopping is None else spec.early_stopping))


def held_out(spec: Boosting, row_hash: np.ndarray, n: int) -> np.ndarray:
    """Rows that only tell when to stop."""
    if not stops_early(spec, n):
        return np.zeros(len(row_hash), dtype=bool)
    key = salted(np.uint64(spec.seed), "cut")
    return uniform(salted(row_hash.astype(np.uint64) ^ key, "row")) < HELD_OUT


def should_stop(losses: Sequence[float]) -> bool:
    """True if none of the last PATIENCE losses is below the one before them."""
    if len(losses) <= PATIENCE:
        return False
    return min(losses[-PATIENCE:]) > losses[-PATIENCE - 1] - TOLERANCE


def boost(codes: np.ndarray, labels: np.ndarray, row_hash: np.ndarray, spec: Boosting) -> tuple[float, list[Tree]]:
    """Start value and trees of rows held in memory, (feature, row) codes."""
    by_row = np.ascontiguousarray(codes.T)
    start = prior(int(labels.sum()), len(labels))
    score = np.full(len(labels), start)
    out = held_out(spec, row_hash, len(labels))
    trees: list[Tree] = []
    losses: list[float] = [float(log_loss(score[out], labels[out]).mean())] if out.any() else []
    for key in tree_keys(spec.seed, range(spec.rounds)):
        g, h = gradients(score, labels)
        inside = in_round(spec, row_hash, key) & ~out
        held = {0: np.flatnonzero(inside)}

        def split(request, held=held, g=g, h=h):
            found = []
            for i, f, cut, a, b in request:
                rows = held.pop(i)
                goes = by_row[rows, f] <= cut
                held[a], held[b] = rows[goes], rows[~goes]
                if len(held[a]) <= len(held[b]):
                    found.append(histogram(by_row, held[a], g, h))
                else:
                    found.append(whole[i] - histogram(by_row, held[b], g, h))
                whole[a] = found[-1]
                whole[b] = whole.pop(i) - found[-1]
            return found

        whole = {0: histogram(by_row, held[0], g, h)}
        trees.append(grow_best_first(spec, whole[0], split, key))
        score = score + trees[-1].predict(codes)
        if losses:
            losses.append(float(log_loss(score[out], labels[out]).mean()))
            if should_stop(losses):
                break
    return start, trees
