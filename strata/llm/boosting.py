"""Gradient-boosted trees for dense feature tables, in memory or spread over tasks.

Rows come grouped, each with the number of times it occurs. A level of a tree
is chosen from sums by node, feature and cut, which blocks of rows add up; the
sums are whole numbers, so that every order of rows and blocks, and the spread
fit and the one in memory, give the same trees.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Gradients are summed as multiples of 1 / SCALE.
SCALE = 2.0 ** 26
#: Rows of one block.
BLOCK = 1 << 16


@dataclass
class Tree:
    """A full binary tree in heap order: inner nodes test ``x[feature] > cut``."""
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        for _ in range(int(np.log2(len(self.leaf)))):
            at = 2 * at + 1 + (x[np.arange(len(x)), self.feature[at]] > self.cut[at])
        return self.leaf[at - len(self.feature)]


@dataclass
class Boosted:
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for t in self.trees:
            z += t(x)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Block:
    """Rows of a fit: how many cuts of each feature they exceed, label, times, log odds."""
    codes: np.ndarray
    y: np.ndarray
    n: np.ndarray
    z: np.ndarray

    def after(self, grown: list[Grown]) -> Block:
        z = self.z.copy()
        for t in grown:
            z += t.leaf[t.place(self.codes, len(t.leaf))]
        return Block(self.codes, self.y, self.n, z)

    def sums(self, tree: Grown, nodes: int, size: int) -> np.ndarray:
        """Rows, gradients and curvatures by feature, node of a level of ``nodes`` and code."""
        p = 1.0 / (1.0 + np.exp(-self.z))
        weights = (self.n, np.rint((p - self.y) * SCALE) * self.n, np.rint(p * (1 - p) * SCALE) * self.n)
        node = tree.place(self.codes, nodes) * size
        out = np.empty((3, self.codes.shape[1], nodes, size), np.int64)
        for f in range(self.codes.shape[1]):
            at = node + self.codes[:, f]
            for k, w in enumerate(weights):
                out[k, f] = np.bincount(at, w, nodes * size).reshape(nodes, size)
        return out


@dataclass
class Grown:
    """A tree over codes: inner nodes test ``codes[feature] >= split``."""
    feature: np.ndarray
    split: np.ndarray
    leaf: np.ndarray

    def place(self, codes: np.ndarray, nodes: int) -> np.ndarray:
        """Each row's node among the ``nodes`` of one level."""
        at, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
        for _ in range(int(np.log2(nodes))):
            at = 2 * at + 1 + (codes[rows, self.feature[at]] >= self.split[at])
        return at - (nodes - 1)


def _cuts(x: np.ndarray, n: np.ndarray, bins: int) -> list[np.ndarray]:
    """Distinct quantiles of each feature, ``n`` times each row; reckoned as Spark's percentile."""
    at = (n.sum() - 1) * (np.arange(bins) / bins)
    low, high = np.floor(at), np.ceil(at)
    cuts = []
    for column in x.T:
        order = np.argsort(column, kind="stable")
        up_to = np.cumsum(n[order])
        a, b = (column[order][np.searchsorted(up_to, k, side="right")] for k in (low, high))
        cuts.append(np.unique(np.where(a == b, a, (high - at) * a + (at - low) * b)))
    return cuts


def _block(x, y, n, cuts: list[np.ndarray], base: float) -> Block:
    codes = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    codes = codes.astype(np.min_scalar_type(max(map(len, cuts))))
    return Block(codes, np.asarray(y, float), np.asarray(n, float), np.full(len(codes), base))


def _boost(model: Boosted, cuts: list[np.ndarray], sums: Callable, advance: Callable, rounds: int, depth: int,
           rate: float, l2: float) -> Boosted:
    """Grows the trees; ``sums(tree, nodes, size)`` adds up all rows, ``advance(grown)`` moves them on."""
    size = max(map(len, cuts)) + 1
    inner, grown = 2 ** depth - 1, []
    for turn in range(rounds):
        # Of features that split alike, the last is taken; each round the order begins one further on.
        order = np.roll(np.arange(len(cuts))[::-1], turn)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        tree = Grown(feature, np.full(inner, size, np.int64), np.zeros(inner + 1))
        for level in range(depth):
            nodes = 2 ** level
            n, g, h = np.cumsum(sums(tree, nodes, size), axis=-1)
            g, h = g / SCALE, h / SCALE
            left = g[..., :-1] ** 2 / (h[..., :-1] + l2)
            right = (g[..., -1:] - g[..., :-1]) ** 2 / (h[..., -1:] - h[..., :-1] + l2)
            gain = left + right - g[..., -1:] ** 2 / (h[..., -1:] + l2)
            gain = np.where((n[..., :-1] > 0) & (n[..., :-1] < n[..., -1:]), gain, -np.inf)
            for k in range(nodes):
                f, c = np.unravel_index(gain[order, k].argmax(), gain[:, k].shape)
                f = order[f]
                at, found = nodes - 1 + k, gain[f, k, c] > 1e-9
                if found:
                    feature[at], cut[at], tree.split[at] = f, cuts[f][c], c + 1
                if level == depth - 1:
                    whole = g[f, k, -1], h[f, k, -1]
                    below = (g[f, k, c], h[f, k, c]) if found else whole
                    tree.leaf[2 * k] = -rate * below[0] / (below[1] + l2)
                    tree.leaf[2 * k + 1] = -rate * (whole[0] - below[0]) / (whole[1] - below[1] + l2)
        grown.append(tree)
        model.trees.append(Tree(feature, cut, tree.leaf))
        advance(grown)
    return model


def _start(ones: float, count: float) -> Boosted:
    prior = (ones + 1.0) / (count + 2.0)
    return Boosted(float(np.log(prior / (1 - prior))))


def fit(x: np.ndarray, y: np.ndarray, n: np.ndarray | None = None, rounds: int = 60, depth: int = 4,
        rate: float = 0.3, l2: float = 1.0, bins: int = 16) -> Boosted:
    """Second-order boosting of the logistic loss; cuts are feature quantiles.
    Row k counts ``n[k]`` times (once, if there is no ``n``)."""
    n = np.ones(len(y)) if n is None else np.asarray(n, float)
    model = _start((y * n).sum(), n.sum())
    if len(set(y.tolist())) < 2:
        return model
    cuts = _cuts(x, n, bins)
    block = _block(x, y, n, cuts, model.base)

    def advance(grown: list[Grown]):
        nonlocal block
        block = block.after(grown[-1:])

    return _boost(model, cuts, lambda *of: block.sums(*of), advance, rounds, depth, rate, l2)


def fit_spread(rows: DataFrame, rounds: int = 60, depth: int = 4, rate: float = 0.3, l2: float = 1.0,
               bins: int = 16) -> Boosted:
    """The trees of ``fit`` for any number of rows ``x`` (array), ``y``, ``n``: rows stay
    on the executors, which send their sums, a job a level."""
    count, ones, size, width = rows.agg(F.sum("n"), F.sum(F.col("y") * F.col("n")), F.count("y"),
                                        F.max(F.size("x"))).first()
    model = _start(ones or 0, count or 0)
    base = model.base
    if not ones or ones == count:
        return model
    at = [float(k) for k in np.arange(bins) / bins]
    cuts = [np.unique(c) for c in rows.agg(*[F.percentile(F.col("x")[f], at, F.col("n")).alias(f"c{f}")
                                             for f in range(width)]).first()]

    def blocks(part: Iterator) -> Iterator[Block]:
        some = list(part)
        for k in range(0, len(some), BLOCK):
            yield _block(*(np.array(c, float) for c in zip(*some[k:k + BLOCK])), cuts, base)

    first = rows.select("x", "y", "n").repartition(-(-size // BLOCK)).rdd.mapPartitions(blocks)
    first = first.persist(StorageLevel.MEMORY_AND_DISK)
    state = first

    def advance(grown: list[Grown]):
        nonlocal state
        if state is not first:
            state.unpersist()
        made = list(grown)     # from the first blocks, so that nothing hangs on a chain of rounds
        state = first.map(lambda b: b.after(made)).persist(StorageLevel.MEMORY_AND_DISK)

    def sums(*of) -> np.ndarray:
        return state.map(lambda b: b.sums(*of)).treeReduce(np.add)

    try:
        return _boost(model, cuts, sums, advance, rounds, depth, rate, l2)
    finally:
        state.unpersist()
        first.unpersist()
