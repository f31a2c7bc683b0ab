"""Gradient-boosted trees on blocks (M6).

Parameters, split candidates, gains, stopping rules and the log loss are ``GBTClassifier``'s, and the fitted model is an
MLlib ``GBTClassificationModel``; tests hold its trees to MLlib's. Only the passes differ: a block keeps each row's
bins, label and margin as arrays, a pass counts a level's nodes by bins, and tasks send sums by (node, slot), which one
task each turns into the best split. The driver sees one split a node and slot.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.base import _FitMultipleIterator
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame

from .blocks import STORED, blocks, slots

REDUCED = 16 << 20   # bytes of tasks' sums that one task adds up
EPS = float(np.finfo(float).eps)   # MLlib takes a node with less impurity for pure


# ------------------------------------------------------------ split candidates and bins
def _values(continuous, fraction, seed):
    """Counted distinct values of each continuous slot, by slot."""
    def of(index, part):
        rng, seen = np.random.default_rng([seed, index]), {}
        for _, x in part:
            if fraction < 1.0:
                x = x[rng.random(len(x)) < fraction]
            for f in continuous:
                seen.setdefault(f, []).append(np.unique(x[:, f], return_counts=True))
        return [(f, _merged(*zip(*got))) for f, got in seen.items()]
    return of


def _merged(values, counts):
    v, inverse = np.unique(np.concatenate(values), return_inverse=True)
    return v, np.bincount(inverse, weights=np.concatenate(counts), minlength=len(v))


def thresholds(values, counts, most: int, stride: float):
    """At most ``most`` split points between sorted distinct values: all of them, or those nearest to multiples of ``stride`` rows."""
    if len(values) - 1 <= most:
        return (values[:-1] + values[1:]) / 2.0
    total = np.cumsum(counts)
    both = total[:-1] + total[1:]   # beyond twice the target, the value before is nearer to it
    at, target = [], stride
    i = 0
    while True:
        i = max(i, int(np.searchsorted(both, 2.0 * target, side="right")))
        if i >= len(both):
            return (values[at] + values[np.array(at, dtype=int) + 1]) / 2.0
        at.append(i)
        i, target = i + 1, target + stride


def packs(bins, most: int = 4096) -> list[list[int]]:
    """Slots counted together, by the tuple of their bins: the narrow ones, as long as the product of their bins is at most ``most``."""
    out, product = [], most + 1
    for f in sorted(range(len(bins)), key=lambda f: (bins[f], f)):
        product *= bins[f]
        if product > most:
            out.append([])
            product = bins[f]
        out[-1].append(f)
    return out


def _binned(splits, arity, kind, models, bins):
    """(bins by slot and then by pack of several slots, labels as -1 and 1, margins by model) of a block."""
    several = [p for p in packs(bins) if len(p) > 1]

    def of(block):
        y, x = block
        b = np.zeros((x.shape[1] + len(several), len(y)), dtype=kind)
        for f in range(x.shape[1]):
            if f in arity:
                if len(y) and not (x[:, f].min() >= 0 and x[:, f].max() < arity[f]):
                    raise ValueError(f"slot {f} has values outside its {arity[f]} categories")
                b[f] = x[:, f]
            else:
                b[f] = np.searchsorted(splits[f], x[:, f], side="left")
        for i, p in enumerate(several, x.shape[1]):
            for f in p:
                b[i] = b[i] * bins[f] + b[f]
        return b, (2 * y - 1).astype(np.int8), np.zeros((models, len(y)))
    return of


# ------------------------------------------------------------ trees
@dataclass
class Tree:
    """Nodes by number, the root is 0: (count, sum, sum of squares), and for inner ones the gain, slot, bins on the left and children."""
    stats: list = field(default_factory=list)
    split: dict = field(default_factory=dict)

    def walker(self, bins):
        """Arrays that lead a row from node to node; a leaf leads to itself."""
        n, most = len(self.stats), max(bins)
        slot, at, left, right = np.zeros(n, dtype=np.intp), np.zeros(n, dtype=np.intp), np.arange(n), np.arange(n)
        tables, end = [np.zeros(most, dtype=bool)], most
        for k, (_, f, goes_left, a, b) in self.split.items():
            slot[k], at[k], left[k], right[k] = f, end, a, b
            tables.append(goes_left)
            end += len(goes_left)
        return slot, at, left, right, np.concatenate(tables), self.depth()

    def depth(self, k=0):
        return 1 + max(self.depth(self.split[k][3]), self.depth(self.split[k][4])) if k in self.split else 0

    def means(self):
        return np.array([s / max(c, 1) for c, s, _ in self.stats])


def _node(walker, b):
    """The node that each row of a block arrives at."""
    slot, at, left, right, table, depth = walker
    rows = np.arange(b.shape[1])
    node = np.zeros(b.shape[1], dtype=np.intp)
    for _ in range(depth):
        node = np.where(table[at[node] + b[slot[node], rows]], left[node], right[node])
    return node


def _residual(y, margin, first):
    if first:
        return y.astype(float)
    with np.errstate(over="ignore"):
        return 4.0 * y / (1.0 + np.exp(2.0 * y * margin))


def _counted(walkers, nodes, bins, first):
    """((place of the (model, node) in ``nodes``) * slots + slot, (count, sum, sum of squares) by bins) over a task's rows."""
    together, row = [], len(bins)   # (slots, their row in a block, bins)
    for p in packs(bins):
        together.append((p, row if len(p) > 1 else p[0], int(np.prod([bins[f] for f in p]))))
        row += len(p) > 1

    def of(part):
        by_model = {}
        for i, (m, k) in enumerate(nodes):
            by_model.setdefault(m, []).append((i, k))
        sums = {m: [np.zeros((3, len(ks) * n)) for _, _, n in together] for m, ks in by_model.items()}
        for bs, y, margins in part:
            for m, ks in by_model.items():
                place = np.full(len(walkers[m][0]), -1, dtype=np.intp)
                place[[k for _, k in ks]] = np.arange(len(ks))
                b, r = bs, _residual(y, margins[m], first)
                if walkers[m][5]:
                    at = place[_node(walkers[m], b)]
                    here = np.flatnonzero(at >= 0)
                    if len(here) < len(at):
                        b, at, r = b[:, here], at[here], r[here]
                rr = r * r
                for g, (_, at_row, n) in enumerate(together):
                    key = b[at_row] if len(ks) == 1 else at * n + b[at_row]
                    for i, w in enumerate((None, r, rr)):
                        sums[m][g][i] += np.bincount(key, weights=w, minlength=len(ks) * n)
        for m, ks in by_model.items():
            for g, (p, _, _) in enumerate(together):
                joint = sums[m][g].reshape(3, len(ks), *[bins[f] for f in p])
                for axis, f in enumerate(p, 2):
                    own = joint.sum(axis=tuple(a for a in range(2, joint.ndim) if a != axis))
                    for j, (i, _) in enumerate(ks):
                        yield i * len(bins) + f, own[:, j]
    return of


def best_split(stats, ordered: bool, least_rows: int, least_weight: float, least_gain: float):
    """(gain, bins on the left, statistics of the left, of the right side, of the node) of one node and slot by its bins'
    statistics; the gain is that of variance, None without a valid split. Categories are ordered by their mean."""
    whole = stats.sum(axis=1)
    if ordered:
        with np.errstate(divide="ignore", invalid="ignore"):
            order = np.argsort(np.where(stats[0] > 0, stats[1] / stats[0], np.inf), kind="stable")
    else:
        order = np.arange(stats.shape[1])
    left = np.cumsum(stats[:, order], axis=1)[:, :-1]
    right = whole[:, None] - left
    ok = (left[0] >= max(least_rows, least_weight)) & (right[0] >= max(least_rows, least_weight))
    if not ok.any():
        return None, None, None, None, whole
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = _impurity(whole) - left[0] / whole[0] * _impurity(left) - right[0] / whole[0] * _impurity(right)
    gain = np.where(ok & (gain >= least_gain), gain, -np.inf)
    i = int(np.argmax(gain))
    if gain[i] == -np.inf:
        return None, None, None, None, whole
    goes_left = np.zeros(stats.shape[1], dtype=bool)
    goes_left[order[:i + 1]] = True
    return float(gain[i]), goes_left, left[:, i], right[:, i], whole


def _impurity(s):
    return (s[2] - s[1] * s[1] / s[0]) / s[0]


def grow(rows, bins, arity, first: bool, models: list[dict]) -> list[Tree]:
    """A regression tree on the residuals of each model, all of them level by level in the same passes; a pass takes as many
    nodes as the models' least ``memory_mb`` has room for."""
    trees, depth, width = [Tree([None]) for _ in models], 0, len(bins)
    node_bytes, parts = 24 * sum(bins), rows.getNumPartitions()
    room = max(1, (min(m["memory_mb"] for m in models) << 20) // node_bytes)
    active = [(m, 0) for m in range(len(models))]
    while active:
        walkers, found = [t.walker(bins) for t in trees], {}
        for i in range(0, len(active), room):
            nodes = active[i:i + room]

            def chosen(item, nodes=nodes):
                key, stats = item
                m = models[nodes[key // width][0]]
                return key, best_split(stats, key % width in arity, m["least_rows"], m["least_weight"], m["least_gain"])

            reducers = min(parts, -(-parts * len(nodes) * node_bytes // REDUCED), len(nodes) * width)
            sums = rows.mapPartitions(_counted(walkers, nodes, bins, first)).reduceByKey(np.add, reducers, int)
            for key, got in sorted(sums.map(chosen).collect(), key=lambda x: x[0]):
                found.setdefault(nodes[key // width], []).append((key % width, got))
        following = []
        for (m, k), options in found.items():
            tree = trees[m]
            if tree.stats[k] is None:
                tree.stats[k] = options[0][1][4]
            f, (gain, goes_left, left, right, _) = max(options, key=lambda x: (-np.inf if x[1][0] is None else x[1][0], -x[0]))
            if gain is None or gain <= 0 or depth == models[m]["max_depth"]:
                continue
            tree.split[k] = (gain, f, goes_left, len(tree.stats), len(tree.stats) + 1)
            for side in (left, right):
                if depth + 1 < models[m]["max_depth"] and abs(_impurity(side)) >= EPS:
                    following.append((m, len(tree.stats)))
                tree.stats.append(side)
        active, depth = following, depth + 1
    return trees


def _boosted(walkers, means, weights):
    def of(block):
        b, y, margins = block
        return b, y, margins + np.stack([w * v[_node(walker, b)] for walker, v, w in zip(walkers, means, weights)])
    return of


# ------------------------------------------------------------ the fitted model as MLlib's
class _Java:
    """MLlib's tree classes over the gateway. Names are looked up once, arrays of one tree come from one buffer: every call is a round trip."""

    def __init__(self, sc):
        ml, self.jvm, self.new_array = sc._jvm.org.apache.spark.ml, sc._jvm, sc._gateway.new_array
        self.double, self.wrap, self.order = sc._jvm.double, sc._jvm.java.nio.ByteBuffer.wrap, sc._jvm.java.nio.ByteOrder.LITTLE_ENDIAN
        self.leaf, self.inner, self.categorical, self.continuous = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.CategoricalSplit, ml.tree.ContinuousSplit
        self.calculator = sc._jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
        self.regression, self.boosted = ml.regression.DecisionTreeRegressionModel, ml.classification.GBTClassificationModel

    def arrays(self, lists):
        """A Java array of doubles for each list."""
        data = np.concatenate([np.asarray(x, dtype="<f8") for x in lists])
        buffer = self.wrap(data.tobytes()).order(self.order).asDoubleBuffer()
        for x in lists:
            a = self.new_array(self.double, len(x))
            buffer.get(a)
            yield a

    def tree(self, t: Tree, uid, width, splits, arity):
        stats = list(self.arrays(t.stats))
        nominal = [k for k, s in t.split.items() if s[1] in arity]
        sets = dict(zip(nominal, self.arrays([np.flatnonzero(t.split[k][2]) for k in nominal]))) if nominal else {}

        def node(k):
            c, s, _ = t.stats[k]
            mean, impurity, calc = float(s / c), float(_impurity(t.stats[k])), self.calculator(stats[k], int(c))
            if k not in t.split:
                return self.leaf(mean, impurity, calc)
            gain, f, goes_left, a, b = t.split[k]
            split = self.categorical(f, sets[k], arity[f]) if f in arity else self.continuous(f, float(splits[f][int(goes_left.sum()) - 1]))
            return self.inner(mean, impurity, gain, node(a), node(b), split, calc)
        return self.regression(uid, node(0), width)

    def model(self, uid, trees, weights, width, splits, arity):
        a = self.new_array(self.regression, len(trees))
        for i, t in enumerate(trees):
            a[i] = self.tree(t, f"{uid}_tree_{i}", width, splits, arity)
        return self.boosted(uid, a, next(self.arrays([weights])), width, 2)


class _Rows:
    """The stored blocks of a training frame, their number of rows and the split candidates by number of bins."""

    def __init__(self, df: DataFrame, features: str, label: str):
        self.df, self.lock, self.splits = df, threading.Lock(), {}
        self.width, self.arity = slots(df, features)
        self.blocks = blocks(df, features, label).persist(STORED)
        self.n = self.blocks.map(lambda b: len(b[0])).sum()

    def candidates(self, bins: int, seed: int):
        """{continuous slot: thresholds}: from all rows, or as in MLlib from max(bins^2, 10,000) of them."""
        with self.lock:
            if bins not in self.splits:
                continuous = [f for f in range(self.width) if f not in self.arity]
                fraction = min(1.0, max(bins * bins, 10_000) / self.n)
                counted = self.blocks.mapPartitionsWithIndex(_values(continuous, fraction, seed % (1 << 32)))
                merged = counted.reduceByKey(lambda a, b: _merged(*zip(a, b)), max(1, len(continuous)), int)
                got = dict(merged.mapValues(lambda vc: thresholds(*vc, bins - 1, vc[1].sum() / bins)).collect())
                self.splits[bins] = {f: got.get(f, np.zeros(0)) for f in continuous}
            return self.splits[bins]

    def release(self):
        self.blocks.unpersist()


class BlockGBTClassifier(GBTClassifier):
    """``GBTClassifier`` on blocks. Row weights, a validation column, subsampling of rows or slots stay MLlib's."""

    def _plain(self) -> bool:
        told = any(self.isDefined(p) and self.getOrDefault(p) for p in (self.weightCol, self.validationIndicatorCol))
        return not told and self.getSubsamplingRate() == 1.0 and self.getFeatureSubsetStrategy() in ("all", "auto", "1.0")

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        if not self._plain():
            return super()._fit(dataset)
        rows = _Rows(dataset, self.getFeaturesCol(), self.getLabelCol())
        try:
            return _boost([self], rows, alone=True)[0]
        finally:
            rows.release()

    def fitMultiple(self, dataset: DataFrame, paramMaps):
        """The fits of a grid read one set of blocks, released when the last has ended; those with the same bins, number of
        trees and seed grow in the same passes."""
        made = [self.copy(m) for m in paramMaps]
        if not all(e._plain() and (e.getFeaturesCol(), e.getLabelCol()) == (self.getFeaturesCol(), self.getLabelCol()) for e in made):
            return super().fitMultiple(dataset, paramMaps)
        rows, groups, lock, left = _Rows(dataset, self.getFeaturesCol(), self.getLabelCol()), {}, threading.Lock(), [len(made)]
        for i, e in enumerate(made):
            groups.setdefault((e.getMaxBins(), e.getMaxIter(), e.getSeed()), []).append(i)
        of = {i: key for key, members in groups.items() for i in members}
        locks, models = {key: threading.Lock() for key in groups}, {}

        def one(i):
            try:
                with locks[of[i]]:
                    if i not in models:
                        members = groups[of[i]]
                        models.update(zip(members, _boost([made[j] for j in members], rows)))
                return models[i]
            finally:
                with lock:
                    left[0] -= 1
                    if not left[0]:
                        rows.release()
        return _FitMultipleIterator(one, len(made))


def _boost(fits: list[BlockGBTClassifier], rows: _Rows, alone: bool = False) -> list[GBTClassificationModel]:
    """The models of estimators with the same bins, number of trees and seed."""
    lead = fits[0]
    if not rows.n:
        raise ValueError("no rows to fit")
    most = min(lead.getMaxBins(), rows.n)
    over = {f: n for f, n in rows.arity.items() if n > most}
    if over:
        raise ValueError(f"maxBins {most} is below the number of categories of slots {over}")
    splits = rows.candidates(most, lead.getSeed())
    bins = [rows.arity[f] if f in rows.arity else len(splits[f]) + 1 for f in range(rows.width)]
    told = [{"max_depth": e.getMaxDepth(), "least_rows": e.getMinInstancesPerNode(), "least_weight": e.getMinWeightFractionPerNode() * rows.n,
             "least_gain": e.getMinInfoGain(), "memory_mb": e.getMaxMemoryInMB()} for e in fits]
    kind = np.uint16 if max(bins) <= 1 << 16 else np.uint32
    state, old, forests = rows.blocks.map(_binned(splits, rows.arity, kind, len(fits), bins)).persist(STORED), None, []
    try:
        for t in range(lead.getMaxIter()):
            weights = [e.getStepSize() if t else 1.0 for e in fits]
            if t:
                last = forests[-1][0]
                old, state = state, state.map(_boosted([x.walker(bins) for x in last], [x.means() for x in last], forests[-1][1])).persist(STORED)
            forests.append((grow(state, bins, rows.arity, not t, told), weights))
            if old:
                old.unpersist()
            elif alone:
                rows.release()   # the bins are stored now
    finally:
        for x in (old, state):
            if x:
                x.unpersist()
    java = _Java(rows.df.sparkSession.sparkContext)
    return [e._copyValues(GBTClassificationModel(java.model(e.uid, [f[0][i] for f in forests], [f[1][i] for f in forests], rows.width, splits, rows.arity)))
            for i, e in enumerate(fits)]
