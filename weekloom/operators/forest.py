"""A random forest and boosted trees of two classes on binned rows: histograms in tasks, sums and splits by Spark.

The methods are MLlib's (``tests/test_forest.py`` holds a tree and boosted rounds against MLlib's). Forest: up to
``max_bins`` bins an input, a Poisson(1) bootstrap for each tree, a new choice of inputs for every
node, the split of largest Gini gain, one pass over the rows a level for all trees, and two leaves
of one parent that predict the same class joined. What differs is how a pass works. MLlib keeps
``trees`` sample counts with every row and adds row by row to the nodes of all trees; here a row is
one byte an input in blocks of ``BLOCK`` rows, its sample counts are drawn again in each pass from
the seed, the block and the tree, and a block is counted tree by tree with numpy, so that the counts
at hand stay in the processor's cache. Split points come from a summary of all rows.

Boosted trees: the first tree fits the labels -1 and 1, each later one, of weight ``STEP``, the negative
slope of the loss 2 ln(1 + exp(-2 y F)); splits of largest fall of the variance among all inputs. A block
carries the margins F of its rows, renewed once a round.
"""

from __future__ import annotations

from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.sql import DataFrame, functions as F

from weekloom.staging import stage

#: Rows of a block, and blocks that one task of a pass reads at most.
BLOCK = 65_536
TASK_BLOCKS = 64
#: Rows that are summarised together, and the points of a summary of one input of them.
CHUNK, POINTS = 262_144, 1024


def _matrix(batches, size: int):
    """``(x, y)`` of up to ``size`` rows each, from Arrow batches with columns ``x`` and ``y``."""
    xs, ys, have = [], [], 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        x, y = batch.column("x"), batch.column("y")
        flat = x.flatten().to_numpy(zero_copy_only=False)
        if x.null_count or y.null_count or not np.all((y := y.to_numpy()) * (y - 1) == 0) or np.isnan(flat).any():
            raise ValueError("a forest takes labels 0 and 1 and vectors without null or NaN")
        x = flat.reshape(batch.num_rows, -1)
        while have + len(y) >= size:
            cut = size - have
            yield np.concatenate([*xs, x[:cut]]), np.concatenate([*ys, y[:cut]])
            xs, ys, have, x, y = [], [], 0, x[cut:], y[cut:]
        if len(y):
            xs, ys, have = [*xs, x], [*ys, y], have + len(y)
    if have:
        yield np.concatenate(xs), np.concatenate(ys)


def _summary(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their counts; of over ``POINTS`` only those at equal steps of rank, with what lies between."""
    points, n = np.unique(values, return_counts=True)
    if len(points) > POINTS:
        upto = np.cumsum(n)
        at = np.unique(np.searchsorted(upto, np.linspace(0, len(values), POINTS + 1)[1:]))
        points, n = points[at], np.diff(upto[at], prepend=0)
    return points, n


def split_points(points: np.ndarray, n: np.ndarray, most: int) -> np.ndarray:
    """MLlib's thresholds: the middle between all neighbouring values, or up to ``most`` at equal steps of the counts."""
    points, place = np.unique(points, return_inverse=True)
    n = np.bincount(place, weights=n)
    middle = (points[:-1] + points[1:]) / 2
    if len(middle) <= most:
        return middle
    step = n.sum() / (most + 1)
    found, target, upto = [], step, np.cumsum(n)
    for i in range(len(middle)):
        if abs(upto[i] - target) < abs(upto[i + 1] - target):
            found.append(middle[i])
            target += step
            if len(found) == most:
                break
    return np.array(found)


def thresholds(rows: DataFrame, most: int) -> list[np.ndarray]:
    """Split points of every input of the rows ``(x, y)``; only these reach the driver."""

    def summaries(batches):
        for x, _ in _matrix(batches, CHUNK):
            found = [_summary(x[:, j]) for j in range(x.shape[1])]
            yield pa.RecordBatch.from_pydict({
                "input": pa.array(range(len(found)), pa.int32()),
                "points": pa.array([p.tobytes() for p, _ in found], pa.binary()),
                "n": pa.array([n.astype(np.int64).tobytes() for _, n in found], pa.binary())})

    def merged(key, table):
        points, n = (np.concatenate([np.frombuffer(b.as_buffer(), t) for b in table.column(c)]) for c, t in (("points", "f8"), ("n", "i8")))
        return pa.table({"input": pa.array([key[0].as_py()], pa.int32()), "at": pa.array([split_points(points, n, most).tobytes()], pa.binary())})

    parts = rows.mapInArrow(summaries, "input int, points binary, n binary")
    found = parts.groupBy("input").applyInArrow(merged, "input int, at binary").collect()
    return [np.frombuffer(r["at"], "f8") for r in sorted(found, key=lambda r: r["input"])]


def blocks(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """``(block, y, bins)``: labels and bins (row by row, a byte an input) of the rows ``(x, y)`` in their layout."""

    def packed(batches):
        part = TaskContext.get().partitionId()
        for k, (x, y) in enumerate(_matrix(batches, BLOCK)):
            bins = np.empty(x.shape, np.uint8)
            for j, cut in enumerate(cuts):
                bins[:, j] = np.searchsorted(cut, x[:, j])
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([(part << 32) + k], pa.int64()), "y": pa.array([y.astype(np.uint8).tobytes()], pa.binary()),
                "bins": pa.array([bins.tobytes()], pa.binary())})

    return rows.mapInArrow(packed, "block long, y binary, bins binary")


def _poisson_table() -> np.ndarray:
    """The Poisson(1) count of each of 65,536 equally likely draws."""
    upto, p, k = [], float(np.exp(-1)), 0
    while not upto or upto[-1] < 1 - 2**-17:
        upto.append((upto[-1] if upto else 0.0) + p)
        k += 1
        p /= k
    return np.searchsorted(upto, (np.arange(65_536) + 0.5) / 65_536).astype(np.uint8)


def _at_level(flat: np.ndarray, rows: tuple, feature: np.ndarray, place: np.ndarray, level: int) -> tuple[np.ndarray, tuple]:
    """The node of a level, from 0, of each row that comes so far, and ``rows`` (arrays of one length, the first with starts) of these."""
    node = np.zeros(len(rows[0]), np.int64)
    for d in range(level):
        own, cut = (v[(1 << d) - 1 : (2 << d) - 1] for v in (feature, place))
        at = own.take(node)
        if (own < 0).any():  # a leaf
            on = np.flatnonzero(at >= 0)
            node, at, rows = node.take(on), at.take(on), tuple(r.take(on) for r in rows)
        at += rows[0]
        after = flat.take(at) > cut.take(node)
        node += node
        node += after
    return node, rows


def _splits(counts: np.ndarray) -> np.ndarray:
    """For each node slot, place and gain of its best split, then its rows and those left of it by class; ``counts`` by (slot, node, class, bin)."""
    left = np.cumsum(counts, axis=3)
    total = left[..., -1:]
    left = left[..., :-1]
    right = total - left
    n, n_left, n_right = total.sum(2), left.sum(2), right.sum(2)
    with np.errstate(divide="ignore", invalid="ignore"):
        impurity = lambda c, k: 1.0 - ((c / k[:, :, None]) ** 2).sum(2)
        gain = impurity(total, n) - n_left / n * impurity(left, n_left) - n_right / n * impurity(right, n_right)
    gain = np.where((n_left >= 1) & (n_right >= 1), gain, -1.0)
    _, nodes, places = gain.shape
    flat = gain.transpose(1, 0, 2).reshape(nodes, -1)
    best = flat.argmax(1)
    slot, place = best // places, best % places
    at = np.arange(nodes)
    return np.column_stack([slot, place, flat[at, best], total[0, :, :, 0], left[slot, at, :, place]])


def _level(table: DataFrame, level: int, feature, place, active, chosen, bins: int, seed: int, bootstrap: bool) -> dict[int, np.ndarray]:
    """``_splits`` of every node of a level, by tree: one pass over the blocks."""
    trees, nodes, slots = chosen.shape
    inputs_at = np.ascontiguousarray(chosen.transpose(0, 2, 1)).astype(np.int64)
    width = nodes * 2 * bins
    place, draws = place.astype(np.uint8), _poisson_table()

    def counted(batches):
        sums = None
        for batch in batches:
            for block, y, packed in zip(*(batch.column(c) for c in ("block", "y", "bins")), strict=True):
                sums = np.zeros((trees, slots, width)) if sums is None else sums
                y = np.frombuffer(y.as_buffer(), np.uint8) * np.int64(bins)
                flat = np.frombuffer(packed.as_buffer(), np.uint8)
                starts = np.arange(len(y)) * (len(flat) // len(y))
                for t in np.flatnonzero(active.any(1)):
                    rows = starts, y
                    if bootstrap:
                        n = draws.take(np.random.Generator(np.random.SFC64([seed, block.as_py(), t])).integers(0, 65_536, len(y), np.uint16))
                        kept = np.flatnonzero(n != 0)
                        rows = starts.take(kept), y.take(kept), n.take(kept).astype(np.float64)
                    node, rows = _at_level(flat, rows, feature[t], place[t], level)
                    if not active[t].all():
                        on = np.flatnonzero(active[t].take(node))
                        node, rows = node.take(on), tuple(r.take(on) for r in rows)
                    cell = node * (2 * bins) + rows[1]
                    for s in range(slots):
                        found = flat.take(inputs_at[t, s].take(node) + rows[0])
                        sums[t, s] += np.bincount(cell + found, rows[2] if bootstrap else None, width)
        for t in np.flatnonzero(active.any(1)) if sums is not None else ():
            yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "counts": pa.array([sums[t].tobytes()], pa.binary())})

    def best(key, table):
        total = np.zeros(slots * width)
        for counts in table.column("counts"):
            total += np.frombuffer(counts.as_buffer(), "f8")
        return pa.table({"tree": pa.array([key[0].as_py()], pa.int32()),
                         "found": pa.array([_splits(total.reshape(slots, nodes, 2, bins)).tobytes()], pa.binary())})

    parts = table.mapInArrow(counted, "tree int, counts binary")
    rows = parts.groupBy("tree").applyInArrow(best, "tree int, found binary").collect()
    return {r["tree"]: np.frombuffer(r["found"], "f8").reshape(nodes, -1) for r in rows}


def _table(dataset: DataFrame, features: str, label: str, max_bins: int, a_core: int) -> tuple[DataFrame, list[np.ndarray]]:
    """The blocks of the rows, in as many partitions as a pass has tasks (``a_core`` or more for each core), and the split points."""
    rows = dataset.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    cuts = thresholds(rows, min(max_bins, 256) - 1)
    if not cuts:
        raise ValueError("a fit needs rows")
    table = stage(blocks(rows, cuts), "blocks")
    n = table.count()
    return table.repartition(min(n, max(a_core * dataset.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_BLOCKS)))), cuts


def _below_leaves(feature: np.ndarray, value: np.ndarray) -> np.ndarray:
    """``value`` by (tree, node) with what lies below a leaf as the leaf, so that every row can go all the way down."""
    value = value.copy()
    for node in range(feature.shape[1]):
        for child in (2 * node + 1, 2 * node + 2):
            value[:, child] = np.where(feature[:, node] < 0, value[:, node], value[:, child])
    return value


class Forest(Estimator, HasFeaturesCol, HasLabelCol):
    """Trees of up to ``depth`` levels on the vectors of ``features_col``; the layout of the rows and the seed fix the fit."""

    def __init__(self, features_col: str = "features", trees: int = 20, depth: int = 5, max_bins: int = 32,
                 inputs: int | None = None, bootstrap: bool = True, seed: int = 0):
        super().__init__()
        self._set(featuresCol=features_col, labelCol="label")
        self.trees, self.depth, self.max_bins = trees, depth, max_bins
        #: Inputs that a node may split on; by default the root of their number, or all for one tree, as in MLlib.
        self.inputs, self.bootstrap, self.seed = inputs, bootstrap, seed

    def _fit(self, dataset: DataFrame) -> ForestModel:
        table, cuts = _table(dataset, self.getFeaturesCol(), self.getLabelCol(), self.max_bins, 2)
        table = table.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return ForestModel(self.getFeaturesCol(), cuts, *self._grown(table, cuts))
        finally:
            table.unpersist()

    def _grown(self, table: DataFrame, cuts: list[np.ndarray]):
        trees, inputs = self.trees, len(cuts)
        wanted = min(inputs, self.inputs or (ceil(sqrt(inputs)) if trees > 1 else inputs))
        bins = max(2, 1 + max(len(c) for c in cuts))
        inner = (1 << self.depth) - 1
        feature, place = np.full((trees, inner), -1), np.zeros((trees, inner), np.int64)
        gain, counts = np.zeros((trees, inner)), np.zeros((trees, 2 * inner + 1, 2))
        active = np.ones((trees, 1), bool)
        draw = np.random.default_rng(self.seed)
        for level in range(self.depth):
            nodes, first = 1 << level, (1 << level) - 1
            chosen = np.sort(draw.random((trees, nodes, inputs)).argsort(2)[:, :, :wanted], 2)
            if not active.any():
                break
            found = _level(table, level, feature, place, active, chosen, bins, self.seed, self.bootstrap)
            after = np.zeros((trees, 2 * nodes), bool)
            for t, rows in found.items():
                slot, at, best, total, left = rows[:, 0].astype(int), rows[:, 1], rows[:, 2], rows[:, 3:5], rows[:, 5:7]
                if level == 0:
                    counts[t, 0] = total[0]
                for i in np.flatnonzero(active[t] & (best > 0)):
                    node = first + i
                    feature[t, node], place[t, node], gain[t, node] = chosen[t, i, slot[i]], at[i], best[i]
                    counts[t, 2 * node + 1], counts[t, 2 * node + 2] = left[i], total[i] - left[i]
                    # a node of one class is a leaf
                    after[t, 2 * i : 2 * i + 2] = [left[i].min() > 0, (total[i] - left[i]).min() > 0]
            active = after
        return feature, place, gain, counts


class _Trees(Model, HasFeaturesCol):
    """Trees as arrays by node: the children of node i are 2 i + 1 and 2 i + 2; ``feature`` is -1 at a leaf."""

    def __init__(self, features_col: str, cuts: list[np.ndarray], feature: np.ndarray, place: np.ndarray, value: np.ndarray):
        super().__init__()
        self._set(featuresCol=features_col)
        self.feature, self.value = feature, value
        self.threshold = np.full(feature.shape, np.inf)
        for j, cut in enumerate(cuts):
            own = feature == j
            self.threshold[own] = cut[place[own]]

    def _summed(self, dataset: DataFrame, name: str) -> DataFrame:
        """``dataset`` with the sum of the values of its rows' leaves."""
        trees, inner = self.feature.shape
        depth = (inner + 1).bit_length() - 1
        last = _below_leaves(self.feature, self.value)[:, inner:]
        feature, threshold = np.maximum(self.feature, 0), self.threshold

        @F.arrow_udf("double")
        def summed(x: pa.Array) -> pa.Array:
            flat = x.flatten().to_numpy(zero_copy_only=False)
            starts = np.arange(len(x)) * (len(flat) // max(1, len(x)))
            total = np.zeros(len(x))
            for t in range(trees):
                node = np.zeros(len(x), np.int64)
                for _ in range(depth):
                    node = 2 * node + 1 + (flat.take(feature[t].take(node) + starts) > threshold[t].take(node))
                total += last[t].take(node - inner)
            return pa.array(total)

        return dataset.withColumn(name, summed(vector_to_array(self.getFeaturesCol())))


class ForestModel(_Trees):
    """Each tree gives the class shares of the leaf; two leaves of one parent that predict the same class are one."""

    def __init__(self, features_col: str, cuts, feature, place, gain, counts):
        feature, inner = feature.copy(), feature.shape[1]
        leaf = np.ones((len(feature), 2 * inner + 1), bool)
        high = counts[:, :, 1] > counts[:, :, 0]
        for node in range(inner - 1, -1, -1):
            a, b = 2 * node + 1, 2 * node + 2
            feature[leaf[:, a] & leaf[:, b] & (high[:, a] == high[:, b]), node] = -1
            leaf[:, node] = feature[:, node] < 0
        whole = counts.sum(2)
        share = np.divide(counts[:, :, 1], whole, out=np.zeros_like(whole), where=whole > 0)
        super().__init__(features_col, cuts, feature, place, share)
        self.inputs, self.weight = len(cuts), gain * whole[:, :inner]

    @property
    def featureImportances(self) -> DenseVector:
        """Gain times rows of an input's splits, as shares of their tree, averaged over the trees that split."""
        own = np.stack([np.where(self.feature == j, self.weight, 0.0).sum(1) for j in range(self.inputs)], 1)
        whole = own.sum(1, keepdims=True)
        shares = np.divide(own, whole, out=np.zeros_like(own), where=whole > 0).sum(0)
        return DenseVector(shares / shares.sum() if shares.any() else shares)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, high = float(len(self.feature)), F.col("__votes")
        out = self._summed(dataset, "__votes").withColumn("rawPrediction", array_to_vector(F.array(F.lit(trees) - high, high)))
        out = out.withColumn("probability", array_to_vector(F.array(1 - high / trees, high / trees)))
        return out.withColumn("prediction", (high > F.lit(trees) - high).cast("double")).drop("__votes")


#: Weight of every tree but the first, and rounds after which the margins are written to shared storage.
STEP, CHECKPOINT_ROUNDS = 0.1, 10
#: Sums of so many tasks (at most 140 kB each for 17 inputs) are added by the driver, of more by tasks first.
DIRECT_PARTS = 64


def _targets(y: np.ndarray, margin: np.ndarray | None) -> np.ndarray:
    """What the next tree fits: the labels -1 and 1 before there are margins, then the negative slope of the loss."""
    sign = 2.0 * y - 1.0
    # a margin far on the right side overflows to a slope of 0
    with np.errstate(over="ignore"):
        return sign if margin is None else 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin))


def _variance_splits(n: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, ...]:
    """Input, place, gain, and the means of all, left and right rows at each node's best split; ``n``, ``total`` by (input, node, bin)."""
    n_left, s_left = n.cumsum(2), total.cumsum(2)
    n_all, s_all = n_left[:, :, -1:], s_left[:, :, -1:]
    n_left, s_left = n_left[:, :, :-1], s_left[:, :, :-1]
    n_right, s_right = n_all - n_left, s_all - s_left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (s_left**2 / n_left + s_right**2 / n_right - s_all**2 / n_all) / n_all
        means = s_all / n_all, s_left / n_left, s_right / n_right
    gain = np.where((n_left >= 1) & (n_right >= 1), gain, -1.0)
    _, nodes, places = gain.shape
    flat = gain.transpose(1, 0, 2).reshape(nodes, -1)
    best, at = flat.argmax(1), np.arange(nodes)
    own, place = best // places, best % places
    return own, place, flat[at, best], means[0][0, :, 0], means[1][own, at, place], means[2][own, at, place]


def _renewed(rows, tree: tuple[np.ndarray, np.ndarray, np.ndarray], weight: float, depth: int):
    """Blocks ``(y, bins, margins)`` with the margins after one more tree."""
    feature, place, value = tree
    last = weight * _below_leaves(feature[None], value[None])[0, len(feature) :]
    place, feature = np.where(feature < 0, 255, place).astype(np.uint8), np.maximum(feature, 0)
    for y, flat, margin in rows:
        starts = np.arange(len(y)) * (len(flat) // len(y))
        node, _ = _at_level(flat, (starts,), feature, place, depth)
        yield y, flat, last.take(node) + (0.0 if margin is None else margin)


class Boosted(Estimator, HasFeaturesCol, HasLabelCol):
    """Boosted trees of up to ``depth`` levels on the vectors of ``features_col``, one pass over the blocks a level."""

    def __init__(self, features_col: str = "features", rounds: int = 20, depth: int = 5, max_bins: int = 32):
        super().__init__()
        self._set(featuresCol=features_col, labelCol="label")
        self.rounds, self.depth, self.max_bins = rounds, depth, max_bins

    def _fit(self, dataset: DataFrame) -> BoostedModel:
        # 300 short passes, so as few tasks as there are cores
        table, cuts = _table(dataset, self.getFeaturesCol(), self.getLabelCol(), self.max_bins, 1)
        depth, trees, before = self.depth, [], None
        state = table.select("y", "bins").rdd.map(
            lambda r: (np.frombuffer(r["y"], np.uint8), np.frombuffer(r["bins"], np.uint8), None)).persist(StorageLevel.MEMORY_AND_DISK)
        for m in range(self.rounds):
            tree = self._grown(state, cuts)
            trees.append(tree)
            if before is not None:
                before.unpersist()
            if m + 1 < self.rounds:
                weight = 1.0 if m == 0 else STEP
                after = state.mapPartitions(lambda rows, tree=tree, weight=weight: _renewed(rows, tree, weight, depth))
                after = after.persist(StorageLevel.MEMORY_AND_DISK)
                if (m + 1) % CHECKPOINT_ROUNDS == 0:
                    after.checkpoint()
                # the next tree's first pass renews the margins and keeps them
                before, state = state, after
        state.unpersist()
        return BoostedModel(self.getFeaturesCol(), cuts, *(np.stack(v) for v in zip(*trees, strict=True)))

    def _grown(self, state, cuts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Input, place and mean target by node of the next tree; only sums by (input, node, bin) reach the driver."""
        inputs, bins, inner = len(cuts), max(2, 1 + max(len(c) for c in cuts)), (1 << self.depth) - 1
        feature, place, value = np.full(inner, -1), np.zeros(inner, np.uint8), np.zeros(2 * inner + 1)
        active = np.ones(1, bool)
        for level in range(self.depth):
            nodes, first = 1 << level, (1 << level) - 1
            width = nodes * bins

            def counted(rows, level=level, width=width):
                sums = np.zeros((2, inputs, width))
                for y, flat, margin in rows:
                    starts = np.arange(len(y)) * inputs
                    node, (starts, target) = _at_level(flat, (starts, _targets(y, margin)), feature, place, level)
                    cell = node * bins
                    for j in range(inputs):
                        at = cell + (flat[j::inputs] if len(starts) == len(y) else flat.take(starts + j))
                        sums[0, j] += np.bincount(at, None, width)
                        sums[1, j] += np.bincount(at, target, width)
                yield sums

            parts = state.mapPartitions(counted)
            n, total = parts.treeReduce(np.add, 1 if parts.getNumPartitions() <= DIRECT_PARTS else 2).reshape(2, inputs, nodes, bins)
            own, at, gain, mean, left, right = _variance_splits(n, total)
            if level == 0:
                value[0] = mean[0]
            found = np.flatnonzero(active & (gain > 0))
            active = np.zeros(2 * nodes, bool)
            for i in found:
                node = first + i
                feature[node], place[node], value[2 * node + 1], value[2 * node + 2] = own[i], at[i], left[i], right[i]
                active[2 * i : 2 * i + 2] = True
            if not len(found):
                break
        return feature, place, value


class BoostedModel(_Trees):
    """The margin is the sum of the leaves' means, of weight ``STEP`` but for the first tree."""

    def __init__(self, features_col: str, cuts, feature, place, value):
        weight = np.where(np.arange(len(value)) == 0, 1.0, STEP)
        super().__init__(features_col, cuts, feature, place, value * weight[:, None])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        margin = F.col("__margin")
        high = 1 / (1 + F.exp(-2 * margin))
        out = self._summed(dataset, "__margin").withColumn("rawPrediction", array_to_vector(F.array(-margin, margin)))
        out = out.withColumn("probability", array_to_vector(F.array(1 - high, high)))
        return out.withColumn("prediction", (margin > 0).cast("double")).drop("__margin")
