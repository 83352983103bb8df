"""Trees of a whole search grown together, level by level, from histograms.

Features are cut into bins once. Rows that fall into the same bins are alike for every tree,
so they are one unit, with their number per fold and class. All trees of a search, (fold, parameters), grow at
the same time: a job per level sums two weights per (tree, open node, feature, bin). The sums of a
part of the open nodes meet in one task, which picks their splits; the driver gets the splits
alone and sends them back. A job has at most CELLS sums, deeper levels take more jobs.

``grow``: classification trees. Every node keeps its class counts, so a tree of depth 9
holds those of depth 1 to 8. ``Boosting``: second-order boosting of the log loss;
the margins of all models stand beside the units and are written every KEEP rounds, so a
lost executor costs at most that many rounds of its units. Weights are integers (counts, or
gradients in fixed point), so the sums don't depend on partitions or their order.

Defined cases: rows with a null label, fold or feature vector take no part; a label over 0.5 is class 1; NaN counts as
the largest value; rows of fold UNSEEN are scored but learned by no model; without rows a tree
is one node and says class 0. Of equal gains the first feature and the lowest cut win.
"""

from __future__ import annotations

import operator
import pickle
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batched import ALL, few_parts, fold_counts, vectors  # noqa: F401

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module

BINS = 64
UNSEEN = -2  # fold of rows that no model learns from
CELLS = 1 << 20  # sums of one job
PART_ROWS = 2048  # fewer rows than this are not worth a task
UNITS = 8192  # units of one block
CHUNK = 1 << 16  # sums that meet in one task
JOINT = 64  # bins of features that are counted together
KEEP = 10  # rounds between two written states
FIXED = float(1 << 24)  # gradients are multiples of 1 / FIXED
LEAST_GAIN = 1e-10


class Binned:
    """Blocks of (bin codes, tally, margin per model). A unit's tally has its rows by fold (first the
    unseen ones, then fold 0, 1, ...) and class."""

    def __init__(self, df: DataFrame, features: str = "features", label: str = "label", fold: str = "fold",
                 bins: int = BINS, models: int = 0):
        df = df.filter(F.col(features).isNotNull() & F.col(label).isNotNull() & F.col(fold).isNotNull())
        x = vector_to_array(features)
        width = df.select(F.size(x)).head()
        marks = [k / bins for k in range(bins + 1)]
        found = df.select(x.alias("x"), F.col(fold).cast("int").alias("f")).agg(
            F.count("*"), F.max("f"),
            *[F.percentile_approx(F.nanvl(F.col("x")[k], F.lit(float("inf"))), marks) for k in range(width[0] if width else 0)]).first()
        cuts = [np.unique(np.array(c, "float64"))[:-1] for c in found[2:]]
        folds, wide = max(found[1] if found[1] is not None else 0, 0) + 1, max(1, 2 * len(cuts))

        def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = vectors(batch.column("x"))
                codes = [np.searchsorted(c, x[:, k]) for k, c in enumerate(cuts)] or [np.zeros(len(x))]
                raw = np.stack(codes, axis=1).astype("int16").tobytes()
                column = pa.FixedSizeBinaryArray.from_buffers(pa.binary(wide), len(x), [None, pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([column.cast(pa.binary()), batch.column("f"), batch.column("c")], names=["code", "f", "c"])

        def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, count = [], 0

            def out() -> pa.RecordBatch:
                t = pa.Table.from_batches(held)
                codes = np.frombuffer(b"".join(t.column("code").to_pylist()), "int16").reshape(count, -1)[:, :len(cuts)]
                tally = np.array(t.column("tally").to_pylist(), "float64").reshape(count, -1, 2)
                return pa.RecordBatch.from_arrays([pa.array([pickle.dumps((codes, tally))], pa.binary())], names=["block"])

            for batch in batches:
                held, count = held + [batch], count + batch.num_rows
                if count >= UNITS:
                    yield out()
                    held, count = [], 0
            if count:
                yield out()

        self.spark, self.cuts, self.sizes = df.sparkSession, cuts, [len(c) + 1 for c in cuts]
        self._parts = few_parts(self.spark, found[0], PART_ROWS)
        rows = df.select(x.alias("x"), F.col(fold).cast("int").alias("f"), (F.col(label).cast("double") > 0.5).cast("int").alias("c"))
        rows = rows.filter((F.col("f") >= 0) | (F.col("f") == UNSEEN)).mapInArrow(code, "code binary, f int, c int")
        units = rows.groupBy("code").agg(fold_counts(F.col("f"), folds, [F.col("c") == 0, F.col("c") == 1]).alias("tally"))
        blocks = units.repartition(self._parts, "code").mapInArrow(block, "block binary").checkpoint().rdd
        self._depth = 1 if self._parts <= 32 else 2
        self._rows = blocks.map(lambda r: (*pickle.loads(r[0]),))
        self._rdd = self._rows.map(lambda b: (*b, np.zeros((len(b[0]), models)))).persist(StorageLevel.MEMORY_AND_DISK)
        self._older, self._written, self._changes = self._rows, None, 0

    def total(self, fn: Callable, state):
        """Sum over all blocks of ``fn(codes, tally, margins, state)``; 0.0 without blocks."""
        sums = self._rdd.mapPartitions(lambda blocks: [sum((fn(*b, state) for b in blocks), 0.0)])
        if not sums.getNumPartitions():
            return 0.0
        return sums.treeReduce(operator.add, self._depth)

    def chosen(self, state: tuple, nodes: int, pick: Callable) -> list:
        """``pick(nodes, sums)`` of the histogram's open nodes, in some parts; nothing without units."""
        cells = 2 * nodes * sum(self.sizes)
        parts = 1 if self._parts == 1 else max(1, min(self.spark.sparkContext.defaultParallelism, cells // CHUNK))
        cut = np.array_split(np.arange(nodes), parts)

        def sums(blocks):
            out = sum((histogram(*b, state) for b in blocks), 0.0)
            return [(k, out[at[0]:at[-1] + 1]) for k, at in enumerate(cut) if len(at)] if np.ndim(out) else []

        found = self._rdd.mapPartitions(sums)
        if self._parts > 1:
            found = found.reduceByKey(operator.add, parts)
        return [v for _, v in sorted(found.map(lambda kv: (kv[0], pick(cut[kv[0]], kv[1]))).collect(), key=lambda kv: kv[0])]

    def change(self, fn: Callable) -> None:
        """Replace the margins by ``fn(codes, margins)``."""
        new = self._rdd.map(lambda b: (*b[:2], fn(b[0], b[2]))).persist(StorageLevel.MEMORY_AND_DISK)
        self._older.unpersist()
        self._changes += 1
        if self._rdd.isCheckpointed():
            self._drop(self._written)
            self._written = self._rdd.getCheckpointFile()
        if self._changes % KEEP == 0:
            new.checkpoint()
        self._older, self._rdd = self._rdd, new

    def _drop(self, path: str | None) -> None:
        if path:
            jvm, context = self.spark._jvm, self.spark.sparkContext
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)

    def release(self) -> None:
        self._rdd.unpersist()
        self._older.unpersist()
        self._rows.unpersist()
        self._drop(self._written)


class Forest:
    """Trees as arrays (tree x node); the right child follows the left one, a leaf has none (-1)."""

    def __init__(self, trees: int):
        self.count = np.ones(trees, "int64")
        self.feature, self.cut = np.zeros((trees, 1), "int32"), np.zeros((trees, 1), "int32")
        self.left = np.full((trees, 1), -1, "int32")
        self.sums = np.zeros((trees, 1, 2))

    def split(self, tree: np.ndarray, node: np.ndarray, feature: np.ndarray, cut: np.ndarray,
              low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Split open nodes, given tree by tree; (tree, node) of the new nodes."""
        first = np.searchsorted(tree, tree)
        at = self.count[tree] + 2 * (np.arange(len(tree)) - first)
        self.count += 2 * np.bincount(tree, minlength=len(self.count))
        more = int(self.count.max()) - self.left.shape[1]
        if more > 0:
            self.feature, self.cut = (np.pad(a, ((0, 0), (0, more))) for a in (self.feature, self.cut))
            self.left = np.pad(self.left, ((0, 0), (0, more)), constant_values=-1)
            self.sums = np.pad(self.sums, ((0, 0), (0, more), (0, 0)))
        self.feature[tree, node], self.cut[tree, node], self.left[tree, node] = feature, cut, at
        self.sums[tree, at], self.sums[tree, at + 1] = low, high
        return np.repeat(tree, 2), np.stack([at, at + 1], axis=1).ravel()

    def arrays(self, trees: np.ndarray) -> tuple:
        return self.feature[trees], self.cut[trees], self.left[trees]


def step(codes: np.ndarray, trees: tuple, at: np.ndarray) -> np.ndarray:
    """One level down; ``at``: units x trees."""
    feature, cut, left = trees
    node = at + np.arange(at.shape[1]) * left.shape[1]
    low = left.ravel().take(node)
    code = codes.ravel().take(feature.ravel().take(node) + np.arange(len(codes))[:, None] * codes.shape[1])
    return np.where(low >= 0, low + (code > cut.ravel().take(node)), at)


def walk(codes: np.ndarray, trees: tuple, steps: int) -> np.ndarray:
    at = np.zeros((len(codes), len(trees[0])), "int64")
    for _ in range(steps):
        at = step(codes, trees, at)
    return at


def counts(zeros: np.ndarray, ones: np.ndarray, margins) -> tuple:
    """Weights of classification: rows, rows of class 1."""
    return zeros + ones, ones


def slopes(zeros: np.ndarray, ones: np.ndarray, margins: np.ndarray) -> tuple:
    """Weights of boosting: second and first derivative of the log loss."""
    p = 1.0 / (1.0 + np.exp(-np.clip(margins, -500, 500)))
    return (zeros + ones) * np.rint(p * (1 - p) * FIXED), zeros * np.rint(p * FIXED) + ones * np.rint((p - 1) * FIXED)


def joint_features(sizes: list[int]) -> list[list[int]]:
    """Features in groups whose bins together are few."""
    groups, cells = [], []
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        fits = next((g for g, n in enumerate(cells) if n * sizes[k] <= JOINT), None)
        if fits is None:
            groups.append([k])
            cells.append(sizes[k])
        else:
            groups[fits].append(k)
            cells[fits] *= sizes[k]
    return groups


def learned_rows(tally: np.ndarray, held: np.ndarray) -> np.ndarray:
    """units x models x classes: rows that a model learns from, all but those unseen or of the fold held out."""
    out = np.repeat(tally[:, 1:].sum(axis=1)[:, None, :], len(held), axis=1)
    has = np.flatnonzero((held >= 0) & (held + 1 < tally.shape[1]))
    out[:, has] -= tally[:, held[has] + 1]
    return out


def by_fold(tally: np.ndarray, folds: int) -> np.ndarray:
    """folds x classes x units, from fold 0 on."""
    out = np.zeros((folds, 2, len(tally)))
    some = min(folds, tally.shape[1] - 1)
    out[:some] = tally[:, 1:some + 1].transpose(1, 2, 0)
    return out


def histogram(codes, tally, margins, state):
    """Sums of both weights per (open node, feature, bin): nodes x all bins x 2."""
    trees, steps, which, held, slots, nodes, sizes, weigh = state
    at = walk(codes, trees, steps)
    slot = slots.ravel().take(at + np.arange(len(which)) * slots.shape[1])
    learned = learned_rows(tally, held)
    unit, model = np.nonzero((slot >= 0) & (learned.sum(axis=2) > 0))
    zeros, ones = (learned[unit, model, c] for c in (0, 1))
    weights = weigh(zeros, ones, margins[unit, which[model]] if margins.shape[1] else None)
    slot, starts = slot[unit, model].astype("int64"), np.cumsum([0, *sizes])
    out = np.zeros((nodes, int(starts[-1]), 2))
    for group in joint_features(sizes):
        shape = [sizes[k] for k in group]
        joint = np.ravel_multi_index([codes[:, k].astype("int64") for k in group], shape)
        cell, size = slot * int(np.prod(shape)) + joint[unit], int(np.prod(shape))
        for c, weight in enumerate(weights):
            got = np.bincount(cell, weight, nodes * size).reshape(nodes, *shape)
            for i, k in enumerate(group):
                out[:, starts[k]:starts[k + 1], c] = got.sum(axis=tuple(j + 1 for j in range(len(group)) if j != i))
    return out


def best_splits(sums: np.ndarray, sizes: list[int], gain: Callable) -> tuple:
    """Per node: gain, feature and cut of the best split, sums of its left side, and of the node.
    ``gain(left, total)`` is -inf where a split isn't allowed."""
    total = sums[:, :sizes[0]].sum(axis=1)
    left, feature, cut, at = [], [], [], 0
    for k, size in enumerate(sizes):
        left.append(np.cumsum(sums[:, at:at + size], axis=1)[:, :-1])
        feature += [k] * (size - 1)
        cut += range(size - 1)
        at += size
    left = np.concatenate(left, axis=1)
    if not left.shape[1]:
        none = np.zeros(len(sums), "int32")
        return np.full(len(sums), -np.inf), none, none, total, total
    gains = np.round(gain(left, total[:, None, :]), 10)
    best = gains.argmax(axis=1)
    rows = np.arange(len(sums))
    return gains[rows, best], np.array(feature)[best], np.array(cut)[best], left[rows, best], total


def grow_levels(blocks: Binned, held: np.ndarray, depths: np.ndarray, weigh: Callable, gain: Callable,
                going: np.ndarray | None = None) -> Forest:
    """Grow one tree per model to its depth; ``gain(models, left, total)``; ``going``: the models that take part."""
    forest, sizes = Forest(len(held)), blocks.sizes
    tree = np.arange(len(held)) if going is None else going
    node = np.zeros(len(tree), "int64")
    per_job = max(1, CELLS // (2 * max(sum(sizes), 1)))
    for level in range(int(depths.max(initial=0)) if sizes else 0):
        use = depths[tree] > level
        tree, node = tree[use], node[use]
        if not len(tree):
            break
        fresh = []
        for start in range(0, len(tree), per_job):
            t, n = tree[start:start + per_job], node[start:start + per_job]
            which, local = np.unique(t, return_inverse=True)
            slots = np.full((len(which), forest.left.shape[1]), -1, "int32")
            slots[local, n] = np.arange(len(t))
            state = (forest.arrays(which), level, which, held[which], slots, len(t), sizes, weigh)
            pick = lambda at, sums, t=t: best_splits(sums, sizes, lambda a, b: gain(t[at], a, b))
            found = blocks.chosen(state, len(t), pick)
            if not found:
                return forest
            value, feature, cut, low, total = (np.concatenate(c) for c in zip(*found))
            if level == 0:
                forest.sums[t, n] = total
            fresh.append((t, n, value, feature, cut, low, total - low))
        t, n, value, feature, cut, low, high = (np.concatenate(c) for c in zip(*fresh))
        good = value > LEAST_GAIN
        tree, node = forest.split(t[good], n[good], feature[good], cut[good], low[good], high[good])
    return forest


def impurity(sums: np.ndarray, entropy: np.ndarray) -> np.ndarray:
    """Rows x impurity of nodes from (rows, rows of class 1)."""
    n, ones = sums[..., 0], sums[..., 1]
    p = ones / np.maximum(n, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        bits = -np.nan_to_num(p * np.log2(p)) - np.nan_to_num((1 - p) * np.log2(1 - p))
    return n * np.where(entropy, bits, 2 * p * (1 - p))


def grow(blocks: Binned, points: list[dict], held: list[int]) -> Forest:
    """A classification tree per (point, held fold), in this order, to depth ``maxDepth``. Points:
    ``impurity`` (gini, if not given, or entropy), ``minInstancesPerNode`` (1) and ``minRowsToSplit`` (2)."""
    held_all = np.tile(held, len(points))
    depths = np.repeat([p["maxDepth"] for p in points], len(held))
    entropy = np.repeat([p.get("impurity", "gini") == "entropy" for p in points], len(held))
    least = np.repeat([p.get("minInstancesPerNode", 1) for p in points], len(held))
    to_split = np.repeat([p.get("minRowsToSplit", 2) for p in points], len(held))

    def gain(models, left, total):
        right, kind = total - left, entropy[models][:, None]
        value = (impurity(total, kind) - impurity(left, kind) - impurity(right, kind)) / np.maximum(total[..., 0], 1)
        small = np.minimum(left[..., 0], right[..., 0]) < least[models][:, None]
        return np.where(small | (total[..., 0] < to_split[models][:, None]), -np.inf, value)

    return grow_levels(blocks, held_all, depths, counts, gain)


def tree_hits(codes, tally, margins, state):
    """Right answers and rows per (depth from 1, fold; the last: all of them but UNSEEN; tree)."""
    trees, sums, depth, folds = state
    says = sums[..., 1] * 2 > sums[..., 0]
    rows = np.concatenate([by_fold(tally, folds), tally[:, 1:].sum(axis=1).T[None]])
    zeros, ones = rows[:, 0], rows[:, 1]
    at, out = np.zeros((len(codes), len(says)), "int64"), []
    for _ in range(depth):
        at = step(codes, trees, at)
        said = says.ravel().take(at + np.arange(len(says)) * says.shape[1]).astype("float64")
        out.append(ones @ said + zeros @ (1.0 - said))
    return np.stack([np.stack(out), np.broadcast_to(rows.sum(axis=(1, 2))[None, :, None], (depth, folds + 1, len(says)))])


def tree_accuracies(blocks: Binned, forest: Forest, depth: int, folds: int) -> np.ndarray:
    """depth x (folds + 1) x trees: accuracy of every tree cut off at every depth."""
    every, out = np.arange(len(forest.count)), []
    for part in np.array_split(every, max(1, -(-len(every) // 64))):
        hits = blocks.total(tree_hits, (forest.arrays(part), forest.sums[part], depth, folds))
        out.append(hits[0] / np.maximum(hits[1], 1.0) if np.ndim(hits) else np.zeros((depth, folds + 1, len(part))))
    return np.concatenate(out, axis=2)


def tree_shares(x: np.ndarray, cuts: list[np.ndarray], trees: tuple, sums: np.ndarray, depth: int) -> np.ndarray:
    """Rows x trees: share of class 1 in the node of each row at a depth; 0 without rows learned from."""
    codes = np.stack([np.searchsorted(c, x[:, k]) for k, c in enumerate(cuts)], axis=1)
    at = walk(codes, trees, depth)
    got = sums[np.arange(at.shape[1])[None, :], at]
    return got[..., 1] / np.maximum(got[..., 0], 1.0)


PULL, LEAST_SLOPE = 1.0, 1.0  # penalty of squared leaf values; least second derivative of a child


def boosting_gain(models, left, total):
    left, total = left / FIXED, total / FIXED
    right = total - left
    value = sum(sign * s[..., 1] ** 2 / (s[..., 0] + PULL) for sign, s in ((1, left), (1, right), (-1, total)))
    return np.where(np.minimum(left[..., 0], right[..., 0]) < LEAST_SLOPE, -np.inf, value)


def boost(blocks: Binned, held: np.ndarray, depths: np.ndarray, rates: np.ndarray, rounds: np.ndarray,
          watch: dict[int, Callable] | None = None) -> None:
    """Boost all models; margins start at 0 and grow by ``rate`` x leaf value. ``watch[r]()`` is called after
    round r. A model stays as it is after its own number of rounds."""
    for r in range(1, int(rounds.max(initial=0)) + 1):
        going = np.flatnonzero(rounds >= r)
        forest = grow_levels(blocks, held, depths, slopes, boosting_gain, going)
        value = -rates[going, None] * forest.sums[going, :, 1] / (forest.sums[going, :, 0] + PULL * FIXED)
        trees, deep = forest.arrays(going), int(depths[going].max())

        def add(codes, margins, trees=trees, value=value, going=going, deep=deep):
            margins = margins.copy()
            margins[:, going] += value[np.arange(len(going))[None, :], walk(codes, trees, deep)]
            return margins

        blocks.change(add)
        if watch and r in watch:
            watch[r]()


def margin_scores(codes, tally, margins, folds):
    """Per fold (then UNSEEN rows) and model: log loss, squared error of the probability, right answers, rows."""
    p = 1.0 / (1.0 + np.exp(-np.clip(margins, -500, 500)))
    rows = np.concatenate([by_fold(tally, folds), tally[:, 0].T[None]])
    zeros, ones = rows[:, 0], rows[:, 1]
    loss, says = np.logaddexp(0.0, margins), (margins > 0).astype("float64")
    return np.stack([zeros @ loss + ones @ (loss - margins), zeros @ p ** 2 + ones @ (p - 1) ** 2,
                     zeros @ (1.0 - says) + ones @ says,
                     np.broadcast_to(rows.sum(axis=(1, 2))[:, None], (folds + 1, margins.shape[1]))])
