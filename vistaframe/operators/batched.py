"""Many small models over the same rows, trained together.

Every model of a search, (fold, parameters), sees the same rows. So one job per
step serves them all: tasks hold blocks of rows as matrices, get the parameters
of all models, and send sums of fixed size (gradients, Gram matrices, losses,
hits), which are added up in a tree over the tasks. The driver holds parameters
only. Networks get equal rows once, with their number (``Counted``). Blocks come from a written checkpoint, so a lost executor costs a re-read.

``newton``: logistic regressions by Newton steps on sums over rows. ``Networks``:
multi-layer perceptrons by full-batch gradient steps (momentum with a rate that
adapts, or Adam).

Defined cases: rows with a null label, fold or feature vector take no part; without
rows all parameters stay at their start; of equal scores the first point is best.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module

BLOCK_ROWS = 4096
ALL = -1  # "fold" of a model that is fitted on all rows


def vectors(column: pa.Array) -> np.ndarray:
    """rows x values of lists of one length; null: NaN."""
    values = column.flatten()
    x = values.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    return x.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def few_parts(spark: SparkSession, rows: int, least: int) -> int:
    """Parts for jobs that many steps repeat: one a core, if each has ``least`` rows; more when parts get very long."""
    return max(1, min(-(-rows // least), max(spark.sparkContext.defaultParallelism, -(-rows // (least << 7)))))


def fold_counts(fold: Column, folds: int, kinds: list[Column]) -> Column:
    """Number of rows by fold (first the negative ones, then fold 0, 1, ...) and kind, in one array."""
    inside = [fold < 0, *[fold == k for k in range(folds)]]
    return F.array(*[F.count_if(i & k) for i in inside for k in kinds])


class Blocks:
    """Rows as (features, label, fold) matrices, some thousand rows each."""

    def __init__(self, df: DataFrame, features: str = "features", label: str = "label", fold: str = "fold"):
        rows = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), F.col(fold).cast("int").alias("f"))
        rows = rows.filter("x is not null and y is not null and f is not null")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK_ROWS):
                    part = batch.slice(at, BLOCK_ROWS)
                    x = np.array(part.column("x").to_pylist(), "float64")
                    block = (x, part.column("y").to_numpy(), part.column("f").to_numpy())
                    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], pa.binary())], names=["block"])

        self.spark = df.sparkSession
        self._rdd = (rows.mapInArrow(cut, "block binary").checkpoint().rdd.map(lambda r: pickle.loads(r[0]))
                     .persist(StorageLevel.MEMORY_AND_DISK))
        self._depth = 1 if self._rdd.getNumPartitions() <= 32 else 2
        self.features = next(iter(self._rdd.map(lambda b: b[0].shape[1]).take(1)), 0)

    def total(self, fn: Callable, state, zero: np.ndarray) -> np.ndarray:
        """Sum over all blocks of ``fn(features, labels, folds, state)``."""
        sent = self.spark.sparkContext.broadcast(state)
        sums = self._rdd.map(lambda b: fn(*b, sent.value)).treeAggregate(zero, lambda a, b: a + b, lambda a, b: a + b, self._depth)
        sent.destroy()
        return sums

    def release(self) -> None:
        self._rdd.unpersist()


class Counted(Blocks):
    """Equal rows once, as (features, label, rows by fold) matrices: what a network does with a row it does with
    all that equal it. The columns by fold: the negative ones, then fold 0, 1, ..."""

    def __init__(self, df: DataFrame, features: str = "features", label: str = "label", fold: str = "fold"):
        rows = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), F.col(fold).cast("int").alias("f"))
        rows = rows.filter("x is not null and y is not null and f is not null")
        self.spark = df.sparkSession
        count, top = rows.agg(F.count(F.lit(1)), F.max("f")).first()
        parts = few_parts(self.spark, count, BLOCK_ROWS // 4)
        counted = rows.groupBy("x", "y").agg(fold_counts(F.col("f"), max(top if top is not None else 0, 0) + 1, [F.lit(True)]).alias("t"))
        counted = counted.repartition(parts, "x", "y").sortWithinPartitions("x", "y")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, count = [], 0

            def out() -> pa.RecordBatch:
                t = pa.Table.from_batches(held).combine_chunks()
                x, y, t = (t.column(c).chunk(0) for c in ("x", "y", "t"))
                block = (vectors(x), y.to_numpy(), vectors(t))
                return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], pa.binary())], names=["block"])

            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK_ROWS // 4):
                    part = batch.slice(at, BLOCK_ROWS // 4)
                    if count + part.num_rows > BLOCK_ROWS // 4:
                        yield out()
                        held, count = [], 0
                    held, count = held + [part], count + part.num_rows
            if count:
                yield out()

        self._rdd = (counted.mapInArrow(cut, "block binary").checkpoint().rdd.map(lambda r: pickle.loads(r[0]))
                     .persist(StorageLevel.MEMORY_AND_DISK))
        self._depth = 2  # the sums of networks are long: a few of them meet before the driver
        self.features = next(iter(self._rdd.map(lambda b: b[0].shape[1]).take(1)), 0)


def with_one(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1))], axis=1)


def seen(folds: np.ndarray, held: np.ndarray) -> np.ndarray:
    """rows x models: 1 where the model learns from the row."""
    return (folds[:, None] != held[None, :]).astype("float64")


def newton_sums(x, y, f, state):
    """Loss, gradient and Gram matrix per model, flat."""
    w, held = state
    z = with_one(x)
    margin, use = z @ w.T, seen(f, held)
    p = 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))
    loss = (use * (np.logaddexp(0.0, margin) - y[:, None] * margin)).sum(axis=0)
    grad = (use * (p - y[:, None])).T @ z
    outer = (z[:, :, None] * z[:, None, :]).reshape(len(z), -1)
    gram = (use * p * (1 - p)).T @ outer
    return np.concatenate([loss[:, None], grad, gram], axis=1)


def newton(blocks: Blocks, penalties: np.ndarray, held: np.ndarray, steps: int = 60, tolerance: float = 1e-8) -> np.ndarray:
    """Coefficients, the intercept last, of one logistic regression per (penalty, held fold):
    least sum of log losses + penalty / 2 * squared coefficients (not the intercept).
    A step that doesn't lower the loss is halved."""
    models, d = len(penalties), blocks.features + 1
    ridge = np.repeat(penalties[:, None], d, axis=1)
    ridge[:, -1] = 0.0
    w, move, best = np.zeros((models, d)), np.zeros((models, d)), np.full(models, np.inf)
    going = np.ones(models, bool)
    for _ in range(steps):
        at = np.flatnonzero(going)
        sums = blocks.total(newton_sums, ((w + move)[at], held[at]), np.zeros((len(at), 1 + d + d * d)))
        for k, row in zip(at.tolist(), sums):
            now = w[k] + move[k]
            loss = row[0] + 0.5 * float((ridge[k] * now * now).sum())
            if loss > best[k] + 1e-12 * abs(best[k]):
                move[k] = move[k] / 2
                going[k] = np.abs(move[k]).max() > tolerance * (1 + np.abs(w[k]).max())
                continue
            gain, best[k], w[k] = best[k] - loss, loss, now
            grad = row[1:1 + d] + ridge[k] * now
            step = np.linalg.lstsq(row[1 + d:].reshape(d, d) + np.diag(ridge[k]), -grad, rcond=1e-12)[0]
            move[k] = step
            going[k] = np.abs(step).max() > tolerance * (1 + np.abs(now).max()) and gain > 1e-13 * abs(loss)
        if not going.any():
            break
    return w


def linear_hits(x, y, f, state):
    """Per model and fold (the last row: of all folds): right answers, rows."""
    w, folds = state
    right = ((with_one(x) @ w.T > 0) == (y[:, None] > 0.5)).astype("float64")
    inside = np.stack([f == k for k in range(folds)] + [np.ones(len(f), bool)]).astype("float64")
    return np.stack([inside @ right, np.repeat(inside.sum(axis=1)[:, None], len(w), axis=1)])


def accuracies(hits: np.ndarray) -> np.ndarray:
    """(folds + 1) x models from sums of right answers and rows."""
    return hits[0] / np.maximum(hits[1], 1.0)


ACTIVATIONS = {
    "tanh": (np.tanh, lambda a: 1.0 - a * a),
    "relu": (lambda v: np.maximum(v, 0.0), lambda a: (a > 0).astype(a.dtype)),
    "logistic": (lambda v: 1.0 / (1.0 + np.exp(-np.clip(v, -60, 60))), lambda a: a * (1.0 - a)),
}


@dataclass
class Network:
    """One network of a search: hidden layers, activation, solver and penalty, and the fold that it doesn't see."""

    hidden: tuple[int, ...]
    activation: str
    solver: str  # "sgd": momentum, the rate falls where the loss stalls; "adam"
    alpha: float
    held: int
    weights: list[np.ndarray] = field(default_factory=list)  # per layer, the bias as last row

    def start(self, features: int, seed: int) -> None:
        rng, sizes = np.random.default_rng(seed), [features, *self.hidden, 1]
        for a, b in zip(sizes, sizes[1:]):
            bound = np.sqrt((2.0 if self.activation == "logistic" else 6.0) / (a + b))
            self.weights.append(rng.uniform(-bound, bound, (a + 1, b)))


def margins(x: np.ndarray, weights: list[np.ndarray], activation: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """(margin per row, what each layer gets)."""
    act, got, a = ACTIVATIONS[activation][0], [], x
    for k, w in enumerate(weights):
        got.append(a)
        a = a @ w[:-1] + w[-1]
        if k + 1 < len(weights):
            a = act(a)
    return a[:, 0], got


def gradient(x: np.ndarray, y: np.ndarray, weights: list[np.ndarray], activation: str,
             times: np.ndarray | float = 1.0) -> tuple[float, np.ndarray]:
    """Sum of the log losses and its gradient, flat; a row counts ``times``."""
    margin, got = margins(x, weights, activation)
    slope, grads = ACTIVATIONS[activation][1], []
    back = ((1.0 / (1.0 + np.exp(-np.clip(margin, -60, 60))) - y) * times)[:, None]
    for k in range(len(weights) - 1, -1, -1):
        grads.append(np.concatenate([got[k].T @ back, back.sum(axis=0, keepdims=True)]))
        if k:
            back = (back @ weights[k][:-1].T) * slope(got[k])
    return float(((np.logaddexp(0.0, margin) - y * margin) * times).sum()), np.concatenate([g.ravel() for g in reversed(grads)])


def times_of(f: np.ndarray, held: int) -> np.ndarray:
    """How often each row counts for a model: ``f`` has the rows' folds, or their numbers by fold."""
    if f.ndim == 1:
        return (f != held).astype("float64")
    return f.sum(axis=1) - (f[:, held + 1] if 0 <= held < f.shape[1] - 1 else 0.0)


def network_sums(x, y, f, nets):
    """Rows, loss and gradient of every network, one after the other."""
    out = []
    for weights, activation, held in nets:
        times = times_of(f, held)
        use = times > 0
        loss, grad = gradient(x[use], y[use], weights, activation, times[use])
        out.append(np.r_[float(times.sum()), loss, grad])
    return np.concatenate(out)


def network_hits(x, y, f, state):
    nets, folds = state
    right = np.stack([(margins(x, w, a)[0] > 0) == (y > 0.5) for w, a, _ in nets], axis=1).astype("float64")
    every = times_of(f, ALL - 1)  # of no fold
    inside = np.stack([every - times_of(f, k) for k in range(folds)] + [every])
    return np.stack([inside @ right, np.repeat(inside.sum(axis=1)[:, None], len(nets), axis=1)])


RATES = {"sgd": 0.1, "adam": 0.01}  # of steps over all rows; those over a few rows at a time take smaller ones
MOMENTUM, BETA1, BETA2, PATIENCE, TOLERANCE, LEAST_RATE = 0.9, 0.9, 0.999, 10, 1e-4, 1e-6


def train_networks(blocks: Blocks, nets: list[Network], rounds: int, seed: int = 42) -> None:
    """Train all networks in place. One whose loss stalls for PATIENCE rounds is done ("adam")
    or goes on at a fifth of its rate ("sgd", down to LEAST_RATE)."""
    for net in nets:
        net.start(blocks.features, seed)
    flat = [np.concatenate([w.ravel() for w in n.weights]) for n in nets]
    shapes = [[w.shape for w in n.weights] for n in nets]
    one = [np.zeros_like(v) for v in flat]
    two = [np.zeros_like(v) for v in flat]
    rate, best, stalled = [RATES[n.solver] for n in nets], [np.inf] * len(nets), [0] * len(nets)
    penalised = [np.concatenate([np.r_[np.ones((s[0] - 1) * s[1]), np.zeros(s[1])] for s in shape]) for shape in shapes]
    going = list(range(len(nets)))

    def layers(k):
        out, at = [], 0
        for s in shapes[k]:
            out.append(flat[k][at:at + s[0] * s[1]].reshape(s))
            at += s[0] * s[1]
        return out

    for t in range(1, rounds + 1):
        if not going:
            break
        state = [(layers(k), nets[k].activation, nets[k].held) for k in going]
        sums, at, left = blocks.total(network_sums, state, np.zeros(sum(2 + len(flat[k]) for k in going))), 0, []
        for k in going:
            n, loss = max(sums[at], 1.0), sums[at + 1]
            grad = (sums[at + 2:at + 2 + len(flat[k])] + nets[k].alpha * penalised[k] * flat[k]) / n
            loss = (loss + 0.5 * nets[k].alpha * float((penalised[k] * flat[k] ** 2).sum())) / n
            at += 2 + len(flat[k])
            stalled[k] = stalled[k] + 1 if loss > best[k] - TOLERANCE else 0
            best[k] = min(best[k], loss)
            if stalled[k] >= PATIENCE:
                if nets[k].solver == "adam" or rate[k] / 5 < LEAST_RATE:
                    continue
                rate[k], stalled[k] = rate[k] / 5, 0
            if nets[k].solver == "sgd":
                one[k] = MOMENTUM * one[k] - rate[k] * grad
                flat[k] = flat[k] + MOMENTUM * one[k] - rate[k] * grad
            else:
                one[k], two[k] = BETA1 * one[k] + (1 - BETA1) * grad, BETA2 * two[k] + (1 - BETA2) * grad * grad
                flat[k] = flat[k] - rate[k] * (one[k] / (1 - BETA1 ** t)) / (np.sqrt(two[k] / (1 - BETA2 ** t)) + 1e-8)
            left.append(k)
        going = left
    for k, net in enumerate(nets):
        net.weights = layers(k)


def network_accuracies(blocks: Blocks, nets: list[Network], folds: int) -> np.ndarray:
    state = ([(n.weights, n.activation, n.held) for n in nets], folds)
    return accuracies(blocks.total(network_hits, state, np.zeros((2, folds + 1, len(nets)))))


def share(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))


def linear_shares(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return share(with_one(x) @ weights.T)


def network_shares(x: np.ndarray, nets: list[tuple]) -> np.ndarray:
    return np.stack([share(margins(x, w, a)[0]) for w, a in nets], axis=1)


def add_shares(df: DataFrame, bases: dict[str, Callable], fold: Column, features: str = "features") -> DataFrame:
    """Adds ``p_<name>``, the probability of label 1 by the model that didn't see the row. A base maps rows to
    rows x (one column per fold left out, then that of the model of all rows, which serves fold -1)."""
    fns = list(bases.values())

    @F.pandas_udf(ArrayType(DoubleType()))
    def shares(vectors: pd.Series, folds: pd.Series) -> pd.Series:
        x, at = np.array(vectors.tolist(), "float64").reshape(len(vectors), -1), folds.to_numpy()
        rows = np.arange(len(x))
        got = np.stack([fn(x)[rows, at] for fn in fns], axis=1) if len(x) else np.zeros((0, len(fns)))
        return pd.Series(list(got))

    out = df.withColumn("_shares", shares(vector_to_array(features), fold))
    return out.withColumns({f"p_{k}": F.col("_shares")[i] for i, k in enumerate(bases)}).drop("_shares")
