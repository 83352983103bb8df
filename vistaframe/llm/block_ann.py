"""Nearest neighbours by a block matrix join with int8 tiles.

Vectors are scaled to length one and quantised to int8 per vector, with the
exact length of the quantisation error kept. A stated query set meets all
candidates in a grid of cells (query block x stripe of candidates); in a cell,
tile products of the int8 matrices give every cosine up to a bound,

    |cos(q, c) - sq*sc*<iq, ic>|  <=  |eq| + |ec| + |eq||ec|,

so a pair whose upper bound is under the fifth best lower bound can't be among
the nearest. Surviving pairs are recomputed in double precision on the original
vectors; each query's best are merged in a heap, per cell and then over cells.
The result is exact (recall 1).

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part; vectors of different length are never compared; ties
go to the smaller id; rows that repeat an id are one neighbour and one query, whose
score with another is the best of all their vectors, and a row
is never its own query's candidate by id; null ids take no part; an empty table
gives no rows; other columns take no part. Equal vectors of a block are compared
once: only their ``k + 1`` smallest distinct ids can be among the ``k`` nearest.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 4096  # vectors of one block record
QUERY_BLOCKS = 4  # blocks of queries that a cell holds
STRIPE_ROWS = 32_768  # candidates of one stripe, about
EXACT_DIM = 1024  # int8 products of so many components are exact sums in single precision
PAIRS = 200_000  # surviving pairs recomputed at a time


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 rows, scale per row, length of the error per row) of the unit vectors of ``x``."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127.0
    q = np.rint(unit / scale[:, None]).astype("int8")
    error = np.linalg.norm(unit - q * scale[:, None], axis=1) * (1 + 1e-9) + 1e-12
    return q, scale, error


def tile_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows, by slices of components."""
    out = 0.0
    for at in range(0, a.shape[1], EXACT_DIM):
        out = out + (a[:, at:at + EXACT_DIM].astype("float32") @ b[:, at:at + EXACT_DIM].astype("float32").T).astype("float64")
    return out


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    dot = np.multiply(x, y).sum(axis=1)
    return dot / (np.sqrt(np.multiply(x, x).sum(axis=1)) * np.sqrt(np.multiply(y, y).sum(axis=1)))


def _valid_blocks(k: int | None):
    """Block records (dim, pickled ids and vectors) of a partition's rows;
    with ``k``, in the order of ids and of equal vectors in a block only the
    k + 1 smallest distinct ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(dim: int) -> pa.RecordBatch:
            rows = held.pop(dim)
            ids = np.concatenate([r[0] for r in rows])
            x = np.concatenate([r[1] for r in rows])
            if k is not None:
                order = np.argsort(ids, kind="stable")
                ids, x = ids[order], x[order]
                _, same = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.itemsize * dim))).ravel(),
                                    return_inverse=True)
                by = np.argsort(same, kind="stable")  # ids ascend within equal vectors
                by = by[np.r_[True, (same[by][1:] != same[by][:-1]) | (ids[by][1:] != ids[by][:-1])]]
                starts = np.flatnonzero(np.r_[True, same[by][1:] != same[by][:-1]])
                rank = np.arange(len(by)) - np.repeat(starts, np.diff(np.r_[starts, len(by)]))
                keep = np.sort(by[rank <= k])
                ids, x = ids[keep], x[keep]
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([int(ids[0])], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([pickle.dumps((ids, x))], pa.binary())], names=["dim", "first", "n", "payload"])

        for batch in batches:
            lists = batch.column("vector")
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            ends = lists.offsets.to_numpy()
            size = np.diff(ends)
            flat = lists.values.to_numpy(zero_copy_only=False).astype("float64")  # null components become NaN
            valid = np.asarray(lists.is_valid()) & (size > 0)
            for dim in np.unique(size[valid]).tolist():
                at = np.flatnonzero(valid & (size == dim))
                x = flat[(ends[at][:, None] + np.arange(dim)[None, :])]
                norm = np.sqrt(np.multiply(x, x).sum(axis=1))
                good = np.isfinite(x).all(axis=1) & (norm > 0) & np.isfinite(norm)
                if good.any():
                    held.setdefault(dim, []).append((ids[at[good]].astype("int64"), x[good]))
                    if sum(len(r[0]) for r in held[dim]) >= BLOCK:
                        yield block(dim)
        for dim in list(held):
            yield block(dim)
    return run


def _blocks(rows: DataFrame, k: int | None) -> DataFrame:
    return rows.mapInArrow(_valid_blocks(k), "dim int, first long, n long, payload binary")


class _Queries:
    """The query blocks of a cell, with the k best of each query so far."""

    def __init__(self, payloads: list[bytes], k: int):
        parts = [pickle.loads(p) for p in payloads]
        self.ids = np.concatenate([p[0] for p in parts])
        self.x = np.concatenate([p[1] for p in parts])
        self.q, self.scale, self.error = quantise(self.x)
        self.k = k
        self.heaps: list[list] = [[] for _ in self.ids]  # (score, -id): the least of the best on top
        self.floor = np.full(len(self.ids), -np.inf)

    def meet(self, payload: bytes) -> None:
        ids, x = pickle.loads(payload)
        q, scale, error = quantise(x)
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])  # ids ascend
        for at in range(0, len(self.ids), 512):
            to = min(at + 512, len(self.ids))
            near = tile_product(self.q[at:to], q) * (self.scale[at:to, None] * scale[None, :])
            eq = self.error[at:to, None]
            bound = eq + error[None, :] + eq * error[None, :]
            other = self.ids[at:to, None] != ids[None, :]
            low = np.where(other, near - bound, -np.inf)
            if len(starts) < len(ids):  # an id counts once
                low = np.maximum.reduceat(low, starts, axis=1)
            if low.shape[1] > self.k:
                kth = np.partition(low, low.shape[1] - self.k, axis=1)[:, -self.k]
                floor = np.maximum(self.floor[at:to], kth)
            else:
                floor = self.floor[at:to]
            a, b = np.nonzero(other & (near + bound >= floor[:, None]))
            for s in range(0, len(a), PAIRS):
                self._exact(a[s:s + PAIRS] + at, b[s:s + PAIRS], ids, x)

    def _exact(self, a: np.ndarray, b: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        scores = cosine(self.x[a], x[b])
        order = np.lexsort((-scores, ids[b], a))
        a, b, scores = a[order], b[order], scores[order]
        if len(a):  # the best of an id
            first = np.r_[True, (a[1:] != a[:-1]) | (ids[b][1:] != ids[b][:-1])]
            a, b, scores = a[first], b[first], scores[first]
        order = np.lexsort((ids[b], -scores, a))
        a, b, scores = a[order], b[order], scores[order]
        starts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.empty(0, int)
        rank = np.arange(len(a)) - np.repeat(starts, np.diff(np.r_[starts, len(a)]))
        best = rank < self.k
        for i, j, s in zip(a[best].tolist(), ids[b[best]].tolist(), scores[best].tolist()):
            heap = self.heaps[i]
            held = next((n for n, (_, i_held) in enumerate(heap) if i_held == -j), None)
            if held is not None:
                if s > heap[held][0]:
                    heap[held] = (s, -j)
                    heapq.heapify(heap)
            elif len(heap) < self.k:
                heapq.heappush(heap, (s, -j))
            elif (s, -j) > heap[0]:
                heapq.heapreplace(heap, (s, -j))
            if len(heap) == self.k:
                self.floor[i] = heap[0][0]

    def rows(self) -> pa.RecordBatch:
        found = [(int(q), -j, s) for q, heap in zip(self.ids, self.heaps) for s, j in heap]
        cols = list(zip(*found)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                           pa.array(cols[2], pa.float64())], names=["query_id", "vec_id", "score"])


def _cells(k: int):
    """A partition's cells, one after the other: queries first, then the candidates' blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, payloads, queries = None, [], None
        for batch in batches:
            for dim, row, stripe, side, payload in zip(*(batch.column(c).to_pylist() for c in
                                                         ("dim", "row", "stripe", "side", "payload"))):
                if (dim, row, stripe) != cell:
                    if queries is not None:
                        yield queries.rows()
                    cell, payloads, queries = (dim, row, stripe), [], None
                if side == 0:
                    payloads.append(payload)
                elif payloads:
                    queries = queries or _Queries(payloads, k)
                    queries.meet(payload)
        if queries is not None:
            yield queries.rows()
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of each row for which ``is_query`` holds."""
    spark = vectors.sparkSession
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"),
                          vectors[vector_col].cast("array<double>").alias("vector"), is_query.alias("_query"))
    rows = rows.filter(F.col("vec_id").isNotNull())
    asked = _blocks(rows.filter("_query").select("vec_id", "vector"), None)
    given = _blocks(rows.select("vec_id", "vector"), k)
    # the grid: counts only
    n_rows = rows.count()
    stripes = max(1, -(-n_rows // STRIPE_ROWS), spark.sparkContext.defaultParallelism)
    n_queries = rows.filter("_query").count()
    grid_rows = max(1, -(-n_queries // (BLOCK * QUERY_BLOCKS)))
    place = lambda n, salt: F.pmod(F.xxhash64("dim", "first", F.lit(salt)), F.lit(n)).cast("int")
    # blocks, not vectors, are copied: queries once a stripe, candidates once a row of the grid
    left = asked.select("dim", place(grid_rows, 1).alias("row"),
                        F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"), F.lit(0).alias("side"),
                        "first", "payload")
    right = given.select("dim", F.explode(F.sequence(F.lit(0), F.lit(grid_rows - 1))).alias("row"),
                         place(stripes, 2).alias("stripe"), F.lit(1).alias("side"), "first", "payload")
    cells = left.unionByName(right).repartition(stripes * grid_rows, "dim", "row", "stripe")
    found = (cells.sortWithinPartitions("dim", "row", "stripe", "side", "first")
             .select("dim", "row", "stripe", "side", "payload")
             .mapInArrow(_cells(k), "query_id long, vec_id long, score double"))
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id", "score"))), 1, k)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    # a query has at most k rows per cell of its grid row
    return (found.groupBy("query_id").agg(best.alias("best"))
            .select("query_id", F.posexplode("best").alias("at", "b"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"),
                    F.col("b.score").alias("score")))
