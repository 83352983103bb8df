"""Exact k-nearest-neighbour join over blocks of rows.

Exact neighbours of all queries among all reference rows take work in
proportion to queries x rows. Both sides are cut into blocks; a grid of cells
(group of query blocks x stripe of reference rows) is dealt out evenly, so no
task holds more than one group of queries and one block of rows at a time,
whatever the data. There are as few stripes as keep all cores busy: a row is copied to
each group, a query's bests to each stripe. In a cell, a matrix product gives all distances up to
rounding; pairs that can be among the first k, given the k best so far, are computed again in index
order, and each query keeps its k best. The cells' bests are merged by query.

``knn_by_region`` gives the same rows for vectors of few dimensions, where most rows are too far to count. A
tree lays out regions of about REGION rows; their boxes hold all of their rows. A query first meets its own
region, then those whose boxes are no farther than its k-th best row so far. Within a region, groups of queries meet
blocks of rows, nearest boxes first. Only the layout comes from a part of the rows: any layout gives the same neighbours.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .batched import vectors

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module

BLOCK = 1024  # rows of one block
QUERY_BLOCKS = 16  # query blocks of one cell, at most, about
CELLS = 3  # cells a core, about
MET_QUERIES = 2048  # queries that meet a block at a time
EXACT_PAIRS = 1 << 16  # pairs that are computed again at a time
REGION = 1 << 14  # rows of a region, about
ASKED = 1 << 12  # queries of a region that one cell has, about
LAYOUT_ROWS = 1 << 14  # rows that the layout of regions comes from, about
LEAF = 256  # rows of a block, or queries of a group, within a region
LEAVES = 4  # blocks that a group meets at a time
PARTS = 1 << 20  # cells of a region, at most


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, group, vec) -> pickled blocks (ids, groups, matrix in the vectors' own precision)."""
    held, kind = [], "float64"

    def out(rows) -> pa.RecordBatch:
        ids, groups, vecs = zip(*rows)
        block = (np.array(ids, "int64"), np.array([-1 if g is None else g for g in groups], "int64"), np.array(vecs, kind))
        return pa.RecordBatch.from_arrays([pa.array([int(ids[0])], pa.int64()), pa.array([pickle.dumps(block)], pa.binary())],
                                          names=["first", "payload"])

    for batch in batches:
        kind = "float32" if pa.types.is_float32(batch.schema.field("vec").type.value_type) else "float64"
        held += zip(*(batch.column(c).to_pylist() for c in ("id", "grp", "vec")))
        while len(held) >= BLOCK:
            yield out(held[:BLOCK])
            held = held[BLOCK:]
    if held:
        yield out(held)


class _Cell:
    """The queries of a cell with their k best rows so far, nearest first."""

    def __init__(self, parts: list[tuple], k: int):
        self.ids, self.groups, x = (np.concatenate([p[i] for p in parts]) for i in range(3))
        self.x = x.astype("float64")
        self.square = (self.x * self.x).sum(axis=1)
        self.k = k
        self.far = np.full((len(self.ids), k), np.inf)
        self.near_ids = np.full((len(self.ids), k), np.iinfo("int64").max)
        self.limit = np.full(len(self.ids), np.inf)  # distance of the k-th best row that is known from elsewhere

    def meet(self, ids: np.ndarray, groups: np.ndarray, y: np.ndarray, exclude: bool) -> None:
        y = y.astype("float64")
        square = (y * y).sum(axis=1)
        finite = square[np.isfinite(square)]
        most = float(finite.max()) if len(finite) else 0.0
        for start in range(0, len(self.ids), MET_QUERIES):
            part = slice(start, start + MET_QUERIES)
            near = self.x[part] @ y.T
            near *= -2.0
            near += square
            near += self.square[part, None]
            if exclude:
                near[self.groups[part, None] == groups[None, :]] = np.inf
            slack = 1e-9 * (self.square[part] + most) + 1e-300  # of both roundings, at least
            bound = np.fmin(self.far[part, -1], self.limit[part]) ** 2
            fresh = np.flatnonzero(np.isinf(bound))  # fewer than k rows so far
            if len(fresh) and len(ids) > self.k:
                bound[fresh] = np.fmin(bound[fresh], np.partition(near[fresh], self.k - 1, axis=1)[:, self.k - 1] + slack[fresh])
            query, row = np.nonzero(near <= (bound + slack)[:, None])
            if len(fresh):
                real = np.isfinite(near[query, row])
                query, row = query[real], row[real]
            if len(query):
                self._keep(query + start, y, ids, row)

    def _keep(self, query: np.ndarray, y: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        exact = np.empty(len(query))
        for at in range(0, len(query), EXACT_PAIRS):
            some = slice(at, at + EXACT_PAIRS)
            diff = self.x[query[some]] - y[row[some]]
            exact[some] = np.sqrt(np.cumsum(diff * diff, axis=1)[:, -1])  # summed in index order
        met = np.unique(query)
        owner = np.concatenate([np.repeat(met, self.k), query])
        far = np.concatenate([self.far[met].ravel(), exact])
        own = np.concatenate([self.near_ids[met].ravel(), ids[row]])
        order = np.lexsort((own, far, owner))
        owner = owner[order]
        order = order[np.arange(len(owner)) - np.searchsorted(owner, owner) < self.k]  # each of them has k at least
        self.far[met], self.near_ids[met] = far[order].reshape(-1, self.k), own[order].reshape(-1, self.k)

    def rows(self) -> pa.RecordBatch:
        found = np.isfinite(self.far)
        some = found.any(axis=1)
        ends = pa.array(np.r_[0, np.cumsum(found[some].sum(axis=1))].astype("int32"))
        lists = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(
            [pa.array(self.far[found]), pa.array(self.near_ids[found])], names=["dist", "r_id"]))
        return pa.RecordBatch.from_arrays([pa.array(self.ids[some]), lists], names=["q_id", "best"])


def _cells(k: int, exclude: bool):
    """A partition's cells one after the other: queries first, then rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, payloads, cell = None, [], None
        for batch in batches:
            for key, side, payload in zip(*(batch.column(c).to_pylist() for c in ("cell", "side", "payload"))):
                if key != at:
                    if cell:
                        yield cell.rows()
                    at, payloads, cell = key, [], None
                if side == 0:
                    payloads.append(payload)
                elif payloads:
                    cell = cell or _Cell([pickle.loads(p) for p in payloads], k)
                    cell.meet(*pickle.loads(payload), exclude)
        if cell:
            yield cell.rows()
    return run


def knn(ref: DataFrame, query: DataFrame, k: int, id_col: str = "vec_id", vec: str = "embedding",
        exclude_same: str | None = None) -> DataFrame:
    """``(q_id, r_id, dist, rank)`` for the k nearest reference rows of every
    query row; ties on distance are broken by the reference id. With
    ``exclude_same``, rows that agree with the query in that column take no
    part (cross validation by folds)."""
    spark = ref.sparkSession
    group = (F.col(exclude_same) if exclude_same else F.lit(None)).cast("long")

    def blocks(df):
        return df.select(F.col(id_col).cast("long").alias("id"), group.alias("grp"),
                         (F.col(vec) if single else F.col(vec).cast("array<double>")).alias("vec")).mapInArrow(
                             _blocks, "first long, payload binary")

    single = ref.schema[vec].dataType == query.schema[vec].dataType == ArrayType(FloatType())
    cores, wanted = spark.sparkContext.defaultParallelism, -(-query.count() // BLOCK)
    groups = max(1, min(wanted, max(cores, -(-wanted // QUERY_BLOCKS))))
    stripes = max(1, min(-(-CELLS * cores // groups), -(-ref.count() // BLOCK)))
    place = lambda n, salt: F.pmod(F.xxhash64("first", F.lit(salt)), F.lit(n)).cast("int")
    asked = blocks(query).select(place(groups, 1).alias("g"), F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("s"),
                                 F.lit(0).alias("side"), "first", "payload")
    given = blocks(ref).select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), place(stripes, 2).alias("s"),
                               F.lit(1).alias("side"), "first", "payload")
    cells = asked.unionByName(given).select((F.col("g") * stripes + F.col("s")).alias("cell"), "side", "first", "payload")
    found = (cells.repartition(stripes * groups, "cell").sortWithinPartitions("cell", "side", "first")
             .select("cell", "side", "payload").mapInArrow(_cells(k, exclude_same is not None), "q_id long, best array<struct<dist double, r_id long>>"))
    return _merged(found, k)


def _merged(found: DataFrame, k: int) -> DataFrame:
    best = F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k)  # k per stripe at most
    return (found.groupBy("q_id").agg(best.alias("b")).select("q_id", F.posexplode("b").alias("p", "b"))
            .select("q_id", F.col("b.r_id").alias("r_id"), F.col("b.dist").alias("dist"), (F.col("p") + 1).cast("int").alias("rank")))


def _halves(x: np.ndarray) -> tuple[int, float] | None:
    """(column, cut) that halves the rows in the column of the widest spread; None if all are equal."""
    low, high = x.min(axis=0), x.max(axis=0)
    if not (high > low).any():
        return None
    column = int(np.where(high > low, x.var(axis=0), -1.0).argmax())
    values, middle = x[:, column], (len(x) - 1) // 2
    cut = np.partition(values, middle)[middle]
    return column, float(cut if cut < high[column] else values[values < cut].max())


def _leaves(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Indices of the rows in compact parts, ``most`` rows each at most."""
    todo, done = [np.arange(len(x))], []
    while todo:
        rows = todo.pop()
        split = _halves(x[rows]) if len(rows) > most else None
        if split is None:
            done += np.array_split(rows, -(-len(rows) // most))  # none without rows, some of equal rows
            continue
        low = x[rows, split[0]] <= split[1]
        todo += [rows[~low], rows[low]]
    return done


def _layout(x: np.ndarray, most: int) -> np.ndarray:
    """Nodes (column, cut, left, right) of a tree whose ends have ``most`` rows at most, if these differ; column -1: an
    end, the region's number in ``left``."""
    end = [-1.0, 0.0, 0.0, 0.0]
    nodes, todo, regions = [[*end]], [(0, np.arange(len(x)))], 0
    while todo:
        at, rows = todo.pop()
        split = _halves(x[rows]) if len(rows) > most else None
        if split is None:
            nodes[at][2], regions = regions, regions + 1
            continue
        nodes[at] = [*split, len(nodes), len(nodes) + 1]
        low = x[rows, split[0]] <= split[1]
        todo += [(len(nodes), rows[low]), (len(nodes) + 1, rows[~low])]
        nodes += [[*end], [*end]]
    return np.array(nodes)


def _region_of(x: np.ndarray, layout: np.ndarray) -> np.ndarray:
    at = np.zeros(len(x), "int64")
    while len(going := np.flatnonzero(layout[at, 0] >= 0)):
        column, cut, left, right = layout[at[going]].T
        at[going] = np.where(x[going, column.astype("int64")] <= cut, left, right)
    return layout[at, 2].astype("int64")


def _first_of_equals(ids: np.ndarray, groups: np.ndarray, x: np.ndarray, k: int) -> tuple:
    """Of rows with the same vector and group the k lowest ids: no query has another one among its k nearest."""
    order = np.lexsort((ids, groups, *x.T))
    ids, groups, x = ids[order], groups[order], x[order]
    fresh = np.r_[True, (groups[1:] != groups[:-1]) | (x[1:] != x[:-1]).any(axis=1)]
    place = np.arange(len(ids))
    keep = place - np.maximum.accumulate(np.where(fresh, place, 0)) < k
    return ids[keep], groups[keep], x[keep]


def _finite(x: np.ndarray) -> np.ndarray:
    """Rows that have a distance to others."""
    with np.errstate(over="ignore", invalid="ignore"):
        return np.flatnonzero(np.isfinite((x * x).sum(axis=1)))


def _region_blocks(layout: np.ndarray, k: int | None):
    """Rows (id, grp, vec) -> blocks of one region each; of equal rows only those that can be among ``k`` nearest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = vectors(batch.column("vec"))
            rows = _finite(x)
            region = _region_of(x[rows], layout)
            ids, groups = batch.column("id").to_numpy(), batch.column("grp").fill_null(-1).to_numpy()
            out = []
            for r in np.unique(region):
                some = rows[region == r]
                part = ids[some], groups[some], x[some]
                part = _first_of_equals(*part, k) if k else part
                for start in range(0, len(part[0]), BLOCK):
                    block = tuple(a[start:start + BLOCK] for a in part)
                    out.append((int(r), len(block[0]), int(block[0][0]), block[2].min(axis=0), block[2].max(axis=0), pickle.dumps(block)))
            if out:
                kinds = pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary()
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                 names=["region", "n", "first", "low", "high", "payload"])
    return run


def _gaps(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Squared distances of boxes, or points, from other boxes: number of the first ones x number of the others."""
    out = np.zeros((len(low), len(lows)))
    for c in range(low.shape[1]):
        gap = np.maximum(lows[:, c] - high[:, c, None], low[:, c, None] - highs[:, c])
        np.maximum(gap, 0.0, out=gap)
        gap *= gap
        out += gap
    return out


class _Region:
    """A region's rows in blocks with their boxes."""

    def __init__(self, payloads: list[bytes], k: int):
        parts = [pickle.loads(p) for p in payloads]
        self.ids, self.groups, self.x = _first_of_equals(*(np.concatenate([p[i] for p in parts]) for i in range(3)), k)
        self.blocks = _leaves(self.x, LEAF)
        self.low, self.high = (np.stack([f(self.x[b], axis=0) for b in self.blocks]) for f in (np.min, np.max))
        self.most = float((self.x * self.x).sum(axis=1).max())


class _Group(_Cell):
    """Queries (ids, groups, vectors, limits) that are near each other."""

    def __init__(self, part: tuple, k: int):
        super().__init__([part[:3]], k)
        self.limit = part[3]

    def bounds(self, most: float) -> np.ndarray:
        """Squared distances up to which a row can count, with a slack for roundings; ``most``: the largest square of a row."""
        return np.fmin(self.far[:, -1], self.limit) ** 2 + 1e-9 * (self.square + most) + 1e-300

    def part(self, at: np.ndarray) -> _Group:
        part = _Group((self.ids[at], self.groups[at], self.x[at], self.limit[at]), self.k)
        part.far, part.near_ids = self.far[at], self.near_ids[at]
        return part

    def search(self, region: _Region, exclude: bool) -> None:
        gaps = _gaps(self.x, self.x, region.low, region.high)
        nearest = gaps.min(axis=0)
        order = np.argsort(nearest, kind="stable")
        for start in range(0, len(order), LEAVES):
            near, bound = order[start:start + LEAVES], self.bounds(region.most)
            if nearest[near[0]] > bound.max():
                break
            open_ = gaps[:, near] <= bound[:, None]
            at = np.flatnonzero(open_.any(axis=1))
            if len(at):
                rows = np.concatenate([region.blocks[b] for b in near[open_.any(axis=0)]])
                part = self.part(at)
                part.meet(region.ids[rows], region.groups[rows], region.x[rows], exclude)
                self.far[at], self.near_ids[at] = part.far, part.near_ids

    def others(self, own: int, boxes: tuple) -> Iterator[tuple[int, tuple]]:
        """The other regions that may have nearer rows, each with its queries."""
        regions, low, high, most = boxes
        bound = self.bounds(most)
        near = _gaps(self.x.min(axis=0)[None], self.x.max(axis=0)[None], low, high)[0] <= bound.max()
        near = np.flatnonzero(near & (regions != own))
        open_ = _gaps(self.x, self.x, low[near], high[near]) <= bound[:, None]
        for k in np.flatnonzero(open_.any(axis=0)):
            at = np.flatnonzero(open_[:, k])
            yield int(regions[near[k]]), (self.ids[at], self.groups[at], self.x[at], self.far[at, -1])


FOUND = pa.schema([("q_id", pa.int64()), ("best", pa.list_(pa.struct([("dist", pa.float64()), ("r_id", pa.int64())]))),
                   ("region", pa.int32()), ("n", pa.int64()), ("first", pa.int64()), ("payload", pa.binary())])


def _region_cells(k: int, exclude: bool, boxes: tuple | None):
    """A partition's cells one after the other: queries first, then rows. What queries find, and with ``boxes`` (the regions, their
    lowest and highest values, the largest square of a row) the queries that go on to other regions."""
    def table(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in FOUND],
                                          schema=FOUND)

    def met(own: int, asked: list[bytes], given: list[bytes]) -> Iterator[pa.RecordBatch]:
        region, parts, on = _Region(given, k), [pickle.loads(p) for p in asked], {}
        ids, groups, x = (np.concatenate([p[i] for p in parts]) for i in range(3))
        limit = np.concatenate([p[3] if len(p) > 3 else np.full(len(p[0]), np.inf) for p in parts])
        for at in _leaves(x, LEAF):
            group = _Group((ids[at], groups[at], x[at], limit[at]), k)
            group.search(region, exclude)
            found = group.rows()
            yield table(q_id=found.column("q_id"), best=found.column("best").cast(FOUND.field("best").type))
            for other, part in group.others(own, boxes) if boxes else ():
                on.setdefault(other, []).append(part)
        for other, parts in on.items():
            part = [np.concatenate([p[i] for p in parts]) for i in range(4)]
            blocks = [tuple(a[start:start + BLOCK] for a in part) for start in range(0, len(part[0]), BLOCK)]
            yield table(region=[other] * len(blocks), n=[len(b[0]) for b in blocks], first=[int(b[0][0]) for b in blocks],
                        payload=[pickle.dumps(b) for b in blocks])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sides = None, ([], [])
        for batch in batches:
            for key, side, payload in zip(*(batch.column(c).to_pylist() for c in ("cell", "side", "payload"))):
                if key != at:
                    if all(sides):
                        yield from met(at // PARTS, *sides)
                    at, sides = key, ([], [])
                sides[side].append(payload)
        if all(sides):
            yield from met(at // PARTS, *sides)
    return run


def knn_by_region(ref: DataFrame, query: DataFrame, k: int, id_col: str = "vec_id", vec: str = "embedding",
                  exclude_same: str | None = None) -> DataFrame:
    """The rows of ``knn``, for vectors of few dimensions. Blocks, and what queries find in their own region, are written as checkpoints."""
    spark = ref.sparkSession
    group = (F.col(exclude_same) if exclude_same else F.lit(None)).cast("long")

    def plain(df):
        return df.filter(F.col(vec).isNotNull()).select(F.col(id_col).cast("long").alias("id"), group.alias("grp"),
                                                        F.col(vec).cast("array<double>").alias("vec"))

    def blocks(df, k=None):
        return plain(df).mapInArrow(_region_blocks(layout, k), "region int, n long, first long, low array<double>, high array<double>, payload binary")

    def cells(asked):
        sizes = asked.groupBy("region").agg(F.sum("n")).collect()
        per = max(BLOCK, min(ASKED, -(-sum(n for _, n in sizes) // (CELLS * spark.sparkContext.defaultParallelism))))
        parts = [(r, min(PARTS, -(-n // per))) for r, n in sizes]
        known = F.broadcast(spark.createDataFrame(parts, "region int, parts int"))
        cell = lambda part: (F.col("region").cast("long") * PARTS + part).alias("cell")
        left = asked.join(known, "region").select(cell(F.pmod(F.xxhash64("first"), "parts")), F.lit(0).alias("side"), "payload")
        right = given.join(known, "region").select("region", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "payload")
        right = right.select(cell(F.col("part")), F.lit(1).alias("side"), "payload")
        return left.unionByName(right).repartition(max(1, sum(p for _, p in parts)), "cell").sortWithinPartitions("cell", "side")

    count = ref.count()
    chosen = plain(ref).filter(F.pmod(F.xxhash64("id"), F.lit(max(1, count // LAYOUT_ROWS))) == 0).select("vec").limit(4 * LAYOUT_ROWS)
    seeds = vectors(chosen.toArrow().column("vec").combine_chunks())
    seeds = seeds[_finite(seeds)]
    layout = _layout(seeds, max(1, len(seeds) * REGION // max(count, 1)))
    given = blocks(ref, k).checkpoint()
    sides = given.select("region", F.posexplode(F.arrays_zip("low", "high")).alias("at", "v")).groupBy("region", "at").agg(
        F.min("v.low"), F.max("v.high")).orderBy("region", "at").collect()
    if not sides:
        return spark.createDataFrame([], "q_id long, r_id long, dist double, rank int")
    regions = np.unique([s[0] for s in sides])
    low, high = (np.array([s[i] for s in sides]).reshape(len(regions), -1) for i in (2, 3))
    boxes = regions, low, high, float(np.maximum(low ** 2, high ** 2).sum(axis=1).max())
    kinds = "q_id long, best array<struct<dist double, r_id long>>, region int, n long, first long, payload binary"
    own = cells(blocks(query).checkpoint()).mapInArrow(_region_cells(k, exclude_same is not None, boxes), kinds).checkpoint()
    more = cells(own.filter("region is not null")).mapInArrow(_region_cells(k, exclude_same is not None, None), kinds)
    return _merged(own.filter("region is null").unionByName(more).select("q_id", "best"), k)


def majority_vote(neigh: DataFrame, labels: DataFrame, k: int, label: str = "label",
                  id_col: str = "vec_id") -> DataFrame:
    """Most frequent label among the first ``k`` neighbours; ties go to the
    smallest label."""
    lab = labels.select(F.col(id_col).alias("r_id"), F.col(label).alias("__l"))
    votes = (neigh.filter(F.col("rank") <= k).join(lab, "r_id")
                  .groupBy("q_id", "__l").agg(F.count(F.lit(1)).alias("__n")))
    best = votes.groupBy("q_id").agg(F.min_by("__l", F.struct(-F.col("__n"), F.col("__l"))).alias("predicted"))
    return best


def predictions_by_k(neigh: DataFrame, labels: DataFrame, ks: list[int], label: str = "label",
                     id_col: str = "vec_id") -> DataFrame:
    """``(k, q_id, predicted, actual)``: the majority vote for every k in
    ``ks`` from ONE neighbour ranking (computed to max(ks)). The k values
    become rows via explode."""
    lab = labels.select(F.col(id_col).alias("r_id"), F.col(label).alias("__l"))
    truth = labels.select(F.col(id_col).alias("q_id"), F.col(label).alias("actual"))
    nk = neigh.join(lab, "r_id").withColumn("k", F.explode(F.sequence(F.greatest(F.col("rank"), F.lit(min(ks))), F.lit(max(ks)))))
    votes = nk.groupBy("k", "q_id", "__l").agg(F.count(F.lit(1)).alias("__n"))
    pred = votes.groupBy("k", "q_id").agg(F.min_by("__l", F.struct(-F.col("__n"), F.col("__l"))).alias("predicted"))
    return pred.join(truth, "q_id")


def labels_in_order(neigh: DataFrame, labels: DataFrame, label: str = "label", id_col: str = "vec_id") -> DataFrame:
    """``(q_id, near)``: the ranks and labels of a query's neighbours in one list."""
    lab = labels.select(F.col(id_col).alias("r_id"), F.col(label).cast("double").alias("label"))
    return neigh.join(lab, "r_id").groupBy("q_id").agg(F.collect_list(F.struct("rank", "label")).alias("near"))


def hits_by_k(near: DataFrame, labels: DataFrame, ks: list[int], label: str = "label", id_col: str = "vec_id") -> DataFrame:
    """``(k, hits)``: how many votes of the first k neighbours (ties: the smallest label, null before the others) are the
    query's own label. ``near``: see ``labels_in_order``; a query's list gives its votes for every k at once."""
    most = max(ks)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("near")
            if not len(lists):
                continue
            pairs, owner = lists.flatten(), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            rank, label = pairs.field("rank").to_numpy(), pairs.field("label")
            # codes in the order of labels: null is 0, NaN the last
            known, code = np.unique(label.fill_null(0.0).to_numpy(), return_inverse=True)
            code = np.where(label.is_null().to_numpy(zero_copy_only=False), 0, code + 1)
            actual = batch.column("actual").fill_null(0.0).to_numpy()
            at = np.minimum(np.searchsorted(known, actual), len(known) - 1)
            same = (known[at] == actual) | (np.isnan(known[at]) & np.isnan(actual))
            own = np.where(same & batch.column("actual").is_valid().to_numpy(zero_copy_only=False), at + 1, -1)
            use = rank <= most
            votes = np.zeros((len(lists), most, len(known) + 1), "int64")
            np.add.at(votes, (owner[use], rank[use] - 1, code[use]), 1)
            said = votes.cumsum(axis=1).argmax(axis=2)
            hits = (said == own[:, None]).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int32()), pa.array(hits[np.array(ks) - 1], pa.int64())], names=["k", "hits"])

    truth = labels.select(F.col(id_col).alias("q_id"), F.col(label).cast("double").alias("actual"))
    return near.join(truth, "q_id").select("near", "actual").mapInArrow(count, "k int, hits long").groupBy("k").agg(F.sum("hits").alias("hits"))
