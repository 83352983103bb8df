"""Near duplicates among embeddings, by small-world graphs per shard.

Vectors with one label are dealt into shards of bounded size by a hash, and each
shard gets a graph (``hnsw``). Every vector searches every shard of its label: a
cell, a pair of shards, searches both ways and joins what either way found. A
search whose whole beam lies within the threshold is repeated with a wider one.
In each cell and direction a hashed sample of the queries is also compared with
the whole shard; until the audited recall of links is AUDIT_RECALL, the beam
doubles for all queries of the cell. (If even a beam as wide as the shard fails,
because the graph has parts that don't meet, the shard is compared whole.) What
was found is verified by cosine in double precision.

Equal vectors are one class: copies are counted, not searched. A cell sends, per
class with links, their number and the least class it reaches within the cell;
so links never leave a task one by one, and a group of near copies costs a row a
vector and cell. Components are united over the rows of all cells.

Work grows with the product of a label's shards, as every query meets every
shard; larger shards (a parameter) make that slower than the square of the rows.

Defined cases: a null label, and vectors that are null, empty, zero or hold null
or non-finite components, link with nothing, nor do vectors whose squares sum to
zero or overflow; vectors of different length are never compared; a row with a
null id links with nothing and has a null component; rows that repeat an id and
its vector count once; an id with several vectors has a row each with the links
of its own vector, and one component; an empty table gives no rows; other
columns take no part, whatever their names.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .block_ann import cosine
from .common import Scratch
from .components import components
from .exact_dedup import mark_held, repeated_keys
from .hnsw import Graph, mix

SHARD_ROWS = 4096
MAX_TASKS = 10_000
BEAM = 48
SLACK = 1e-4  # of similarities in single precision
AUDIT_SHARE, AUDIT_LEAST, AUDIT_RECALL = 8, 128, 0.995  # one query in 8, at least 128
FILTER_ROWS = 1024
PAIRS = 100_000  # verified at a time


class Shard:
    """The classes of one shard and their graph."""

    def __init__(self, node: list[int], mark: list[int], copies: list[int], x: np.ndarray):
        self.node, self.mark, self.copies = np.array(node, "int64"), np.array(mark, "int64"), np.array(copies, "int64")
        self.graph = Graph(x, self.node ^ self.mark)
        order = self.graph.order
        self.node, self.mark, self.copies, self.x = self.node[order], self.mark[order], self.copies[order], x[order]

    def packed(self) -> bytes:
        """Plain arrays: classes shipped by value can't be unpickled elsewhere."""
        return pickle.dumps((self.node, self.mark, self.copies, self.x, self.graph.x, self.graph.layers))

    @classmethod
    def unpacked(cls, payload: bytes) -> Shard:
        out = cls.__new__(cls)
        out.graph = Graph.__new__(Graph)
        out.node, out.mark, out.copies, out.x, out.graph.x, out.graph.layers = pickle.loads(payload)
        return out


def _found(graph: Graph, q: np.ndarray, ef: int, least: float, own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) pairs within ``least`` that beams of ``ef`` meet; a beam that lies within it whole is widened."""
    size, todo = len(graph.x), np.arange(len(q))
    out: list[tuple[np.ndarray, np.ndarray]] = []
    while len(todo):
        ef, full = min(ef, size), []
        step = max(1, (1 << 21) // ef)
        for at in range(0, len(todo), step):
            part = todo[at:at + step]
            node, sim = graph.search(q[part], ef, None if own is None else own[part])
            wide = (sim[:, -1] >= least) if ef < size else np.zeros(len(part), bool)
            r, c = np.nonzero((sim >= least) & ~wide[:, None])
            out.append((part[r], node[r, c]))
            full.append(part[wide])
        todo, ef = np.concatenate(full), ef * 2
    return tuple(np.concatenate([o[k] for o in out]) for k in (0, 1)) if out else (np.empty(0, int), np.empty(0, int))


def _whole(graph: Graph, q: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs within ``least``, by products with the whole shard."""
    parts = []
    for at in range(0, len(q), 512):
        r, c = np.nonzero(q[at:at + 512] @ graph.x.T >= least)
        parts.append((r + at, c))
    return tuple(np.concatenate([p[k] for p in parts]) for k in (0, 1))


def audited(graph: Graph, q: np.ndarray, keys: np.ndarray, threshold: float, own: np.ndarray | None = None,
            beam: int = BEAM) -> tuple[np.ndarray, np.ndarray, float, int]:
    """(queries, nodes, recall audited before any comparison of the whole shard, beam)"""
    least, size = threshold - SLACK, len(graph.x)
    count = max(AUDIT_LEAST, len(q) // AUDIT_SHARE)
    sample = np.sort(np.argsort(mix(keys ^ np.int64(0x5DEECE66D)), kind="stable")[:count])
    a, b = _whole(graph, q[sample], least)
    truth = np.unique(sample[a].astype("int64") * size + b)
    while True:
        rows, nodes = _found(graph, q, beam, least, own)
        recall = np.isin(truth, rows.astype("int64") * size + nodes).mean() if len(truth) else 1.0
        if recall >= AUDIT_RECALL:
            return rows, nodes, float(recall), beam
        if beam >= size:
            return *_whole(graph, q, least), float(recall), beam
        beam *= 2


def _verified(x: np.ndarray, y: np.ndarray, rows: np.ndarray, nodes: np.ndarray, threshold: float) -> np.ndarray:
    keep = np.zeros(len(rows), bool)
    for at in range(0, len(rows), PAIRS):
        s = slice(at, at + PAIRS)
        keep[s] = cosine(x[rows[s]], y[nodes[s]]) >= threshold
    return keep


def _linked(left: Shard, right: Shard | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of a cell as distinct pairs (place in left, place in right); within one shard in both orders."""
    if right is None:
        n = len(left.node)
        a, b, _, _ = audited(left.graph, left.graph.x, left.mark, threshold, np.arange(n))
        a, b = np.r_[a, b], np.r_[b, a]
        a, b = a[a != b], b[a != b]
        other = left
    else:
        a, b, _, _ = audited(right.graph, left.graph.x, left.mark, threshold)
        d, c, _, _ = audited(left.graph, right.graph.x, right.mark, threshold)
        a, b, other = np.r_[a, c], np.r_[b, d], right
    codes = np.unique(a.astype("int64") * len(other.node) + b)
    a, b = codes // len(other.node), codes % len(other.node)
    keep = _verified(left.x, other.x, a, b, threshold)
    return a[keep], b[keep]


def _reached(n: int, a: np.ndarray, b: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Per place the least name it reaches."""
    least = name.copy()
    while True:
        before = least.copy()
        np.minimum.at(least, a, before[b])
        np.minimum.at(least, b, before[a])
        if np.array_equal(before, least):
            return least


def cell_rows(left: Shard, right: Shard | None, threshold: float) -> pa.RecordBatch:
    """``node, mark, n_links, reached`` per class of the cell that has links in it."""
    a, b = _linked(left, right, threshold)
    n = len(left.node)
    if right is None:
        node, mark, copies = left.node, left.mark, left.copies
        links = np.bincount(a, copies[b], n)
    else:
        node, mark, copies = (np.r_[u, v] for u, v in ((left.node, right.node), (left.mark, right.mark), (left.copies, right.copies)))
        b = b + n
        links = np.bincount(a, copies[b], len(node)) + np.bincount(b, copies[a], len(node))
    reached = _reached(len(node), a, b, node)
    some = links > 0
    return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(mark[some]), pa.array(links[some].astype("int64")),
                                       pa.array(reached[some])], names=["node", "mark", "n_links", "reached"])


def _groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...], values: tuple[str, ...]) -> Iterator[tuple[tuple, list]]:
    """Runs of rows with the same ``names``."""
    now, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names + values)):
            if row[:len(names)] != now:
                if held:
                    yield now, held
                now, held = row[:len(names)], []
            held.append(row[len(names):])
    if held:
        yield now, held


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key = ("label", "dim", "shard")
    for (label, dim, shard), rows in _groups(batches, key, ("node", "mark", "copies", "vector")):
        node, mark, copies, vector = zip(*rows)
        payload = Shard(node, mark, copies, np.array(vector, "float64")).packed()
        yield pa.RecordBatch.from_arrays([pa.array([label], pa.string()), pa.array([dim], pa.int32()), pa.array([shard], pa.int64()),
                                          pa.array([payload], pa.binary())], names=[*key, "payload"])


def _cells(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, ("label", "dim", "i", "j"), ("payload",)):
            shards = [Shard.unpacked(r[0]) for r in rows]
            yield cell_rows(shards[0], shards[1] if len(shards) > 1 else None, threshold)
    return run


def similar_vectors(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embedding_dedup")
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[label_col].cast("string").alias("label"),
                          vectors[vector_col].cast("array<double>").alias("vector"))
    inf = F.lit(float("inf"))
    squares = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v)
    valid = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull()
                       & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < inf))
                       & (squares > 0) & (squares < inf), F.lit(False))
    rows = rows.withColumn("valid", valid).withColumn("mark", F.xxhash64("label", "vector"))
    some = rows.filter("valid")

    # classes of equal vectors: one whose mark is surely unique is its row, which passes no shuffle here
    marks = scratch.write(repeated_keys(some.select(F.col("mark").alias("key")), FILTER_ROWS), "repeated_marks")
    some = mark_held(some, F.col("mark"), marks, FILTER_ROWS, "often")
    members = some.filter("often").select("label", "vector", "mark", "vec_id").distinct()
    several = scratch.write(members.groupBy("label", "vector", "mark").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")), "classes")
    alone = some.filter("not often").select("label", "vector", "mark", F.col("vec_id").alias("node"), F.lit(1).cast("long").alias("copies"))
    classes = several.unionByName(alone).withColumn("dim", F.size("vector"))

    # shards and their graphs
    sizes = scratch.write(classes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("shards")), "sizes")
    total = sizes.agg(F.coalesce(F.sum("shards"), F.lit(0)), F.coalesce(F.sum(F.expr("shards * (shards + 1) / 2")), F.lit(0))).first()
    tasks = lambda n: int(min(max(n, spark.sparkContext.defaultParallelism), MAX_TASKS))
    dealt = classes.join(sizes, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("node", "mark"), F.col("shards")))
    key = ["label", "dim", "shard"]
    graphs = (dealt.select(*key, "node", "mark", "copies", "vector").repartition(tasks(2 * total[0]), *key)
              .sortWithinPartitions(*key).mapInArrow(_build, "label string, dim int, shard long, payload binary"))
    graphs = scratch.write(graphs, "graphs")

    # cells: every shard with itself and with each later one of its label
    last = F.col("shards") - 1
    cells = sizes.select("label", "dim", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("i"), "shards")
    cells = cells.select("label", "dim", "i", F.explode(F.sequence(F.col("i"), last)).alias("j"))
    sides = cells.select("label", "dim", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("shard"))
    loaded = sides.join(graphs, key).repartition(tasks(2 * total[1]), "label", "dim", "i", "j")
    found = (loaded.sortWithinPartitions("label", "dim", "i", "j", "shard").select("label", "dim", "i", "j", "payload")
             .mapInArrow(_cells(threshold), "node long, mark long, n_links long, reached long"))
    found = scratch.write(found, "cell_links")
    scratch.release("graphs", "sizes")

    # components of classes; an id with several vectors ties their classes (more ids may seem repeated: that adds no link)
    ids = scratch.write(repeated_keys(some.select(F.xxhash64("vec_id").alias("key")), FILTER_ROWS), "repeated_ids")
    copies = some.filter("often").select("vec_id", "label", "vector", "mark").join(several, ["mark", "label", "vector"])
    copies = scratch.write(copies.select("vec_id", "mark", "node", (F.col("copies") - 1).alias("equal")), "copies")
    tied = mark_held(copies, F.xxhash64("vec_id"), ids, FILTER_ROWS, "twice").filter("twice")
    links = found.select(F.col("node").alias("a"), F.col("reached").alias("b")).unionByName(
        tied.select(F.col("vec_id").alias("a"), F.col("node").alias("b"))).filter("a <> b")
    joined = scratch.write(components(links), "components").select(F.col("node").alias("at"), "component")
    counts = scratch.write(found.groupBy("node", "mark").agg(F.sum("n_links").alias("n")), "counts")

    of_class = copies.unionByName(some.filter("not often").select("vec_id", "mark", F.col("vec_id").alias("node"), F.lit(0).cast("long").alias("equal")))
    linked = (of_class.join(counts, ["node", "mark"], "left").join(joined, F.col("node") == F.col("at"), "left")
              .select("vec_id", (F.col("equal") + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id")))
    rest = rows.filter("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def oracle(threshold: float = 0.93) -> str:
    """All pairs in SQL: every vector reaches the ids that its links lead to."""
    return f"""WITH RECURSIVE v AS MATERIALIZED (
        SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS MATERIALIZED (
        SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
        WHERE list_dot_product(a.x, b.x) / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= {threshold}),
    reach AS (SELECT a, a AS c FROM (SELECT DISTINCT a FROM links) UNION SELECT links.b AS a, reach.c FROM reach JOIN links ON links.a = reach.a)
    SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id, vec_id = coalesce(c, vec_id) AS kept
    FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) AS n ON n.a = vec_id
    LEFT JOIN (SELECT a, min(c) AS c FROM reach GROUP BY a) AS r ON r.a = vec_id"""
