"""Product codes of vectors, with Orchard's search for the nearest entry.

Components become integers, vectors are cut into equal consecutive parts, and
each part position has a codebook. A round assigns every part to its nearest
entry and moves each entry to the mean of its parts; all sums are integers, so
the result doesn't depend on how rows are dealt out.

Orchard's search keeps, for every entry, the list of all entries by distance
from it. It walks along the list of the best entry so far; an entry nearer to
the query takes over, and the walk goes on along that one's list, passing over
entries it has visited. It stops where the list is farther from the entry than
twice the query is: by the triangle inequality no later entry is nearer, nor as
near with a smaller index. The parts of a batch walk side by side, some list
places a step.

Spark deals out the vectors, which stay where they are read; a task sends one
row per used entry, and what the driver holds are the codebooks, of a size set
by parameters.

Defined cases: rows whose vector is null, empty, or holds null or non-finite
components take no part, nor do rows with a null id, vectors of another length
than that of the smallest id, and vectors with a component of LARGEST or more in
size (distances would leave 64 bits). A length that is no multiple of the parts is
filled up with zeros; with fewer rows than entries each codebook has an entry a
row; rows repeated with one id are rows of their own, ordered by their vectors
where the first codebook is chosen; ties go to the smaller index; an empty table
gives no rows; other columns take no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LARGEST = 32_768.0  # of a component before scaling: distances of parts of up to 1,024 components stay below 2 ** 62
STEP = 8  # list places looked at together


class Orchard:
    """Nearest entry of one codebook (integer rows)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        gap = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        self._order = np.argsort(gap, axis=1, kind="stable")  # the entry itself or an equal one first
        self._gap = np.take_along_axis(gap, self._order, axis=1)
        middle = entries.sum(axis=0) // max(len(entries), 1)
        self._start = int(((entries - middle) ** 2).sum(axis=1).argmin())

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) per row of ``x``; ties to the smaller index."""
        n, size = len(x), len(self.entries)
        most = max(int(np.abs(x).max(initial=0)), int(np.abs(self.entries).max(initial=0)))
        kind = "int32" if (2 * most) ** 2 * x.shape[1] < 1 << 31 else "int64"  # exact either way
        x, entries = x.astype(kind), self.entries.astype(kind)
        best = np.full(n, self._start)
        near = ((x - entries[self._start]) ** 2).sum(axis=1, dtype="int64")
        visited = np.zeros((n, size), bool)
        visited[:, self._start] = True
        at = np.zeros(n, dtype="int64")  # place in the list of the best entry
        going = np.arange(n)
        places = np.arange(STEP)
        while len(going):
            look = np.minimum(at[going, None] + places, size - 1)
            entry = self._order[best[going, None], look]
            # within twice the distance (squares: four times)
            inside = self._gap[best[going, None], look] <= 4 * near[going, None]
            fresh = inside & ~visited[going[:, None], entry] & (at[going, None] + places < size)
            row, col = np.nonzero(fresh)
            better = np.zeros(len(going), bool)
            if len(row):
                found = entry[row, col]
                visited[going[row], found] = True
                gap = x[going[row]] - entries[found]
                d = np.einsum("ij,ij->i", gap, gap).astype("int64")
                order = np.lexsort((found, d, row))
                first = order[np.r_[True, row[order][1:] != row[order][:-1]]]
                r, e, d = row[first], found[first], d[first]
                q = going[r]
                won = (d < near[q]) | ((d == near[q]) & (e < best[q]))
                best[q[won]], near[q[won]] = e[won], d[won]
                better[r[won]] = True
            at[going] = np.where(better, 0, at[going] + STEP)
            going = going[better | (inside.all(axis=1) & (at[going] < size))]
        return best, near


def _rows_of(batch: pa.RecordBatch, scale: int, width: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the kept rows, their integer vectors) of a batch; vectors have ``width`` components."""
    lists = batch.column("vector")
    ends = lists.offsets.to_numpy().astype("int64")
    size = np.diff(ends)
    at = np.flatnonzero(np.asarray(lists.is_valid()) & (size == width))
    flat = lists.values.to_numpy(zero_copy_only=False).astype("float64")  # null components become NaN
    x = flat[ends[at][:, None] + np.arange(width)[None, :]]
    with np.errstate(invalid="ignore"):
        good = np.isfinite(x).all(axis=1) & (np.abs(x) < LARGEST).all(axis=1)
    return at[good], np.floor(x[good] * float(scale)).astype("int64")


def _cut(x: np.ndarray, parts: int) -> list[np.ndarray]:
    wide = -(-x.shape[1] // parts) * parts
    if wide > x.shape[1]:
        x = np.concatenate([x, np.zeros((len(x), wide - x.shape[1]), x.dtype)], axis=1)
    return [np.ascontiguousarray(p) for p in np.split(x, parts, axis=1)]


def _sums(books: list[np.ndarray], scale: int, width: int):
    """A task's sums and counts per part and entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Orchard(b) for b in books]
        total = [np.zeros(b.shape, "int64") for b in books]
        count = [np.zeros(len(b), "int64") for b in books]
        for batch in batches:
            _, x = _rows_of(batch, scale, width)
            for p, part in enumerate(_cut(x, len(books))):
                entry, _ = search[p].nearest(part)
                np.add.at(total[p], entry, part)
                count[p] += np.bincount(entry, minlength=len(books[p]))
        for p in range(len(books)):
            used = np.flatnonzero(count[p])
            # a row per component: sums add up in Spark as exact integers
            for e in used.tolist():
                d = total[p].shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p] * d, pa.int32()), pa.array([e] * d, pa.int32()), pa.array(range(d), pa.int32()),
                     pa.array(total[p][e]), pa.array([int(count[p][e])] * d, pa.int64())], names=["part", "entry", "at", "total", "n"])
    return run


def _coded(books: list[np.ndarray], scale: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Orchard(b) for b in books]
        digits = np.array([f"{i:02x}" for i in range(max(len(b) for b in books))])
        for batch in batches:
            at, x = _rows_of(batch, scale, width)
            code, error = np.full(len(at), "", dtype=object), np.zeros(len(at), "int64")
            for p, part in enumerate(_cut(x, len(books))):
                entry, near = search[p].nearest(part)
                code, error = code + digits[entry].astype(object), error + near
            kept = batch.select(["vec_id", "label"]).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), pa.array(code, pa.string()), pa.array(error)],
                                             names=["vec_id", "label", "code", "error"])
    return run


def _valid(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("vector"),
                          vectors[label_col].alias("label"))
    good = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LARGEST))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & good)


def fit_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                  scale: int = SCALE) -> tuple[list[np.ndarray], int]:
    """(codebook per part, length of the vectors) from ``vec_id, vector``."""
    shortest = rows.orderBy("vec_id", "vector").select(F.size("vector")).first()
    width = shortest[0] if shortest else 0
    first = rows.filter(F.size("vector") == width).orderBy("vec_id", "vector").limit(entries).select("vector").collect()
    if not first:
        return [np.empty((0, 0), "int64")] * parts, 0
    books = _cut(np.floor(np.array([r["vector"] for r in first], "float64") * float(scale)).astype("int64"), parts)
    for _ in range(rounds):
        sums = rows.select("vector").mapInArrow(_sums(books, scale, width), "part int, entry int, at int, total long, n long")
        moved = [b.copy() for b in books]
        for r in sums.groupBy("part", "entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
            moved[r["part"]][r["entry"], r["at"]] = r["total"] // r["n"]
        books = moved
    return books, width


def codebooks_digest(books: list[np.ndarray]) -> str:
    """sha256 of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def encode(rows: DataFrame, books: list[np.ndarray], width: int, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, code, error`` per row with a vector of ``width`` components."""
    return rows.select("vec_id", "vector", "label").mapInArrow(
        _coded(books, scale, width), f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, code string, error long")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` per kept row."""
    rows = _valid(vectors, id_col, vector_col, label_col)
    books, width = fit_codebooks(rows, parts, entries, rounds, scale)
    if not width:
        return rows.limit(0).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                                    F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = materialise(encode(rows, books, width, scale), "vector_codes")
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return (coded.join(sums, coded["label"].eqNullSafe(F.col("_label")), "left").drop("_label")
            .withColumn("codebooks_sha256", F.lit(codebooks_digest(books))))


def decode(codes: DataFrame, books: list[np.ndarray], code_col: str = "code", scale: int = SCALE) -> DataFrame:
    """Add ``vector``: the entries of a row's code, in the original scale."""
    tables = [F.array(*[F.array(*[F.lit(v / scale) for v in e]) for e in b.tolist()]) for b in books]
    at = lambda p: F.conv(F.substring(code_col, 2 * p + 1, 2), 16, 10).cast("int")
    return codes.withColumn("vector", F.concat(*[F.get(t, at(p)) for p, t in enumerate(tables)]))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same in SQL, every part against every entry."""
    sql = [f"""kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
               list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v, len(embedding) // {parts} AS w
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
           f"""cut AS MATERIALIZED (
        SELECT r, vec_id, p, list_slice(v, p * w + 1, p * w + w) AS x FROM kept, range({parts}) AS t(p))""",
           f"book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS b FROM cut WHERE r <= {entries})"]
    for k in range(rounds + 1):
        sql.append(f"""near{k} AS MATERIALIZED (
        SELECT r, p, first(e ORDER BY d, e) AS e, min(d) AS d FROM (
            SELECT r, cut.p, e, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - b[i]) * (x[i] - b[i]))) AS d
            FROM cut JOIN book{k} ON cut.p = book{k}.p) GROUP BY r, p)""")
        if k < rounds:
            sql.append(f"""mean{k} AS MATERIALIZED (
        SELECT p, e, list(m ORDER BY i) AS b FROM (
            SELECT p, e, i, floor(sum(x[i]) / count(*)) AS m
            FROM cut JOIN near{k} USING (r, p), range(1, 1 + (SELECT max(w) FROM kept)) AS t(i) GROUP BY p, e, i) GROUP BY p, e)""")
            sql.append(f"""book{k + 1} AS MATERIALIZED (
        SELECT p, e, coalesce(mean{k}.b, book{k}.b) AS b FROM book{k} LEFT JOIN mean{k} USING (p, e))""")
    sql.append(f"""coded AS MATERIALIZED (
        SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY r)""")
    return "WITH " + ",\n    ".join(sql) + f"""
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(array_to_string(list_transform(b, lambda v: CAST(CAST(v AS BIGINT) AS VARCHAR)), ','), ','
                                     ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
    FROM kept JOIN coded USING (r)"""
