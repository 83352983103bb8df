import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vistaframe.llm import vector_codes as vc
from vistaframe.llm.common import prepare


def brute(rows, parts, entries, rounds):
    """rows (vec_id, vector, label) -> the result's rows, in plain Python."""
    good = [r for r in rows if r[0] is not None and r[1] and all(v is not None and math.isfinite(v) for v in r[1])]
    good.sort(key=lambda r: (r[0], r[1]))
    vec = [[math.floor(1024 * v) for v in r[1]] for r in good]
    w = len(vec[0]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for v in vec]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(near(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(col) // len(groups[i]) for col in zip(*groups[i])] if i in groups else e for i, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    out = []
    for r, c in zip(good, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append([r[0], r[2], "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)])
    return sorted(((i, c, e, sum(o[3] for o in out if o[1] == lab), digest) for i, lab, c, e in out), key=str)


def got(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows],
                                  "vec_id long, embedding array<double>, label int, code string, part int, entry int")
    out = vc.compress(frame, **options)
    return sorted(map(tuple, out.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


@pytest.mark.parametrize("size,width", [(1, 3), (2, 1), (40, 4), (256, 16)])
def test_orchard_equals_all_distances(size, width):
    rng = np.random.default_rng(size)
    entries = rng.integers(-6, 7, (size, width)) * (1 if width < 16 else 40)  # few values: many ties and equal entries
    x = np.concatenate([rng.integers(-8, 9, (700, width)) * (1 if width < 16 else 40), entries])
    d = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    index, near = vc.Orchard(entries).nearest(x)
    assert np.array_equal(index, d.argmin(axis=1)) and np.array_equal(near, d.min(axis=1))


@pytest.mark.parametrize("entries", [8, 256])
def test_codes_equal_brute_force(spark, entries):
    rng = np.random.default_rng(entries)
    rows = [(int(i), (rng.integers(-3, 4, 8) / 7 + rng.integers(0, 3)).tolist(), [0, 1, 2, None][i % 4]) for i in rng.permutation(120)]
    rows += [(200, None, 1), (201, [0.0] * 8, None), (202, [1.0, None] + [0.0] * 6, 1), (203, [math.nan] + [0.0] * 7, 1),
             (204, [math.inf] + [0.0] * 7, 1), (7, [9.0] * 8, 5), (7, [9.0] * 8, 5), (None, [1.0] * 8, 1), (205, [], 1)]
    assert got(prepare(spark), rows, entries=entries) == brute(rows, 4, entries, 4)


def test_lengths_and_empty_tables(spark):
    rows = [(1, [0.5, 1.0, 0.25, 2.0, 3.0], 1), (2, [0.5] * 4, 1), (3, [0.25] * 5, 1), (4, [1e9] * 5, 1)]
    assert [r[0] for r in got(prepare(spark), rows)] == [1, 3]  # of another length, too large: no part
    assert got(spark, []) == [] and got(spark, [(1, None, 1)]) == []


def test_decode_gives_the_entries(spark):
    rng = np.random.default_rng(1)
    frame = prepare(spark).createDataFrame([(i, rng.normal(size=8).tolist(), 1) for i in range(20)],
                                           "vec_id long, embedding array<double>, label int")
    rows = vc._valid(frame, "vec_id", "embedding", "label")
    books, width = vc.fit_codebooks(rows)
    for r in vc.decode(vc.encode(rows, books, width), books).join(rows.select("vec_id", F.col("vector").alias("original")), "vec_id").collect():
        gap = sum((math.floor(1024 * a) - 1024 * b) ** 2 for a, b in zip(r.original, r.vector))
        assert gap == r.error
