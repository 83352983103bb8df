import math

import numpy as np
import pytest

from vistaframe.llm import embedding_dedup as ed
from vistaframe.llm import hnsw
from vistaframe.llm.common import prepare


def brute(rows, threshold):
    """{(id, vector): (links, component, kept)} for rows (id, vector, label) that are distinct."""
    def valid(r):
        return (r[0] is not None and r[2] is not None and r[1] and all(v is not None and math.isfinite(v) for v in r[1])
                and 0 < sum(v * v for v in r[1]) < math.inf)

    good = [r for r in rows if valid(r)]
    parent = {r[0]: r[0] for r in good}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(good)
    for i, a in enumerate(good):
        for j, b in enumerate(good[:i]):
            if a[2] == b[2] and len(a[1]) == len(b[1]) and a[0] != b[0]:
                x, y = np.array(a[1]), np.array(b[1])
                if float((x * y).sum()) / (math.sqrt(float((x * x).sum())) * math.sqrt(float((y * y).sum()))) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    p, q = find(a[0]), find(b[0])
                    parent[max(p, q)] = min(p, q)
    out = [(r[0], n, find(r[0]), r[0] == find(r[0])) for r, n in zip(good, links)]
    out += [(r[0], 0, r[0], True) for r in rows if not valid(r)]
    return sorted(out, key=str)


def got(spark, rows, threshold=0.93, **options):
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows],
                                  "vec_id long, embedding array<double>, label int, node int, mark string, dim int")
    return sorted(map(tuple, ed.similar_vectors(frame, threshold, **options).collect()), key=str)


def families(seed, n, dim=16):
    """Clusters of near copies of all sizes, exact copies, labels of unlike size."""
    rng, rows = np.random.default_rng(seed), []
    while len(rows) < n:
        base, label = rng.normal(size=dim), int(rng.choice([0, 0, 0, 1, 2]))
        for _ in range(int(rng.choice([1, 1, 2, 5, 40]))):
            noise = rng.normal(size=dim) * rng.choice([0, 0.05, 0.2, 0.4])
            rows.append((len(rows), (base + noise).tolist(), label))
    return rows


@pytest.mark.parametrize("shard_rows", [4096, 60])
def test_equal_to_all_pairs(spark, shard_rows):
    rows = families(shard_rows, 500)
    assert got(prepare(spark), rows, shard_rows=shard_rows) == brute(rows, 0.93)


def test_defined_cases(spark):
    a, b = [1.0] + [0.0] * 7, [0.0, 1.0] + [0.0] * 6
    rows = [(9, a, 1), (3, a, 1), (4, a, 2), (5, a, None), (6, None, 1), (7, [], 1), (8, [0.0] * 8, 1), (10, [None] + a[1:], 1),
            (11, [math.nan] + a[1:], 1), (12, [math.inf] + a[1:], 1), (13, [1.0], 1), (None, a, 1), (14, [1e200] * 8, 1),
            (15, [2.0] + [0.0] * 7, 1), (20, b, 1), (21, [0.0, 1.0, 0.1] + [0.0] * 5, 1)]
    assert got(prepare(spark), rows) == brute(rows, 0.93)
    assert got(spark, []) == []


def test_repeated_ids(spark):
    a, b, c = ([0.0] * k + [1.0] + [0.0] * (3 - k) for k in range(3))
    rows = [(3, a, 1), (5, a, 1), (5, a, 1), (5, b, 1), (8, b, 1), (9, c, 1)]
    assert got(prepare(spark), rows) == sorted([(3, 1, 3, True), (5, 1, 3, False), (5, 1, 3, False), (5, 1, 3, False),
                                                (8, 1, 3, False), (9, 0, 9, True)], key=str)


def test_a_group_of_equal_vectors_is_one_class(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=8).tolist()
    rows = [(i, base, 1) for i in range(300)] + [(1000 + i, rng.normal(size=8).tolist(), 1) for i in range(50)]
    out = {r[0]: r for r in got(prepare(spark), rows, shard_rows=20)}
    assert all(out[i][1] >= 299 and out[i][2] == 0 for i in range(300))
    assert list(out.values()) == brute(rows, 0.93) or sorted(out.values(), key=str) == brute(rows, 0.93)


def test_graph_finds_neighbours():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 16))
    graph = hnsw.Graph(x, np.arange(3000))
    q = rng.normal(size=(200, 16)).astype("float32")
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    node, sim = graph.search(q, 64)
    truth = np.argsort(-(q @ graph.x.T), axis=1)[:, :10]
    assert np.mean([len(set(t) & set(n.tolist())) / 10 for t, n in zip(truth, node)]) > 0.95
    assert all((np.diff(s[s > -np.inf]) <= 0).all() for s in sim)
    assert len(graph.layers) > 1 and len(graph.layers[-1]) == 3000


@pytest.mark.parametrize("n", [1, 2, 3, 17, 33, 100])
def test_small_graphs(n):
    x = np.random.default_rng(n).normal(size=(n, 4))
    graph = hnsw.Graph(x, np.arange(n))
    node, _ = graph.search(graph.x, n)
    assert (node[:, 0] == np.arange(n)).all()


def test_beams_widen_until_the_audit_passes():
    """A group larger than the beam, and far clusters: the audited recall holds."""
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=32) * 4 + rng.normal(size=(700, 32)) * 0.3] + [rng.normal(size=(800, 32))])
    graph = hnsw.Graph(x, np.arange(1500))
    rows, nodes, recall, beam = ed.audited(graph, graph.x, np.arange(1500), 0.93, np.arange(1500), beam=8)
    truth = (graph.x @ graph.x.T >= 0.93 - ed.SLACK).sum()
    assert recall >= ed.AUDIT_RECALL and len(np.unique(rows * 1500 + nodes)) >= 0.99 * truth


def test_components_within_a_cell():
    n = np.array([50, 10, 40, 30, 20, 60])
    assert ed._reached(6, np.array([0, 2]), np.array([2, 3]), n).tolist() == [30, 10, 30, 30, 20, 60]
