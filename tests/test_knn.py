"""Nearest rows against brute force, however cells are cut."""

import numpy as np
import pytest

from vistaframe.operators import knn as K


@pytest.mark.parametrize("kind,exclude", [("float", None), ("double", None), ("double", "fold")])
def test_equals_brute_force(spark, monkeypatch, kind, exclude):
    monkeypatch.setattr(K, "BLOCK", 16)
    monkeypatch.setattr(K, "MET_QUERIES", 10)
    monkeypatch.setattr(K, "EXACT_PAIRS", 50)
    rng = np.random.default_rng(4)
    x = rng.integers(-2, 3, (150, 3)).astype("float32")  # many ties
    df = spark.createDataFrame([(i, [float(v) for v in r], i % 4) for i, r in enumerate(x)], f"vec_id long, embedding array<{kind}>, fold int")
    got = {(r.q_id, r["rank"]): (r.r_id, r.dist) for r in K.knn(df.repartition(3), df.repartition(2), 7, exclude_same=exclude).collect()}
    for q in range(150):
        every = sorted((float(np.sqrt(((x[q].astype(float) - x[r]) ** 2).sum())), r) for r in range(150) if not exclude or r % 4 != q % 4)
        assert [got[q, k + 1] for k in range(7)] == [(r, pytest.approx(d)) for d, r in every[:7]]
    assert len(got) == 150 * 7


def test_fewer_rows_than_asked_for_and_bad_rows(spark):
    rows = [(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [float("nan"), 0.0]), (3, [3.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.q_id, r["rank"], r.r_id, r.dist) for r in K.knn(df, df.filter("vec_id <> 3"), 5).collect())
    assert got == [(0, 1, 0, 0.0), (0, 2, 1, 1.0), (0, 3, 3, 5.0), (1, 1, 1, 0.0), (1, 2, 0, 1.0), (1, 3, 3, pytest.approx(20 ** 0.5))]


def test_a_query_leaves_a_cell_as_one_row(spark):
    """A cell's bests are one list per query, and few cells see a query."""
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(rng.normal(size=(300, 2)))], "vec_id long, embedding array<double>")
    plan = K.knn(df, df, 5)._jdf.queryExecution().toString()
    assert "flatten(collect_list(best" in plan


@pytest.fixture
def small_regions(monkeypatch):
    for name, value in {"REGION": 64, "LEAF": 8, "LAYOUT_ROWS": 300, "BLOCK": 16, "ASKED": 32, "MET_QUERIES": 10}.items():
        monkeypatch.setattr(K, name, value)


def odd_vectors(kind, rng, n):
    if kind == "ties":
        return rng.integers(-2, 3, (n, 3)).astype(float)
    if kind == "equal":
        return np.zeros((n, 2))
    if kind == "mixed":
        return np.c_[rng.integers(0, 2, (n, 3)), np.round(rng.normal(size=n), 1)].astype(float)
    x = rng.normal(size=(n, 4))
    x[3, 1], x[4, 0], x[5] = np.nan, np.inf, 1e200
    return x


@pytest.mark.parametrize("kind", ["ties", "equal", "mixed", "bad"])
@pytest.mark.parametrize("exclude", [None, "fold"])
def test_regions_give_the_rows_of_all_pairs(spark, small_regions, kind, exclude):
    rng = np.random.default_rng(1)
    x = odd_vectors(kind, rng, 400)
    ids = rng.integers(0, 250, 400) if kind == "mixed" else rng.permutation(400)  # ids that repeat
    rows = [(int(i), [float(v) for v in r], j % 4 if j % 9 else None) for j, (i, r) in enumerate(zip(ids, x))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, fold int").repartition(5)
    asked = df.filter("vec_id % 3 <> 0")
    got = K.knn_by_region(df, asked, 7, exclude_same=exclude).collect()
    assert got and sorted(map(tuple, got)) == sorted(map(tuple, K.knn(df, asked, 7, exclude_same=exclude).collect()))


def test_regions_without_rows(spark):
    df = spark.createDataFrame([(0, [1.0], 0), (1, None, 0)], "vec_id long, embedding array<double>, fold int")
    assert K.knn_by_region(df.limit(0), df, 3).count() == 0 and K.knn_by_region(df, df.limit(0), 3).count() == 0
    assert [tuple(r) for r in K.knn_by_region(df, df, 3).collect()] == [(0, 0, 0.0, 1)]


def test_a_group_meets_few_of_a_regions_rows(monkeypatch):
    import pickle

    rng, met = np.random.default_rng(2), []
    x, none = rng.normal(size=(20_000, 3)), np.zeros(20_000, "int64")
    region = K._Region([pickle.dumps((np.arange(20_000), none, x))], 5)
    group = K._Group((np.arange(50), none[:50], x[:50] * 0.01, np.full(50, np.inf)), 5)
    monkeypatch.setattr(K._Group, "meet", lambda self, ids, *a, f=K._Cell.meet: met.append(len(ids)) or f(self, ids, *a))
    group.search(region, False)
    for q, ids in zip(group.x, group.near_ids):
        assert ids.tolist() == np.argsort(((x - q) ** 2).sum(axis=1))[:5].tolist()
    assert sum(met) < 4_000


def test_of_equal_rows_the_lowest_ids_stay():
    x, ids = np.repeat([[0.0, 1.0], [2.0, 3.0]], 50, axis=0), np.arange(100)[::-1].copy()
    kept, groups, _ = K._first_of_equals(ids, ids % 2, x, 3)
    assert sorted(kept.tolist()) == [0, 1, 2, 3, 4, 5, 50, 51, 52, 53, 54, 55] and (groups == kept % 2).all()


def test_hits_for_every_k_equal_the_votes(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=2)], None if i % 17 == 0 else float(rng.integers(0, 3)) if i % 19 else float("nan"))
            for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label double")
    near, ks = K.knn(df, df, 9), [1, 2, 5, 9]
    want = {k: 0 for k in ks}
    for r in K.predictions_by_k(near, df, list(range(1, 10))).filter("predicted = actual").groupBy("k").count().collect():
        want[r["k"]] = r["count"]
    got = {r["k"]: r["hits"] for r in K.hits_by_k(K.labels_in_order(near, df), df, ks).collect()}
    assert got == {k: want[k] for k in ks}
