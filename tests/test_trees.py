"""Trees and boosting grown from histograms equal twins that search every split of plain rows."""

import functools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vistaframe.operators import batched as B
from vistaframe.operators import models as M
from vistaframe.operators import trees as T
from vistaframe.registry import models as RM

SCHEMA = "a double, b double, c double, label double, fold int"


def frame(spark, x, y, fold):
    rows = [(*map(float, r), float(v), int(k)) for r, v, k in zip(x, y, fold)]
    return M.assemble(spark.createDataFrame(rows, SCHEMA), ["a", "b", "c"])


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, (160, 3)).astype(float)
    x[:, 2] = x[:, 2] > 4
    y = ((x[:, 0] + 2 * x[:, 2] + rng.normal(size=160) * 2) > 3).astype(float)
    return x, y, np.arange(160) % 5


def measure(y, kind):
    p = y.mean()
    if kind == "gini":
        return 2 * p * (1 - p)
    return -sum(q * np.log2(q) for q in (p, 1 - p) if q > 0)


def twin_tree(x, y, depth, kind, least, to_split):
    """Says: a function of a row and a depth."""
    says = float(y.sum() * 2 > len(y))
    best = (1e-10, None, None)
    if depth and len(y) >= to_split:
        for k in range(x.shape[1]):
            for v in sorted(set(x[:, k]))[:-1]:
                low = x[:, k] <= v
                if min(low.sum(), (~low).sum()) < least:
                    continue
                gain = measure(y, kind) - low.mean() * measure(y[low], kind) - (~low).mean() * measure(y[~low], kind)
                if round(gain, 10) > best[0]:
                    best = (round(gain, 10), k, v)
    if best[1] is None:
        return lambda row, d: says
    _, k, v = best
    low = x[:, k] <= v
    left, right = (twin_tree(x[s], y[s], depth - 1, kind, least, to_split) for s in (low, ~low))
    return lambda row, d: says if d == 0 else (left if row[k] <= v else right)(row, d - 1)


POINTS = [("gini", 1, 2), ("entropy", 3, 2), ("gini", 2, 30)]


@pytest.mark.parametrize("parts", [1, 4])
def test_trees_equal_a_twin_at_every_depth(spark, data, parts, monkeypatch):
    monkeypatch.setattr(T, "PART_ROWS", 160 // parts)
    monkeypatch.setattr(T, "CELLS", 200)  # several jobs a level
    x, y, fold = data
    blocks = T.Binned(frame(spark, x, y, fold).repartition(parts))
    points = [{"maxDepth": 5, "impurity": i, "minInstancesPerNode": n, "minRowsToSplit": s} for i, n, s in POINTS]
    got = T.tree_accuracies(blocks, T.grow(blocks, points, list(range(5))), 5, 5)
    blocks.release()
    for i, (kind, least, to_split) in enumerate(POINTS):
        for k in (0, 3):
            use = fold != k
            tree = twin_tree(x[use], y[use], 5, kind, least, to_split)
            for d in range(1, 6):
                want = np.mean([tree(r, d) == v for r, v in zip(x[~use], y[~use])])
                assert got[d - 1, k, i * 5 + k] == pytest.approx(want), (kind, k, d)


def twin_boost(x, y, use, depth, rate, rounds):
    margin = np.zeros(len(y))

    def leaf(rows, g, h, depth, out):
        mine, best = rows & use, (1e-10, None)
        score = lambda s: g[s].sum() ** 2 / (h[s].sum() + 1)
        for k in range(x.shape[1] if depth else 0):
            for v in sorted(set(x[:, k]))[:-1]:
                low, high = mine & (x[:, k] <= v), mine & (x[:, k] > v)
                if min(h[low].sum(), h[high].sum()) < 1:
                    continue
                gain = round(score(low) + score(high) - score(mine), 10)
                if gain > best[0]:
                    best = (gain, (k, v))
        if best[1] is None:
            out[rows] = -rate * g[mine].sum() / (h[mine].sum() + 1)
            return
        k, v = best[1]
        leaf(rows & (x[:, k] <= v), g, h, depth - 1, out)
        leaf(rows & (x[:, k] > v), g, h, depth - 1, out)

    for _ in range(rounds):
        p, out = 1 / (1 + np.exp(-margin)), np.zeros(len(y))
        leaf(np.ones(len(y), bool), p - y, p * (1 - p), depth, out)
        margin += out
    return margin


@pytest.mark.parametrize("parts", [1, 4])
def test_boosting_equals_a_twin(spark, data, parts, monkeypatch):
    monkeypatch.setattr(T, "PART_ROWS", 160 // parts)
    monkeypatch.setattr(T, "KEEP", 2)  # the state is written on the way
    x, y, fold = data
    fold = np.where(np.arange(160) % 8 == 7, T.UNSEEN, fold)
    held, depths, rates, rounds = np.array([0, 2, T.ALL]), np.array([2, 3, 3]), np.array([0.5, 0.1, 0.3]), np.array([3, 5, 4])
    blocks, seen = T.Binned(frame(spark, x, y, fold).repartition(parts), models=3), {}
    T.boost(blocks, held, depths, rates, rounds, {3: lambda: seen.update(mid=blocks.total(T.margin_scores, 5))})
    got = blocks.total(T.margin_scores, 5)
    blocks.release()
    for m in range(3):
        use = (fold != held[m]) & (fold >= 0)
        margin = twin_boost(x, y, use, depths[m], rates[m], rounds[m])
        loss = np.logaddexp(0, margin) - y * margin
        for i, k in enumerate([0, 1, 2, 3, 4, T.UNSEEN]):
            inside = fold == k
            assert got[0, i, m] == pytest.approx(loss[inside].sum(), abs=1e-4)
            assert got[1, i, m] == pytest.approx(((1 / (1 + np.exp(-margin)) - y)[inside] ** 2).sum(), abs=1e-4)
            assert got[2, i, m] == ((margin > 0) == (y > 0.5))[inside].sum() and got[3, i, m] == inside.sum()
    assert np.allclose(seen["mid"][:, :, 0], got[:, :, 0])  # done after three rounds


def test_bare_frames(spark):
    point = [{"maxDepth": 3, "impurity": "gini", "minInstancesPerNode": 1}]
    empty = M.assemble(spark.createDataFrame([], SCHEMA), ["a", "b", "c"])
    blocks = T.Binned(empty, models=1)
    T.boost(blocks, np.array([T.ALL]), np.array([2]), np.array([0.1]), np.array([2]))
    forest = T.grow(blocks, point, [T.ALL])
    assert forest.count.tolist() == [1] and T.tree_accuracies(blocks, forest, 3, 5).max() == 0
    one = [(1.0, float("nan"), 0.0, 1.0, k % 5) for k in range(10)] + [(None, 2.0, 0.0, None, 1), (1.0, 2.0, 0.0, 0.0, None)]
    blocks = T.Binned(M.assemble(spark.createDataFrame(one, SCHEMA), ["a", "b", "c"]))
    forest = T.grow(blocks, point, [T.ALL])
    assert forest.count.tolist() == [1] and forest.sums[0, 0].tolist() == [10, 10]
    assert T.tree_accuracies(blocks, forest, 3, 5)[0, -1, 0] == 1.0
    mixed = [(1.0, float("nan") if k % 2 else 5.0, 0.0, float(k % 2), k % 5) for k in range(10)]
    blocks = T.Binned(M.assemble(spark.createDataFrame(mixed, SCHEMA), ["a", "b", "c"]))
    assert T.tree_accuracies(blocks, T.grow(blocks, point, [T.ALL]), 3, 5)[0, -1, 0] == 1.0


def test_scores_differ_between_points(spark):
    tr, _ = RM._train_test(spark, SF_SMALL)
    maps = M.full_grid({"maxDepth": [1, 9], "minInstancesPerNode": [1, 4], "impurity": ["gini"], "minRowsToSplit": [2, 10]})
    rows = RM.tree_scores(tr, maps).collect()
    assert len(rows) == 8 and all(0 < r["cv_accuracy"] <= 1 for r in rows) and len({r["cv_accuracy"] for r in rows}) > 1


def test_searches_hold_out_every_fold(spark, monkeypatch):
    """The score of a point is the mean over all five folds, each learned by a model that didn't see it."""
    tr, te = RM._train_test(spark, SF_SMALL)
    monkeypatch.setattr(RM, "GBT_ROUNDS", [1, 2])
    monkeypatch.setattr(RM, "GBT_AXES", {"maxDepth": [2], "stepSize": [0.1]})
    monkeypatch.setattr(RM, "random_draws", lambda: [{"maxDepth": 2, "maxIter": 2, "stepSize": 0.1}])
    rows = [tr.select("features", "label", "fold").collect(), te.select("features", "label").collect()]
    # the raw values as bins of the whole table, as the search has them
    blocks = T.Binned(tr)
    code = lambda got: np.stack([np.searchsorted(c, [r["features"][k] for r in got]) for k, c in enumerate(blocks.cuts)], 1)
    x, y = code(rows[0]), np.array([r["label"] for r in rows[0]])
    fold = np.array([r["fold"] for r in rows[0]])
    blocks.release()
    losses = []
    for k in range(5):
        margin = twin_boost(x, y, fold != k, 2, 0.1, 2)[fold == k]
        losses.append((np.logaddexp(0, margin) - y[fold == k] * margin).mean())
    got = {r["maxIter"]: r["log_loss"] for r in RM.boosted_losses(tr).collect()}
    assert got[2] == pytest.approx(np.mean(losses), abs=1e-6) and got[2] < got[1] < np.log(2)
    table, error = RM.boosted_errors(tr, te)
    assert 0 < table.first()["rmse"] < 0.5 and 0 < error < 0.5


def test_shares_come_from_the_model_that_did_not_see_the_row(spark, data):
    x, y, fold = data
    df = frame(spark, x, y, fold)
    blocks = T.Binned(df)
    forest = T.grow(blocks, [{"maxDepth": 3}], [*range(5), T.ALL])
    blocks.release()
    own = np.arange(6)
    base = functools.partial(T.tree_shares, cuts=blocks.cuts, trees=forest.arrays(own), sums=forest.sums[own], depth=3)
    lines = functools.partial(B.linear_shares, weights=np.arange(24.0).reshape(6, 4) / 24 - 0.5)
    got = B.add_shares(df, {"tree": base, "line": lines}, F.col("fold")).collect()
    trees = [twin_tree(x[fold != k], y[fold != k], 3, "gini", 1, 2) for k in range(5)]
    weights = np.arange(24.0).reshape(6, 4) / 24 - 0.5
    for r in got:
        row, k = [r["a"], r["b"], r["c"]], r["fold"]
        assert r["p_tree"] == 0.5 or float(r["p_tree"] > 0.5) == trees[k](row, 3)
        assert r["p_line"] == pytest.approx(1 / (1 + np.exp(-(np.dot(row, weights[k][:3]) + weights[k][3]))))
    whole = twin_tree(x, y, 3, "gini", 1, 2)
    for r in B.add_shares(df, {"tree": base}, F.lit(-1)).collect():
        assert r["p_tree"] == 0.5 or float(r["p_tree"] > 0.5) == whole([r["a"], r["b"], r["c"]], 3)


def test_rows_of_the_same_bins_are_one_unit(spark, data, monkeypatch):
    """A unit per code; what jobs send to the driver are splits, not histograms."""
    monkeypatch.setattr(T, "PART_ROWS", 40)
    monkeypatch.setattr(T, "CHUNK", 8)
    x, y, fold = data
    blocks = T.Binned(frame(spark, x, y, fold).repartition(4))
    held = blocks._rdd.collect()
    assert sum(len(b[0]) for b in held) == len({tuple(r) for r in x}) and sum(b[1].sum() for b in held) == 160
    seen, before = [], T.Binned.chosen
    monkeypatch.setattr(T.Binned, "chosen", lambda self, state, nodes, pick: seen.append((nodes, before(self, state, nodes, pick))) or seen[-1][1])
    T.grow(blocks, [{"maxDepth": 4}], list(range(5)))
    assert len(seen) == 4
    for nodes, found in seen:
        assert sum(len(f[0]) for f in found) == nodes and all(a.size <= 2 * len(f[0]) for f in found for a in f)
    blocks.release()


def test_features_counted_together():
    sizes = [60, 25, 2, 2, 1, 13, 2, 64]
    groups = T.joint_features(sizes)
    assert sorted(k for g in groups for k in g) == list(range(8)) and len(groups) < 8
    assert all(len(g) == 1 or np.prod([sizes[k] for k in g]) <= T.JOINT for g in groups)
