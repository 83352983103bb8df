"""Models trained together equal models trained alone."""

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from vistaframe.operators import batched as B
from vistaframe.operators import models as M
from vistaframe.registry import models as RM


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.normal(size=300) > 0).astype(float)
    fold = np.arange(300) % 5
    rows = [(*map(float, r), float(v), int(k)) for r, v, k in zip(x, y, fold)]
    df = M.assemble(spark.createDataFrame(rows, "a double, b double, c double, label double, fold int"), ["a", "b", "c"])
    return x, y, fold, B.Blocks(df.repartition(4))


def loss_of(w, x, y, penalty):
    margin = x @ w[:-1] + w[-1]
    return (np.logaddexp(0, margin) - y * margin).sum() + penalty / 2 * (w[:-1] ** 2).sum()


def descend(x, y, penalty, steps=20_000):
    """A twin that shares nothing with Newton: gradient descent to convergence."""
    w, z = np.zeros(x.shape[1] + 1), np.c_[x, np.ones(len(x))]
    ridge = np.r_[np.full(x.shape[1], penalty), 0.0]
    rate = 1.0 / (np.linalg.norm(z, 2) ** 2 / 4 + penalty)
    for _ in range(steps):
        w = w - rate * (z.T @ (1 / (1 + np.exp(-z @ w)) - y) + ridge * w)
    return w


def test_newton_equals_gradient_descent(small):
    x, y, fold, blocks = small
    penalties, held = np.array([0.5, 0.5, 10.0]), np.array([B.ALL, 2, 3])
    w = B.newton(blocks, penalties, held)
    for k in range(3):
        use = fold != held[k]
        assert np.allclose(w[k], descend(x[use], y[use], penalties[k]), atol=1e-4)


def test_newton_on_separable_and_collinear_rows(spark):
    rows = [(float(i), 2.0 * i, float(i > 9), i % 5) for i in range(20)]
    df = M.assemble(spark.createDataFrame(rows, "a double, b double, label double, fold int"), ["a", "b"])
    w = B.newton(B.Blocks(df), np.array([1e-8, 1e5]), np.array([B.ALL, B.ALL]))
    assert np.isfinite(w).all()
    hits = B.Blocks(df).total(B.linear_hits, (w, 5), np.zeros((2, 6, 2)))
    assert B.accuracies(hits)[-1, 0] == 1.0 and hits[1, -1].tolist() == [20, 20]


@pytest.mark.parametrize("activation", ["tanh", "relu", "logistic"])
def test_gradients_equal_differences(activation):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(30, 4)), rng.integers(0, 2, 30).astype(float)
    net = B.Network((5, 3), activation, "sgd", 0.0, B.ALL)
    net.start(4, 3)
    _, grad = B.gradient(x, y, net.weights, activation)
    at = 0
    for w in net.weights:
        for i in np.ndindex(w.shape):
            kept, step = w[i], 1e-6
            w[i] = kept + step
            up = B.gradient(x, y, net.weights, activation)[0]
            w[i] = kept - step
            down = B.gradient(x, y, net.weights, activation)[0]
            w[i] = kept
            assert grad[at] == pytest.approx((up - down) / (2 * step), abs=1e-4)
            at += 1


def test_networks_learn_and_leave_their_fold_out(small):
    _, _, _, blocks = small
    nets = [B.Network((8,), a, s, 0.01, k) for a, s in (("tanh", "adam"), ("relu", "sgd")) for k in (0, B.ALL)]
    B.train_networks(blocks, nets, 60)
    by_fold = B.network_accuracies(blocks, nets, 5)
    assert (by_fold[-1] > 0.75).all() and by_fold[0, 0] > 0.7
    alone = [B.Network((8,), "tanh", "adam", 0.01, 0)]
    B.train_networks(blocks, alone, 60)
    assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(alone[0].weights, nets[0].weights))


def test_search_scores(spark, monkeypatch):
    tr, te = RM._train_test(spark, SF_SMALL)
    table = RM.logreg_scores(tr, te).orderBy("step").collect()
    assert len(table) == 15 and max(r.cv_accuracy for r in table) >= RM._majority(tr) - 0.02
    monkeypatch.setattr(RM, "MLP_ROUNDS", 40)
    rows = RM.mlp_scores(tr).collect()
    assert len(rows) == 10 and max(r.cv_accuracy for r in rows) >= RM._majority(tr) - 0.02


def test_equal_rows_are_one_row(spark):
    """Rows that come often are held once, with their number by fold; the networks are those of the plain rows."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 3, (600, 2)).astype(float)
    y = (x[:, 0] + rng.normal(size=600) > 1).astype(float)
    rows = [(*map(float, r), float(v), int(k)) for r, v, k in zip(x, y, np.arange(600) % 5)]
    df = M.assemble(spark.createDataFrame(rows, "a double, b double, label double, fold int"), ["a", "b"])
    plain, counted = B.Blocks(df.repartition(3)), B.Counted(df.repartition(3))
    held = counted._rdd.collect()
    assert sum(len(b[0]) for b in held) == len({r[:3] for r in rows}) and sum(b[2].sum() for b in held) == 600
    nets = [[B.Network((6,), a, s, 0.01, k) for a, s in (("tanh", "adam"), ("relu", "sgd")) for k in (0, 3, B.ALL)] for _ in range(2)]
    for blocks, some in zip((plain, counted), nets):
        B.train_networks(blocks, some, 20)
    for a, b in zip(*nets):
        assert all(np.allclose(v, w, atol=1e-8) for v, w in zip(a.weights, b.weights))
    assert np.allclose(B.network_accuracies(plain, nets[0], 5), B.network_accuracies(counted, nets[0], 5))


def test_counted_of_no_rows(spark):
    df = M.assemble(spark.createDataFrame([], "a double, label double, fold int"), ["a"])
    nets = [B.Network((2,), "tanh", "adam", 0.01, 0)]
    blocks = B.Counted(df)
    B.train_networks(blocks, nets, 2)
    assert B.network_accuracies(blocks, nets, 5).max() == 0
