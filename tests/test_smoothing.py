"""Smoothed curves against direct least squares and direct kernel sums."""

import math
import random

import numpy as np
import pytest

from vistaframe.operators import stats as T


def direct(points, grid, share):
    """Weighted least squares by numpy at every grid point."""
    x, y = np.array(points, float).T
    lo, hi = x.min(), x.max()
    h = share * (hi - lo)
    out = []
    for g in np.linspace(lo, hi, grid):
        u = (x - g) / h
        w = np.where(np.abs(u) < 1, (1 - np.minimum(np.abs(u), 1) ** 3) ** 3, 0.0)
        a = np.stack([np.ones_like(u), u], axis=1) * np.sqrt(w)[:, None]
        fit, slope = np.linalg.lstsq(a, y * np.sqrt(w), rcond=None)[0]
        out.append((g, fit, slope / h))
    return out


@pytest.mark.parametrize("share", [0.15, 0.4, 1.0])
def test_equals_direct_least_squares(spark, share):
    r = random.Random(7)
    groups = {"a": [(v, math.sin(v) + r.gauss(0, 0.1)) for v in (r.uniform(0, 10) for _ in range(400))],
              None: [(float(v % 40), 3.0 * v) for v in range(200)]}
    df = spark.createDataFrame([(k, *p) for k, ps in groups.items() for p in ps], "m string, x double, y double")
    got = T.local_regression(df.repartition(5), "m", "x", "y", grid_points=21, share=share).collect()
    for k, ps in groups.items():
        rows = sorted((r for r in got if r["m"] == k), key=lambda r: r["g"])
        assert [r["g"] for r in rows] == list(range(21))
        for row, (gx, fit, slope) in zip(rows, direct(ps, 21, share)):
            assert row["x"] == pytest.approx(gx) and row["fit"] == pytest.approx(fit, abs=1e-8)
            assert row["slope"] == pytest.approx(slope, abs=1e-7)


def test_line_is_reproduced(spark):
    df = spark.range(200).selectExpr("1 AS m", "cast(id AS double) AS x", "2.5 * id - 7 AS y")
    for r in T.local_regression(df, "m", "x", "y", grid_points=9).collect():
        assert r["fit"] == pytest.approx(2.5 * r["x"] - 7) and r["slope"] == pytest.approx(2.5)


def test_gaps_single_values_and_bad_rows(spark):
    rows = [("gap", 0.0, 1.0), ("gap", 0.0, 3.0), ("gap", 100.0, 5.0), ("one", 4.0, 1.0), ("one", 4.0, 2.0),
            ("one", None, 9.0), ("one", 1.0, None), ("one", float("nan"), 9.0), ("one", 1.0, float("inf")), ("none", None, 1.0)]
    df = spark.createDataFrame(rows, "m string, x double, y double")
    got = {(r["m"], r["g"]): r for r in T.local_regression(df, "m", "x", "y", grid_points=11, share=0.1).collect()}
    assert {m for m, _ in got} == {"gap", "one"}
    assert [k for k in got if k[0] == "one"] == [("one", 0)]
    assert got["one", 0]["fit"] == 1.5 and got["one", 0]["slope"] is None
    assert got["gap", 0]["fit"] == 2.0 and got["gap", 10]["fit"] == 5.0
    assert got["gap", 5]["fit"] is None and got["gap", 5]["weight"] == 0.0


def test_rows_between_grid_points(spark):
    """A reach shorter than a step: rows that reach no point add nothing."""
    df = spark.createDataFrame([("m", float(v), float(v)) for v in range(101)], "m string, x double, y double")
    got = T.local_regression(df, "m", "x", "y", grid_points=3, share=0.05).orderBy("g").collect()
    assert [round(r["fit"], 9) for r in got] == [0.0, 50.0, 100.0]


def test_empty(spark):
    df = spark.createDataFrame([], "m string, x double, y double")
    assert T.local_regression(df, "m", "x", "y").count() == 0 and T.smoothed_ecdf(df, "x", "m").count() == 0


def test_smoothed_ecdf(spark):
    r = random.Random(3)
    values = [r.gauss(0, 1) for _ in range(500)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 1.0), ("b", 1.0)], "m string, v double")
    got = T.smoothed_ecdf(df, "v", "m").collect()
    assert all(r["cum_share"] is None for r in got if r["m"] == "b")
    rows = sorted((r for r in got if r["m"] == "a"), key=lambda r: r["g"])
    shares = [r["cum_share"] for r in rows]
    assert shares == sorted(shares) and shares[0] == 0 and shares[-1] == pytest.approx(1)
    q = np.quantile(values, [0.25, 0.75])
    bw = 0.9 * min(np.std(values, ddof=1), (q[1] - q[0]) / 1.34) * len(values) ** -0.2
    for row in rows:
        exact = np.mean([0.5 * (1 + math.erf((row["x"] - v) / bw / math.sqrt(2))) for v in values])
        assert row["cum_share"] == pytest.approx(exact, abs=5e-3)


def test_rows_are_not_copied_per_grid_point(spark, monkeypatch):
    """Moments are added up inside tasks, whatever the kinds of groups and however small the tables that a task holds."""
    monkeypatch.setattr(T, "MOMENT_ROWS", 7)
    monkeypatch.setattr(T, "MOMENT_CELLS", 30)
    r = random.Random(11)
    points = {(a, b): [(r.uniform(0, 5), r.gauss(0, 1)) for _ in range(30)] for a in ("p", None) for b in (1, 2, None)}
    df = spark.createDataFrame([(*k, *p) for k, ps in points.items() for p in ps], "a string, b int, x double, y double").repartition(3)
    curve = T.local_regression(df, ["a", "b"], "x", "y", grid_points=12, share=0.4)
    assert "Generate explode(sequence(cast(__low" not in curve._jdf.queryExecution().toString() and "MapInArrow" in curve._jdf.queryExecution().toString()
    got = curve.collect()
    assert len(got) == 12 * len(points)
    for k, ps in points.items():
        rows = sorted((r for r in got if (r["a"], r["b"]) == k), key=lambda r: r["g"])
        for row, (gx, fit, slope) in zip(rows, direct(ps, 12, 0.4)):
            assert row["x"] == pytest.approx(gx) and row["fit"] == pytest.approx(fit, abs=1e-8)
