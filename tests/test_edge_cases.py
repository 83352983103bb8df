"""Hand-made frames for the traps of each operator; expected values worked
out by hand or by a brute-force Python version of the rule."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tests.conftest import SF_SMALL
from vistaframe.functions import scalars as X
from vistaframe.operators import backtest as B
from vistaframe.operators import features as FE
from vistaframe.operators import joins as J
from vistaframe.operators import series as S
from vistaframe.operators import stats as T


def d(i):
    return dt.date(2020, 1, 1) + dt.timedelta(days=i)


def test_word_count_edges(spark):
    df = spark.createDataFrame([("",), ("  a  b ",), ("one",), ("x\ny\tz",)], "t string")
    got = [r[0] for r in df.select(X.word_count("t")).collect()]
    assert got == [0, 2, 1, 3]


def test_neighbor_impute_runs_and_edges(spark):
    rows = [("a", d(0), None), ("a", d(1), 2.0), ("a", d(2), None), ("a", d(3), 4.0),
            ("a", d(4), None), ("a", d(5), None), ("a", d(6), 10.0)]
    df = spark.createDataFrame(rows, "asset string, d date, close double")
    nb = {r.d: r.close for r in S.neighbor_impute(df).collect()}
    assert nb[d(0)] is None and nb[d(2)] == 3.0 and nb[d(4)] is None and nb[d(5)] is None
    li = {r.d: r.close for r in S.neighbor_impute(df, method="linear").collect()}
    assert li[d(0)] is None and li[d(2)] == 3.0 and li[d(4)] == 6.0 and li[d(5)] == 8.0


def test_rolling_incomplete_and_null_windows(spark):
    rows = [("a", d(i), float(i) if i != 5 else None) for i in range(10)]
    df = spark.createDataFrame(rows, "asset string, d date, x double")
    got = {r.d: r.m for r in S.rolling(df, "x", 3, "mean", out="m").collect()}
    assert got[d(1)] is None            # incomplete
    assert got[d(2)] == 1.0
    assert got[d(5)] is None and got[d(7)] is None   # window holds the NULL
    assert got[d(8)] == 7.0


def test_pct_change_pads_gap(spark):
    rows = [("a", d(0), 1.0), ("a", d(1), None), ("a", d(2), 2.0)]
    df = spark.createDataFrame(rows, "asset string, d date, close double")
    got = {r.d: r.r for r in S.pct_change(df, out="r").collect()}
    assert got[d(0)] is None and got[d(1)] == 0.0 and got[d(2)] == 1.0


def test_winsorize_bound(spark):
    rnd = random.Random(1)
    xs = [rnd.gauss(0, 1) for _ in range(500)] + [9.0, -9.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    sigma = math.sqrt(sum((x - sum(xs) / len(xs)) ** 2 for x in xs) / len(xs))
    w = [r.w for r in S.winsorize_sigma(df, "x", 2.0, "w").collect()]
    assert max(abs(v) for v in w) <= 2 * sigma + 1e-12
    assert sorted(w)[-1] == pytest.approx(2 * sigma)


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 10]], "x double")
    h = {r.bin: r.n for r in T.histogram_bins(df, "x", 5).collect()}
    assert sum(h.values()) == 6 and h[4] == 1 and h[0] == 2 and h[3] == 0


def test_top_n_ties_keeps_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 4), ("c", 4), ("d", 1)], "k string, n long")
    got = sorted(r.k for r in T.top_n_ties(df, "n", 2).collect())
    assert got == ["a", "b", "c"]


def test_top_n_with_other_always_has_other(spark):
    df = spark.createDataFrame([("g", "x", 3), ("g", "y", 1)] +
                               [("h", f"t{i}", 1) for i in range(12)], "grp string, token string, n long")
    df = df.groupBy("grp", "token").agg(F.sum("n").alias("n"))
    rows = T.top_n_with_other(df, "grp", "token", "n", top=9).collect()
    g = {r.token: r.share for r in rows if r.grp == "g"}
    assert g["Other"] == 0.0 and g["x"] == 0.75
    h = [r for r in rows if r.grp == "h"]
    assert len(h) == 10 and sum(r.n for r in h) == 12


def _python_two_sum(nums, target):
    seen = {}
    for i, v in enumerate(nums):
        if target - v not in seen:
            seen[v] = i
        else:
            return [seen[target - v], i]
    return None


def test_two_sum_matches_hash_map_rule(spark):
    rnd = random.Random(7)
    rows, expect = [], {}
    for g in range(40):
        nums = [rnd.randint(0, 12) for _ in range(rnd.randint(1, 15))]
        for i, v in enumerate(nums):
            rows.append((g, i, v))
        r = _python_two_sum(nums, 12)
        if r:
            expect[g] = tuple(r)
    df = spark.createDataFrame(rows, "g long, t long, v int")
    got = {r.g: (r.i, r.j) for r in J.two_sum(df, "g", ["t"], "v", 12).collect()}
    assert got == expect


def _python_backtest(rows, hold, sell, trade, capital=100000.0, start=100):
    diffs = [r[2] for r in rows]
    cash, shares, name, days = capital, 0.0, "", 0
    for idx in range(start - 1, len(rows)):
        a, b, diff = rows[idx]
        xs = diffs[: idx + 1]
        m = sum(xs) / len(xs)
        sigma = math.sqrt(sum((x - m) ** 2 for x in xs) / len(xs))
        if shares == 0 and trade * sigma <= abs(diff):
            if diff > 0:
                shares, name = cash / b, "B"
            else:
                shares, name = cash / a, "A"
        if sell * sigma > diff and days > hold:
            if name == "A":
                cash = a * shares
            if name == "B":
                cash = b * shares
            shares, name, days = 0.0, "", 0
        days += 1
    if shares > 0:
        cash = shares * (rows[-1][0] if name == "A" else rows[-1][1])
    return cash / capital


@pytest.fixture(scope="module")
def spread_df(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(160):
        diff = 0.0 if i % 17 == 0 else rnd.gauss(0, 0.02)
        rows.append(("A", "B", d(i), 10 + rnd.random(), 20 + rnd.random(), diff))
    return spark.createDataFrame(rows, "first string, second string, d date, a_close double, b_close double, diff double"), \
        [(r[3], r[4], r[5]) for r in rows]


@pytest.mark.parametrize("hold,sell,trade", [(5, 0, 0), (10, 1, 1), (0, 3, 0), (5, 0, 1e9), (20, 2, 3)])
def test_backtest_fold_equals_loop(spark, spread_df, hold, sell, trade):
    df, rows = spread_df
    got = B.backtest_grid(df, {"hold_time": [hold], "sell_sigma": [sell], "trade_sigma": [trade]}).collect()[0].ratio
    assert got == pytest.approx(_python_backtest(rows, hold, sell, trade), rel=1e-12)
    if trade == 1e9:
        assert got == 1.0


def test_stratified_split_exact_and_disjoint(spark):
    rows = [(i, 1 if i % 10 == 0 else 0) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, y int")
    s = FE.stratified_split(df, "y", "id", prefix_len=2)
    c = {(r.y, r.split): r["count"] for r in s.groupBy("y", "split").count().collect()}
    assert c[(1, "train")] == 200 - math.ceil(0.3 * 200) and c[(0, "train")] == 1800 - math.ceil(0.3 * 1800)
    assert s.select("id").distinct().count() == 2000


def test_anti_join_previous_empty_poll_and_return(spark):
    rows = [("s", d(0), "a"), ("s", d(0), "b"), ("s", d(1), None), ("s", d(2), "a"), ("s", d(2), "c"),
            ("s", d(3), "c"), ("s", d(4), "a")]
    df = spark.createDataFrame(rows, "site string, snapshot date, item string")
    skip = sorted((r.snapshot, r.item) for r in J.anti_join_previous(df, skip_empty=True).collect())
    assert skip == [(d(0), "a"), (d(0), "b"), (d(2), "c"), (d(4), "a")]
    keep = sorted((r.snapshot, r.item) for r in J.anti_join_previous(df, skip_empty=False).collect())
    assert keep == [(d(0), "a"), (d(0), "b"), (d(2), "a"), (d(2), "c"), (d(4), "a")]


def test_recode_cascade_last_rule_wins(spark):
    df = spark.createDataFrame([("Private",), ("State-gov",), ("Self-emp-inc",), (None,), ("x",)], "w string")
    e = X.recode_cascade("w", [(["Self-emp-inc"], 2), (["State-gov"], 1), (["Private"], 0)], 3)
    assert [r[0] for r in df.select(e).collect()] == [0, 1, 2, 3, 3]


def test_chrono_split_counts(spark):
    rows = [("a", d(i), float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "asset string, d date, close double")
    s = {r.d: r.split for r in S.chrono_split(df, 0.3).collect()}
    assert sum(v == "train" for v in s.values()) == math.ceil(10 * 0.3) + 1


@pytest.mark.parametrize("stat", ["mean", "sd", "var"])
def test_blocked_rolling_equals_plain_window_on_hot_series(spark, stat):
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    rows = [("hot", base + dt.timedelta(minutes=7 * i), None if i % 41 == 0 else rnd.random()) for i in range(600)]
    rows += [("cold", base + dt.timedelta(minutes=i), rnd.random()) for i in range(20)]
    df = spark.createDataFrame(rows, "asset string, d timestamp, x double")
    plain = {(r.asset, r.d): r.v for r in S.rolling(df, "x", 12, stat, out="v").collect()}
    blocked = {(r.asset, r.d): r.v for r in S.rolling_blocked(df, "x", 12, stat, out="v", block_rows=25).collect()}
    assert plain.keys() == blocked.keys()
    for k, v in plain.items():
        assert (v is None and blocked[k] is None) or blocked[k] == pytest.approx(v, rel=1e-12, abs=1e-15)


def test_binarize_is_strict(spark):
    df = spark.createDataFrame([(4.9,), (5.0,), (5.1,)], "x double")
    got = [r.b for r in FE.binarize(df, "x", "b", 5.0).collect()]
    assert got == [0.0, 0.0, 1.0]


def test_bucket_edges_last_closed_and_invalid_kept(spark):
    df = spark.createDataFrame([(1995.0,), (1996.999,), (1997.0,), (2003.0,), (2004.0,)], "y double")
    got = [r.lab for r in FE.bucketize(df, "y", "lab", [1995.0, 1997.0, 1999.0, 2001.0, 2003.0],
                                        ["a", "b", "c", "d"]).collect()]
    assert got == ["a", "a", "b", "d", None]


@pytest.mark.parametrize("ddof", [0, 1])
def test_blocked_expanding_equals_plain_window(spark, ddof):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    rows = [("hot", base + dt.timedelta(minutes=13 * i), None if i % 37 == 3 else 100 + rnd.random() * 5)
            for i in range(500)]
    rows += [("cold", base + dt.timedelta(minutes=i), rnd.random()) for i in range(7)]
    df = spark.createDataFrame(rows, "asset string, d timestamp, x double")
    plain = {(r.asset, r.d): r.v for r in S.expanding_std(df, "x", by="asset", out="v", ddof=ddof).collect()}
    blocked = {(r.asset, r.d): r.v for r in S.expanding_std_blocked(df, "x", out="v", ddof=ddof, block_rows=20).collect()}
    assert plain.keys() == blocked.keys()
    for k, v in plain.items():
        assert (v is None and blocked[k] is None) or blocked[k] == pytest.approx(v, rel=1e-9, abs=1e-12), k


def test_parameter_grids_cover_every_ordered_pair(spark):
    grid = queries()["cross_param_grid_pairs"](spark, SF_SMALL)
    runs = queries()["backtest_grid_pairs"](spark, SF_SMALL)
    for df in (grid, runs):
        per_pair = {(r["first"], r["second"]): r["count"] for r in df.groupBy("first", "second").count().collect()}
        assert len(per_pair) == 30 and set(per_pair.values()) == {96}
    best = runs.agg(F.max("ratio")).first()[0]
    top = queries()["top_k_strategies_pairs"](spark, SF_SMALL).collect()
    assert len(top) == 5 and max(r["ratio"] for r in top) == best


def test_pair_summary_has_every_pair_of_numeric_features(spark):
    rows = queries()["pair_summary_all"](spark, SF_SMALL).collect()
    assert sum(c.startswith("corr_") for c in rows[0].asDict()) == 6 and sum(c.startswith("mean_") for c in rows[0].asDict()) == 4
    by_class = {r["income"]: r for r in rows}
    assert by_class["<=50K"]["corr_age_gain"] is None and by_class["<=50K"]["mean_gain"] == 0  # one value in this class
    assert abs(by_class[">50K"]["corr_edu_gain"]) <= 1 and by_class[">50K"]["mean_gain"] > 0


def test_density_of_narrow_groups(spark):
    """Values within 1e-5 of each other have a curve, beside a wide group."""
    rng = random.Random(3)
    values = {"narrow": [rng.gauss(0, 1) * 1e-6 for _ in range(300)], "wide": [rng.gauss(0, 1) for _ in range(300)]}
    df = spark.createDataFrame([(g, x) for g, xs in values.items() for x in xs] + [("one", 1.0), ("one", 1.0)], "g string, x double")
    rows = T.density_curve(df.withColumnRenamed("g", "grp"), "x", "grp", grid_points=16).collect()
    for g, xs in values.items():
        s = sorted(xs)
        sd = math.sqrt(sum((x - sum(xs) / 300) ** 2 for x in xs) / 299)
        quantile = lambda q: s[int(q * 299)] + (q * 299 - int(q * 299)) * (s[int(q * 299) + 1] - s[int(q * 299)])
        bw = 0.9 * min(sd, (quantile(0.75) - quantile(0.25)) / 1.34) * 300 ** -0.2
        got = [r for r in rows if r["grp"] == g]
        top = max(r["density"] for r in got)
        assert len(got) == 16
        for r in got:
            want = sum(math.exp(-0.5 * ((r["x"] - x) / bw) ** 2) for x in xs) / (300 * bw * math.sqrt(2 * math.pi))
            assert abs(r["density"] - want) < 0.005 * top
    assert all(r["density"] is None for r in rows if r["grp"] == "one")
