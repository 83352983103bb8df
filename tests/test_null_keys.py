"""Rows of the NULL group stay in every operator that joins an aggregate back."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vistaframe.operators import features as FE
from vistaframe.operators import series as S
from vistaframe.operators import stats as ST


@pytest.fixture(scope="module")
def rows(spark):
    day = dt.datetime(2020, 1, 1)
    data = [(i, g, day + dt.timedelta(hours=i), float(i * i % 17)) for i, g in enumerate(["a", None] * 20)]
    return spark.createDataFrame(data, "id long, grp string, d timestamp, x double")


def groups(df):
    return {r["grp"]: r["count"] for r in df.groupBy("grp").count().collect()}


def test_row_operators_keep_the_null_group(rows):
    assert groups(S.group_min_offset(rows, "grp", "x", "o")) == {"a": 20, None: 20}
    assert groups(S.rolling_blocked(rows, "x", 3, by="grp", block_rows=5)) == {"a": 20, None: 20}
    assert groups(S.expanding_std_blocked(rows, "x", by="grp", block_rows=5)) == {"a": 20, None: 20}
    split = FE.stratified_split(rows, "grp", "id")
    assert {(r["grp"], r["split"]): r["count"] for r in split.groupBy("grp", "split").count().collect()} == {
        (g, s): n for g in ("a", None) for s, n in (("train", 14), ("test", 6))}


def test_blocked_windows_equal_the_plain_ones(rows):
    plain = {r["id"]: r["x_rolling_mean"] for r in S.rolling(rows, "x", 3, by="grp").collect()}
    blocked = {r["id"]: r["x_rolling_mean"] for r in S.rolling_blocked(rows, "x", 3, by="grp", block_rows=4).collect()}
    assert plain == blocked


def test_group_statistics_keep_the_null_group(rows):
    for df in (ST.box_stats(rows, "x", "grp"), ST.ecdf_by_group(rows, "x", "grp"),
               ST.density_curve(rows, "x", "grp", grid_points=4), S.horizon_outcome(rows, 2, "x", by="grp")):
        assert {r["grp"] for r in df.collect()} == {"a", None}
    outcome = S.horizon_outcome(rows, 2, "x", by="grp").filter(F.col("grp").isNull()).first()
    assert outcome["n"] > 0 and outcome["p50_growth"] is not None


def test_top_n_with_other_keeps_the_null_group(spark):
    counts = spark.createDataFrame([(g, t, n) for g in ("a", None) for t, n in (("x", 5), ("y", 3), ("z", 1))],
                                   "grp string, t string, n long")
    got = {(r["grp"], r["t"]): (r["n"], r["share"]) for r in ST.top_n_with_other(counts, "grp", "t", top=1).collect()}
    assert got == {(g, t): v for g in ("a", None) for t, v in (("x", (5, 0.5556)), ("Other", (4, 0.4444)))}
    plan = ST.top_n_with_other(counts, "grp", "t", top=1)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_quantile_bins_gather_nothing(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("x"))
    out = FE.quantile_bins(df, "x", "b", 4).groupBy("b").agg(F.min("x").alias("lo"), F.count("*").alias("n")).orderBy("b").collect()
    values = sorted(i % 97 for i in range(1000))
    splits = [values[-(-i * 1000 // 4) - 1] for i in (1, 2, 3)]
    assert [r["lo"] for r in out] == [0.0, *map(float, splits)]
