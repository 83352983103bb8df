"""Ordered / window queries over the ``prices`` adapter."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..oracle import with_
from ..operators import series as S
from ..plans import adapters as A
from ._base import r6, register

W = "WINDOW w AS (PARTITION BY asset ORDER BY d)"
W252 = "WINDOW w AS (PARTITION BY asset ORDER BY d ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)"
LOGRET = """SELECT d, asset, close,
  CASE WHEN close / lag(close) OVER w > 0 THEN ln(close / lag(close) OVER w) END AS r
  FROM prices WINDOW w AS (PARTITION BY asset ORDER BY d)"""


def _log_returns(spark, sf):
    return S.log_return(A.prices(spark, sf), out="r")


@register("log_return", with_("prices") + f"""
SELECT d, asset, close,
  round(CASE WHEN close / lag(close) OVER w > 0 THEN ln(close / lag(close) OVER w) END, 6) + 0.0 AS log_return
FROM prices {W}""")
def log_return(spark, sf):
    df = S.log_return(A.prices(spark, sf))
    return df.select("d", "asset", "close", r6("log_return").alias("log_return"))


def _rolling_sql(expr: str, name: str) -> str:
    return with_("prices", extra={"rets": LOGRET}) + f"""
SELECT d, asset, round(CASE WHEN count(r) OVER w = 252 THEN {expr} END, 6) + 0.0 AS {name}
FROM rets {W252}"""


@register("rolling_mean", _rolling_sql("avg(r) OVER w", "rolling_mean"))
def rolling_mean(spark, sf):
    df = S.rolling(_log_returns(spark, sf), "r", 252, "mean", out="rolling_mean")
    return df.select("d", "asset", r6("rolling_mean").alias("rolling_mean"))


@register("rolling_sd", _rolling_sql("stddev_samp(r) OVER w / sqrt(1.0 / 252)", "rolling_sd"))
def rolling_sd(spark, sf):
    # roll_sd(...) / sqrt(1/252): annualised sample sd
    df = S.rolling(_log_returns(spark, sf), "r", 252, "sd", out="rolling_sd",
                   scale=1 / math.sqrt(1 / 252))
    return df.select("d", "asset", r6("rolling_sd").alias("rolling_sd"))


@register("rolling_var", _rolling_sql("var_samp(r) OVER w / sqrt(1.0 / 252)", "rolling_var"))
def rolling_var(spark, sf):
    # roll_var(...) / sqrt(1/252): scaled by sqrt(252), kept as written
    df = S.rolling(_log_returns(spark, sf), "r", 252, "var", out="rolling_var",
                   scale=1 / math.sqrt(1 / 252))
    return df.select("d", "asset", r6("rolling_var").alias("rolling_var"))


@register("annualized_vol", with_("prices") + f"""
SELECT asset, round(stddev_samp(r) * sqrt(252), 6) + 0.0 AS annualized_vol FROM (
  SELECT asset, close / lag(close) OVER w - 1 AS r FROM prices {W}) GROUP BY asset""")
def annualized_vol(spark, sf):
    df = S.pct_change(A.prices(spark, sf), out="r")
    return df.groupBy("asset").agg(r6(F.stddev_samp("r") * F.sqrt(F.lit(252))).alias("annualized_vol"))


RETS = """SELECT d, asset, close, close / lag(close) OVER (PARTITION BY asset ORDER BY d) - 1 AS r FROM prices"""
SPREAD = """SELECT a.d, a.close AS a_close, b.close AS b_close, a.r AS a_ret, b.r AS b_ret, a.r - b.r AS diff
FROM rets a JOIN rets b ON a.d = b.d
WHERE a.asset = 'AF' AND b.asset = 'RO' AND a.r IS NOT NULL AND b.r IS NOT NULL"""


def spread_sql(**extra) -> str:
    return with_("prices", extra={"rets": RETS, "spread": SPREAD, **extra})


def spread(spark, sf):
    from ..operators.pairs import spread_frame
    pairs = spark.createDataFrame([(A.PAIR_FIRST, A.PAIR_SECOND)], "first string, second string")
    return spread_frame(A.prices(spark, sf), pairs)


@register("pct_change", with_("prices_gappy", extra={"f": """
SELECT d, asset, last_value(close IGNORE NULLS) OVER (PARTITION BY asset ORDER BY d
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fc FROM prices_gappy"""}) + f"""
SELECT d, asset, round(fc / lag(fc) OVER w - 1, 6) + 0.0 AS pct_return FROM f {W}""")
def pct_change(spark, sf):
    df = S.pct_change(A.prices_gappy(spark, sf), out="pct_return", pad=True)
    return df.select("d", "asset", r6("pct_return").alias("pct_return"))


@register("neighbor_impute", with_("prices_gappy") + f"""
SELECT d, asset, round(coalesce(close, (lag(close) OVER w + lead(close) OVER w) / 2), 6) + 0.0 AS close
FROM prices_gappy {W}""")
def neighbor_impute(spark, sf):
    df = S.neighbor_impute(A.prices_gappy(spark, sf), method="neighbor")
    return df.select("d", "asset", r6("close").alias("close"))


@register("neighbor_impute_linear", with_("prices_gappy", extra={"k": f"""
SELECT d, asset, close, row_number() OVER w AS rn FROM prices_gappy {W}"""}) + """
SELECT g.d, g.asset, round(coalesce(g.close, p.close + (n.close - p.close) * (g.rn - p.rn) / (n.rn - p.rn)), 6) + 0.0 AS close
FROM k g
LEFT JOIN LATERAL (SELECT close, rn FROM k x WHERE x.asset = g.asset AND x.rn <= g.rn AND x.close IS NOT NULL ORDER BY x.rn DESC LIMIT 1) p ON TRUE
LEFT JOIN LATERAL (SELECT close, rn FROM k x WHERE x.asset = g.asset AND x.rn >= g.rn AND x.close IS NOT NULL ORDER BY x.rn LIMIT 1) n ON TRUE""")
def neighbor_impute_linear(spark, sf):
    df = S.neighbor_impute(A.prices_gappy(spark, sf), method="linear")
    return df.select("d", "asset", r6("close").alias("close"))


@register("expanding_std", spread_sql() + """
SELECT d, round(stddev_pop(diff) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) + 0.0 AS sigma
FROM spread""")
def expanding_std(spark, sf):
    df = S.expanding_std(spread(spark, sf), "diff", order="d", by=["first", "second"], out="sigma")
    return df.select("d", r6("sigma").alias("sigma"))


@register("spread_column", spread_sql() + """
SELECT d, a_ret, b_ret, round(diff, 9) + 0.0 AS diff FROM spread""")
def spread_column(spark, sf):
    df = spread(spark, sf)
    return df.select("d", "a_ret", "b_ret", r6(F.col("a_ret") - F.col("b_ret"), 9).alias("diff"))


@register("winsorize_sigma", spread_sql(s="SELECT stddev_pop(diff) AS sg FROM spread") + """
SELECT d, round(CASE WHEN abs(diff) < 2 * sg THEN diff ELSE sign(diff) * 2 * sg END, 9) + 0.0 AS diff_w
FROM spread, s""")
def winsorize_sigma(spark, sf):
    df = S.winsorize_sigma(spread(spark, sf), "diff", k=2.0, out="diff_w")
    return df.select("d", r6("diff_w", 9).alias("diff_w"))


@register("group_min_offset", with_("tracks") + """
SELECT artist_name, title, year, year - min(year) OVER (PARTITION BY artist_name) AS time_since_first_release
FROM tracks""")
def group_min_offset(spark, sf):
    df = S.group_min_offset(A.tracks(spark, sf), "artist_name", "year", "time_since_first_release")
    return df.select("artist_name", "title", "year", "time_since_first_release")


@register("chrono_split", with_("prices", extra={"dd": """
SELECT d, row_number() OVER (ORDER BY d) AS rk, count(*) OVER () AS n FROM (SELECT DISTINCT d FROM prices)"""}) + """
SELECT p.d, p.asset, p.close, CASE WHEN rk <= ceil(n * CAST(0.3 AS DOUBLE)) + 1 THEN 'train' ELSE 'test' END AS split
FROM prices p JOIN dd ON p.d = dd.d""")
def chrono_split(spark, sf):
    return S.chrono_split(A.prices(spark, sf), 0.3, "d").select("d", "asset", "close", "split")


TRIM = """SELECT d, asset, close, row_number() OVER (PARTITION BY asset ORDER BY d) AS rn FROM (
  SELECT d, asset, close, CASE WHEN count(r) OVER w = 252 THEN var_samp(r) OVER w END AS v
  FROM (SELECT d, asset, close, CASE WHEN close / lag(close) OVER (PARTITION BY asset ORDER BY d) > 0
        THEN ln(close / lag(close) OVER (PARTITION BY asset ORDER BY d)) END AS r FROM prices)
  WINDOW w AS (PARTITION BY asset ORDER BY d ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)) WHERE v IS NOT NULL"""


def _trimmed(spark, sf):
    df = S.rolling(_log_returns(spark, sf), "r", 252, "var", out="v")
    return df.filter(F.col("v").isNotNull()).select("d", "asset", "close")


@register("nth_row", with_("prices", extra={"t": TRIM}) + """
SELECT asset, CAST(rn AS BIGINT) AS k, d, close FROM t WHERE rn IN (1, 503)""")
def nth_row(spark, sf):
    t = _trimmed(spark, sf)
    parts = [S.nth_row(t, k).withColumn("k", F.lit(k).cast("bigint")) for k in (1, 2 * 252 - 1)]
    return parts[0].unionByName(parts[1]).select("asset", "k", "d", "close")


@register("skip_first_k", with_("prices") + """
SELECT d, asset, close FROM (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY d) AS rn FROM prices) WHERE rn > 99""")
def skip_first_k(spark, sf):
    return S.skip_first_k(A.prices(spark, sf), 99).select("d", "asset", "close")


@register("horizon_outcome", with_("prices") + """
SELECT asset, count(g) AS n, round(avg(g), 6) + 0.0 AS mean_growth, round(stddev_samp(g), 6) + 0.0 AS sd_growth,
  round(quantile_cont(g, 0.05), 6) + 0.0 AS p05_growth, round(quantile_cont(g, 0.5), 6) + 0.0 AS p50_growth,
  round(quantile_cont(g, 0.95), 6) + 0.0 AS p95_growth
FROM (SELECT asset, lead(close, 252) OVER (PARTITION BY asset ORDER BY d) / close AS g FROM prices) GROUP BY asset""")
def horizon_outcome(spark, sf):
    df = S.horizon_outcome(A.prices(spark, sf), 252)
    return df.select("asset", "n", *[r6(c).alias(c) for c in
                                     ("mean_growth", "sd_growth", "p05_growth", "p50_growth", "p95_growth")])


@register("forecast_summary", with_("prices", extra={"t": TRIM, "g": """
SELECT asset, lead(close, 252) OVER (PARTITION BY asset ORDER BY d) / close AS g FROM prices"""}) + """
SELECT i.asset, round(i.close * avg(g.g), 6) + 0.0 AS predicted_price, round(abs(i.close) * stddev_samp(g.g), 6) + 0.0 AS sd_price,
  max(a.close) AS actual_price
FROM (SELECT asset, close FROM t WHERE rn = 1) i JOIN g ON g.asset = i.asset AND g.g IS NOT NULL
LEFT JOIN (SELECT asset, close FROM t WHERE rn = 503) a ON a.asset = i.asset GROUP BY i.asset, i.close""")
def forecast_summary(spark, sf):
    """Terminal price scenarios = first trimmed close x every observed 252-step
    growth of the asset; mean and sd per asset next to the realised close.
    One pass: a single series window yields the trimmed positions and the
    forward growths, one aggregation the summary."""
    df = S.rolling(_log_returns(spark, sf), "r", 252, "var", out="v")
    w = S.series_window("asset", "d")
    trimmed = F.col("v").isNotNull()
    df = (df.withColumn("trn", F.when(trimmed, F.count(F.when(trimmed, 1)).over(w.rowsBetween(Window.unboundedPreceding, 0))))
            .withColumn("g", F.try_divide(F.lead("close", 252).over(w), F.col("close"))))
    agg = df.groupBy("asset").agg(F.max(F.when(F.col("trn") == 1, F.col("close"))).alias("c0"),
                                  F.max(F.when(F.col("trn") == 2 * 252 - 1, F.col("close"))).alias("actual_price"),
                                  F.avg("g").alias("mg"), F.stddev_samp("g").alias("sg"))
    return agg.select("asset", r6(F.col("c0") * F.col("mg")).alias("predicted_price"),
                      r6(F.abs("c0") * F.col("sg")).alias("sd_price"), "actual_price")


# ---- many-series variants (one series per user of ``events``)
EV_W = "WINDOW w AS (PARTITION BY asset ORDER BY d ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"


@register("rolling_mean_events", with_("event_series") + f"""
SELECT asset, d, round(CASE WHEN count(close) OVER w = 10 THEN avg(close) OVER w END, 6) + 0.0 AS rolling_mean
FROM event_series {EV_W}""")
def rolling_mean_events(spark, sf):
    """10-event trailing mean per user, in blocks of positions: a user with
    very many events is spread over many tasks."""
    df = S.rolling_blocked(A.event_series(spark, sf), "close", 10, "mean", out="rolling_mean")
    return df.select("asset", "d", r6("rolling_mean").alias("rolling_mean"))


@register("rolling_sd_events_blocked", with_("event_series") + f"""
SELECT asset, d, round(CASE WHEN count(close) OVER w = 10 THEN stddev_samp(close) OVER w END, 6) + 0.0 AS rolling_sd
FROM event_series {EV_W}""")
def rolling_sd_events_blocked(spark, sf):
    """Same frame through the hot-key-safe blocked window: series are cut
    into blocks of 32 positions with a 9-row halo (hourly buckets give the
    positions), so no task ever holds more than one block."""
    df = S.rolling_blocked(A.event_series(spark, sf), "close", 10, "sd", out="rolling_sd", block_rows=32,
                           bucket=F.date_trunc("hour", F.col("d")))
    return df.select("asset", "d", r6("rolling_sd").alias("rolling_sd"))


@register("log_return_events", with_("event_series") + """
SELECT asset, d, round(CASE WHEN lag(close) OVER w <> 0 AND close / lag(close) OVER w > 0
  THEN ln(close / lag(close) OVER w) END, 6) + 0.0 AS log_return
FROM event_series WINDOW w AS (PARTITION BY asset ORDER BY d)""")
def log_return_events(spark, sf):
    df = S.log_return_blocked(A.event_series(spark, sf))
    return df.select("asset", "d", r6("log_return").alias("log_return"))


@register("expanding_std_events_blocked", with_("event_series") + """
SELECT asset, d, round(stddev_pop(close) OVER (PARTITION BY asset ORDER BY d
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) + 0.0 AS sigma FROM event_series""")
def expanding_std_events_blocked(spark, sf):
    """Running population sd per user through the hot-key-safe blocked form
    (blocks of 32 positions at this scale)."""
    df = S.expanding_std_blocked(A.event_series(spark, sf), "close", out="sigma", block_rows=32,
                                 bucket=F.date_trunc("hour", F.col("d")))
    return df.select("asset", "d", r6("sigma").alias("sigma"))
