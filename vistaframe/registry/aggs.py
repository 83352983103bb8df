"""Aggregation queries (grouped, distributional, co-movement, scoring)."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..oracle import with_
from ..operators import series as S
from ..operators import stats as T
from ..plans import adapters as A
from ._base import r6, register
from .windows import LOGRET, RETS, SPREAD, spread, spread_sql

DISC = """SELECT *, CAST(len(regexp_extract_all(discourse_text, '\\S+')) AS INT) AS discourse_len,
  CASE WHEN CAST(len(regexp_extract_all(discourse_text, '\\S+')) AS INT) = predictionstring_len THEN 0 ELSE 1 END AS len_predict
FROM discourse"""


def discourse_flags(spark, sf):
    d = A.discourse(spark, sf)
    d = d.withColumn("discourse_len", X.word_count("discourse_text"))
    return d.withColumn("len_predict", X.mismatch_flag("discourse_len", "predictionstring_len"))


@register("group_mean", with_("tracks") + """
SELECT artist_name, round(avg(duration), 6) + 0.0 AS mean_duration FROM tracks GROUP BY artist_name""")
def group_mean(spark, sf):
    t = A.tracks(spark, sf)
    return t.groupBy("artist_name").agg(r6(F.avg("duration")).alias("mean_duration")) \
            .orderBy(F.col("mean_duration").desc(), "artist_name")


@register("group_mean_multi", with_("discourse") + """
SELECT discourse_type, round(avg(discourse_start), 6) + 0.0 AS discourse_start,
  round(avg(discourse_end), 6) + 0.0 AS discourse_end FROM discourse GROUP BY discourse_type""")
def group_mean_multi(spark, sf):
    d = A.discourse(spark, sf)
    return (d.groupBy("discourse_type")
             .agg(r6(F.avg("discourse_start")).alias("discourse_start"), r6(F.avg("discourse_end")).alias("discourse_end"))
             .orderBy(F.col("discourse_start").desc(), "discourse_type"))


@register("value_counts", with_("tracks") + """
SELECT artist_name, count(*) AS n FROM tracks GROUP BY artist_name""")
def value_counts(spark, sf):
    return T.value_counts(A.tracks(spark, sf), "artist_name").orderBy(F.col("n").desc(), "artist_name")


@register("value_share", with_("census_null") + """
SELECT workclass, count(*) AS n, round(count(*) / (SELECT count(*) FROM census_null), 6) + 0.0 AS share
FROM census_null GROUP BY workclass""")
def value_share(spark, sf):
    df = T.value_share(A.census(spark, sf, sentinel_as_null=True), "workclass", dropna=False)
    return df.select("workclass", "n", r6("share").alias("share"))


@register("value_share_top5", with_("census") + """
SELECT native_country, round(count(*) / (SELECT count(*) FROM census), 6) + 0.0 AS share
FROM census GROUP BY native_country ORDER BY count(*) DESC, native_country LIMIT 5""")
def value_share_top5(spark, sf):
    df = T.value_share(A.census(spark, sf), "native_country", dropna=True)
    return T.top_k(df, 5, F.col("n").desc(), F.col("native_country")).select(
        "native_country", r6("share").alias("share"))


@register("group_sum_count", with_("discourse", extra={"t": DISC}) + """
SELECT discourse_type, CAST(sum(len_predict) AS BIGINT) AS len_predict, count(discourse_len) AS discourse_len
FROM t GROUP BY discourse_type""")
def group_sum_count(spark, sf):
    d = discourse_flags(spark, sf)
    return d.groupBy("discourse_type").agg(F.sum("len_predict").cast("bigint").alias("len_predict"),
                                           F.count("discourse_len").alias("discourse_len"))


@register("group_fail_rate", with_("discourse", extra={"t": DISC}) + """
SELECT discourse_type, CAST(sum(len_predict) AS BIGINT) AS len_predict, count(discourse_len) AS discourse_len,
  round(sum(len_predict) / count(discourse_len), 6) + 0.0 AS fail_rate
FROM t GROUP BY discourse_type HAVING sum(len_predict) > 0""")
def group_fail_rate(spark, sf):
    """Failures / total per group in ONE aggregation (the original joins two
    aggregates); only groups with at least one failure appear."""
    d = discourse_flags(spark, sf)
    g = d.groupBy("discourse_type").agg(F.sum("len_predict").cast("bigint").alias("len_predict"),
                                        F.count("discourse_len").alias("discourse_len"))
    return g.filter(F.col("len_predict") > 0).withColumn(
        "fail_rate", r6(F.col("len_predict") / F.col("discourse_len")))


@register("join_group_summaries", with_("discourse", extra={"t": DISC}) + """
SELECT e.discourse_type, e.len_predict, a.discourse_len FROM
 (SELECT discourse_type, CAST(sum(len_predict) AS BIGINT) AS len_predict FROM t WHERE len_predict = 1 GROUP BY discourse_type) e
 LEFT JOIN (SELECT discourse_type, count(discourse_len) AS discourse_len FROM t GROUP BY discourse_type) a
 ON e.discourse_type = a.discourse_type""")
def join_group_summaries(spark, sf):
    """Left join of two per-group summaries (as the original merge); both
    sides are already aggregated (one row per group)."""
    d = discourse_flags(spark, sf)
    errs = d.filter(F.col("len_predict") == 1).groupBy("discourse_type") \
            .agg(F.sum("len_predict").cast("bigint").alias("len_predict"))
    alls = d.groupBy("discourse_type").agg(F.count("discourse_len").alias("discourse_len"))
    return errs.join(alls, "discourse_type", "left")


@register("overall_fail_rate", with_("discourse", extra={"t": DISC}) + """
SELECT CAST(sum(len_predict) AS BIGINT) AS n_fail, round(sum(len_predict) / count(*), 6) + 0.0 AS fail_share,
  printf('%.2f%%', 100.0 * sum(len_predict) / count(*)) AS fail_pct FROM t""")
def overall_fail_rate(spark, sf):
    d = discourse_flags(spark, sf)
    share = F.sum("len_predict") / F.count(F.lit(1))
    return d.agg(F.sum("len_predict").cast("bigint").alias("n_fail"), r6(share).alias("fail_share"),
                 F.format_string("%.2f%%", F.round(share * 100, 2)).alias("fail_pct"))


@register("column_moments", with_("prices", extra={"lr": LOGRET}) + """
SELECT asset, round(avg(r), 6) + 0.0 AS mean, round(stddev_samp(r), 6) + 0.0 AS sd,
  round(var_samp(r), 9) + 0.0 AS var FROM lr WHERE r IS NOT NULL GROUP BY asset""")
def column_moments(spark, sf):
    r = S.log_return(A.prices(spark, sf), out="r").filter(F.col("r").isNotNull())
    return r.groupBy("asset").agg(r6(F.avg("r")).alias("mean"), r6(F.stddev_samp("r")).alias("sd"),
                                  r6(F.var_samp("r"), 9).alias("var"))


COMPLETE = """SELECT * FROM lr WHERE r IS NOT NULL AND d IN (
  SELECT d FROM lr WHERE r IS NOT NULL GROUP BY d HAVING count(*) = 6)"""


@register("corr_matrix", with_("prices", extra={"lr": LOGRET, "c": COMPLETE}) + """
SELECT a.asset AS a, b.asset AS b, round(corr(a.r, b.r), 6) + 0.0 AS corr, count(*) AS n
FROM c a JOIN c b ON a.d = b.d GROUP BY a.asset, b.asset""")
def corr_matrix(spark, sf):
    r = S.log_return(A.prices(spark, sf), out="r")
    m = T.corr_matrix(r, complete=True, include_self=True, stat="corr")
    return m.select("a", "b", r6("corr").alias("corr"), "n")


@register("corr_pairs", with_("prices", extra={"rt": RETS}) + """
SELECT a.asset AS a, b.asset AS b, round(corr(a.r, b.r), 6) + 0.0 AS corr, count(*) AS n
FROM rt a JOIN rt b ON a.d = b.d AND a.asset <> b.asset
WHERE a.r IS NOT NULL AND b.r IS NOT NULL GROUP BY a.asset, b.asset""")
def corr_pairs(spark, sf):
    r = S.pct_change(A.prices(spark, sf), out="r", pad=False)
    m = T.corr_matrix(r, complete=False, include_self=False, stat="corr")
    return m.select("a", "b", r6("corr").alias("corr"), "n")


@register("cov_matrix_first_n", with_("prices", extra={"lr": LOGRET, "c": COMPLETE, "f": """
SELECT * FROM c WHERE d IN (SELECT DISTINCT d FROM c ORDER BY d LIMIT 252)"""}) + """
SELECT a.asset AS a, b.asset AS b, round(covar_samp(a.r, b.r), 9) + 0.0 AS cov, count(*) AS n
FROM f a JOIN f b ON a.d = b.d GROUP BY a.asset, b.asset""")
def cov_matrix_first_n(spark, sf):
    r = S.log_return(A.prices(spark, sf), out="r").filter(F.col("r").isNotNull())
    c = T.complete_rows(r, n_keys=len(A.ASSETS))
    first = c.select("d").distinct().orderBy("d").limit(252)
    m = T.corr_matrix(c.join(first, "d", "left_semi"), complete=False, include_self=True, stat="cov")
    return m.select("a", "b", r6("cov", 9).alias("cov"), "n")


@register("first_last_return", with_("prices") + """
SELECT asset, round(1000 * (max_by(close, d) / min_by(close, d) - 1), 6) + 0.0 AS dollar_return
FROM prices GROUP BY asset""")
def first_last_return(spark, sf):
    df = T.first_last_return(A.prices(spark, sf), 1000.0)
    return df.select("asset", r6("dollar_return").alias("dollar_return"))


@register("first_last_return_second", with_("prices") + """
SELECT asset, round(1000 * (max_by(close, d) / min_by(close, d) - 1), 6) + 0.0 AS dollar_return
FROM (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY d) AS rn FROM prices) WHERE rn >= 2 GROUP BY asset""")
def first_last_return_second(spark, sf):
    df = T.first_last_return(A.prices(spark, sf), 1000.0, start_row=2)
    return df.select("asset", r6("dollar_return").alias("dollar_return"))


@register("compound_return", spread_sql() + """
SELECT 'AF' AS asset, round(list_reduce(list(1 + a_ret ORDER BY d), lambda a, x: a * x) - 1, 6) + 0.0 AS compound_return FROM spread
UNION ALL SELECT 'RO', round(list_reduce(list(1 + b_ret ORDER BY d), lambda a, x: a * x) - 1, 6) + 0.0 FROM spread""")
def compound_return(spark, sf):
    sp = spread(spark, sf)
    a = T.compound_return(sp, "a_ret", "first", order="d").select(F.col("first").alias("asset"), "compound_return")
    b = T.compound_return(sp, "b_ret", "second", order="d").select(F.col("second").alias("asset"), "compound_return")
    return a.unionByName(b).select("asset", r6("compound_return").alias("compound_return"))


@register("portfolio_return", spread_sql() + """
SELECT round(100000 * (0.5 * (list_reduce(list(1 + a_ret ORDER BY d), lambda a, x: a * x) - 1)
  + 0.5 * (list_reduce(list(1 + b_ret ORDER BY d), lambda a, x: a * x) - 1)), 4) + 0.0 AS portfolio_return
FROM spread""")
def portfolio_return(spark, sf):
    """Capital x sum_i w_i * compound_i with the weights as a tiny broadcast
    table joined to the per-asset compound returns."""
    sp = spread(spark, sf)
    comp = (T.compound_return(sp, "a_ret", "first", order="d").select(F.col("first").alias("asset"), "compound_return")
             .unionByName(T.compound_return(sp, "b_ret", "second", order="d").select(F.col("second").alias("asset"), "compound_return")))
    weights = spark.createDataFrame([(A.PAIR_FIRST, 0.5), (A.PAIR_SECOND, 0.5)], "asset string, w double")
    return (comp.join(F.broadcast(weights), "asset")
                .agg(r6(F.lit(100000.0) * F.sum(F.col("w") * F.col("compound_return")), 4).alias("portfolio_return")))


@register("rmse_by_model", with_("predictions") + """
SELECT model, round(sqrt(avg((predicted - actual) * (predicted - actual))), 6) + 0.0 AS rmse
FROM predictions GROUP BY model""")
def rmse_by_model(spark, sf):
    return T.rmse_by(A.predictions(spark, sf), "model").select("model", r6("rmse").alias("rmse"))


VOTES_LONG = """SELECT 'a' AS model, id, y, p_a AS p FROM votes UNION ALL SELECT 'b', id, y, p_b FROM votes
UNION ALL SELECT 'c', id, y, p_c FROM votes UNION ALL SELECT 'd', id, y, p_d FROM votes"""


def votes_long(spark, sf):
    v = A.votes(spark, sf)
    return v.select("id", "y", F.stack(F.lit(4), F.lit("a"), "p_a", F.lit("b"), "p_b", F.lit("c"), "p_c",
                                       F.lit("d"), "p_d").alias("model", "p"))


@register("model_scorecard", with_("votes", extra={"vl": VOTES_LONG}) + """
SELECT model, round(sqrt(avg(power(CAST(p > 0.5 AS INT) - y, 2))), 6) + 0.0 AS rmse,
  round(avg(CASE WHEN CAST(p > 0.5 AS INT) = y THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS accuracy, count(*) AS n
FROM vl GROUP BY model""")
def model_scorecard(spark, sf):
    s = T.scorecard(votes_long(spark, sf))
    return s.select("model", r6("rmse").alias("rmse"), r6("accuracy").alias("accuracy"), "n")


@register("histogram_bins", spread_sql(mm="SELECT min(diff) AS lo, max(diff) AS hi FROM spread") + """
SELECT g.bin, round(lo + g.bin * (hi - lo) / 20.0, 9) + 0.0 AS lo,
  round(CASE WHEN g.bin = 19 THEN hi ELSE lo + (g.bin + 1) * (hi - lo) / 20.0 END, 9) + 0.0 AS hi,
  coalesce(c.n, 0) AS n
FROM (SELECT range AS bin FROM range(20)) g CROSS JOIN mm
LEFT JOIN (SELECT CAST(least(floor((diff - lo) / ((hi - lo) / 20.0)), 19) AS BIGINT) AS bin, count(*) AS n
           FROM spread, mm GROUP BY 1) c ON c.bin = g.bin""")
def histogram_bins(spark, sf):
    h = T.histogram_bins(spread(spark, sf), "diff", 20)
    return h.select("bin", r6("lo", 9).alias("lo"), r6("hi", 9).alias("hi"), "n")


@register("histogram_bins_positive", with_("census", extra={"x": "SELECT capital_gain FROM census WHERE capital_gain > 0",
                                                           "mm": "SELECT min(capital_gain) AS lo, max(capital_gain) AS hi FROM x"}) + """
SELECT g.bin, round(lo + g.bin * (hi - lo) / 10.0, 6) + 0.0 AS lo,
  round(CASE WHEN g.bin = 9 THEN hi ELSE lo + (g.bin + 1) * (hi - lo) / 10.0 END, 6) + 0.0 AS hi,
  coalesce(c.n, 0) AS n
FROM (SELECT range AS bin FROM range(10)) g CROSS JOIN mm
LEFT JOIN (SELECT CAST(least(floor((capital_gain - lo) / ((hi - lo) / 10.0)), 9) AS BIGINT) AS bin, count(*) AS n
           FROM x, mm GROUP BY 1) c ON c.bin = g.bin""")
def histogram_bins_positive(spark, sf):
    x = A.census(spark, sf).filter(F.col("capital_gain") > 0)
    h = T.histogram_bins(x, "capital_gain", 10)
    return h.select("bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "n")


@register("box_stats", with_("census", extra={"q": """
SELECT income, count(education_num) AS n, quantile_cont(education_num, 0.25) AS q1, quantile_cont(education_num, 0.5) AS median,
  quantile_cont(education_num, 0.75) AS q3 FROM census GROUP BY income"""}) + """
SELECT q.income, q.n, round(q1, 6) + 0.0 AS q1, round(median, 6) + 0.0 AS median, round(q3, 6) + 0.0 AS q3,
  min(CASE WHEN education_num >= q1 - 1.5 * (q3 - q1) THEN education_num END) AS whisker_lo,
  max(CASE WHEN education_num <= q3 + 1.5 * (q3 - q1) THEN education_num END) AS whisker_hi,
  count(CASE WHEN education_num < q1 - 1.5 * (q3 - q1) OR education_num > q3 + 1.5 * (q3 - q1) THEN 1 END) AS n_outliers
FROM census c JOIN q ON c.income = q.income GROUP BY q.income, q.n, q1, median, q3""")
def box_stats(spark, sf):
    b = T.box_stats(A.census(spark, sf), "education_num", "income")
    return b.select("income", "n", r6("q1").alias("q1"), r6("median").alias("median"), r6("q3").alias("q3"),
                    F.col("whisker_lo").cast("bigint").alias("whisker_lo"),
                    F.col("whisker_hi").cast("bigint").alias("whisker_hi"), "n_outliers")


@register("ecdf_by_group", with_("census", extra={"vc": "SELECT income, age, count(*) AS n FROM census GROUP BY income, age"}) + """
SELECT income, age, n, round(sum(n) OVER (PARTITION BY income ORDER BY age ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  / sum(n) OVER (PARTITION BY income), 6) + 0.0 AS cum_share FROM vc""")
def ecdf_by_group(spark, sf):
    e = T.ecdf_by_group(A.census(spark, sf), "age", "income")
    return e.select("income", F.col("age").cast("bigint").alias("age"), "n", r6("cum_share").alias("cum_share"))


@register("ecdf_smooth", with_("census", extra={"st": """
SELECT income, count(age) AS n, 0.9 * least(stddev_samp(age), CASE WHEN (quantile_cont(age, 0.75) - quantile_cont(age, 0.25)) / 1.34 > 0
   THEN (quantile_cont(age, 0.75) - quantile_cont(age, 0.25)) / 1.34 ELSE stddev_samp(age) END) * pow(CAST(count(age) AS DOUBLE), -0.2) AS bw,
  min(age) AS lo, max(age) AS hi FROM census GROUP BY income""", "b": """
SELECT c.income, lo + (floor((age - lo) / (bw / 50)) + 0.5) * (bw / 50) AS c, count(*) AS k
FROM census c JOIN st ON c.income = st.income GROUP BY ALL""",
  "p": """SELECT income, g, n, bw, lo - 3.0 * bw + g * (hi - lo + 2 * 3.0 * bw) / 63 AS x
  FROM st, (SELECT range AS g FROM range(64))""",
  "d": """SELECT p.income, p.g, p.x, sum(b.k * exp(-0.5 * ((p.x - b.c) / p.bw) * ((p.x - b.c) / p.bw))) AS y
  FROM p JOIN b ON p.income = b.income GROUP BY p.income, p.g, p.x""",
  "a": """SELECT income, g, x, coalesce((y + lag(y) OVER w) / 2 * (x - lag(x) OVER w), 0) AS area FROM d
  WINDOW w AS (PARTITION BY income ORDER BY g)"""}) + """
SELECT income, g, round(x, 6) + 0.0 AS x, round(sum(area) OVER (PARTITION BY income ORDER BY g ROWS UNBOUNDED PRECEDING)
  / sum(area) OVER (PARTITION BY income), 6) + 0.0 AS cum_share FROM a""")
def ecdf_smooth(spark, sf):
    """``ecdf_by_group`` as a kernel-smoothed curve."""
    e = T.smoothed_ecdf(A.census(spark, sf), "age", "income", grid_points=64)
    return e.select("income", F.col("g").cast("bigint").alias("g"), r6("x").alias("x"), r6("cum_share").alias("cum_share"))


@register("density_curve", with_("prices", extra={"lr": LOGRET, "x": "SELECT asset, r FROM lr WHERE r IS NOT NULL", "st": """
SELECT asset, count(r) AS n, 0.9 * least(stddev_samp(r), CASE WHEN (quantile_cont(r, 0.75) - quantile_cont(r, 0.25)) / 1.34 > 0
   THEN (quantile_cont(r, 0.75) - quantile_cont(r, 0.25)) / 1.34 ELSE stddev_samp(r) END) * pow(CAST(count(r) AS DOUBLE), -0.2) AS bw,
  min(r) AS lo, max(r) AS hi FROM x GROUP BY asset""", "b": "SELECT asset, round(r, 4) AS c, count(*) AS k FROM x GROUP BY asset, round(r, 4)",
  "p": """SELECT asset, g, n, bw, lo - 3.0 * bw + g * (hi - lo + 2 * 3.0 * bw) / 63 AS x
  FROM st, (SELECT range AS g FROM range(64))"""}) + """
SELECT p.asset, p.g, round(p.x, 6) + 0.0 AS x,
  round(sum(b.k * exp(-0.5 * ((p.x - b.c) / p.bw) * ((p.x - b.c) / p.bw))) / (p.n * p.bw * sqrt(2 * pi())), 6) + 0.0 AS density
FROM p JOIN b ON p.asset = b.asset GROUP BY p.asset, p.g, p.x, p.n, p.bw""")
def density_curve(spark, sf):
    r = S.log_return(A.prices(spark, sf), out="r")
    d = T.density_curve(r, "r", "asset", grid_points=64, resolution=4)
    return d.select("asset", F.col("g").cast("bigint").alias("g"), r6("x").alias("x"), r6("density").alias("density"))


@register("density_curve_scaled", with_("prices", extra={"lr": LOGRET, "x": "SELECT asset, r FROM lr WHERE r IS NOT NULL", "st": """
SELECT asset, count(r) AS n, 0.9 * least(stddev_samp(r), CASE WHEN (quantile_cont(r, 0.75) - quantile_cont(r, 0.25)) / 1.34 > 0
   THEN (quantile_cont(r, 0.75) - quantile_cont(r, 0.25)) / 1.34 ELSE stddev_samp(r) END) * pow(CAST(count(r) AS DOUBLE), -0.2) AS bw,
  min(r) AS lo, max(r) AS hi FROM x GROUP BY asset""", "b": """
SELECT asset, lo + (floor((r - lo) / (bw / 50)) + 0.5) * (bw / 50) AS c, count(*) AS k FROM x JOIN st USING (asset) GROUP BY ALL""",
  "p": """SELECT asset, g, n, bw, lo - 3.0 * bw + g * (hi - lo + 2 * 3.0 * bw) / 63 AS x
  FROM st, (SELECT range AS g FROM range(64))"""}) + """
SELECT p.asset, p.g, round(p.x, 6) + 0.0 AS x,
  round(sum(b.k * exp(-0.5 * ((p.x - b.c) / p.bw) * ((p.x - b.c) / p.bw))) / (p.n * p.bw * sqrt(2 * pi())), 6) + 0.0 AS density
FROM p JOIN b ON p.asset = b.asset GROUP BY p.asset, p.g, p.x, p.n, p.bw""")
def density_curve_scaled(spark, sf):
    """``density_curve`` with bins of a fiftieth of each group's bandwidth."""
    d = T.density_curve(S.log_return(A.prices(spark, sf), out="r"), "r", "asset", grid_points=64)
    return d.select("asset", F.col("g").cast("bigint").alias("g"), r6("x").alias("x"), r6("density").alias("density"))


@register("trend_by_bin", with_("predictions") + """
SELECT model, CAST(floor(actual / 10000.0) AS BIGINT) AS bucket, round(avg(actual), 6) + 0.0 AS mean_actual,
  round(avg(predicted), 6) + 0.0 AS mean_predicted, count(*) AS n,
  round(avg(CASE WHEN predicted > actual THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS share_over
FROM predictions GROUP BY model, floor(actual / 10000.0)""")
def trend_by_bin(spark, sf):
    t = T.trend_by_bin(A.predictions(spark, sf), "model", "actual", "predicted", 10000.0)
    return t.select("model", "bucket", *[r6(c).alias(c) for c in ("mean_actual", "mean_predicted")], "n",
                    r6("share_over").alias("share_over"))


@register("trend_smooth", with_("predictions", extra={
    "st": "SELECT model, min(actual) AS lo, (max(actual) - min(actual)) / 63 AS step, (max(actual) - min(actual)) * 0.2 AS h FROM predictions GROUP BY model",
    "p": "SELECT model, g, lo + g * step AS x, h FROM st, (SELECT range AS g FROM range(64))",
    "w": """SELECT p.model, g, x, h, predicted AS y, (actual - x) / h AS u, pow(1 - pow(abs((actual - x) / h), 3), 3) AS w
  FROM p JOIN predictions r ON r.model = p.model AND abs(r.actual - p.x) < p.h""",
    "m": """SELECT model, g, x, h, sum(w) AS s0, sum(w * u) AS s1, sum(w * u * u) AS s2, sum(w * y) AS t0, sum(w * u * y) AS t1
  FROM w GROUP BY model, g, x, h"""}) + """
SELECT model, g, round(x, 4) + 0.0 AS x, round((s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1), 4) + 0.0 AS fit,
  round((s0 * t1 - s1 * t0) / (s0 * s2 - s1 * s1) / h, 6) + 0.0 AS slope, round(s0, 4) + 0.0 AS weight FROM m""")
def trend_smooth(spark, sf):
    """Predicted over actual as a smoothed line per model."""
    t = T.local_regression(A.predictions(spark, sf), "model", "actual", "predicted", grid_points=64, share=0.2)
    return t.select("model", "g", *[r6(c, 4).alias(c) for c in ("x", "fit")], r6("slope").alias("slope"),
                    r6("weight", 4).alias("weight"))


@register("pair_summary_by_class", with_("census") + """
SELECT income, round(corr(age, education_num), 6) + 0.0 AS corr_age_edu, round(corr(age, hours_per_week), 6) + 0.0 AS corr_age_hours,
  round(corr(education_num, hours_per_week), 6) + 0.0 AS corr_edu_hours, round(avg(age), 6) + 0.0 AS mean_age,
  round(avg(education_num), 6) + 0.0 AS mean_edu, round(avg(hours_per_week), 6) + 0.0 AS mean_hours, count(*) AS n
FROM census GROUP BY income""")
def pair_summary_by_class(spark, sf):
    """What a pair plot coloured by class shows, as numbers: per class the
    correlation of each feature pair and the feature means (one pass)."""
    c = A.census(spark, sf)
    return c.groupBy("income").agg(
        r6(F.corr("age", "education_num")).alias("corr_age_edu"),
        r6(F.corr("age", "hours_per_week")).alias("corr_age_hours"),
        r6(F.corr("education_num", "hours_per_week")).alias("corr_edu_hours"),
        r6(F.avg("age")).alias("mean_age"), r6(F.avg("education_num")).alias("mean_edu"),
        r6(F.avg("hours_per_week")).alias("mean_hours"), F.count(F.lit(1)).alias("n"))


_NUMERIC = {"age": "age", "edu": "education_num", "hours": "hours_per_week", "gain": "capital_gain"}
_NUMERIC_PAIRS = list(itertools.combinations(_NUMERIC, 2))


@register("pair_summary_all", with_("census") + "SELECT income, " + ", ".join(
    f"CASE WHEN min({_NUMERIC[a]}) < max({_NUMERIC[a]}) AND min({_NUMERIC[b]}) < max({_NUMERIC[b]}) "
    f"THEN round(corr({_NUMERIC[a]}, {_NUMERIC[b]}), 6) + 0.0 END AS corr_{a}_{b}" for a, b in _NUMERIC_PAIRS) + ", "
          + ", ".join(f"round(avg({c}), 6) + 0.0 AS mean_{a}" for a, c in _NUMERIC.items())
          + ", count(*) AS n FROM census GROUP BY income")
def pair_summary_all(spark, sf):
    """``pair_summary_by_class`` over all pairs of the numeric features (one
    pass); no correlation where a feature has one value in a class."""
    def corr(a, b):
        varies = (F.min(a) < F.max(a)) & (F.min(b) < F.max(b))
        # F.corr divides by zero where a column has one value, also under a condition
        return F.when(varies, F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))

    c = A.census(spark, sf)
    return c.groupBy("income").agg(
        *[r6(corr(_NUMERIC[a], _NUMERIC[b])).alias(f"corr_{a}_{b}") for a, b in _NUMERIC_PAIRS],
        *[r6(F.avg(x)).alias(f"mean_{a}") for a, x in _NUMERIC.items()], F.count(F.lit(1)).alias("n"))
