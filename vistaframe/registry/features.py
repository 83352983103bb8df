"""Feature-transform queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from ..oracle import with_
from ..plans import adapters as A
from ._base import r6, register
from .text import RECODES, census_etl

DECADE_SPLITS = [1995.0, 1997.0, 1999.0, 2001.0, 2003.0]
DECADE_LABELS = ["1995-96", "1997-98", "1999-00", "2001-02"]


@register("binarize", with_("tracks") + """
SELECT artist_hotttnesss > 0.5 AS is_hottt_or_nottt, count(*) AS n FROM tracks GROUP BY ALL""")
def binarize(spark, sf):
    b = FE.binarize(A.tracks(spark, sf).select("artist_hotttnesss"), "artist_hotttnesss", "is_hottt_or_nottt", 0.5)
    return b.groupBy(F.col("is_hottt_or_nottt").cast("boolean").alias("is_hottt_or_nottt")).agg(
        F.count(F.lit(1)).alias("n"))


@register("bucketize_labels", with_("tracks") + """
SELECT CASE WHEN year >= 1995 AND year < 1997 THEN '1995-96' WHEN year >= 1997 AND year < 1999 THEN '1997-98'
  WHEN year >= 1999 AND year < 2001 THEN '1999-00' WHEN year >= 2001 AND year <= 2003 THEN '2001-02' END AS decade,
  count(*) AS n, round(avg(artist_hotttnesss), 6) + 0.0 AS mean_hotttnesss FROM tracks GROUP BY ALL""")
def bucketize_labels(spark, sf):
    t = A.tracks(spark, sf).select("year", "artist_hotttnesss")
    b = FE.bucketize(t, "year", "decade", DECADE_SPLITS, DECADE_LABELS)
    return b.groupBy("decade").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("artist_hotttnesss")).alias("mean_hotttnesss"))


@register("quantile_bins", with_("tracks", extra={"q": """
SELECT quantile_disc(duration, 0.2) AS q1, quantile_disc(duration, 0.4) AS q2, quantile_disc(duration, 0.6) AS q3,
  quantile_disc(duration, 0.8) AS q4 FROM tracks"""}) + """
SELECT CAST((duration >= q1)::INT + (duration >= q2)::INT + (duration >= q3)::INT + (duration >= q4)::INT AS DOUBLE) AS duration_bin,
  count(*) AS n, min(duration) AS lo, max(duration) AS hi FROM tracks, q GROUP BY ALL""")
def quantile_bins(spark, sf):
    t = A.tracks(spark, sf).select("duration")
    b = FE.quantile_bins(t, "duration", "duration_bin", 5)
    return b.groupBy("duration_bin").agg(F.count(F.lit(1)).alias("n"), F.min("duration").alias("lo"),
                                         F.max("duration").alias("hi"))


@register("one_hot", with_("census_null") + f"""
SELECT id, CAST(race_cat = 0 AS INT) AS race_cat_0, CAST(race_cat = 1 AS INT) AS race_cat_1, CAST(race_cat = 2 AS INT) AS race_cat_2,
  CAST(workclass_cat = 0 AS INT) AS workclass_cat_0, CAST(workclass_cat = 1 AS INT) AS workclass_cat_1,
  CAST(workclass_cat = 2 AS INT) AS workclass_cat_2, CAST(workclass_cat = 3 AS INT) AS workclass_cat_3
FROM (SELECT id, {RECODES} FROM census_null)""")
def one_hot(spark, sf):
    e = census_etl(spark, sf).select("id", "race_cat", "workclass_cat")
    e = FE.one_hot(e, "race_cat", [0, 1, 2])
    return FE.one_hot(e, "workclass_cat", [0, 1, 2, 3])


SPLIT = """SELECT *, CASE WHEN row_number() OVER (PARTITION BY income ORDER BY md5(CAST(id AS VARCHAR) || '42'), id)
  <= count(*) OVER (PARTITION BY income) - (3 * count(*) OVER (PARTITION BY income) + 9) // 10 THEN 'train' ELSE 'test' END AS split
FROM census"""


@register("stratified_split", with_("census", extra={"s": SPLIT}) + "SELECT id, income, split FROM s")
def stratified_split(spark, sf):
    s = FE.stratified_split(A.census(spark, sf), "income", "id", test_tenths=3, seed=42)
    return s.select("id", "income", "split")


NUM = ["age", "education_num", "hours_per_week", "capital_gain"]


@register("standard_scale", with_("census", extra={"s": SPLIT, "st": """
SELECT avg(age) AS m1, stddev_pop(age) AS s1, avg(education_num) AS m2, stddev_pop(education_num) AS s2,
  avg(hours_per_week) AS m3, stddev_pop(hours_per_week) AS s3, avg(capital_gain) AS m4, stddev_pop(capital_gain) AS s4
FROM s WHERE split = 'train'"""}) + """
SELECT id, split, round((age - m1) / s1, 6) + 0.0 AS sc_age, round((education_num - m2) / s2, 6) + 0.0 AS sc_education_num,
  round((hours_per_week - m3) / s3, 6) + 0.0 AS sc_hours_per_week, round((capital_gain - m4) / s4, 6) + 0.0 AS sc_capital_gain
FROM s, st""")
def standard_scale(spark, sf):
    s = FE.stratified_split(A.census(spark, sf), "income", "id")
    z = FE.standard_scale(s, NUM)
    return z.select("id", "split", *[r6(f"sc_{c}").alias(f"sc_{c}") for c in NUM])
