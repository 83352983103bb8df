"""Join / pairing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..oracle import with_
from ..operators import joins as J
from ..operators import series as S
from ..operators.pairs import align_wide, spread_frame
from ..plans import adapters as A
from ..sources.tables import read_table
from ._base import r6, register
from .verbs import WIDE
from .windows import RETS, spread, spread_sql


@register("align_series_outer", with_("prices", extra={"w": WIDE}) + "SELECT * FROM w")
def align_series_outer(spark, sf):
    return align_wide(A.prices(spark, sf), A.ASSETS, how="outer")


@register("align_series_left", with_("prices", extra={"w": WIDE}) + "SELECT * FROM w WHERE AF IS NOT NULL")
def align_series_left(spark, sf):
    return align_wide(A.prices(spark, sf), A.ASSETS, how="left")


@register("concat_columns", with_("census") + """
SELECT id, age, education_num, hours_per_week, round(capital_gain, 6) + 0.0 AS capital_gain,
  CASE income WHEN '>50K' THEN 1 WHEN '<=50K' THEN 0 END AS income FROM census""")
def concat_columns(spark, sf):
    """Features and label side by side: one projection of the same rows
    (no positional paste, which Spark does not have)."""
    c = A.census(spark, sf)
    return c.select("id", "age", "education_num", "hours_per_week", r6("capital_gain").alias("capital_gain"),
                    F.when(F.col("income") == ">50K", 1).when(F.col("income") == "<=50K", 0).alias("income"))


SNAPNUM = """SELECT site, snapshot, row_number() OVER (PARTITION BY site ORDER BY snapshot) AS sn
FROM (SELECT DISTINCT site, snapshot FROM snapshots {where})"""
DELTA = """SELECT s.site, s.snapshot, s.item FROM snapshots s JOIN nums n ON s.site = n.site AND s.snapshot = n.snapshot
WHERE s.item IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM snapshots p JOIN nums pn ON p.site = pn.site AND p.snapshot = pn.snapshot
  WHERE p.site = s.site AND p.item = s.item AND pn.sn = n.sn - 1)"""


def delta_sql(skip_empty: bool) -> str:
    where = "WHERE item IS NOT NULL" if skip_empty else ""
    return with_("snapshots", extra={"nums": SNAPNUM.format(where=where), "delta": DELTA})


@register("anti_join_previous", delta_sql(False) + "SELECT * FROM delta")
def anti_join_previous(spark, sf):
    return J.anti_join_previous(A.snapshots(spark, sf), skip_empty=False).select("site", "snapshot", "item")


GRID = {"hold_time": [5, 10, 15, 20, 25, 30], "sell_sigma": [0, 1, 2, 3], "trade_sigma": [0, 1, 2, 3]}
GRID_SQL = """SELECT CAST(h AS DOUBLE) AS hold_time, CAST(s AS DOUBLE) AS sell_sigma, CAST(t AS DOUBLE) AS trade_sigma
FROM (SELECT unnest([5, 10, 15, 20, 25, 30]) AS h), (SELECT unnest([0, 1, 2, 3]) AS s), (SELECT unnest([0, 1, 2, 3]) AS t)"""


@register("cross_param_grid", spread_sql(grid=GRID_SQL) + """
SELECT p.first, p.second, g.* FROM (SELECT DISTINCT 'AF' AS first, 'RO' AS second FROM spread) p, grid g""")
def cross_param_grid(spark, sf):
    """The pair of the original, if present in the data, x 6 x 4 x 4 parameter triples."""
    pairs = spread(spark, sf).select("first", "second").distinct()
    return J.param_grid(pairs, GRID)


def every_pair(spark, sf):
    """The two-asset frame of every ordered pair of assets."""
    pairs = spark.createDataFrame([(a, b) for a in A.ASSETS for b in A.ASSETS if a != b], "first string, second string")
    return spread_frame(A.prices(spark, sf), pairs)


@register("cross_param_grid_pairs", with_("prices", extra={"rets": RETS, "grid": GRID_SQL}) + """
SELECT p.first, p.second, g.* FROM (SELECT DISTINCT a.asset AS first, b.asset AS second FROM rets a JOIN rets b
  ON a.d = b.d AND a.asset <> b.asset WHERE a.r IS NOT NULL AND b.r IS NOT NULL) p, grid g""")
def cross_param_grid_pairs(spark, sf):
    """Every ordered pair present in the data x 6 x 4 x 4 parameter triples."""
    return J.param_grid(every_pair(spark, sf).select("first", "second").distinct(), GRID)


@register("pairwise_columns", with_("prices", extra={"rt": RETS}) + """
SELECT a.d, a.asset AS a, b.asset AS b, round(a.r, 9) + 0.0 AS ra, round(b.r, 9) + 0.0 AS rb
FROM rt a JOIN rt b ON a.d = b.d AND a.asset <> b.asset WHERE a.r IS NOT NULL AND b.r IS NOT NULL""")
def pairwise_columns(spark, sf):
    from ..operators.stats import pairwise_long
    r = S.pct_change(A.prices(spark, sf), out="r", pad=False).filter(F.col("r").isNotNull())
    p = pairwise_long(r, value="r", include_self=False)
    return p.select("d", "a", "b", r6("va", 9).alias("ra"), r6("vb", 9).alias("rb"))


@register("pair_sum_join", """
WITH ev AS (SELECT user_id, CAST(trunc(value) AS INT) AS v,
   row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events),
fp AS (SELECT user_id, v, min(pos) AS fpos FROM ev GROUP BY user_id, v),
jj AS (SELECT e.user_id, min(e.pos) AS j FROM ev e JOIN fp ON fp.user_id = e.user_id AND fp.v = 500 - e.v
       WHERE fp.fpos < e.pos GROUP BY e.user_id),
jv AS (SELECT jj.user_id, jj.j, e.v FROM jj JOIN ev e ON e.user_id = jj.user_id AND e.pos = jj.j)
SELECT jv.user_id, CAST(max(x.pos) AS BIGINT) AS i, CAST(jv.j AS BIGINT) AS j
FROM jv JOIN ev x ON x.user_id = jv.user_id AND x.v = 500 - jv.v AND x.pos < jv.j GROUP BY jv.user_id, jv.j""")
def pair_sum_join(spark, sf):
    """Two-sum per user over the event values in time order, target 500."""
    ev = read_table(spark, sf, "events").withColumn("v", F.col("value").cast("int"))
    return J.two_sum(ev, "user_id", ["ts", "event_id"], "v", 500).select("user_id", "i", "j")
