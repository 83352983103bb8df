"""Pair-strategy backtests (fold over ordered arrays) and their top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import backtest as B
from ..operators import stats as T
from ..oracle import with_
from ..plans import adapters as A
from ._base import register
from .joins import GRID, GRID_SQL, every_pair
from .windows import RETS, spread, spread_sql

_BUY = "(r.shares = 0 AND r.trade * it.sigma <= abs(it.diff))"
_SH1 = f"(CASE WHEN {_BUY} THEN CASE WHEN it.diff > 0 THEN r.cash / it.b_close ELSE r.cash / it.a_close END ELSE r.shares END)"
_NM1 = f"(CASE WHEN {_BUY} THEN CASE WHEN it.diff > 0 THEN 2 ELSE 1 END ELSE r.held END)"
_SELL = "(r.sell * it.sigma > it.diff AND r.days > r.hold)"
RUN = f"""
s AS (SELECT row_number() OVER (ORDER BY d) AS rn, d, a_close, b_close, diff,
  stddev_pop(diff) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sigma FROM spread),
it AS (SELECT * FROM s WHERE rn >= 100),
params AS ({{params}}),
run AS (
  SELECT hold, sell, trade, CAST(99 AS BIGINT) AS k, CAST(100000 AS DOUBLE) AS cash, CAST(0 AS DOUBLE) AS shares,
         0 AS held, 0 AS days, CAST(NULL AS DOUBLE) AS last_a, CAST(NULL AS DOUBLE) AS last_b FROM params
  UNION ALL
  SELECT r.hold, r.sell, r.trade, r.k + 1,
    CASE WHEN {_SELL} AND {_NM1} = 1 THEN it.a_close * {_SH1} WHEN {_SELL} AND {_NM1} = 2 THEN it.b_close * {_SH1} ELSE r.cash END,
    CASE WHEN {_SELL} THEN 0.0 ELSE {_SH1} END,
    CASE WHEN {_SELL} THEN 0 ELSE {_NM1} END,
    CASE WHEN {_SELL} THEN 0 ELSE r.days END + 1,
    it.a_close, it.b_close
  FROM run r JOIN it ON it.rn = r.k + 1),
fin AS (SELECT hold, sell, trade, arg_max(CASE WHEN shares > 0 THEN CASE WHEN held = 1 THEN shares * last_a ELSE shares * last_b END
  ELSE cash END, k) AS final FROM run GROUP BY hold, sell, trade)
"""


def _sql(params: str) -> str:
    return "WITH RECURSIVE " + spread_sql(grid=GRID_SQL)[len("WITH "):].rstrip() + ",\n" + RUN.format(params=params)


# the same fold for every ordered pair of assets
_PAIRS = """WITH RECURSIVE """ + with_("prices", extra={"rets": RETS, "spread": """
SELECT a.d, a.asset AS first, b.asset AS second, a.close AS a_close, b.close AS b_close, a.r - b.r AS diff
FROM rets a JOIN rets b ON a.d = b.d AND a.asset <> b.asset WHERE a.r IS NOT NULL AND b.r IS NOT NULL"""})[len("WITH "):].rstrip() + ",\n" + (
    RUN.replace("row_number() OVER (ORDER BY d) AS rn, d,", "row_number() OVER (PARTITION BY first, second ORDER BY d) AS rn, first, second, d,")
       .replace("OVER (ORDER BY d ROWS", "OVER (PARTITION BY first, second ORDER BY d ROWS")
       .replace("SELECT hold, sell, trade, CAST(99", "SELECT first, second, hold, sell, trade, CAST(99")
       .replace("SELECT r.hold, r.sell", "SELECT r.first, r.second, r.hold, r.sell")
       .replace("ON it.rn = r.k + 1", "ON it.rn = r.k + 1 AND it.first = r.first AND it.second = r.second")
       .replace("(SELECT hold, sell, trade, arg_max", "(SELECT first, second, hold, sell, trade, arg_max")
       .replace("FROM run GROUP BY hold", "FROM run GROUP BY first, second, hold"))


@register("pair_backtest", _PAIRS.format(params="SELECT DISTINCT first, second, 5.0 AS hold, 0.0 AS sell, 0.0 AS trade FROM it") + """
SELECT first, second, final - 100000 AS profit FROM fin""")
def pair_backtest(spark, sf):
    """Every ordered pair of assets, each a row that any executor can fold."""
    bt = B.pair_backtest(every_pair(spark, sf), hold=5, sell=0, trade=0)
    return bt.select("first", "second", "profit")


@register("backtest_grid", _sql("SELECT hold_time AS hold, sell_sigma AS sell, trade_sigma AS trade FROM grid") + """
SELECT 'AF' AS first, 'RO' AS second, hold AS hold_time, sell AS sell_sigma, trade AS trade_sigma,
  final / 100000 AS ratio FROM fin""")
def backtest_grid(spark, sf):
    g = B.backtest_grid(spread(spark, sf), GRID)
    # the fold is the same IEEE arithmetic in both engines: no rounding needed
    # (decimal rounding of values near 1e13 differs between engines)
    return g.select("first", "second", "hold_time", "sell_sigma", "trade_sigma", "ratio")


@register("top_k_strategies", _sql("SELECT hold_time AS hold, sell_sigma AS sell, trade_sigma AS trade FROM grid") + """
SELECT hold AS hold_time, sell AS sell_sigma, trade AS trade_sigma, final / 100000 AS ratio,
  printf('ratio %.6e: open beyond %d sigma, close below %d sigma, after at least %d days', final / 100000, CAST(trade AS INT), CAST(sell AS INT), CAST(hold AS INT)) AS line
FROM fin ORDER BY final DESC, hold, sell, trade LIMIT 5""")
def top_k_strategies(spark, sf):
    g = B.backtest_grid(spread(spark, sf), GRID)
    top = T.top_k(g, 5, F.col("ratio").desc(), "hold_time", "sell_sigma", "trade_sigma")
    line = F.format_string("ratio %.6e: open beyond %d sigma, close below %d sigma, after at least %d days",
                           F.col("ratio"), F.col("trade_sigma").cast("int"), F.col("sell_sigma").cast("int"),
                           F.col("hold_time").cast("int"))
    return top.select("hold_time", "sell_sigma", "trade_sigma", "ratio", line.alias("line"))


_PAIRS_GRID = _PAIRS.format(params="""SELECT first, second, hold_time AS hold, sell_sigma AS sell, trade_sigma AS trade
  FROM (SELECT DISTINCT first, second FROM it), (""" + GRID_SQL + """)""")


@register("backtest_grid_pairs", _PAIRS_GRID + """
SELECT first, second, hold AS hold_time, sell AS sell_sigma, trade AS trade_sigma, final / 100000 AS ratio FROM fin""")
def backtest_grid_pairs(spark, sf):
    """Every ordered pair of assets x every parameter triple."""
    g = B.backtest_grid(every_pair(spark, sf), GRID)
    return g.select("first", "second", "hold_time", "sell_sigma", "trade_sigma", "ratio")


@register("top_k_strategies_pairs", _PAIRS_GRID + """
SELECT first, second, hold AS hold_time, sell AS sell_sigma, trade AS trade_sigma, final / 100000 AS ratio,
  printf('%s-%s: ratio %.6e: open beyond %d sigma, close below %d sigma, after at least %d days', first, second, final / 100000, CAST(trade AS INT), CAST(sell AS INT), CAST(hold AS INT)) AS line
FROM fin ORDER BY final / 100000 DESC, hold, sell, trade, first, second LIMIT 5""")
def top_k_strategies_pairs(spark, sf):
    """The best of every ordered pair's strategies."""
    g = B.backtest_grid(every_pair(spark, sf), GRID)
    top = T.top_k(g, 5, F.col("ratio").desc(), "hold_time", "sell_sigma", "trade_sigma", "first", "second")
    line = F.format_string("%s-%s: ratio %.6e: open beyond %d sigma, close below %d sigma, after at least %d days",
                           "first", "second", F.col("ratio"), F.col("trade_sigma").cast("int"), F.col("sell_sigma").cast("int"),
                           F.col("hold_time").cast("int"))
    return top.select("first", "second", "hold_time", "sell_sigma", "trade_sigma", "ratio", line.alias("line"))
