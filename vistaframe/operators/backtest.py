"""Long-only pair strategy with a hold clock, as a fold over each pair's
ordered rows.

Per pair the rows are gathered once into an array sorted by time (its
length is the number of instants of one series - calendar-bound, not
data-bound), then ``aggregate`` walks it with a struct state. A parameter
grid multiplies the pair rows (``explode``), so every (pair, parameter set)
is an independent row that any executor can fold.

Rules (fixed behaviour of the strategy):
state (cash = capital, shares = 0, held = none, days = 0); for every row
from ``start`` on, with sigma = population sd of ``diff`` over all rows up
to and including the current one:
1. flat and ``trade*sigma <= |diff|``: buy the second asset when
   ``diff > 0``, else the first; ``shares = cash / close``;
2. then, same row, if ``sell*sigma > diff`` (signed) and ``days > hold``:
   sell what is held at its close (nothing held: cash unchanged), and
   reset ``days = 0``;
3. ``days += 1`` on every row.
An open position is valued at the last close of the held asset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NONE, FIRST, SECOND = 0, 1, 2


def pair_arrays(spread: DataFrame, start: int = 100, keys=("first", "second"), time_col: str = "d") -> DataFrame:
    """One row per pair holding the time-ordered array of
    ``(rn, a_close, b_close, diff, sigma)`` for rows ``rn >= start``."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(time_col)
    s = (spread.withColumn("rn", F.row_number().over(w))
               .withColumn("sigma", F.stddev_pop("diff").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    s = s.filter(F.col("rn") >= start)
    rec = F.struct("rn", "a_close", "b_close", "diff", "sigma")
    return s.groupBy(*keys).agg(F.array_sort(F.collect_list(rec)).alias("rows"))


def _step(hold: Column, sell: Column, trade: Column):
    def step(acc, x):
        sig, diff = x["sigma"], x["diff"]
        buy = (acc["shares"] == 0) & (trade * sig <= F.abs(diff))
        buy_second = buy & (diff > 0)
        buy_first = buy & ~(diff > 0)
        shares1 = (F.when(buy_second, acc["cash"] / x["b_close"])
                    .when(buy_first, acc["cash"] / x["a_close"]).otherwise(acc["shares"]))
        held1 = F.when(buy_second, F.lit(SECOND)).when(buy_first, F.lit(FIRST)).otherwise(acc["held"])
        sell_now = (sell * sig > diff) & (acc["days"] > hold)
        cash2 = (F.when(sell_now & (held1 == FIRST), x["a_close"] * shares1)
                  .when(sell_now & (held1 == SECOND), x["b_close"] * shares1).otherwise(acc["cash"]))
        return F.struct(cash2.alias("cash"),
                        F.when(sell_now, F.lit(0.0)).otherwise(shares1).alias("shares"),
                        F.when(sell_now, F.lit(NONE)).otherwise(held1).alias("held"),
                        (F.when(sell_now, F.lit(0)).otherwise(acc["days"]) + 1).alias("days"),
                        x["a_close"].alias("last_a"), x["b_close"].alias("last_b"))
    return step


def run_strategy(arrays: DataFrame, hold, sell, trade, capital: float = 100000.0,
                 rows_col: str = "rows") -> Column:
    """Final portfolio value of the strategy over each row's array.
    ``hold/sell/trade`` are columns (per-row parameters) or numbers."""
    def c(v):
        return v if isinstance(v, Column) else F.lit(float(v))
    init = F.struct(F.lit(float(capital)).alias("cash"), F.lit(0.0).alias("shares"), F.lit(NONE).alias("held"),
                    F.lit(0).alias("days"), F.lit(None).cast("double").alias("last_a"),
                    F.lit(None).cast("double").alias("last_b"))

    def finish(acc):
        open_value = F.when(acc["held"] == FIRST, acc["shares"] * acc["last_a"]).otherwise(acc["shares"] * acc["last_b"])
        return F.when(acc["shares"] > 0, open_value).otherwise(acc["cash"])

    return F.aggregate(F.col(rows_col), init, _step(c(hold), c(sell), c(trade)), finish)


def pair_backtest(spread: DataFrame, hold: float = 5, sell: float = 0, trade: float = 0,
                  capital: float = 100000.0, start: int = 100) -> DataFrame:
    """Profit of one parameter set per pair (the first, fixed version)."""
    arr = pair_arrays(spread, start)
    return arr.select("first", "second",
                      (run_strategy(arr, hold, sell, trade, capital) - F.lit(capital)).alias("profit"))


def backtest_grid(spread: DataFrame, grid: dict[str, list], capital: float = 100000.0,
                  start: int = 100) -> DataFrame:
    """``final / capital`` for every pair x parameter triple. The grid is a
    fixed-size product generated by ``explode`` on each pair row, and the
    (pair, triple) rows are dealt out before they are folded."""
    from .joins import param_grid
    arr = param_grid(pair_arrays(spread, start), grid).repartition("first", "second", *grid)
    ratio = run_strategy(arr, F.col("hold_time"), F.col("sell_sigma"), F.col("trade_sigma"), capital) / F.lit(capital)
    return arr.select("first", "second", "hold_time", "sell_sigma", "trade_sigma", ratio.alias("ratio"))
