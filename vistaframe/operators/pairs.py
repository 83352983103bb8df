"""Aligning series and building the two-asset spread frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .series import pct_change


def align_wide(df: DataFrame, assets: list[str], time_col: str = "d", key: str = "asset",
               value: str = "close", how: str = "outer") -> DataFrame:
    """Long ``(time, key, value)`` -> one column per asset.

    ``outer``: union of instants (missing cells NULL); ``left``: instants of
    the first asset only. One shuffle on the time column via ``pivot`` with
    an explicit value list (no extra job to discover the keys) instead of N
    full joins.
    """
    wide = df.groupBy(time_col).pivot(key, assets).agg(F.first(value))
    if how == "left":
        wide = wide.filter(F.col(assets[0]).isNotNull())
    elif how == "inner":
        for a in assets:
            wide = wide.filter(F.col(a).isNotNull())
    elif how != "outer":
        raise ValueError(how)
    return wide


def spread_frame(prices: DataFrame, pairs: DataFrame, time_col: str = "d") -> DataFrame:
    """Two-asset frame per pair: closes, simple returns (each computed on the
    asset's own series) and ``diff = ret_first - ret_second`` on the instants
    where both returns exist.

    ``pairs`` has columns ``first, second`` (a handful of rows, bounded by
    the number of assets squared), so it is broadcast.
    """
    rets = pct_change(prices, out="r")
    # each asset row meets the pairs it plays a role in (a broadcast table of
    # 2 x pairs rows); one aggregation then lines the two roles up per
    # instant - a single pass over the returns, no self-join
    roles = (pairs.select("first", "second", F.col("first").alias("asset"), F.lit(True).alias("is_first"))
                  .unionByName(pairs.select("first", "second", F.col("second").alias("asset"),
                                            F.lit(False).alias("is_first"))))
    tagged = rets.join(F.broadcast(roles), "asset")

    def pick(flag, col):
        return F.max(F.when(F.col("is_first") == flag, F.col(col)))

    wide = tagged.groupBy("first", "second", time_col).agg(
        pick(True, "close").alias("a_close"), pick(True, "r").alias("a_ret"),
        pick(False, "close").alias("b_close"), pick(False, "r").alias("b_ret"))
    return (wide.filter(F.col("a_ret").isNotNull() & F.col("b_ret").isNotNull())
                .withColumn("diff", F.col("a_ret") - F.col("b_ret")))
