"""Adapters: shapes the analyses expect, derived by Spark from the warehouse.

Each adapter is a lazy DataFrame over the parquet tables, so its cost grows
with the data and Catalyst prunes whatever the consuming query does not use.
The matching SQL text for the DuckDB oracle lives in ``vistaframe.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table

# Fixed values of the fixture contract (FIXTURES.md): the two assets of the
# pair strategy and the asset whose price is blanked on day 13.
PAIR_FIRST = "AF"
PAIR_SECOND = "RO"
ASSETS = ["AF", "AO", "NF", "NO", "RF", "RO"]
GAP_ASSET = "NF"
GAP_DAY = 13
EMPTY_POLL_DAYS = (10, 20)
LANGS = ["de", "en", "es", "fr"]


def prices(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Daily price per asset ``(d, asset, close)``.

    Close = volume-weighted unit price in cents. Both sums are integer sums,
    so the value is bit-identical whatever the partitioning of the data.
    One partial (map-side) aggregation: the output is days x 6 assets no
    matter how large ``lineitem`` is.
    """
    li = lineitem if lineitem is not None else read_table(spark, sf_dir, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return (li.groupBy(F.to_date("l_shipdate").alias("d"),
                       F.concat("l_returnflag", "l_linestatus").alias("asset"))
              .agg((F.sum(cents).cast("double")
                    / F.sum(F.col("l_quantity").cast("bigint")).cast("double")).alias("close")))


def prices_gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``prices`` with the close of one asset blanked on day 13 of each month."""
    p = prices(spark, sf_dir)
    gap = (F.col("asset") == GAP_ASSET) & (F.dayofmonth("d") == GAP_DAY)
    return p.select("d", "asset", F.when(gap, F.lit(None).cast("double"))
                    .otherwise(F.col("close")).alias("close"))


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many short series: one per user ``(asset, d, close)``."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("asset"), F.col("ts").alias("d"),
                     F.col("value").alias("close"))


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")
    return (li.join(part, li.l_partkey == part.p_partkey)
              .select(F.col("p_brand").alias("artist_name"), F.col("p_type").alias("release"),
                      F.col("p_name").alias("title"), F.year("l_shipdate").cast("int").alias("year"),
                      (F.col("l_extendedprice") / 200).alias("duration"),
                      (F.col("l_quantity") / 50).alias("artist_familiarity"),
                      (F.col("l_discount") * 10).alias("artist_hotttnesss")))


def census(spark: SparkSession, sf_dir: str, sentinel_as_null: bool = False) -> DataFrame:
    """Census-like person table; ``workclass`` uses the '?' sentinel unless
    ``sentinel_as_null``."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    o = read_table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    seg = F.col("c_mktsegment")
    workclass = (F.when(seg == "BUILDING", "Private").when(seg == "MACHINERY", "Local-gov")
                  .when(seg == "HOUSEHOLD", "State-gov").when(seg == "AUTOMOBILE", "Self-emp-inc")
                  .otherwise("?"))
    if sentinel_as_null:
        workclass = F.nullif(workclass, F.lit("?"))
    race = (F.when(F.col("c_nationkey") % 3 == 0, "White").when(F.col("c_nationkey") % 3 == 1, "Black")
             .otherwise("Other"))
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(o, o.o_custkey == c.c_custkey)
             .select(F.col("c_custkey").alias("id"), (18 + F.col("c_custkey") % 60).alias("age"),
                     workclass.alias("workclass"), F.col("n").alias("education_num"),
                     race.alias("race"),
                     F.when(F.col("c_custkey") % 2 == 0, "Male").otherwise("Female").alias("sex"),
                     F.col("n_name").alias("native_country"),
                     F.when(F.col("c_acctbal") > 8000, F.col("c_acctbal")).otherwise(F.lit(0.0))
                      .alias("capital_gain"),
                     (20 + F.col("n")).alias("hours_per_week"),
                     F.when(F.col("c_acctbal") + 400 * F.col("n") > 9000, ">50K").otherwise("<=50K")
                      .alias("income")))


def discourse(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    blanks = F.length("text") - F.length(F.regexp_replace("text", " ", ""))
    return d.select(F.col("doc_id").alias("id"), F.col("lang").alias("discourse_type"),
                    F.col("text").alias("discourse_text"),
                    (F.col("doc_id") % 500).alias("discourse_start"),
                    (F.col("doc_id") % 500 + F.col("n_chars")).alias("discourse_end"),
                    (blanks + 1).cast("int").alias("predictionstring_len"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls ``(site, snapshot, item)``; polls on days 10 and 20 came back
    empty and are represented by one marker row with a NULL item."""
    ev = read_table(spark, sf_dir, "events")
    base = ev.select(F.col("event_type").alias("site"), F.to_date("ts").alias("snapshot"),
                     F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("item")).distinct()
    empty = F.dayofmonth("snapshot").isin(*EMPTY_POLL_DAYS)
    kept = base.filter(~empty)
    markers = (base.filter(empty).select("site", "snapshot").distinct()
                   .select("site", "snapshot", F.lit(None).cast("string").alias("item")))
    return kept.unionByName(markers)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")
    retail = (li.join(part, li.l_partkey == part.p_partkey)
                .select(F.lit("retail").alias("model"), F.col("l_extendedprice").alias("actual"),
                        (F.col("p_retailprice") * F.col("l_quantity")).alias("predicted")))
    flat = li.select(F.lit("flat").alias("model"), F.col("l_extendedprice").alias("actual"),
                     (F.lit(1500) * F.col("l_quantity")).alias("predicted"))
    return retail.unionByName(flat)


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four given probability columns per order for the ensemble operators."""
    o = read_table(spark, sf_dir, "orders")

    def frac(c: Column, m: int) -> Column:
        return (c % m).cast("double") / (m - 1)

    return o.select(F.col("o_orderkey").alias("id"),
                    F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("y"),
                    frac(F.col("o_custkey"), 101).alias("p_a"), frac(F.col("o_orderkey"), 97).alias("p_b"),
                    frac(F.col("o_custkey"), 53).alias("p_c"), frac(F.col("o_orderkey"), 29).alias("p_d"))
