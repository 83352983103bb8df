"""Grouped and distributional statistics.

Aggregates are written so that Spark can combine them map-side (partial
aggregation before the shuffle). Global quantities that every row needs
(totals, min/max, a k-th largest count) are scalar subqueries, evaluated
once and inlined - never a window over all rows.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .keys import join_back

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module


def _cols(x):
    return [x] if isinstance(x, str) else list(x)


# ---------------------------------------------------------------- counting
def value_counts(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """Rows per value (NULL is its own value), as in ``count(a)``."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def value_share(df: DataFrame, col: str, dropna: bool = True, out: str = "share") -> DataFrame:
    """Share of each value; ``dropna=False`` keeps missing as its own row
    and counts it in the denominator."""
    src = df if not dropna else df.filter(F.col(col).isNotNull())
    counts = src.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n")).scalar()  # of the counts: the exchange below it is reused
    return counts.withColumn(out, F.col("n") / total)


def top_n_ties(counts: DataFrame, weight: str, n: int) -> DataFrame:
    """Rows whose ``weight`` is among the ``n`` largest, ties included
    (``top_n`` semantics). The n-th largest value comes from a top-n
    (TakeOrderedAndProject) subquery; no global rank window."""
    nth = counts.select(weight).orderBy(F.col(weight).desc()).limit(n).agg(F.min(weight)).scalar()
    return counts.filter(F.col(weight) >= nth)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows by an ordering (the ordering should be unique)."""
    return df.orderBy(*order).limit(k)


# ------------------------------------------------------------ distribution
def running_counts(df: DataFrame, value: str, by) -> DataFrame:
    """``(group, value, n, __cum, __tot)``: rows per distinct value, the
    number of rows up to it and of all rows in the group.

    Rows are reduced to value counts first (partial aggregation). The counts
    are dealt out by range of (group, value), each part sums its own, and a
    part starts from the sum of the parts before it, so a group with very
    many distinct values is spread over many tasks.
    """
    by = _cols(by)
    vc = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written, so that both uses below see the same parts
    vc = vc.repartitionByRange(parts, *by, value).withColumn("__part", F.spark_partition_id()).checkpoint()
    sums = vc.groupBy(*by, "__part").agg(F.sum("n").alias("__s"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    sums = sums.select(*by, "__part", F.coalesce(F.sum("__s").over(
        group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"),
        F.sum("__s").over(group).alias("__tot"))
    inside = Window.partitionBy(*by, "__part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (join_back(vc.withColumn("__in", F.sum("n").over(inside)), sums, [*by, "__part"])
            .withColumn("__cum", F.col("__base") + F.col("__in")).drop("__base", "__in", "__part"))


def exact_quantiles(df: DataFrame, value: str, by, probs, names=None) -> DataFrame:
    """Exact quantiles with linear interpolation between order statistics
    (position ``(n-1)*p``, the ``quantile_cont`` / ``percentile`` rule), found
    in the running counts of the distinct values."""
    by = _cols(by)
    names = names or [f"q{int(round(p * 100)):02d}" for p in probs]
    vc = running_counts(df.filter(F.col(value).isNotNull()), value, by).withColumn("__prev", F.col("__cum") - F.col("n"))
    aggs = []
    for p, name in zip(probs, names):
        pos = (F.col("__tot") - 1).cast("double") * F.lit(float(p))

        def at(idx):
            return F.min(F.when((F.col("__prev") <= idx) & (idx < F.col("__cum")), F.col(value).cast("double")))

        lo, hi = F.floor(pos), F.ceil(pos)
        aggs += [at(lo).alias(f"__lo_{name}"), at(hi).alias(f"__hi_{name}"), F.max(pos - lo).alias(f"__d_{name}")]
    q = vc.groupBy(*by).agg(F.max("__tot").alias("n"), *aggs)
    return q.select(*by, "n", *[(F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__d_{n}")).alias(n)
                                for n in names])


def histogram_bins(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram between min and max; the last bin is closed.
    Every bin is reported, empty ones with 0."""
    spark = df.sparkSession
    # one scalar subquery (a struct), reused wherever its fields appear
    mm = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    lo, hi = mm["lo"], mm["hi"]
    width = (hi - lo) / F.lit(float(bins))
    b = F.least(F.floor(F.try_divide(F.col(value) - lo, width)), F.lit(bins - 1)).cast("bigint")
    counts = (df.filter(F.col(value).isNotNull()).select(F.coalesce(b, F.lit(0).cast("bigint")).alias("bin"))
                .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    grid = spark.range(bins).select(F.col("id").alias("bin"))
    return (F.broadcast(grid).join(counts, "bin", "left")
              .select("bin", (lo + F.col("bin") * width).alias("lo"),
                      F.when(F.col("bin") == bins - 1, hi).otherwise(lo + (F.col("bin") + 1) * width).alias("hi"),
                      F.coalesce("n", F.lit(0).cast("bigint")).alias("n")))


def box_stats(df: DataFrame, value: str, by, approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """Tukey box statistics per group: quartiles (linear interpolation),
    whiskers = most extreme data within 1.5 IQR of the box, outlier count.

    ``approx=True`` uses the mergeable ``percentile_approx`` sketch.
    """
    by = _cols(by)
    if approx:
        q = F.percentile_approx(value, [0.25, 0.5, 0.75], accuracy)
        qs = df.groupBy(*by).agg(q.alias("__q"), F.count(value).alias("n"))
        qs = qs.select(*by, "n", F.col("__q")[0].alias("q1"), F.col("__q")[1].alias("median"),
                       F.col("__q")[2].alias("q3"))
    else:
        qs = exact_quantiles(df, value, by, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    lo_f = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi_f = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    x = F.col(value)
    wh = (join_back(df, qs, by)
            .groupBy(*by).agg(F.min(F.when(x >= lo_f, x)).alias("whisker_lo"),
                              F.max(F.when(x <= hi_f, x)).alias("whisker_hi"),
                              F.count(F.when((x < lo_f) | (x > hi_f), 1)).alias("n_outliers")))
    return join_back(qs, wh, by)


def ecdf_by_group(df: DataFrame, value: str, by) -> DataFrame:
    """Empirical CDF per group, each group normalised separately, from the
    running counts of the distinct values."""
    by = _cols(by)
    vc = running_counts(df.filter(F.col(value).isNotNull()), value, by)
    return vc.select(*by, value, "n", (F.col("__cum") / F.col("__tot")).alias("cum_share"))


def density_curve(df: DataFrame, value: str, by, grid_points: int = 64, resolution: int | None = None,
                  cut: float = 3.0, bins_per_bandwidth: int = 50) -> DataFrame:
    """Gaussian kernel density per group on an even grid.

    Bandwidth: Silverman's rule ``0.9 * min(sd, IQR/1.34) * n^-1/5`` (the R
    default). Values are first binned by a fixed fraction of their group's
    bandwidth, or to ``resolution`` decimals, and counted, so the kernel sum
    costs O(distinct bins x grid) instead of O(n x grid). A group of one value
    has no bandwidth and a null density.
    The grid spans ``[min - cut*bw, max + cut*bw]``.
    """
    by = _cols(by)
    x = df.filter(F.col(value).isNotNull())
    st = x.groupBy(*by).agg(
        F.count(value).alias("n"), F.stddev_samp(value).alias("sd"),
        F.min(value).alias("lo"), F.max(value).alias("hi"))
    st = join_back(st, exact_quantiles(x, value, by, [0.25, 0.75], ["q25", "q75"]).drop("n"), by)
    iqr = (F.col("q75") - F.col("q25")) / 1.34
    bw = F.lit(0.9) * F.least(F.col("sd"), F.when(iqr > 0, iqr).otherwise(F.col("sd"))) \
        * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    st = st.select(*by, "n", F.nullif(bw, F.lit(0.0)).alias("bw"), "lo", "hi")
    if resolution is None:
        width = F.col("__bw") / bins_per_bandwidth
        x = join_back(x, st.select(*by, F.col("bw").alias("__bw"), F.col("lo").alias("__lo")), by)
        centre = F.coalesce(F.col("__lo") + (F.floor((F.col(value) - F.col("__lo")) / width) + 0.5) * width, F.col(value))
    else:
        centre = F.round(value, resolution)
    bins = x.groupBy(*by, centre.alias("c")).agg(F.count(F.lit(1)).alias("k"))
    # the grid is generated per group from its own row: no join needed
    pts = (st.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))))
             .select(*by, "g", "n", "bw",
                     (F.col("lo") - cut * F.col("bw") + F.col("g") * (F.col("hi") - F.col("lo") + 2 * cut * F.col("bw"))
                      / (grid_points - 1)).alias("x")))
    z = (F.col("x") - F.col("c")) / F.col("bw")
    dens = (join_back(pts, bins, by).groupBy(*by, "g", "x", "n", "bw")
               .agg(F.sum(F.col("k") * F.exp(-0.5 * z * z)).alias("s")))
    return dens.select(*by, "g", "x", (F.col("s") / (F.col("n") * F.col("bw") * math.sqrt(2 * math.pi))).alias("density"))


def smoothed_ecdf(df: DataFrame, value: str, by, grid_points: int = 64) -> DataFrame:
    """Kernel-smoothed cumulative share per group: the trapezoid sum of
    ``density_curve`` along its grid, scaled to end at 1. Only the grid is
    ordered, never the rows. A group of one value has null shares."""
    by = _cols(by)
    along = Window.partitionBy(*by).orderBy("g")
    area = (F.col("density") + F.lag("density").over(along)) / 2 * (F.col("x") - F.lag("x").over(along))
    d = density_curve(df, value, by, grid_points).withColumn("__area", F.coalesce(area, F.col("density") * 0))
    total = F.sum("__area").over(Window.partitionBy(*by))
    return d.select(*by, "g", "x", (F.sum("__area").over(along) / total).alias("cum_share"))


# --------------------------------------------------------- co-movement
def pairwise_long(df: DataFrame, key: str = "asset", time_col: str = "d", value: str = "r",
                  include_self: bool = True) -> DataFrame:
    """Aligned values of every ordered key pair on common instants:
    ``(time, a, b, va, vb)``. Self-join on the time column."""
    a = df.select(F.col(time_col), F.col(key).alias("a"), F.col(value).alias("va"))
    b = df.select(F.col(time_col), F.col(key).alias("b"), F.col(value).alias("vb"))
    j = a.join(b, time_col)
    if not include_self:
        j = j.filter(F.col("a") != F.col("b"))
    return j


def complete_rows(df: DataFrame, key: str = "asset", time_col: str = "d", value: str = "r",
                  n_keys=None) -> DataFrame:
    """Keep instants where every key has a non-NULL value (complete cases)."""
    ok = (df.groupBy(time_col).agg(F.count(value).alias("__c"))
            .filter(F.col("__c") == (n_keys if n_keys is not None
                                     else df.select(F.countDistinct(key)).scalar())))
    return df.join(ok.select(time_col), time_col, "left_semi")


def corr_matrix(df: DataFrame, key: str = "asset", time_col: str = "d", value: str = "r",
                complete: bool = True, include_self: bool = True, stat: str = "corr") -> DataFrame:
    """Pearson correlation (or sample covariance) for every ordered pair of
    keys. ``complete``: only instants where all keys have a value (like
    ``cor``); otherwise pair-wise complete."""
    src = df.filter(F.col(value).isNotNull())
    if complete:
        src = complete_rows(src, key, time_col, value)
    j = pairwise_long(src, key, time_col, value, include_self)
    fn = {"corr": F.corr, "cov": F.covar_samp}[stat]
    return j.groupBy("a", "b").agg(fn("va", "vb").alias(stat), F.count(F.lit(1)).alias("n"))


def compound_return(df: DataFrame, value: str, by, order: str | None = None) -> DataFrame:
    """``prod(1 + r) - 1`` per group (NULL returns skipped).

    With ``order`` the factors are multiplied in that (time) order - a
    deterministic result independent of partitioning, as a sequential
    product over a time index gives. The series of one group is gathered as
    one array (its length is the series length). Without ``order`` the
    partial-aggregating ``product`` is used (result may differ in the last
    bits between runs)."""
    if order is None:
        return df.groupBy(*_cols(by)).agg((F.product(F.lit(1.0) + F.col(value)) - 1).alias("compound_return"))
    x = df.filter(F.col(value).isNotNull())
    arr = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), (F.lit(1.0) + F.col(value)).alias("f"))))
    prod = F.aggregate(arr, F.lit(1.0), lambda a, e: a * e["f"])
    return x.groupBy(*_cols(by)).agg((prod - 1).alias("compound_return"))


def first_last_return(df: DataFrame, investment: float, value: str = "close", time_col: str = "d",
                      by="asset", start_row: int = 1) -> DataFrame:
    """``iv * (last / first - 1)`` per series; ``start_row=2`` measures from
    the second row (the variant of the original)."""
    by = _cols(by)
    src = df.filter(F.col(value).isNotNull())
    if start_row > 1:
        w = Window.partitionBy(*by).orderBy(time_col)
        src = src.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") >= start_row)
    g = src.groupBy(*by).agg(F.min_by(value, time_col).alias("first"), F.max_by(value, time_col).alias("last"))
    return g.withColumn("dollar_return", F.lit(investment) * (F.col("last") / F.col("first") - 1))


# ---------------------------------------------------------- model scoring
def rmse_by(df: DataFrame, by, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    res = F.col(predicted) - F.col(actual)
    return df.groupBy(*_cols(by)).agg(F.sqrt(F.avg(res * res)).alias("rmse"))


def scorecard(long_preds: DataFrame, by: str = "model", y: str = "y", p: str = "p",
              threshold: float = 0.5) -> DataFrame:
    """RMSE and accuracy of hard class predictions ``p > threshold`` per
    model, from a long ``(model, id, y, p)`` table in one aggregation."""
    yhat = (F.col(p) > threshold).cast("int")
    err = (yhat - F.col(y)).cast("double")
    return long_preds.groupBy(by).agg(F.sqrt(F.avg(err * err)).alias("rmse"),
                                      F.avg((yhat == F.col(y)).cast("double")).alias("accuracy"),
                                      F.count(F.lit(1)).alias("n"))


def trend_by_bin(df: DataFrame, by: str, x: str, y: str, width: float) -> DataFrame:
    """Mean of x and y per equal-width bucket of x, plus the share of points
    above the y = x line (a binned stand-in for a smoothed trend line)."""
    bucket = F.floor(F.col(x) / width).cast("bigint")
    return (df.groupBy(by, bucket.alias("bucket"))
              .agg(F.avg(x).alias(f"mean_{x}"), F.avg(y).alias(f"mean_{y}"), F.count(F.lit(1)).alias("n"),
                   F.avg((F.col(y) > F.col(x)).cast("double")).alias("share_over")))


MOMENTS = ["s0", "s1", "s2", "t0", "t1"]  # sums of w, w * u, w * u^2, w * y, w * u * y
MOMENT_ROWS, MOMENT_CELLS = 8192, 1 << 18  # rows that are added up together; grid points that a task holds at most


def _moments(by: list[str], grid_points: int):
    """Rows with the grid points that they reach (from __low to __high) -> sums per group and grid point."""
    def run(batches):
        held, count, sums = [], 0, {}

        def add():
            t = pa.Table.from_batches(held).combine_chunks()
            group = np.zeros(t.num_rows, "int64")
            for c in by:  # groups of this table, numbered
                codes = t.column(c).chunk(0).dictionary_encode(null_encoding="encode")
                group = group * len(codes.dictionary) + codes.indices.to_numpy()
                group = np.unique(group, return_inverse=True)[1]
            first = np.unique(group, return_index=True)[1] if by else np.zeros(1, "int64")
            keys = list(zip(*(t.column(c).take(pa.array(first)).to_pylist() for c in by))) if by else [()]
            x, y, lo, step, h, low, high = (t.column(c).to_numpy() for c in ("__x", "__y", "__lo", "__step", "__h", "__low", "__high"))
            cells = len(keys) * grid_points
            out = np.zeros((5, cells))
            for j in range(int((high - low).max()) + 1):
                at = np.flatnonzero(low + j <= high)
                g, reach, v = low[at] + j, h[at], y[at]
                u = np.where(reach > 0, (x[at] - (lo[at] + g * step[at])) / np.where(reach > 0, reach, 1.0), 0.0)
                a = np.minimum(np.abs(u), 1.0)
                w = 1.0 - a * a * a
                w = w * w * w
                cell, wu, wv = group[at] * grid_points + g, w * u, w * v
                for k, weight in enumerate((w, wu, wu * u, wv, wv * u)):
                    out[k] += np.bincount(cell, weight, cells)
            for key, mine in zip(keys, out.reshape(5, len(keys), grid_points).transpose(1, 0, 2)):
                sums[key] = sums[key] + mine if key in sums else mine

        def out():
            keys, g = list(sums), np.tile(np.arange(grid_points), len(sums))
            every = np.concatenate(list(sums.values()), axis=1)
            some = np.flatnonzero(every[0] != 0)  # no weight: nothing else either
            owner = pa.array(some // grid_points)
            fields = [pa.array([k[i] for k in keys], schema.field(c).type).take(owner) for i, c in enumerate(by)]
            return pa.RecordBatch.from_arrays([*fields, pa.array(g[some], pa.int64()), *(pa.array(m[some]) for m in every)],
                                              names=[*by, "__g", *MOMENTS])

        for batch in batches:
            schema = batch.schema
            held.append(batch)
            count += batch.num_rows
            if count >= MOMENT_ROWS:
                add()
                held, count = [], 0
                if len(sums) * grid_points > MOMENT_CELLS:
                    yield out()
                    sums = {}
        if count:
            add()
        if sums:
            yield out()
    return run


def local_regression(df: DataFrame, by, x: str, y: str, grid_points: int = 64, share: float = 0.2) -> DataFrame:
    """Smoothed trend line ``by, g, x, fit, slope, weight``: at each point of
    an even grid over a group's range of x, a straight line fitted by least
    squares with tricube weights of the rows within ``share`` of the range.

    A row adds its weighted moments to the grid points it reaches, as arrays inside
    Arrow batches; moments are sums, so tasks combine them before the shuffle and a row of a hot group
    costs no more than one of any other. Offsets are measured from the grid
    point in bandwidths, which keeps the normal equations well scaled.
    Rows with a null or non-finite x or y take no part. Where the rows in reach
    have one x, the fit is their mean and the slope null; a grid point that no
    row reaches has a null fit and weight 0. A group of one x has one point.
    """
    by = _cols(by)
    inf = float("inf")
    finite = lambda c: F.col(c).cast("double").alias(c)
    rows = df.select(*by, finite(x), finite(y)).filter(
        (F.abs(F.col(x)) < inf) & (F.abs(F.col(y)) < inf))  # NaN is larger than any number
    st = rows.groupBy(*by).agg(F.min(x).alias("__lo"), F.max(x).alias("__hi"))
    st = st.select(*by, "__lo", ((F.col("__hi") - F.col("__lo")) / (grid_points - 1)).alias("__step"),
                   ((F.col("__hi") - F.col("__lo")) * share).alias("__h"))
    last = F.when(F.col("__step") > 0, grid_points - 1).otherwise(0)
    at = lambda edge: F.coalesce(edge / F.nullif(F.col("__step"), F.lit(0.0)), F.lit(0.0))
    low = F.greatest(F.ceil(at(F.col(x) - F.col("__h") - F.col("__lo"))), F.lit(0))
    high = F.least(F.floor(at(F.col(x) + F.col("__h") - F.col("__lo"))), last)
    grid_x = F.col("__lo") + F.col("__g") * F.col("__step")
    near = (join_back(rows, st, by).withColumns({"__low": low.cast("int"), "__high": high.cast("int")})
            .filter("__low <= __high")  # a row between two points may reach none
            .select(*by, F.col(x).alias("__x"), F.col(y).alias("__y"), "__lo", "__step", "__h", "__low", "__high"))
    parts = near.mapInArrow(_moments(by, grid_points), StructType(
        [rows.schema[c] for c in by] + [StructField("__g", LongType())] + [StructField(c, DoubleType()) for c in MOMENTS]))
    sums = parts.groupBy(*by, "__g").agg(*[F.sum(c).alias(c) for c in MOMENTS])
    points = st.select(*by, "__lo", "__step", "__h", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("__g"))
    both = join_back(points, sums, [*by, "__g"], "left")
    s0, s1, s2, t0, t1 = (F.col(c) for c in ("s0", "s1", "s2", "t0", "t1"))
    det = s0 * s2 - s1 * s1
    solvable = det > 1e-9 * s0 * s2
    return both.select(
        *by, F.col("__g").alias("g"), grid_x.alias("x"),
        F.when(solvable, (s2 * t0 - s1 * t1) / det).when(s0 > 0, t0 / s0).alias("fit"),
        F.when(solvable, (s0 * t1 - s1 * t0) / det / F.col("__h")).alias("slope"), F.coalesce(s0, F.lit(0.0)).alias("weight"))


# ---------------------------------------------------------- top-n & pivot
def top_n_with_other(counts: DataFrame, group: str, token: str, n_col: str = "n", top: int = 9,
                     other: str = "Other", digits: int = 4) -> DataFrame:
    """Top ``top`` tokens per group plus an ``Other`` row for the rest (always
    present, possibly 0); shares rounded. Ties broken by token."""
    w = Window.partitionBy(group).orderBy(F.col(n_col).desc(), F.col(token))
    # the limit on the rank reaches the tasks before the shuffle
    kept = counts.withColumn("__rk", F.row_number().over(w)).filter(F.col("__rk") <= top)
    kept = kept.select(group, token, F.col(n_col).cast("bigint").alias(n_col))
    tot = counts.groupBy(group).agg(F.sum(n_col).cast("bigint").alias("__tot"))
    # every group has its 'Other' row: what the kept tokens leave
    rest = join_back(tot, kept.groupBy(group).agg(F.sum(n_col).alias("__kept")), group, "left")
    rest = rest.select(group, F.lit(other).alias(token), (F.col("__tot") - F.coalesce("__kept", F.lit(0))).alias(n_col))
    both = kept.unionByName(rest)
    return (join_back(both.groupBy(group, token).agg(F.sum(n_col).alias(n_col)), tot, group)
            .select(group, token, F.col(n_col), F.round(F.col(n_col) / F.col("__tot"), digits).alias("share")))


def pivot_wide(df: DataFrame, row: str, col: str, value: str, values: list) -> DataFrame:
    """Rows x columns matrix; absent cells stay NULL. ``values`` is the
    explicit list of column keys (no extra job to discover them)."""
    return df.groupBy(row).pivot(col, values).agg(F.first(value))


# ----------------------------------------------------------------- profile
def profile_schema(df: DataFrame) -> DataFrame:
    """One row per column: name, Spark type, non-null count, row count and
    column count - all counts from a single aggregation pass."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(f"nn_{i}") for i, c in enumerate(cols)])
    types = dict(df.dtypes)
    stacked = F.stack(F.lit(len(cols)), *[x for i, c in enumerate(cols)
                                           for x in (F.lit(i), F.lit(c), F.lit(types[c]), F.col(f"nn_{i}"))])
    return agg.select(F.col("__rows").alias("n_rows"), F.lit(len(cols)).cast("bigint").alias("n_cols"),
                      stacked.alias("position", "column_name", "data_type", "non_null"))


def null_counts(df: DataFrame) -> DataFrame:
    """Missing cells per column (NULL, and NaN for floating columns)."""
    types = dict(df.dtypes)

    def miss(c):
        col = F.col(f"`{c}`")
        cond = col.isNull() | F.isnan(col) if types[c] in ("double", "float") else col.isNull()
        return F.sum(cond.cast("bigint"))

    cols = df.columns
    agg = df.agg(*[miss(c).alias(f"m_{i}") for i, c in enumerate(cols)])
    stacked = F.stack(F.lit(len(cols)), *[x for i, c in enumerate(cols) for x in (F.lit(c), F.col(f"m_{i}"))])
    return agg.select(stacked.alias("column_name", "n_missing"))
