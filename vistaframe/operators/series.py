"""Ordered per-series operators (returns, rolling and expanding statistics,
imputation, positional slices).

Every window is partitioned by the series key, so rows of different series
never meet in one task; positional notions ("first row", "row 252") are
``row_number`` over an explicit, unique ordering instead of physical order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .keys import join_back


def _cols(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def series_window(by, order) -> WindowSpec:
    """Rows of one series in time order. ``order`` must be unique per series."""
    return Window.partitionBy(*_cols(by)).orderBy(*_cols(order))


def log_return(df: DataFrame, value: str = "close", order="d", by="asset",
               out: str = "log_return") -> DataFrame:
    """``ln(x / lag(x))``; first row of a series is NULL, as is a step whose
    ratio is not positive (log undefined)."""
    w = series_window(by, order)
    ratio = F.try_divide(F.col(value), F.lag(value).over(w))
    return df.withColumn(out, F.when(ratio > 0, F.ln(ratio)))


def pct_change(df: DataFrame, value: str = "close", order="d", by="asset",
               out: str = "pct_return", pad: bool = True) -> DataFrame:
    """``x / prev - 1``. With ``pad`` missing values are first carried forward
    (the classic pandas default), so a gap yields 0 and the step after the gap
    is measured from the last known value."""
    w = series_window(by, order)
    base = F.col(value)
    if pad:
        base = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    tmp = f"__{out}_base"
    df = df.withColumn(tmp, base)
    r = F.try_divide(F.col(tmp), F.lag(tmp).over(w)) - 1
    return df.withColumn(out, r).drop(tmp)


def neighbor_impute(df: DataFrame, value: str = "close", order="d", by="asset",
                    out: str | None = None, method: str = "neighbor") -> DataFrame:
    """Fill a missing value.

    ``neighbor``: mean of the previous and next row; stays NULL when either
    neighbour is missing (runs of gaps, series edges) - the behaviour of the
    original imputation. ``linear``: linear interpolation in row position
    between the nearest known values on both sides (fills runs too).
    """
    out = out or value
    w = series_window(by, order)
    if method == "neighbor":
        filled = F.coalesce(F.col(value), (F.lag(value).over(w) + F.lead(value).over(w)) / 2)
        return df.withColumn(out, filled)
    if method != "linear":
        raise ValueError(f"unknown method {method!r}")
    rn = "__rn"
    df = df.withColumn(rn, F.row_number().over(w))
    known_pos = F.when(F.col(value).isNotNull(), F.col(rn))
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    after = w.rowsBetween(0, Window.unboundedFollowing)
    df = (df.withColumn("__p0", F.last(known_pos, ignorenulls=True).over(before))
            .withColumn("__v0", F.last(value, ignorenulls=True).over(before))
            .withColumn("__p1", F.first(known_pos, ignorenulls=True).over(after))
            .withColumn("__v1", F.first(value, ignorenulls=True).over(after)))
    frac = F.try_divide((F.col(rn) - F.col("__p0")).cast("double"), (F.col("__p1") - F.col("__p0")).cast("double"))
    interp = F.col("__v0") + (F.col("__v1") - F.col("__v0")) * frac
    return (df.withColumn(out, F.coalesce(F.col(value), interp))
              .drop(rn, "__p0", "__v0", "__p1", "__v1"))


_ROLL = {"mean": F.avg, "sd": F.stddev_samp, "var": F.var_samp, "sum": F.sum,
         "min": F.min, "max": F.max}


def rolling(df: DataFrame, value: str, n: int = 252, stat: str = "mean", order="d", by="asset",
            out: str | None = None, scale: float = 1.0, align: str = "right") -> DataFrame:
    """Fixed-width rolling statistic over ``n`` rows.

    A window that is incomplete or contains a NULL yields NULL (like the
    R roll_* functions with their default ``na.rm = FALSE``). ``align``:
    ``right`` = trailing (the row and n-1 before), ``left`` = leading,
    ``center`` = centred; for even ``n`` the centre takes n/2-1 rows before
    and n/2 after (our assumption for the even-width case).
    """
    out = out or f"{value}_rolling_{stat}"
    if align == "right":
        lo, hi = -(n - 1), 0
    elif align == "left":
        lo, hi = 0, n - 1
    elif align == "center":
        lo, hi = -((n - 1) // 2), n // 2
    else:
        raise ValueError(f"unknown align {align!r}")
    frame = series_window(by, order).rowsBetween(lo, hi)
    agg = _ROLL[stat](value).over(frame)
    full = F.count(value).over(frame) == n
    res = agg * F.lit(scale) if scale != 1.0 else agg
    return df.withColumn(out, F.when(full, res))


def expanding_std(df: DataFrame, value: str, order="d", by=None, out: str | None = None,
                  ddof: int = 0) -> DataFrame:
    """Standard deviation of all rows up to and including the current one
    (population by default, as ``np.std``). Incremental in the frame, so
    linear rather than quadratic in the series length."""
    out = out or f"{value}_expanding_std"
    frame = series_window(by, order).rowsBetween(Window.unboundedPreceding, 0)
    fn = F.stddev_pop if ddof == 0 else F.stddev_samp
    return df.withColumn(out, fn(value).over(frame))


def winsorize_sigma(df: DataFrame, value: str, k: float = 2.0, out: str | None = None) -> DataFrame:
    """Clip at +-k sigma (population sigma over the whole column):
    ``x if |x| < k*sigma else sign(x)*k*sigma``. Sigma is a scalar subquery:
    one global partial aggregate, no window over all rows."""
    out = out or f"{value}_winsorized"
    sigma = df.select(F.stddev_pop(value)).scalar()
    lim = F.lit(k) * sigma
    x = F.col(value)
    return df.withColumn(out, F.when(F.abs(x) < lim, x).otherwise(F.signum(x) * lim))


def group_min_offset(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """``value - min(value)`` within the group, kept on every row.

    Written as aggregate + equi-join instead of an unordered window so a hot
    group is pre-aggregated map-side and AQE can split its join partition."""
    mins = df.groupBy(group).agg(F.min(value).alias("__min"))
    return (join_back(df, mins, group)
              .withColumn(out, F.col(value) - F.col("__min")).drop("__min"))


def row_position(df: DataFrame, order, by=None, out: str = "rn") -> DataFrame:
    return df.withColumn(out, F.row_number().over(series_window(by, order)))


def nth_row(df: DataFrame, k: int, order="d", by="asset") -> DataFrame:
    """The k-th row (1-based) of every series."""
    return row_position(df, order, by, "__rn").filter(F.col("__rn") == k).drop("__rn")


def skip_first_k(df: DataFrame, k: int, order="d", by="asset") -> DataFrame:
    """Drop the first ``k`` rows of every series."""
    return row_position(df, order, by, "__rn").filter(F.col("__rn") > k).drop("__rn")


def chrono_split(df: DataFrame, fraction: float, time_col: str = "d",
                 out: str = "split") -> DataFrame:
    """Chronological train/test split on one global time axis.

    The first ``ceil(N*fraction) + 1`` distinct instants are train, the rest
    test (the label slice is inclusive). Only the distinct instants are
    ranked, by counts per range of instants, and joined back: no window spans
    the whole axis.
    """
    from .stats import running_counts
    ranks = running_counts(df.select(time_col).distinct(), time_col, [])  # rank of an instant, number of them
    cut = F.ceil(F.col("__tot") * F.lit(fraction)) + 1
    ranks = ranks.select(time_col, F.when(F.col("__cum") <= cut, F.lit("train")).otherwise(F.lit("test")).alias(out))
    return df.join(ranks, on=time_col, how="inner")


def horizon_outcome(df: DataFrame, horizon: int = 252, value: str = "close", order="d",
                    by="asset", percentiles=(0.05, 0.5, 0.95)) -> DataFrame:
    """Distribution of the ``horizon``-step forward growth ``x[t+h]/x[t]``
    per series: count, mean, sample sd and exact percentiles."""
    w = series_window(by, order)
    g = df.withColumn("__g", F.try_divide(F.lead(value, horizon).over(w), F.col(value)))
    from .stats import exact_quantiles
    aggs = [F.count("__g").alias("n"), F.avg("__g").alias("mean_growth"),
            F.stddev_samp("__g").alias("sd_growth")]
    names = [f"p{int(round(p * 100)):02d}_growth" for p in percentiles]
    qs = exact_quantiles(g, "__g", by, list(percentiles), names).drop("n")
    return join_back(g.groupBy(*_cols(by)).agg(*aggs), qs, _cols(by), "left")


def positions(df: DataFrame, order: str, by, bucket: Column, out: str = "__pos") -> DataFrame:
    """0-based position of every row within its series, without a window
    over a whole series: rows are counted per (series, time bucket), bucket
    offsets are a running sum over the small count table, and rows are
    ranked only inside their bucket."""
    by = _cols(by)
    d = df.withColumn("__bk", bucket)
    cnt = d.groupBy(*by, "__bk").agg(F.count(F.lit(1)).alias("__c"))
    before = Window.partitionBy(*by).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    cnt = cnt.select(*by, "__bk", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__off"))
    d = join_back(d, cnt, by + ["__bk"])
    inner = Window.partitionBy(*by, "__bk").orderBy(*_cols(order))
    return d.withColumn(out, F.col("__off") + F.row_number().over(inner) - 1).drop("__bk", "__off")


def in_blocks(df: DataFrame, order: str, by, bucket: Column | None, block_rows: int, halo: int) -> DataFrame:
    """Rows with their position ``__pos`` in the series, dealt to blocks
    ``__blk`` of ``block_rows`` positions. The last ``halo`` rows of a block are
    copied into the next one (``__halo``)."""
    if block_rows < halo:
        raise ValueError("block_rows must be >= the halo")
    bucket = bucket if bucket is not None else F.date_trunc("hour", F.col(order))
    d = positions(df, order, by, bucket)
    own = F.floor(F.col("__pos") / block_rows)
    copies = F.when(F.col("__pos") % block_rows >= block_rows - halo, F.array(own, own + 1)).otherwise(F.array(own))
    return d.withColumn("__blk", F.explode(copies)).withColumn("__halo", F.col("__blk") != own)


def log_return_blocked(df: DataFrame, value: str = "close", order="d", by="asset", out: str = "log_return",
                       bucket: Column | None = None, block_rows: int = 1_000_000) -> DataFrame:
    """``log_return`` for series of any length: a block and the row before it
    in one task."""
    u = in_blocks(df, order, by, bucket, block_rows, 1)
    w = Window.partitionBy(*_cols(by), "__blk").orderBy("__pos")
    ratio = F.try_divide(F.col(value), F.lag(value).over(w))
    return u.withColumn(out, F.when(ratio > 0, F.ln(ratio))).filter(~F.col("__halo")).drop("__halo", "__blk", "__pos")


def rolling_blocked(df: DataFrame, value: str, n: int, stat: str = "mean", order="d", by="asset",
                    out: str | None = None, bucket: Column | None = None, block_rows: int = 1_000_000,
                    scale: float = 1.0) -> DataFrame:
    """``rolling`` (trailing, same NULL rules) for series of any length.

    Each series is cut into blocks of ``block_rows`` consecutive positions;
    the last ``n-1`` rows of a block are copied into the next block as a
    halo, so every window lies inside one block. Work per task is bounded by
    ``block_rows + n - 1`` rows however long one series (a hot key) is.
    """
    out = out or f"{value}_rolling_{stat}"
    u = in_blocks(df, order, by, bucket, block_rows, n - 1)
    frame = Window.partitionBy(*_cols(by), "__blk").orderBy("__pos").rowsBetween(-(n - 1), 0)
    agg = _ROLL[stat](value).over(frame)
    res = agg * F.lit(scale) if scale != 1.0 else agg
    return (u.withColumn(out, F.when(F.count(value).over(frame) == n, res))
             .filter(~F.col("__halo")).drop("__halo", "__blk", "__pos"))


def expanding_std_blocked(df: DataFrame, value: str, order="d", by="asset", out: str | None = None,
                          ddof: int = 0, bucket: Column | None = None, block_rows: int = 1_000_000) -> DataFrame:
    """``expanding_std`` for series of any length (hot keys).

    Values are centred on their series mean (limits cancellation), each
    series is cut into blocks of ``block_rows`` positions; running count, sum
    and sum of squares are block prefix sums (a window over the small block
    table) plus running sums inside one block. No task holds more than one
    block of one series.
    """
    by = _cols(by)
    out = out or f"{value}_expanding_std"
    bucket = bucket if bucket is not None else F.date_trunc("hour", F.col(order))
    d = positions(df, order, by, bucket)
    mu = d.groupBy(*by).agg(F.avg(value).alias("__mu"))
    d = (join_back(d, mu, by).withColumn("__y", F.col(value) - F.col("__mu"))
          .withColumn("__blk", F.floor(F.col("__pos") / block_rows)))
    blk = d.groupBy(*by, "__blk").agg(F.count(value).alias("__bn"), F.sum("__y").alias("__b1"),
                                      F.sum(F.col("__y") * F.col("__y")).alias("__b2"))
    prev = Window.partitionBy(*by).orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    blk = blk.select(*by, "__blk", F.coalesce(F.sum("__bn").over(prev), F.lit(0)).alias("__pn"),
                     F.coalesce(F.sum("__b1").over(prev), F.lit(0.0)).alias("__p1"),
                     F.coalesce(F.sum("__b2").over(prev), F.lit(0.0)).alias("__p2"))
    d = join_back(d, blk, by + ["__blk"])
    run = Window.partitionBy(*by, "__blk").orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
    n = F.col("__pn") + F.count(value).over(run)
    s1 = F.col("__p1") + F.coalesce(F.sum("__y").over(run), F.lit(0.0))
    s2 = F.col("__p2") + F.coalesce(F.sum(F.col("__y") * F.col("__y")).over(run), F.lit(0.0))
    d = d.withColumn("__n", n).withColumn("__s1", s1).withColumn("__s2", s2)
    m2 = F.greatest(F.col("__s2") - F.col("__s1") * F.col("__s1") / F.col("__n"), F.lit(0.0))
    denom = F.col("__n") - ddof
    res = F.when(denom > 0, F.sqrt(m2 / denom))
    return d.withColumn(out, res).drop("__pos", "__mu", "__y", "__blk", "__pn", "__p1", "__p2", "__n", "__s1", "__s2")
