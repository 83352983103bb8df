"""Feature preparation: thresholds, buckets, one-hot, scaling, splits."""

from __future__ import annotations

from pyspark.ml.feature import Binarizer, Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .keys import join_back
from .stats import running_counts


def binarize(df: DataFrame, col: str, out: str, threshold: float) -> DataFrame:
    """1.0 where ``col > threshold`` (strict), else 0.0 (``ml.feature.Binarizer``)."""
    src = df.withColumn(col, F.col(col).cast("double"))
    return Binarizer(threshold=threshold, inputCol=col, outputCol=out).transform(src)


def bucketize(df: DataFrame, col: str, out: str, splits: list[float], labels: list[str] | None = None,
              handle_invalid: str = "keep") -> DataFrame:
    """Half-open buckets ``[s_i, s_i+1)``, the last one closed. Out-of-range
    values get the extra index ``len(splits) - 1`` with ``keep`` (label
    ``NULL``). ``labels`` turns indices into readable names through a map
    literal (no join)."""
    src = df.withColumn(col, F.col(col).cast("double"))
    if handle_invalid == "keep":
        # Bucketizer's "keep" covers NaN only; values outside the splits
        # would raise, so they are routed to the invalid bucket as NaN
        inside = F.col(col).between(F.lit(float(splits[0])), F.lit(float(splits[-1])))
        src = src.withColumn(col, F.when(inside | F.col(col).isNull(), F.col(col)).otherwise(F.lit(float("nan"))))
    b = Bucketizer(splits=splits, inputCol=col, outputCol=out, handleInvalid=handle_invalid).transform(src)
    if labels:
        m = F.create_map(*[x for i, lab in enumerate(labels) for x in (F.lit(float(i)), F.lit(lab))])
        b = b.withColumn(out, F.try_element_at(m, F.col(out)))
    return b


def quantile_bins(df: DataFrame, col: str, out: str, buckets: int) -> DataFrame:
    """Equal-frequency bins with exact split points: the value of rank
    ``ceil(i * n / buckets)``. Ranks are counted over all tasks
    (``stats.running_counts``); only the split points reach the driver. NaN
    gets the extra bucket, NULL stays NULL."""
    counts = running_counts(df.filter(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double"))), col, [])
    picks = [F.min(F.when(F.col("__cum") >= F.ceil(F.col("__tot") * F.lit(i) / F.lit(buckets)), F.col(col).cast("double")))
             for i in range(1, buckets)]
    found = sorted({x for x in counts.agg(*picks).first() if x is not None})
    splits = [float("-inf"), *found, float("inf")]
    src = df.withColumn(col, F.col(col).cast("double"))
    return Bucketizer(splits=splits, inputCol=col, outputCol=out, handleInvalid="keep").transform(src)


def one_hot(df: DataFrame, col: str, values: list, prefix: str | None = None) -> DataFrame:
    """One 0/1 column per listed category, none dropped; the original column
    is replaced. (For ML pipelines use StringIndexer + OneHotEncoder with
    ``dropLast=False``.)"""
    prefix = prefix or col
    cols = [(F.col(col) == F.lit(v)).cast("int").alias(f"{prefix}_{v}") for v in values]
    return df.select(*[c for c in df.columns if c != col], *cols)


def md5_key(id_col: str, seed: int) -> F.Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(str(seed))))


def stratified_split(df: DataFrame, label: str, id_col: str, test_tenths: int = 3, seed: int = 42,
                     out: str = "split", prefix_len: int = 4) -> DataFrame:
    """Exact, reproducible stratified split.

    Within each class rows are ordered by ``md5(id || seed)``; the first
    ``n_c - ceil(test_tenths * n_c / 10)`` are train. Ranking is done without
    a window over a whole class: rows are spread over 16^prefix_len hash
    buckets, bucket sizes are summed per class (small table), and only the
    rows of one bucket are ranked together - so a class holding most rows
    still spreads over many tasks.
    """
    h = md5_key(id_col, seed)
    rows = df.withColumn("__h", h).withColumn("__b", F.substring("__h", 1, prefix_len))
    # one exchange on (class, bucket) serves both the bucket sizes and the
    # in-bucket ranking, so the input is read and shuffled once (the second
    # use is a reused exchange)
    rows = rows.repartition(label, "__b")
    sizes = rows.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__bn"))
    wcum = Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (sizes.withColumn("__before", F.coalesce(F.sum("__bn").over(wcum), F.lit(0)))
                  .withColumn("__n", F.sum("__bn").over(Window.partitionBy(label))))
    inner = Window.partitionBy(label, "__b").orderBy("__h", id_col)
    rows = rows.withColumn("__r", F.row_number().over(inner))
    n = F.col("__n")
    n_train = n - F.floor((n * test_tenths + 9) / 10)
    joined = join_back(rows, sizes, [label, "__b"])
    return (joined.withColumn(out, F.when(F.col("__before") + F.col("__r") <= n_train, F.lit("train"))
                                    .otherwise(F.lit("test")))
                  .drop("__h", "__b", "__bn", "__before", "__n", "__r"))


def standard_scale(df: DataFrame, cols: list[str], split_col: str = "split", fit_on: str = "train",
                   prefix: str = "sc_", ddof: int = 0) -> DataFrame:
    """z-scores with mean and sd fitted on the ``fit_on`` rows only and
    applied to every row; originals kept beside ``sc_*`` copies. ``ddof=0``
    (population sd) as the usual scaler; Spark's ``StandardScaler`` would
    use the sample sd."""
    sd = F.stddev_pop if ddof == 0 else F.stddev_samp
    fit = df.filter(F.col(split_col) == fit_on)
    # one struct-valued scalar subquery: a single pass over the fit rows
    st = fit.agg(F.struct(*[F.avg(c).alias(f"m_{c}") for c in cols],
                          *[sd(c).alias(f"s_{c}") for c in cols])).scalar()
    return df.select("*", *[F.try_divide(F.col(c) - st[f"m_{c}"], st[f"s_{c}"]).alias(f"{prefix}{c}")
                            for c in cols])
