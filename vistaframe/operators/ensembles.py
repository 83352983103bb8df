"""Soft votes over probability columns."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def soft_vote_wide(df: DataFrame, prob_cols: dict[str, str], label: str = "y", threshold: float = 0.5,
                   min_size: int = 2) -> DataFrame:
    """Soft vote of every subset of 2..n models given one probability column
    per model on the same row. Each subset's mean is a row-local expression
    (members summed in sorted order, so the result does not depend on column
    order); subsets become rows with ``explode``. One scan, one tiny
    aggregation - no join, no shuffle of the long table."""
    names = sorted(prob_cols)
    subsets = []
    for r in range(min_size, len(names) + 1):
        for combo in itertools.combinations(names, r):
            vals = F.array_sort(F.array(*[F.col(prob_cols[m]).cast("double") for m in combo]))
            mean = F.aggregate(vals, F.lit(0.0), lambda a, x: a + x) / F.lit(float(len(combo)))
            subsets.append(F.struct(F.lit("+".join(combo)).alias("subset"), mean.alias("p")))
    rows = df.select(F.col(label).alias("__y"), F.explode(F.array(*subsets)).alias("__s"))
    ok = ((F.col("__s.p") > threshold).cast("int") == F.col("__y")).cast("double")
    return rows.groupBy(F.col("__s.subset").alias("subset")).agg(F.avg(ok).alias("accuracy"),
                                                                   F.count(F.lit(1)).alias("n"))
