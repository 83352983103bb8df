"""Joins and pairings: snapshot differences, parameter grids, two-sum pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def number_snapshots(df: DataFrame, group: str, snapshot: str, out: str = "snap_no",
                     nonempty_only: str | None = None) -> DataFrame:
    """Dense number of the distinct snapshots within each group.

    Only the distinct ``(group, snapshot)`` pairs are ranked (a small table:
    groups x polls); the result is joined back, so item rows never pass
    through a window partitioned by the few groups.
    """
    snaps = df
    if nonempty_only:
        snaps = snaps.filter(F.col(nonempty_only).isNotNull())
    snaps = snaps.select(group, snapshot).distinct()
    return snaps.withColumn(out, F.row_number().over(Window.partitionBy(group).orderBy(snapshot)))


def anti_join_previous(df: DataFrame, group: str = "site", snapshot: str = "snapshot",
                       item: str = "item", skip_empty: bool = False) -> DataFrame:
    """Items of each snapshot that were absent from the group's previous
    snapshot (duplicates of new items kept).

    ``skip_empty=False`` compares with the immediately previous snapshot
    (state always replaced); ``True`` compares with the last snapshot that
    returned any item (an empty poll does not replace the state). Items of
    the first snapshot of a group are all new.
    """
    nums = number_snapshots(df, group, snapshot, nonempty_only=item if skip_empty else None)
    rows = df.filter(F.col(item).isNotNull())
    # with skip_empty the numbering only counts non-empty snapshots, so
    # "number - 1" is the previous non-empty one
    rows = rows.join(nums, [group, snapshot])
    prev = rows.select(group, item, (F.col("snap_no") + 1).alias("snap_no")).distinct()
    return rows.join(prev, [group, item, "snap_no"], "left_anti").drop("snap_no")


def param_grid(df: DataFrame, axes: dict[str, list]) -> DataFrame:
    """Cartesian product of parameter axes on every input row (axes in the
    given order). Generated with ``explode`` on each row, so no join is
    needed and the product size is fixed by the axes."""
    out = df
    for name, values in axes.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(float(v)) for v in values])))
    return out


def two_sum(df: DataFrame, group: str, order: list[str], value: str, target: int) -> DataFrame:
    """Per group, the first pair of positions ``i < j`` whose values add up to
    ``target``: the smallest ``j``; for it the latest earlier ``i`` (a hash map
    that keeps the last index of each value). Output 0-based positions.

    No pair enumeration: the earliest position of every (group, value) is an
    aggregate; each row looks up its complement once (unique key, so the
    join cannot fan out); the winner per group is a ``min``.
    """
    key = F.struct(*[F.col(c) for c in order])
    rows = df.select(group, F.col(value).alias("v"), key.alias("k"))
    first_pos = rows.groupBy(group, "v").agg(F.min("k").alias("first_k"))
    probe = (rows.withColumn("cv", F.lit(target) - F.col("v"))
                 .join(first_pos.withColumnRenamed("v", "cv"), [group, "cv"])
                 .filter(F.col("first_k") < F.col("k")))
    win = probe.groupBy(group).agg(F.min_by(F.struct("k", "cv"), "k").alias("w"))
    win = win.select(group, F.col("w.k").alias("j_k"), F.col("w.cv").alias("cv"))
    # the latest earlier position holding the complement
    left = (rows.join(win, [group])
                .filter((F.col("v") == F.col("cv")) & (F.col("k") < F.col("j_k")))
                .groupBy(group).agg(F.max("k").alias("i_k")))
    pairs = win.join(left, group)
    # positions: count rows ordered before each key (one pass, no window)
    pos = (rows.join(pairs.select(group, "i_k", "j_k"), group)
               .groupBy(group)
               .agg(F.sum((F.col("k") < F.col("i_k")).cast("bigint")).alias("i"),
                    F.sum((F.col("k") < F.col("j_k")).cast("bigint")).alias("j")))
    return pos
