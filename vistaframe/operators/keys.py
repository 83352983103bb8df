"""Joining an aggregate back to the rows it came from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_back(rows: DataFrame, groups: DataFrame, by, how: str = "inner") -> DataFrame:
    """Equi-join on ``by`` in which a NULL key meets a NULL key, so the rows
    of the NULL group stay. The key columns come from ``rows``."""
    by = [by] if isinstance(by, str) else list(by)
    renamed = groups.select(*[F.col(c).alias(f"__key{i}") for i, c in enumerate(by)],
                            *[c for c in groups.columns if c not in by])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__key{i}")) for i, c in enumerate(by)])
    return rows.join(renamed, same, how).drop(*[f"__key{i}" for i in range(len(by))])
