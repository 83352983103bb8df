"""Table verbs: column selection by rule, completeness, head, distinct,
unpivot, catalog registration."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def columns_by_rule(columns: list[str], starts_with=None, ends_with=None, contains=None,
                    matches=None, ignore_case: bool = True) -> list[str]:
    """Resolve a dplyr-style column selector (case-insensitive by default)
    to an explicit list. Plan-time only: it reads the schema, not the data."""
    flags = re.I if ignore_case else 0
    out = []
    for c in columns:
        ok = True
        if starts_with is not None:
            ok &= re.match(re.escape(starts_with), c, flags) is not None
        if ends_with is not None:
            ok &= re.search(re.escape(ends_with) + r"\Z", c, flags) is not None
        if contains is not None:
            ok &= re.search(re.escape(contains), c, flags) is not None
        if matches is not None:
            ok &= re.search(matches, c, flags) is not None
        if ok:
            out.append(c)
    return out


def select_by_rule(df: DataFrame, **rule) -> DataFrame:
    return df.select(*columns_by_rule(df.columns, **rule))


def drop_incomplete(df: DataFrame, subset=None) -> DataFrame:
    """Keep complete rows (no NULL in ``subset`` or in any column)."""
    return df.dropna(how="any", subset=subset)


def all_complete(df: DataFrame, subset=None) -> DataFrame:
    """One-row answer to "are all rows complete?"."""
    cols = subset or df.columns
    cond = None
    for c in cols:
        e = F.col(f"`{c}`").isNotNull()
        cond = e if cond is None else cond & e
    return df.agg(F.coalesce(F.bool_and(cond), F.lit(True)).alias("all_complete"))


def head_n(df: DataFrame, n: int, *order) -> DataFrame:
    """First ``n`` rows under an explicit ordering (a stable answer)."""
    return df.orderBy(*order).limit(n)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def unpivot_long(df: DataFrame, ids: list[str], values: list[str], key: str = "key",
                 value: str = "value") -> DataFrame:
    return df.unpivot(ids, values, key, value)


def register_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Publish a frame under a name and hand back the catalog's view of it."""
    df.createOrReplaceTempView(name)
    return spark.table(name)


def table_names(spark: SparkSession) -> list[str]:
    return [t.name for t in spark.catalog.listTables()]


def nulls_from_sentinel(df: DataFrame, sentinel: str = "?") -> DataFrame:
    """Turn a sentinel string into NULL in every string column."""
    types = dict(df.dtypes)
    return df.select(*[F.nullif(F.col(c), F.lit(sentinel)).alias(c) if types[c] == "string" else F.col(c)
                       for c in df.columns])
