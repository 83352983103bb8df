"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaframe.session import ensure_checkpoint_dir, scratch_path

# Rows per Arrow batch: with texts of any length in a batch, this bounds what
# a Python worker holds at a time to that many texts.
ARROW_ROWS = "500"
_ARROW_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> SparkSession:
    """Shared folder and batch size for the operators with Python tasks."""
    ensure_checkpoint_dir(spark)
    if int(spark.conf.get(_ARROW_KEY, "10000")) > int(ARROW_ROWS):
        spark.conf.set(_ARROW_KEY, ARROW_ROWS)
    return spark


def _give_back() -> None:
    """Free memory goes back to the system, where the C library can do that."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass


def lean(run: Callable) -> Callable:
    """A task function whose worker, which Spark uses again for later tasks,
    keeps none of the memory that it needed."""
    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _give_back()
        yield from run(batches)
        _give_back()
    return wrapped


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Cuts the lineage: an executor lost later costs a re-read of this table
    and no recomputation of what led to it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables of one operator's run. ``release`` deletes those whose
    last reader has written its own result; what the operator returns may read
    the rest."""

    def __init__(self, spark: SparkSession, name: str):
        self._spark, self._base, self._paths = spark, scratch_path(spark, "llm", name), {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        if name in self._paths:
            raise ValueError(f"{name} is written already")
        path = self._paths[name] = f"{self._base}/{name}"
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def release(self, *names: str) -> None:
        jvm, conf = self._spark.sparkContext._jvm, self._spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self._paths.pop(name))
            path.getFileSystem(conf).delete(path, True)


def id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator works on, under its own names (other
    columns of ``docs``, whatever their names, take no part); a null text is
    the empty text."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def id_remainder(id_col: str | Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod`` (null id: empty text)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % mod


def empty_like(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)
