"""File sources and sinks: CSV with and without header, one-document-per-
file text, persisted results. Paths may be local, HDFS or object store."""

from __future__ import annotations

import itertools
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import local_path, path_exists

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module

DOCUMENT, NO_ID = "doc-", "no-id"  # of files' names
FOLDER_FILES = 500
TASK_FILES, TASK_BYTES = 10_000, 1 << 26  # that one task reads, about
BATCH_FILES, BATCH_BYTES = 1000, 1 << 23


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", header).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True,
             ignore_leading_blank: bool = False, null_value: str | None = None) -> DataFrame:
    """CSV with an explicit schema: no inference pass over the data."""
    r = spark.read.schema(schema).option("header", header).option("mode", "FAILFAST")
    if ignore_leading_blank:
        r = r.option("ignoreLeadingWhiteSpace", True)
    if null_value is not None:
        r = r.option("nullValue", null_value)
    return r.csv(path)


def write_delimited_lines(df: DataFrame, path: str, sep: str = ", ", null_token: str = "?") -> str:
    """Headerless text lines like ``39, State-gov, 77516`` (blank after the
    separator, a token for missing values)."""
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit(null_token)) for c in df.columns])
    df.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


def _uri(path: str) -> str:
    return path if "://" in path else local_path(path)


def _write_files(uri: str):
    def run(rows: Iterator) -> None:
        files, base = fs.FileSystem.from_uri(uri)
        part, folder = TaskContext.get().partitionId(), ""
        for k, (doc_id, same) in enumerate(itertools.groupby(rows, key=lambda r: r[0])):
            if k % FOLDER_FILES == 0:
                folder = f"{base}/part-{part:05d}-{k // FOLDER_FILES:05d}"
                files.create_dir(folder)
            name = NO_ID if doc_id is None else f"{DOCUMENT}{doc_id}"
            with files.open_output_stream(f"{folder}/{name}.txt") as out:
                for _, text in same:
                    out.write(f"{text or ''}\n".encode())
    return run


def write_documents(df: DataFrame, path: str, id_col: str, text_col: str) -> str:
    """One file per document, whose name has the id (a whole number) and whose
    body is the text and a line feed; rows of one id share a file. A task writes
    FOLDER_FILES files into each of its folders; a task that runs again writes
    the same files again. ``path`` is on a file system that pyarrow opens (local, HDFS, object
    stores), shared by the driver and the executors."""
    uri = _uri(path)
    files, base = fs.FileSystem.from_uri(uri)
    files.create_dir(base)
    files.delete_dir_contents(base)
    keyed = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    keyed.repartition("id").sortWithinPartitions("id").foreachPartition(_write_files(uri))
    return path


LISTED = "path string, folder boolean, size long"


def _list_folders(uri: str, deep: bool):
    """Rows (path, folder) -> what the folders hold (path, folder, size); ``deep``: the files below them. Files without
    content and names that start with a dot or underscore are left out, as by Spark's readers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = fs.FileSystem.from_uri(uri)
        for batch in batches:
            todo = batch.column("path").to_pylist()
            while todo:
                found = [f for f in files.get_file_info(fs.FileSelector(todo.pop())) if not f.base_name.startswith((".", "_"))]
                if deep:
                    todo += [f.path for f in found if f.type == fs.FileType.Directory]
                rows = [(f.path, f.type == fs.FileType.Directory, f.size or 0) for f in found
                        if (f.size if f.type == fs.FileType.File else not deep)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["path", "folder", "size"])
    return run


def _read_files(uri: str):
    """Rows (path) -> names and contents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = fs.FileSystem.from_uri(uri)

        def out(names: list[str], bodies: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(bodies, pa.binary())], names=["name", "body"])

        names, bodies, size = [], [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with files.open_input_stream(path) as f:  # unpacked by its ending
                    bodies.append(f.read())
                names.append(path.rsplit("/", 1)[-1])
                size += len(bodies[-1])
                if len(names) >= BATCH_FILES or size >= BATCH_BYTES:
                    yield out(names, bodies)
                    names, bodies, size = [], [], 0
        if names:
            yield out(names, bodies)
    return run


def list_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(path, folder, size)`` of all files below a folder. Tasks list the folders, and the list is written as a checkpoint: the
    driver holds no names, however many files there are."""
    uri = _uri(path)
    files, base = fs.FileSystem.from_uri(uri)
    if files.get_file_info(base).type != fs.FileType.Directory:
        raise FileNotFoundError(path)
    top = spark.createDataFrame([(base,)], "path string").coalesce(1).mapInArrow(_list_folders(uri, False), LISTED)
    dealt = top.repartition(max(1, spark.sparkContext.defaultParallelism), "path")
    below = dealt.filter("folder").mapInArrow(_list_folders(uri, True), LISTED)
    return below.unionByName(dealt.filter("not folder")).checkpoint()


def read_documents(spark: SparkSession, path: str, id_col: str, text_col: str = "text") -> DataFrame:
    """Whole files as rows, the id from the file's name, without the line feed
    at the end. Tasks list and open the files (``list_documents``), each about TASK_FILES or TASK_BYTES."""
    listed = list_documents(spark, path)
    count, size = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    tasks = max(1, min(count, max(spark.sparkContext.defaultParallelism, -(-count // TASK_FILES), -(-size // TASK_BYTES))))
    raw = listed.select("path").repartition(tasks, "path").mapInArrow(_read_files(_uri(path)), "name string, body binary")
    name, value = F.col("name"), F.col("body").cast("string")
    # a file without an id: null
    doc_id = F.when(name.startswith(DOCUMENT), F.regexp_extract(name, f"^{DOCUMENT}(-?[0-9]+)", 1)).cast("long")
    return raw.select(doc_id.alias(id_col), F.substring(value, F.lit(1), F.length(value) - 1).alias(text_col))


def compute_or_load(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Reuse a persisted result when it exists, else compute, persist, reuse.

    The persisted copy is parquet in a shared folder; the write is a full
    materialisation, which also cuts the lineage of ``build``.
    """
    if not path_exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
