"""Token-id files: Parquet list columns, encoded, paged and ordered for selective reads.

Layout: rows in ascending id order over all files (range partitioned, sorted
within each), one row a document, columns ``doc_id, part, pos, n_tokens,
tokens``. ``part`` is the file's number in id order and ``pos`` the row's place
in it, so offsets into the whole id stream come from ``n_tokens`` alone. Ids are
dictionary coded (default) or delta coded; ``doc_id`` and ``n_tokens`` are
always delta coded. Row groups and pages have set sizes; Parquet's column and
offset indexes let a reader skip pages by ``doc_id``.

Defined cases: a null text is the empty text (its ids are the end id alone); a
null id sorts first; rows repeated with one id are all written, side by side,
ordered by a hash of the text; an empty table gives files without rows; other
columns take no part, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import encoder
from .common import id_text

TOKEN_SCHEMA = "doc_id long, pos long, n_tokens long, tokens array<int>"


def list_array(blobs: list[bytes]) -> pa.ListArray:
    """Ids given as bytes -> one Arrow list per entry, without a Python int."""
    ends = np.cumsum([0] + [len(b) // 4 for b in blobs]).astype("int32")
    values = np.frombuffer(b"".join(blobs), dtype="<u4").astype("int32")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def list_crc32(lists: pa.ListArray) -> np.ndarray:
    """Unsigned crc32 per list over its ids as little-endian unsigned 32-bit integers."""
    raw = lists.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()
    ends = (lists.offsets.to_numpy().astype("int64") * 4).tolist()
    return np.array([zlib.crc32(raw[a:b]) for a, b in zip(ends, ends[1:])], dtype="int64")


def _encode(tokenizer_file: str, end_id: int):
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, pos = encoder(tokenizer_file), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            blobs = [ids + end for ids in coder.encode(batch.column("text").to_pylist())]
            n = len(blobs)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.arange(pos, pos + n)),
                 pa.array([len(b) // 4 for b in blobs], pa.int64()), list_array(blobs)],
                names=["doc_id", "pos", "n_tokens", "tokens"])
            pos += n
    return run


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = 0, coding: str = "dictionary",
                      row_group_bytes: int = 16 << 20, page_bytes: int = 64 << 10) -> None:
    """Encode every whole text and write the files. ``coding``: "dictionary" or "delta"."""
    if coding not in ("dictionary", "delta"):
        raise ValueError(f"coding {coding!r}")
    # Texts, not ids, go through the shuffle: they are smaller, and the range
    # bounds are found without encoding anything.
    order = [F.col("doc_id"), F.xxhash64("text")]
    ranged = id_text(docs, id_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order)
    coded = ranged.mapInArrow(_encode(tokenizer_file, end_id), TOKEN_SCHEMA)
    out = coded.withColumn("part", F.spark_partition_id()).select("doc_id", "part", "pos", "n_tokens", "tokens")
    (out.write.option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#tokens.list.element", str(coding == "dictionary").lower())
        .parquet(path))


def read_token_files(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """Documents with their ids; a range of ids is pushed to row groups and pages."""
    df = spark.read.schema("doc_id long, part int, pos long, n_tokens long, tokens array<int>").parquet(path)
    if low is not None:
        df = df.filter(F.col("doc_id") >= low)
    if high is not None:
        df = df.filter(F.col("doc_id") <= high)
    return df


def read_token_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, part, pos, n_tokens, start`` (ids of all documents before it); the ids stay unread."""
    return with_starts(read_token_files(spark, path).select("doc_id", "part", "pos", "n_tokens"))


def with_starts(rows: DataFrame) -> DataFrame:
    """Add ``start``. One row per file is summed in file order; within a file
    the running sum is over that file's rows only. ``rows`` are read twice: give
    a scan or a written table."""
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("_sum"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    # a row per file: Spark's own size check decides how it is joined
    joined = rows.withColumn("_in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return joined.join(files, "part").withColumn("start", F.col("_base") + F.col("_in")).drop("_base", "_in")


def token_digests(rows: DataFrame) -> DataFrame:
    """Replace the ids read from the files by their crc32 and their counted number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("tokens")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), batch.column("pos"),
                 pa.array(np.diff(ids.offsets.to_numpy()).astype("int64")), pa.array(list_crc32(ids))],
                names=["doc_id", "part", "pos", "n_tokens", "ids_crc32"])
    return rows.select("doc_id", "part", "pos", "tokens").mapInArrow(
        run, "doc_id long, part int, pos long, n_tokens long, ids_crc32 long")
