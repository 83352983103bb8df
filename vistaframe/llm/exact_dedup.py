"""Exact deduplication by progressive refinement, in DataFrame operations only.

Rows are grouped by length; those of lengths that occur more than once by
(length, hash of a prefix); and only rows of such a group that has more than
one member have their whole text hashed. Which groups have several members is
held in a bit set of a fixed number of bits (one bit per hash of a group's key,
32,768 bits a row), so it can be broadcast whatever the corpus. A bit shared by
two groups sends a unique row one level further and changes no result. Texts
never pass a shuffle in ``duplicate_report``: it moves ids and hashes.

Equal texts: the row with the largest id stays. Defined cases: null text counts
as empty; a null id is smaller than all others; rows repeated with one id and
one text are all members of the group, and of those with the largest id exactly
one is kept; an empty table gives an empty result; other columns take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, materialise

PREFIX_CHARS = 64
FILTER_ROWS = 256  # of 32,768 bits, 4 KB each: 1 MB in all


def _bit(key: Column, rows: int) -> tuple[Column, Column]:
    """(row, bit) of a hash in the bit set."""
    h = F.pmod(key, F.lit(rows * 32768))
    return F.floor(h / 32768).cast("int"), (h % 32768).cast("int")


def bit_set(keys: DataFrame, rows: int) -> DataFrame:
    """Bit set over the hashes in column ``key``: at most ``rows`` rows of 4 KB."""
    row, bit = _bit(F.col("key"), rows)
    return keys.groupBy(row.alias("_row")).agg(F.bitmap_construct_agg(bit.cast("long")).alias("_bits"))


def repeated_keys(keys: DataFrame, rows: int) -> DataFrame:
    """Bit set over the hashes that occur more than once."""
    return bit_set(keys.groupBy("key").count().filter("count > 1"), rows)


def _holds(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, bit % 8) == 1, F.lit(False))


def mark_held(rows: DataFrame, key: Column, bits: DataFrame, n: int, name: str) -> DataFrame:
    """Add the boolean ``name``: false only where ``key`` is surely not in the set."""
    row, bit = _bit(key, n)
    # the bit set has at most n rows of 4 KB
    out = rows.withColumn("_row", row).withColumn("_bit", bit).join(F.broadcast(bits), "_row", "left")
    return out.withColumn(name, _holds(F.col("_bits"), F.col("_bit"))).drop("_row", "_bit", "_bits")


def _refine(rows: DataFrame, filter_rows: int, prefix_chars: int) -> DataFrame:
    """``rows`` (column ``text``) with ``n_bytes`` and ``survives``: true for
    the members of groups that are still of several rows after the prefix."""
    length = F.octet_length("text")
    by_length = F.xxhash64(length)
    by_prefix = F.xxhash64(length, F.substring("text", 1, prefix_chars))
    lengths = materialise(repeated_keys(rows.select(by_length.alias("key")), filter_rows), "repeated_lengths")
    second = mark_held(rows, by_length, lengths, filter_rows, "_len").filter("_len").select(by_prefix.alias("key"))
    prefixes = materialise(repeated_keys(second, filter_rows), "repeated_prefixes")
    out = mark_held(rows, by_length, lengths, filter_rows, "_len")
    out = mark_held(out, by_prefix, prefixes, filter_rows, "_pre")
    return (out.withColumn("n_bytes", length.cast("long"))
            .withColumn("survives", F.col("_len") & F.col("_pre")).drop("_len", "_pre"))


def duplicate_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False,
                     prefix_chars: int = PREFIX_CHARS, filter_rows: int = FILTER_ROWS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, n_bytes,
    text_sha256`` (lowercase hex; null for rows found unique before their text
    was hashed, unless ``digest_all``)."""
    rows = _refine(id_text(docs, id_col, text_col), filter_rows, prefix_chars)
    digest = F.sha2("text", 256)
    if not digest_all:
        digest = F.when(F.col("survives"), digest)
    narrow = materialise(rows.select("doc_id", "n_bytes", "survives", digest.alias("text_sha256"),
                                     F.monotonically_increasing_id().alias("_row")), "dedup_rows")
    some = narrow.filter("survives")
    groups = materialise(some.groupBy("n_bytes", "text_sha256").agg(
        F.max(F.struct("doc_id", "_row")).alias("_keep"), F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "dedup_groups")
    # both sides are written tables: the join may split a hot group's rows
    found = some.join(groups, ["n_bytes", "text_sha256"], "left")
    alone = narrow.filter("not survives").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        "n_bytes", "text_sha256")
    single = F.col("_n").isNull()
    return alone.unionByName(found.select(
        "doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("_keep.doc_id")).alias("keep_id"),
        F.coalesce(F.col("_n"), F.lit(1)).alias("group_size"),
        (single | (F.col("_keep._row") == F.col("_row"))).alias("kept"), "n_bytes", "text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS,
             filter_rows: int = FILTER_ROWS) -> DataFrame:
    """``docs``, all columns, with one row per distinct text. Unique rows pass
    without a shuffle; of the rest, each task sends one row per group."""
    names = docs.columns
    packed = docs.select(F.struct(*[docs[c] for c in names]).alias("_all"), docs[id_col].cast("long").alias("doc_id"),
                         F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    rows = _refine(packed, filter_rows, prefix_chars)
    alone = rows.filter("not survives").select("_all")
    groups = rows.filter("survives").groupBy("n_bytes", F.sha2("text", 256).alias("_sha")).agg(
        F.max_by("_all", F.struct("doc_id", F.xxhash64("_all"))).alias("_all"))
    return alone.unionByName(groups.select("_all")).select("_all.*")
