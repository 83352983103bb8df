"""Target-distribution importance resampling over hashed n-grams.

Features of a text are all runs of 1 to 3 consecutive words; a feature's bucket
is the crc32 of its bytes modulo a number of buckets. The log ratio of a
bucket's share in a target corpus to its share in the raw corpus is its gain, a
document's weight the sum of its features' gains, and the documents with the
highest weight plus Gumbel noise (from a hash of the id) are drawn: a sample
without replacement in proportion to the importance weights.

crc32 is linear over bits: a message's is that of as many zero bytes, XOR what
each byte adds by itself, which depends on the byte and its distance from the
end alone. So a table (distance, byte) and ``bitwise_xor.reduceat`` over the
features' spans give all crc32 of a block of texts at once, and a constant per
length completes them. Spans longer than the table are cut into blocks from the
end; a block's sum moves on by one table length before the next is added.

Spark sums bucket counts (a row per bucket and task); counts of all buckets, a
number set by a parameter, are what the driver sees. The draw orders rows by
range, so ranks come from one count per part.

Defined cases: a null or empty text has no words and weight 0; texts of any
length are taken whole, in blocks of features; a null id is hashed as the empty
text and comes after all others at equal scores; rows repeated with one id take
part as rows of their own, in any order among equals; an empty target has count
0 in every bucket; an empty table gives no rows; other columns take no part,
whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

BUCKETS, LONGEST_RUN, GAIN_SCALE = 10_000, 3, 1000
SPAN_BYTES = 64  # distances in the table
BLOCK_BYTES = 1 << 18  # of text normalised at a time, if no single text is longer
SPREAD_BYTES = 1 << 20  # bytes of spans summed at a time


def _zero_step(state: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """The register after one more zero byte."""
    return (state >> np.uint32(8)) ^ crc[state & np.uint32(255)]


class PositionCrc:
    """crc32 of many spans of a byte array."""

    def __init__(self, distances: int = SPAN_BYTES):
        single = np.arange(256, dtype="uint32")
        for _ in range(8):  # the register after one byte: the reflected polynomial, bit by bit
            single = np.where(single & 1, (single >> 1) ^ np.uint32(0xEDB88320), single >> 1).astype("uint32")
        table = np.empty((distances, 256), "uint32")
        table[0] = single
        for d in range(1, distances):
            table[d] = _zero_step(table[d - 1], single)
        self._d, self._table = distances, table.ravel()
        # the register after ``distances`` zero bytes, from each of its four bytes
        shift = []
        for k in range(4):
            state = (np.arange(256, dtype="uint64") << np.uint64(8 * k)).astype("uint32")
            for _ in range(distances):
                state = _zero_step(state, single)
            shift.append(state)
        self._shift = shift
        self._zeros = np.empty(0, "uint32")

    def _constant(self, lengths: np.ndarray) -> np.ndarray:
        """crc32 of so many zero bytes."""
        top = int(lengths.max(initial=0))
        if top < 4096:
            if len(self._zeros) <= top:
                self._zeros = np.array([zlib.crc32(bytes(n)) for n in range(4096)], "uint32")
            return self._zeros[lengths]
        sizes, at = np.unique(lengths, return_inverse=True)
        return np.array([zlib.crc32(bytes(int(n))) for n in sizes], "uint32")[at]

    def _short(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """XOR of what the bytes add, for spans of 1 to ``distances`` bytes."""
        out = np.empty(len(starts), "uint32")
        ends = np.cumsum(lengths)
        at = 0
        while at < len(starts):
            base = int(ends[at - 1]) if at else 0
            to = max(int(np.searchsorted(ends, base + SPREAD_BYTES, side="right")), at + 1)
            n, first = lengths[at:to], ends[at:to] - lengths[at:to] - base
            step = np.arange(int(ends[to - 1]) - base)
            byte = data[step + np.repeat(starts[at:to] - first, n)]
            distance = np.repeat(first + n - 1, n) - step
            out[at:to] = np.bitwise_xor.reduceat(self._table[(distance << 8) + byte], first)
            at = to
        return out

    def _moved(self, state: np.ndarray) -> np.ndarray:
        s = self._shift
        return (s[0][state & np.uint32(255)] ^ s[1][(state >> np.uint32(8)) & np.uint32(255)]
                ^ s[2][(state >> np.uint32(16)) & np.uint32(255)] ^ s[3][state >> np.uint32(24)])

    def of(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Unsigned crc32 per span (of at least one byte) of ``data``."""
        long = lengths > self._d
        if not long.any():
            return self._short(data, starts, lengths) ^ self._constant(lengths)
        out = np.zeros(len(starts), "uint32")
        out[~long] = self._short(data, starts[~long], lengths[~long])
        at = np.flatnonzero(long)
        blocks = -(-lengths[at] // self._d)
        head = lengths[at] - (blocks - 1) * self._d  # the first block may be shorter
        state = self._short(data, starts[at], head)
        place = starts[at] + head
        for k in range(1, int(blocks.max())):
            more = np.flatnonzero(blocks > k)
            state[more] = self._moved(state[more]) ^ self._short(data, place[more], np.full(len(more), self._d))
            place[more] += self._d
        out[at] = state
        return out ^ self._constant(lengths)


_BYTES = np.arange(256)
_IS_WORD = (_BYTES >= 0x80) | ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (
    (_BYTES >= 0x41) & (_BYTES <= 0x5A))
# A-Z in lower case, all that is no part of a word as one blank
_NORMAL = np.where(_IS_WORD, np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES), 0x20).astype("uint8")


class Featurizer:
    """Buckets of all runs of words of some texts."""

    def __init__(self, buckets: int = BUCKETS, longest: int = LONGEST_RUN):
        self._crc, self._buckets, self._longest = PositionCrc(), buckets, longest

    def of(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``words`` per text once, then (text, buckets) by length of run: yields
        (kind 0: words per text), (text numbers, buckets)."""
        data = _NORMAL[np.frombuffer(b"\n".join(texts) + b"\n", "uint8")]
        word = data != 0x20
        after = np.r_[False, word[:-1]]
        first = np.flatnonzero(word & ~after)
        ends = np.cumsum([len(t) + 1 for t in texts])
        owner = np.searchsorted(ends, first, side="right")
        keep = word | after  # words, each with one blank behind it
        data = data[keep]
        place = np.cumsum(keep) - 1
        starts = place[first]
        stops = np.flatnonzero(data == 0x20)
        words = np.bincount(owner, minlength=len(texts))
        for k in range(1, self._longest + 1):
            runs = np.flatnonzero(owner[:len(owner) - k + 1] == owner[k - 1:]) if len(owner) >= k else np.empty(0, int)
            crc = self._crc.of(data, starts[runs], stops[runs + k - 1] - starts[runs]) if len(runs) else np.empty(0, "uint32")
            yield words, owner[runs], crc % np.uint32(self._buckets)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of the batches with a bounded number of bytes, or one text."""
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        at, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= BLOCK_BYTES or i + 1 == len(texts):
                yield batch.slice(at, i + 1 - at), texts[at:i + 1]
                at, size = i + 1, 0


def _count(buckets: int, longest: int):
    """A task's counts, one row per bucket that occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, total = Featurizer(buckets, longest), np.zeros(buckets, "int64")
        for _, texts in _blocks(batches):
            for _, _, found in maker.of(texts):
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> np.ndarray:
    """Features per bucket over all texts."""
    rows = texts.select(F.coalesce(texts[text_col].cast("string"), F.lit("")).alias("text"))
    sums = rows.mapInArrow(_count(buckets, longest), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, "int64")
    for r in sums.collect():  # a row per bucket
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(target: np.ndarray, raw: np.ndarray, scale: int = GAIN_SCALE) -> np.ndarray:
    """floor(scale * ln of the ratio of add-one shares) per bucket."""
    t_all, s_all, n = float(target.sum()), float(raw.sum()), len(raw)
    return np.array([math.floor(scale * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n))))
                     for t, s in zip(target.tolist(), raw.tolist())], "int64")


def _weigh(gains: np.ndarray, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Featurizer(len(gains), longest)
        for batch, texts in _blocks(batches):
            n = len(texts)
            words, features, weight = np.zeros(n, "int64"), np.zeros(n, "int64"), np.zeros(n, "int64")
            for words, owner, found in maker.of(texts):
                if len(owner):  # owners ascend
                    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                    weight[owner[first]] += np.add.reduceat(gains[found], first)
                    features[owner[first]] += np.diff(np.r_[first, len(owner)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words.astype("int64")), pa.array(features),
                                              pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])
    return run


def gumbel(id_col: Column, seed: int, scale: int = GAIN_SCALE) -> Column:
    """floor(-scale * ln(-ln(u))) with u from the first 32 bits of sha256(``seed:id``)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(scale)) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def score(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", seed: int = 42,
          longest: int = LONGEST_RUN) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` per row."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    weighed = rows.mapInArrow(_weigh(gains, longest), "doc_id long, n_words long, n_features long, weight long")
    return weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))


def ranked(scored: DataFrame, percent: int = 5, least_words: int = 20) -> DataFrame:
    """Add ``rank`` to the rows of ``score``: 1, 2, ... for the drawn ones, in falling
    order of score, ties to the smaller id; null for the rest."""
    rows = materialise(scored.withColumn("_row", F.monotonically_increasing_id()), "resampling_scores")
    some = rows.filter(F.col("n_words") >= least_words)
    drawn = percent * some.count() // 100
    # rows in order over all parts: a rank is the place in the part plus the rows of the parts before it
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    dealt = some.select("score", "doc_id", "_row").repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = materialise(dealt.withColumn("_at", F.monotonically_increasing_id()).select(
        "_row", F.shiftright("_at", 33).cast("int").alias("part"), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("at")),
        "resampling_order")
    sizes = sorted((r["part"], r["count"]) for r in dealt.groupBy("part").count().collect())  # a row per part
    before, total = [], 0
    for part, n in sizes:
        before.append((part, total))
        total += n
    base = scored.sparkSession.createDataFrame(before, "part int, base long")
    places = dealt.join(base, "part").withColumn("rank", F.col("base") + F.col("at") + 1).filter(F.col("rank") <= drawn)
    return rows.join(places.select("_row", "rank"), "_row", "left").drop("_row")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             percent: int = 5, least_words: int = 20, seed: int = 42, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` per row of ``docs``."""
    gains = bucket_gains(bucket_counts(target, target_text_col, buckets, longest), bucket_counts(docs, text_col, buckets, longest))
    return ranked(score(docs, gains, id_col, text_col, seed, longest), percent, least_words)


def drawn_documents(docs: DataFrame, result: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose ids are drawn, all columns."""
    ids = result.filter("rank is not null").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(ids, docs[id_col].cast("long") == F.col("_drawn"), "left_semi")
