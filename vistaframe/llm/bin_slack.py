"""Best-fit packing by minimum bin slack.

Every document becomes its token ids and an end id; longer ones than a
sequence are cut so that all pieces but the first are full. Which lengths
share a sequence is decided on the histogram of piece lengths, which has at
most ``capacity`` entries whatever the corpus: the longest remaining length
opens a sequence, a subset-sum bitset over the remaining lengths finds the
fullest feasible completion, and that combination is taken out as often as the
remaining counts allow. The pieces of one length are then numbered (by counts
per input partition and a running number within it) and looked up in the plan.
No step sorts or gathers the pieces of one length, so any length may be hot.

Defined cases: null text is the empty text (one piece, the end id); null or
repeated ids are kept as rows of their own; an empty table gives no pieces;
other columns take no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encoder
from .common import id_text, lean, materialise
from .token_files import list_array

PIECE_SCHEMA = ("doc_id long, piece int, start long, length long, ids_crc32 long, part int, ord long, "
                "ids array<int>")


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths (with repeats, never more than ``counts`` has) whose sum is the
    largest that is at most ``room``. Longer lengths are preferred."""
    layers, bits = [], 1
    mask = (1 << (room + 1)) - 1
    for length in sorted((k for k, n in counts.items() if n > 0 and k <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left:  # 1, 2, 4 ... copies: every number up to the count is a sum of these
            k = min(take, left)
            layers.append((length, k, bits))
            bits |= (bits << (length * k)) & mask
            left, take = left - k, take * 2
        if bits >> room & 1:
            break
    at, chosen = bits.bit_length() - 1, []
    for length, k, before in reversed(layers):
        if not before >> at & 1:  # not reachable without this layer
            chosen += [length] * k
            at -= length * k
    return chosen


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """[(lengths of one sequence, number of such sequences)] that uses up the histogram."""
    counts, plan = dict(histogram), []
    while counts:
        top = max(counts)
        counts[top] -= 1
        pattern = [top, *fullest(counts, capacity - top)]
        counts[top] += 1
        need = {k: pattern.count(k) for k in set(pattern)}
        times = min(counts[k] // n for k, n in need.items())
        for k, n in need.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
        plan.append((pattern, times))
    return plan


def plan_slots(plan: list[tuple[list[int], int]]) -> dict[int, tuple]:
    """Per length: arrays (first number, first sequence, copies per sequence, offsets of the copies)."""
    slots: dict[int, list] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, times in plan:
        places: dict[int, list[int]] = {}
        at = 0
        for length in pattern:
            places.setdefault(length, []).append(at)
            at += length
        for length, offsets in places.items():
            slots.setdefault(length, []).append((used.get(length, 0), sequence, offsets))
            used[length] = used.get(length, 0) + times * len(offsets)
        sequence += times
    return {k: ([x[0] for x in v], [x[1] for x in v], [x[2] for x in v]) for k, v in slots.items()}


def _cut(tokenizer_file: str, end_id: int, capacity: int):
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, seen = encoder(tokenizer_file), TaskContext.get().partitionId(), {}
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(),
                                   coder.encode(batch.column("text").to_pylist())):
                ids += end
                n = len(ids) // 4
                stop = (n - 1) % capacity + 1  # only the first piece may be shorter
                start = piece = 0
                while start < n:
                    raw, length = ids[4 * start:4 * stop], stop - start
                    seen[length] = number = seen.get(length, -1) + 1
                    rows.append((doc_id, piece, start, length, zlib.crc32(raw), part, number, raw))
                    start, stop, piece = stop, stop + capacity, piece + 1
            if rows:
                cols = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, kinds)] + [list_array(list(cols[-1]))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "ord", "ids"])
    return run


def _place(slots: dict[int, tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = {k: (np.array(a), np.array(b), c) for k, (a, b, c) in slots.items()}
        for batch in batches:
            lengths, numbers = (batch.column(c).to_numpy() for c in ("length", "number"))
            sequence, offset = np.empty(len(lengths), "int64"), np.empty(len(lengths), "int64")
            for length in np.unique(lengths).tolist():
                first, base, offsets = lookup[length]
                rows = np.flatnonzero(lengths == length)
                entry = np.searchsorted(first, numbers[rows], side="right") - 1
                for e in np.unique(entry).tolist():
                    at, places = rows[entry == e], np.array(offsets[e])
                    k = numbers[at] - first[e]
                    sequence[at], offset[at] = base[e] + k // len(places), places[k % len(places)]
            keep = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "part", "ord")]
            yield pa.RecordBatch.from_arrays(
                keep + [pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "ord", "sequence_id", "offset"])
    return run


def cut_pieces(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
               end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """The written table of pieces with their ids; (part, length, ord) names a piece."""
    pieces = id_text(docs, id_col, text_col).mapInArrow(lean(_cut(tokenizer_file, end_id, capacity)), PIECE_SCHEMA)
    return materialise(pieces, "pieces")


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """``pieces`` (of ``cut_pieces``) without ids, plus ``sequence_id`` and ``offset``."""
    counts = materialise(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece_counts")
    # at most one row per length up to the capacity
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = plan_slots(plan_bins(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = (pieces.drop("ids").join(base, ["part", "length"])
                .withColumn("number", F.col("base") + F.col("ord")).drop("base"))
    return numbered.mapInArrow(_place(slots), "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                              "part int, ord long, sequence_id long, offset long")


def sequences(pieces: DataFrame, packed: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id, ids``. A sequence has at most
    ``capacity`` ids, so its group is bounded."""
    joined = packed.join(pieces.select("part", "length", "ord", "ids"), ["part", "length", "ord"])
    return joined.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
