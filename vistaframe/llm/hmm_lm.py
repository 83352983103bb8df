"""Hidden Markov language model: training over partitions, exact sequence likelihood.

Tokens are runs of anything but ASCII white space, A-Z in lower case, then one
end token. The model emits symbols: each of the most frequent ``head`` words is
one, the end token is one, and all other words fall into classes by their last
two bytes, where a word has the add-one share of its class. So every text has
a probability, made of the symbols' (scaled forward recursion) and of its rare
words' within their classes.

Words are counted over all training tokens. Texts are cut into tokens once:
each part of the corpus numbers its own words, and its list of words with
their training counts goes, by slices of the words' hashes, to tasks that add
up the counts of all parts and send back to each part the total and the symbol
of its words. A word is one entry per part there, however frequent, and only
the head (a parameter) goes to the driver.

Baum-Welch: every round, each task runs scaled forward and backward recursions
over its training texts and returns expected counts; their sums over all tasks
give the next model.

Defined cases: null text is the empty text, whose only token is the end; a null
id counts as the empty id text (for the held-out rule); repeated rows are
trained and scored as rows of their own; without training texts the model is
uniform; an empty table gives no rows; other columns take no part.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, materialise

HEAD_WORDS = 30_000
CLASSES = 256
STATES = 6
ROUNDS = 4
PART_TEXTS, PART_BYTES = 8000, 32 << 20
SLICE_WORDS = 300_000  # words of all parts that one slice of hashes gets, about
CELLS = 800_000  # tokens of texts that run through the recursions together
HELD = 5_000_000  # tokens of texts that are held, to be sorted by length


def _pack(x: np.ndarray) -> bytes:
    return zlib.compress(x.tobytes(), 1)


def _unpack(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw), kind)


def tokens(text: str) -> list[bytes]:
    """The words; as bytes, only ASCII is lowered and split at."""
    return text.encode("utf-8").lower().split()


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % CLASSES


PART_SCHEMA = "part long, doc_id long, held_out boolean, ids binary, words binary, counts binary"


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as numbers of their part's words, and each part's words with their training counts."""
    task, number = TaskContext.get().partitionId(), 0
    local, seen, texts, size = defaultdict(count().__next__), [], 0, 0

    def part() -> int:
        return (task << 24) + number

    def vocabulary() -> pa.RecordBatch:
        used = np.concatenate(seen) if seen else np.empty(0, "uint32")
        counts = np.bincount(used, minlength=len(local)).astype("uint32")
        return pa.RecordBatch.from_arrays(
            [pa.array([part()], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.bool_()), pa.nulls(1, pa.binary()),
             pa.array([zlib.compress(b" ".join(local), 1)], pa.binary()), pa.array([_pack(counts)], pa.binary())],
            names=["part", "doc_id", "held_out", "ids", "words", "counts"])

    for batch in batches:
        parts, numbered = [], []
        for text, held_out in zip(batch.column("text").to_pylist(), batch.column("held_out").to_pylist()):
            ids = np.array(list(map(local.__getitem__, tokens(text))), dtype="uint32")  # a new word gets the next number
            if not held_out:
                seen.append(ids)
            parts.append(part())
            numbered.append(_pack(ids))
            texts, size = texts + 1, size + len(text)
        n = len(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int64()), batch.column("doc_id"), batch.column("held_out"), pa.array(numbered, pa.binary()),
             pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())],
            names=["part", "doc_id", "held_out", "ids", "words", "counts"])
        if texts >= PART_TEXTS or size > PART_BYTES:
            if local:
                yield vocabulary()
            number, seen, texts, size = number + 1, [], 0, 0
            local = defaultdict(count().__next__)
    if local:
        yield vocabulary()


def _sliced(slices: int):
    """A part's words, dealt out by their hashes: (slice, part, words, numbers, counts)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, packed, counted in zip(*(batch.column(c).to_pylist() for c in ("part", "words", "counts"))):
                words = zlib.decompress(packed).split(b" ")
                counts = _unpack(counted, "uint32")
                to = np.fromiter(map(zlib.crc32, words), "uint32", len(words)) % slices
                order = np.argsort(to, kind="stable")
                cuts = np.flatnonzero(np.diff(to[order])) + 1
                groups = np.split(order, cuts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(to[g[0]]) for g in groups], pa.int32()), pa.array([part] * len(groups), pa.int64()),
                     pa.array([zlib.compress(b" ".join([words[i] for i in g.tolist()]), 1) for g in groups], pa.binary()),
                     pa.array([_pack(g.astype("uint32")) for g in groups], pa.binary()),
                     pa.array([_pack(counts[g]) for g in groups], pa.binary())],
                    names=["slice", "part", "words", "numbers", "counts"])
    return run


def _by_slice(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list]]:
    """Per slice: (total counts, [(part, words, numbers)]); a slice's rows stand together."""
    at, totals, asked = None, {}, []
    for batch in batches:
        for k, part, packed, numbers, counted in zip(*(batch.column(c).to_pylist() for c in
                                                       ("slice", "part", "words", "numbers", "counts"))):
            if k != at:
                if asked:
                    yield totals, asked
                at, totals, asked = k, {}, []
            words = zlib.decompress(packed).split(b" ")
            for w, c in zip(words, _unpack(counted, "uint32").tolist()):
                totals[w] = totals.get(w, 0) + c
            asked.append((part, words, numbers))
    if asked:
        yield totals, asked


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for totals, _ in _by_slice(batches):
        known = [(w, c) for w, c in totals.items() if c]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in known], pa.binary()), pa.array([word_class(w) for w, _ in known], pa.int32()),
             pa.array([c for _, c in known], pa.int64())], names=["word", "class", "c"])


def _answers(sent):
    """Per part and slice: numbers of words with their symbols and total counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = sent.value
        for totals, asked in _by_slice(batches):
            symbol = {w: head[w] if w in head else len(head) + word_class(w) for w in totals}
            for at in range(0, len(asked), 50):
                some = asked[at:at + 50]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _, _ in some], pa.int64()), pa.array([n for _, _, n in some], pa.binary()),
                     pa.array([_pack(np.array([symbol[w] for w in words], "uint32")) for _, words, _ in some], pa.binary()),
                     pa.array([_pack(np.array([totals[w] for w in words], "uint64")) for _, words, _ in some], pa.binary())],
                    names=["part", "numbers", "symbols", "counts"])
    return run


def _symbols(n_head: int, ends: int, denominator: int, class_total: np.ndarray):
    """A part's answers come first (kind 0), then its texts (kind 1): symbols
    of the texts, their add-one scores and their rare words' shares."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, answers, symbol = None, [], None
        end = n_head + CLASSES
        end_base, end_known = math.log10((ends + 1) / denominator), int(ends > 0)
        for batch in batches:
            rows = []
            for p, kind, numbers, packed, counted, doc_id, held_out in zip(*(batch.column(c).to_pylist() for c in (
                    "part", "kind", "numbers", "symbols", "counts", "doc_id", "held_out"))):
                if p != part:
                    part, answers, symbol = p, [], None
                if kind == 0:
                    answers.append((_unpack(numbers, "uint32"), _unpack(packed, "uint32"), _unpack(counted, "uint64")))
                    continue
                if symbol is None:
                    n = sum(len(a[0]) for a in answers)
                    symbol, total = np.zeros(n, "uint32"), np.zeros(n, "uint64")
                    for at, s, c in answers:
                        symbol[at], total[at] = s, c
                    base = np.log10((total + 1.0) / denominator)
                    share = np.zeros(n)
                    rare = symbol >= n_head
                    share[rare] = np.log10((total[rare] + 1.0) / class_total[symbol[rare] - n_head])
                    known = (total > 0).astype("int64")
                ids = _unpack(numbers, "uint32")
                rows.append((doc_id, held_out, len(ids) + 1, int(known[ids].sum()) + end_known, float(base[ids].sum()) + end_base,
                             float(share[ids].sum()), _pack(np.append(symbol[ids], np.uint32(end)))))
            if rows:
                kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[
                    "doc_id", "held_out", "n_tokens", "n_known", "base_score", "rare_score", "symbols"])
    return run


def _groups(sequences: list[np.ndarray]) -> Iterator[list[int]]:
    """Indices, longest first, in groups of at most CELLS tokens (or one text)."""
    group, size = [], 0
    for i in sorted(range(len(sequences)), key=lambda i: -len(sequences[i])):
        if group and size + len(sequences[i]) > CELLS:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(sequences[i])
    if group:
        yield group


def _laid(sequences: list[np.ndarray], group: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The group's symbols one text after the other, where each begins, and
    per time the number of texts that still run (texts are longest first)."""
    lengths = np.array([len(sequences[i]) for i in group])
    flat = np.concatenate([sequences[i] for i in group]).astype("int64")
    running = len(group) - np.searchsorted(lengths[::-1], np.arange(1, lengths[0] + 1), side="left")
    return flat, np.cumsum(lengths) - lengths, running


def forward(model: dict, laid, keep: bool):
    """Natural log of each text's symbol probability; with ``keep`` also the
    scaled forward variables and scales per time."""
    flat, begins, running = laid
    start, move, emit = model["start"], model["move"], model["emit"]  # emit: symbol x state
    ones = np.ones(len(start))
    log = np.zeros(len(begins))
    alphas, scales, alpha = [], [], None
    for t, n in enumerate(running.tolist()):
        seen = emit[flat[begins[:n] + t]]
        alpha = start * seen if alpha is None else (alpha[:n] @ move) * seen
        scale = alpha @ ones
        alpha /= scale[:, None]
        log[:n] += np.log(scale)
        if keep:
            alphas.append(alpha)
            scales.append(scale)
    return log, alphas, scales


def expected_counts(model: dict, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected (starts, moves, emissions) of the texts under the model."""
    move, emit = model["move"], model["emit"]
    states = len(move)
    back = move.T.copy()
    starts, moves, emissions = np.zeros(states), np.zeros((states, states)), np.zeros(emit.shape)
    for group in _groups(sequences):
        laid = flat, begins, running = _laid(sequences, group)
        _, alphas, scales = forward(model, laid, True)
        beta = np.ones((0, states))
        for t in range(len(running) - 1, -1, -1):
            n = int(running[t])
            if n > len(beta):  # texts that end here
                beta = np.concatenate([beta, np.ones((n - len(beta), states))])
            if t:
                ahead = emit[flat[begins[:n] + t]] * beta
                ahead /= scales[t][:, None]
                moves += alphas[t - 1][:n].T @ ahead
            alphas[t] *= beta  # now the state's probability given the whole text
            if t:
                beta = ahead @ back
        starts += alphas[0].sum(axis=0)
        used = flat[np.concatenate([begins[:n] + t for t, n in enumerate(running.tolist())])]
        weight = np.concatenate(alphas)
        for s in range(states):
            emissions[:, s] += np.bincount(used, weights=weight[:, s], minlength=len(emit))
    return starts, moves * move, emissions


def _expectation(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        states = len(model["move"])
        total, held, size = None, [], 0

        def add():
            nonlocal total
            got = expected_counts(model, held)
            total = got if total is None else tuple(a + b for a, b in zip(total, got))

        for batch in batches:
            for raw in batch.column("symbols").to_pylist():
                held.append(_unpack(raw, "uint32"))
                size += len(held[-1])
            if size > HELD:
                add()
                held, size = [], 0
        if held:
            add()
        if total is None:
            return
        starts, moves, emissions = total
        used = np.flatnonzero(emissions.any(axis=1))
        # rows below 0: the starts, then the moves out of each state
        keys = np.concatenate([[-1], -2 - np.arange(states), used])
        rows = np.vstack([starts[None, :], moves, emissions[used]])
        yield pa.RecordBatch.from_arrays([pa.array(keys)] + [pa.array(rows[:, s].copy()) for s in range(states)],
                                         names=["key", *(f"s{s}" for s in range(states))])
    return run


def _normal(x: np.ndarray, axis=None) -> np.ndarray:
    return x / x.sum(axis=axis, keepdims=True)


def first_model(share: np.ndarray, states: int, seed: int = 11) -> dict:
    """States that tend to stay, each emitting a random tilt of the symbols' shares."""
    rng = np.random.default_rng(seed)
    emit = share[:, None] * rng.gamma(1.0, 1.0, (len(share), states))
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return {"start": np.full(states, 1 / states), "move": move, "emit": _normal(emit + 1e-12, 0)}


def next_model(rows, share: np.ndarray, states: int) -> dict:
    """Maximisation, with a little of the symbols' shares in every state's emissions."""
    starts, moves, emissions = np.full(states, 0.1), np.full((states, states), 0.1), share[:, None] * np.full((1, states), 10.0)
    for r in rows:
        values = np.array([r[f"s{s}"] for s in range(states)])
        if r["key"] == -1:
            starts += values
        elif r["key"] < 0:
            moves[-2 - r["key"]] += values
        else:
            emissions[r["key"]] += values
    return {"start": _normal(starts), "move": _normal(moves, 1), "emit": _normal(emissions, 0)}


def _score(sent):
    """Adds the symbols' probability; texts are held and run by length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, held, size = sent.value, [], 0
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]

        def out() -> pa.RecordBatch:
            sequences = [s for _, rows in held for s in rows]
            log = np.zeros(len(sequences))
            for group in _groups(sequences):
                log[group] = forward(model, _laid(sequences, group), False)[0]
            table = pa.Table.from_batches([b for b, _ in held]).combine_chunks()
            score = log / math.log(10) + table.column("rare_score").to_numpy()
            return pa.Table.from_arrays([*(table.column(c) for c in names), pa.array(score)], names=[*names, "score"]).to_batches()[0]

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [_unpack(raw, "uint32") for raw in batch.column("symbols").to_pylist()]
            held.append((batch.select([*names, "rare_score"]), rows))
            size += sum(map(len, rows))
            if size > HELD:
                yield out()
                held, size = [], 0
        if held:
            yield out()
    return run


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                states: int = STATES, rounds: int = ROUNDS, head_words: int = HEAD_WORDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    per row, with a model learned from the rows for which ``held_out`` (over
    ``doc_id``) is false. Scores are log10."""
    spark = docs.sparkSession
    rows = id_text(docs, id_col, text_col).withColumn("held_out", held_out)
    numbered = materialise(rows.mapInArrow(_number, PART_SCHEMA), "numbered")
    texts, vocabularies = numbered.filter("ids is not null"), numbered.filter("words is not null")

    # total counts of words, by slices of their hashes
    entries = vocabularies.select(F.sum(F.octet_length("words"))).first()[0] or 0  # packed: some bytes a word
    slices = max(12, int(entries // (3 * SLICE_WORDS)))
    dealt = materialise(vocabularies.select("part", "words", "counts").mapInArrow(
        _sliced(slices), "slice int, part long, words binary, numbers binary, counts binary"), "slices")
    dealt = dealt.repartition(slices, "slice").sortWithinPartitions("slice", "part")
    counts = materialise(dealt.mapInArrow(_totals, "word binary, class int, c long"), "word_counts")
    ends = texts.filter("not held_out").count()
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_tokens, n_types = total["n"] + ends, total["v"] + (ends > 0)
    # the least count in the head, from the number of words of each count: only the head's tasks send words
    left, cut = head_words, 0
    for r in counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("c").desc()).limit(head_words).collect():
        left, cut = left - r["n"], r["c"]
        if left <= 0:
            break
    top = counts.filter(F.col("c") >= cut).orderBy(F.col("c").desc(), "word").limit(head_words).collect()  # at most head_words rows
    head = {bytes(r["word"]): k for k, r in enumerate(top)}
    least = (top[-1]["c"], bytes(top[-1]["word"])) if top else (0, b"")
    rare = counts.filter((F.col("c") < least[0]) | ((F.col("c") == least[0]) & (F.col("word") > F.lit(least[1]))))
    n_class, v_class = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in rare.groupBy("class").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        n_class[r["class"]], v_class[r["class"]] = r["n"], r["v"]

    answers = dealt.mapInArrow(_answers(spark.sparkContext.broadcast(head)),
                               "part long, numbers binary, symbols binary, counts binary")
    nothing = F.lit(None).cast("binary")
    both = answers.select("part", F.lit(0).alias("kind"), "numbers", "symbols", "counts", F.lit(None).cast("long").alias("doc_id"),
                          F.lit(None).cast("boolean").alias("held_out"))
    both = both.unionByName(texts.select("part", F.lit(1).alias("kind"), F.col("ids").alias("numbers"), nothing.alias("symbols"),
                                         nothing.alias("counts"), "doc_id", "held_out"))
    denominator = n_tokens + n_types + 1
    seqs = materialise(both.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(
        _symbols(len(head), ends, denominator, n_class + v_class + 1),
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, rare_score double, symbols binary"), "symbols")

    share = np.concatenate([[r["c"] for r in top], n_class, [ends]]) + 0.5
    share = share / share.sum()
    model = first_model(share, states)
    shape = "key long, " + ", ".join(f"s{s} double" for s in range(states))
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(model)  # (head + classes + 1) x states numbers
        found = seqs.filter("not held_out").select("symbols").mapInArrow(_expectation(sent), shape)
        sums = found.groupBy("key").agg(*[F.sum(f"s{s}").alias(f"s{s}") for s in range(states)])
        model = next_model(sorted(sums.collect(), key=lambda r: r["key"]), share, states)  # a row per symbol at most
    scored = seqs.mapInArrow(_score(spark.sparkContext.broadcast(model)),
                             "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("train_tokens", F.lit(n_tokens).cast("long"))
