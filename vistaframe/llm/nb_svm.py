"""Quality classifier: naive Bayes support vector machine.

Hashed n-gram indicators (words, word pairs, shapes of up to three
neighbouring tokens) are scaled by class log-count ratios and a linear
hinge-loss model is fitted by dual coordinate descent. Training uses at most
``max_rows`` labelled documents (those with the smallest id hashes), so one
task holds them; scoring is row by row over whole texts.

Defined cases: null and empty texts have no features and get the model's
constant; labels that are null take no part, an id labelled more than once
counts by its mean label; an id repeated among documents trains once; without
labels of both classes every score is the smoothed share of class 1; an empty
table gives no rows; other columns take no part.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, id_text, lean
from .linear import NgramFeatures, fit, probability

KINDS = ("word", "bigram", "shape")
FOLDS = 3


def training_features(docs: DataFrame, sample: DataFrame, kinds: tuple[str, ...], labels: list[str]) -> DataFrame:
    """Features of the sampled documents: ``doc_id, features, labels...``; one row an id.
    ``sample`` has a bounded number of rows."""
    texts = docs.join(F.broadcast(sample), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ngrams = NgramFeatures(kinds)
        for batch in batches:
            blobs = [ngrams.of(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(blobs, pa.binary())] + [batch.column(c) for c in labels],
                names=["doc_id", "features", *labels])

    rows = texts.select("doc_id", "text", *labels).mapInArrow(
        lean(run), "doc_id long, features binary, " + ", ".join(f"{c} int" for c in labels))
    return rows.groupBy("doc_id").agg(F.min("features").alias("features"), *[F.max(c).alias(c) for c in labels])


def bounded_sample(labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """``doc_id`` and the label as 0/1; the ``max_rows`` smallest id hashes."""
    one = labels.filter(labels[label].isNotNull() & labels["doc_id"].isNotNull()).groupBy("doc_id").agg(
        (F.avg(label) >= 0.5).cast("int").alias(label))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)


def train_in_one_task(rows: DataFrame, train) -> object:
    """``train(pandas frame)`` in a single task over the bounded ``rows``; its pickled result."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        frame = table.to_pandas() if table is not None else None
        if frame is not None:
            frame = frame.sort_values("doc_id").reset_index(drop=True)  # the same model whatever the partitions
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(frame))], pa.binary())], names=["model"])

    got = rows.select(*names).repartition(1).mapInArrow(lean(run), "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else train(None)


def fold_of(doc_ids: np.ndarray) -> np.ndarray:
    mixed = doc_ids.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(FOLDS)).astype(int)


def _train_quality(label: str):
    def train(frame):
        if frame is None or not len(frame):
            return fit([], np.empty(0, int), np.empty(0, int))[0]
        rows = [np.frombuffer(b, "uint32") for b in frame["features"]]
        return fit(rows, frame[label].to_numpy().astype(int), fold_of(frame["doc_id"].to_numpy()))[0]
    return train


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
                text_col: str = "text", max_rows: int = 20_000):
    """The fitted model; ``labels`` (``doc_id`` and ``label``) names the rows to learn from."""
    sample = bounded_sample(labels, label, max_rows)
    return train_in_one_task(training_features(id_text(docs, id_col, text_col), sample, KINDS, [label]),
                             _train_quality(label))


def score_quality(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2^18 weights and ratios: 2 MB whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ngrams, m = NgramFeatures(KINDS), sent.value
        for batch in batches:
            scores = [probability(m, ngrams.of(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())],
                                             names=["doc_id", "score"])

    return id_text(docs, id_col, text_col).mapInArrow(lean(run), "doc_id long, score double")


def keep_good(docs: DataFrame, model, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``threshold``. The text is scored where it lies."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ngrams, m = NgramFeatures(KINDS), sent.value
        for batch in batches:
            good = [probability(m, ngrams.of(t or "")) >= threshold for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)


def training_labels(labels: DataFrame, mod: int = 5) -> DataFrame:
    """Labels of the ids outside the held-out fold."""
    return labels.filter(id_remainder("doc_id", mod) != 0)
