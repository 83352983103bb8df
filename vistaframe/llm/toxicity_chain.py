"""Toxicity by a classifier chain.

Categories are predicted one after the other. Each category's linear model
sees the text's hashed n-grams and the probabilities of the categories before
it; in training those are out-of-fold predictions, so a later model learns from
inputs as unsure as the ones it gets when it scores. Categories without labels
of their own are weakly labelled by word lists; the last one, ``toxic``, by the
given labels.

Training uses at most ``max_rows`` labelled documents and runs in one task.
Defined cases: null and empty texts have no features and get each model's
constant; null labels take no part; an id labelled more than once counts by its
mean; a category without both classes in training predicts its smoothed share;
an empty table gives no rows; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text
from .linear import NgramFeatures, fit, probability
from .nb_svm import bounded_sample, fold_of, train_in_one_task, training_features

KINDS = ("word", "bigram", "prefix")
# word lists of the weak categories
WEAK = {
    "insult": ("idiot", "moron", "stupid", "loser", "clown", "fool", "dumb"),
    "contempt": ("scum", "trash", "worthless", "pathetic", "disgusting", "filth", "vermin"),
}
CHAIN = (*WEAK, "toxic")


def _train_chain(frame):
    models = []
    if frame is None or not len(frame):
        return [fit([], np.empty(0, int), np.empty(0, int))[0] for _ in CHAIN]
    rows = [np.frombuffer(b, "uint32") for b in frame["features"]]
    fold = fold_of(frame["doc_id"].to_numpy())
    dense = np.empty((len(frame), 0))
    for category in CHAIN:
        model, out_of_fold = fit(rows, frame[category].to_numpy().astype(int), fold, dense, epochs=8)
        models.append(model)
        dense = np.column_stack([dense, out_of_fold])
    return models


def fit_chain(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              max_rows: int = 12_000) -> list:
    """One model per category, in chain order."""
    texts = id_text(docs, id_col, text_col)
    weak = {c: F.col("text").rlike(r"(?i)\b(" + "|".join(words) + r")\b").cast("int") for c, words in WEAK.items()}
    rows = training_features(texts.withColumns(weak), bounded_sample(labels, "toxic", max_rows), KINDS, list(CHAIN))
    return train_in_one_task(rows, _train_chain)


def score_chain(docs: DataFrame, models: list, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``p_<category>`` per category for every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(models)  # three models of 2^18 weights and ratios: 6 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ngrams, chain = NgramFeatures(KINDS), sent.value
        for batch in batches:
            found = np.empty((batch.num_rows, len(chain)))
            for i, text in enumerate(batch.column("text").to_pylist()):
                idx = ngrams.of(text)
                for k, model in enumerate(chain):
                    found[i, k] = probability(model, idx, found[i, :k])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array(found[:, k]) for k in range(len(chain))],
                names=["doc_id", *(f"p_{c}" for c in CHAIN)])

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, " + ", ".join(f"p_{c} double" for c in CHAIN))
