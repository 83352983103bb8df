"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next one's documents. All but the last return the
columns of ``documents``.

Defined cases, the same in every stage: a null text is the empty text; a null id
is an id of its own that is never linked with another; rows repeated with one id
are rows of their own; an empty table gives an empty table; texts are read whole
whatever their length; columns besides ``doc_id``, ``text`` and, for the mixture,
``source`` and ``lang`` take no part and come back unchanged, whatever their names.
Ties: of equal texts the largest id stays, of near copies the smallest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaframe.llm import bin_slack, exact_dedup, mixture, nb_svm, signature_join
from vistaframe.llm.bpe import default_tokenizer
from vistaframe.llm.common import materialise, prepare
from vistaframe.llm.exact_dedup import mark_held, repeated_keys
from vistaframe.sources.tables import read_table

QUALITY = 0.3  # documents of a lower score go
NEAR_WORDS, NEAR_PERCENT = 5, 80
CAPACITY, END_ID = 1024, 2
ID_FILTER_ROWS = 256  # bit set of ids: 1 MB

# The first stage learns a classifier and the later ones work on what it keeps: no SQL says that.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't take for bad."""
    labels = nb_svm.training_labels(read_table(prepare(spark), sf_dir, "labels"))
    return nb_svm.keep_good(docs, nb_svm.fit_quality(docs, labels), QUALITY)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest id."""
    prepare(spark)
    return exact_dedup.keep_one(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, that with the smallest
    id. Rows of a repeated id are told apart by a hash of id and text; of rows
    with one id and one text all stay or go together. Rows with a null id or
    without words stay."""
    prepare(spark)
    row_hash = F.xxhash64("doc_id", "text")
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), docs["doc_id"].cast("long").alias("doc_id"),
                        docs["text"])
    ids = materialise(repeated_keys(whole.filter("doc_id is not null").select(F.xxhash64("doc_id").alias("key")), ID_FILTER_ROWS),
                      "near_repeated_ids")
    # an id taken for a repeated one by chance has a hashed key, too: the kept row follows from the ids either way
    keyed = mark_held(whole, F.xxhash64("doc_id"), ids, ID_FILTER_ROWS, "_often").withColumn(
        "_row", F.when(F.col("doc_id").isNotNull(), F.when(F.col("_often"), row_hash).otherwise(F.col("doc_id"))))
    links = signature_join.similar_components(keyed, id_col="_row", words=NEAR_WORDS, percent=NEAR_PERCENT)
    links = materialise(links.filter("component_id <> doc_id").select(F.col("doc_id").alias("_row"), "component_id").distinct(),
                        "near_links")
    members = links.unionByName(links.select(F.col("component_id").alias("_row"), "component_id").distinct())
    ranked = keyed.select("_row", "doc_id").distinct().join(members, "_row")
    kept = ranked.groupBy("component_id").agg(F.min(F.struct("doc_id", "_row"))["_row"].alias("_row"))
    gone = materialise(members.join(kept, "_row", "left_anti").select("_row"), "near_gone")
    return keyed.join(gone, "_row", "left_anti").select("_doc.*")


def target_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of a set share of the tokens, by the target shares of sources,
    languages and topics; categories too small for their share are kept whole."""
    prepare(spark)
    return mixture.sample(docs, token_share=mixture.TOKEN_SHARE)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in training sequences."""
    prepare(spark)
    pieces = bin_slack.cut_pieces(docs, default_tokenizer(), end_id=END_ID, capacity=CAPACITY)
    return bin_slack.pack(pieces, CAPACITY).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("target_mixture", target_mixture),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
