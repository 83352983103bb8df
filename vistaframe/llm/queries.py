"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaframe.session import scratch_path
from vistaframe.sources.tables import read_table

from . import (bin_slack, block_ann, embedding_dedup, exact_dedup, hmm_lm, importance_resampling, license_scan, mixture, nb_svm,
               signature_join, token_files, toxicity_chain, vector_codes)
from .bpe import default_tokenizer
from .common import id_remainder, materialise, prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@query("op3_bin_slack")
def op3(spark, sf_dir):
    pieces = bin_slack.cut_pieces(read_table(spark, sf_dir, "documents"), default_tokenizer(), end_id=2, capacity=1024)
    return bin_slack.pack(pieces, 1024).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op4_token_files")
def op4(spark, sf_dir):
    path = scratch_path(spark, "llm", "token_files")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), path, default_tokenizer(), end_id=0)
    digests = materialise(token_files.token_digests(token_files.read_token_files(spark, path)), "token_digests")
    return token_files.with_starts(digests).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op6_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""")
def op6(spark, sf_dir):
    return exact_dedup.duplicate_report(read_table(spark, sf_dir, "documents"), digest_all=True).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op9_nb_svm")
def op9(spark, sf_dir):
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = nb_svm.fit_quality(docs, nb_svm.training_labels(labels))
    return nb_svm.score_quality(docs, model).select(
        "doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op2_toxicity_chain")
def op2(spark, sf_dir):
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    models = toxicity_chain.fit_chain(docs, nb_svm.training_labels(labels))
    return toxicity_chain.score_chain(docs, models).select(
        "doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "p_insult", "p_contempt", "p_toxic",
        (F.col("p_toxic") >= 0.5).cast("int").alias("toxic"))


@query("op1_block_ann")
def op1(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    return block_ann.nearest(vectors, F.col("vec_id") % 50 == 0, k=5)


@query("op10_signature_join")
def op10(spark, sf_dir):
    return signature_join.similar_components(read_table(spark, sf_dir, "documents"), words=3, percent=90)


@query("op8_hmm_lm")
def op8(spark, sf_dir):
    return hmm_lm.score_texts(read_table(spark, sf_dir, "documents"), id_remainder("doc_id", 7) == 2).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op7_license_scan", license_scan.oracle())
def op7(spark, sf_dir):
    return license_scan.summary(license_scan.scan(read_table(spark, sf_dir, "documents")))


@query("op5_mixture")
def op5(spark, sf_dir):
    return mixture.calibrate(read_table(spark, sf_dir, "documents"), token_share=mixture.TOKEN_SHARE)[0]


@query("op11_importance_resampling")
def op11(spark, sf_dir):
    docs, target = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return importance_resampling.resample(docs, target, percent=5, least_words=20, seed=42).select(
        "doc_id", "n_features", "weight", "score", "rank")


@query("op13_vector_codes", vector_codes.oracle())
def op13(spark, sf_dir):
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


@query("op12_embedding_dedup", embedding_dedup.oracle())
def op12(spark, sf_dir):
    return embedding_dedup.similar_vectors(read_table(spark, sf_dir, "embeddings"), threshold=0.93)
