"""Nearest-neighbour queries over ``embeddings`` (train = vec_id % 10 < 7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import knn as K
from ..sources.tables import read_table
from ._base import r6, register

DIST = """sqrt(list_reduce(list_transform(generate_series(1, len(a.embedding)), lambda i:
  (CAST(a.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE)) * (CAST(a.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE))),
  lambda s, v: s + v))"""
BRUTE = f"""
tr AS (SELECT * FROM embeddings WHERE vec_id % 10 < 7),
te AS (SELECT * FROM embeddings WHERE vec_id % 10 >= 7),
nb AS (SELECT q_id, r_id, label, row_number() OVER (PARTITION BY q_id ORDER BY dist, r_id) AS rk FROM (
  SELECT a.vec_id AS q_id, b.vec_id AS r_id, b.label, {DIST} AS dist FROM {{queries}} a, tr b))"""


def _split(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return e.filter(F.col("vec_id") % 10 < 7), e.filter(F.col("vec_id") % 10 >= 7)


@register("knn_join", "WITH " + BRUTE.format(queries="te") + """,
v AS (SELECT q_id, label, count(*) AS n FROM nb WHERE rk <= 5 GROUP BY q_id, label),
p AS (SELECT q_id, arg_min(label, (-n, label)) AS predicted FROM v GROUP BY q_id)
SELECT te.vec_id, te.label, p.predicted FROM te JOIN p ON p.q_id = te.vec_id""")
def knn_join(spark, sf):
    """5 nearest training vectors per test vector, majority label."""
    train, test = _split(spark, sf)
    neigh = K.knn(train, test, 5)
    pred = K.majority_vote(neigh, train, 5)
    return test.select("vec_id", "label").join(pred.withColumnRenamed("q_id", "vec_id"), "vec_id")


@register("knn_sweep", "WITH " + BRUTE.format(queries="(SELECT * FROM embeddings)") + """,
ks AS (SELECT unnest(generate_series(1, 25)) AS k),
v AS (SELECT k, q_id, label, count(*) AS n FROM nb, ks WHERE rk <= k GROUP BY k, q_id, label),
p AS (SELECT k, q_id, arg_min(label, (-n, label)) AS predicted FROM v GROUP BY k, q_id)
SELECT CAST(p.k AS INT) AS k,
  round(avg(CASE WHEN e.vec_id % 10 < 7 THEN CASE WHEN predicted = e.label THEN 1.0 ELSE 0.0 END END), 6) + 0.0 AS train_accuracy,
  round(avg(CASE WHEN e.vec_id % 10 >= 7 THEN CASE WHEN predicted = e.label THEN 1.0 ELSE 0.0 END END), 6) + 0.0 AS test_accuracy
FROM p JOIN embeddings e ON e.vec_id = p.q_id GROUP BY p.k""")
def knn_sweep(spark, sf):
    """Train and test accuracy for k = 1..25 from one neighbour ranking to
    k = 25 (train rows count themselves as a neighbour, as in scoring a
    fitted model on its own training set). Both parts come from one
    aggregation over the one ranking."""
    train, _ = _split(spark, sf)
    every = read_table(spark, sf, "embeddings")
    p = K.predictions_by_k(K.knn(train, every, 25), every, list(range(1, 26)))
    hit = (F.col("predicted") == F.col("actual")).cast("double")
    is_train = F.col("q_id") % 10 < 7
    return p.groupBy("k").agg(r6(F.avg(F.when(is_train, hit))).alias("train_accuracy"),
                              r6(F.avg(F.when(~is_train, hit))).alias("test_accuracy"))


@register("knn_cv", f"""WITH tr AS (SELECT * FROM embeddings WHERE vec_id % 10 < 7),
nb AS (SELECT q_id, r_id, label, row_number() OVER (PARTITION BY q_id ORDER BY dist, r_id) AS rk FROM (
  SELECT a.vec_id AS q_id, b.vec_id AS r_id, b.label, {DIST} AS dist FROM tr a, tr b WHERE a.vec_id % 5 <> b.vec_id % 5)),
ks AS (SELECT unnest(generate_series(1, 25)) AS k),
v AS (SELECT k, q_id, label, count(*) AS n FROM nb, ks WHERE rk <= k GROUP BY k, q_id, label),
p AS (SELECT k, q_id, arg_min(label, (-n, label)) AS predicted FROM v GROUP BY k, q_id),
a AS (SELECT CAST(p.k AS INT) AS k, avg(CASE WHEN predicted = tr.label THEN 1.0 ELSE 0.0 END) AS acc
  FROM p JOIN tr ON tr.vec_id = p.q_id GROUP BY p.k)
SELECT k, round(acc, 6) + 0.0 AS cv_accuracy, k = (SELECT min(k) FROM a WHERE acc = (SELECT max(acc) FROM a)) AS best FROM a""")
def knn_cv(spark, sf):
    """5-fold accuracy on the training rows for k = 1..25 (folds by id; a
    row's neighbours come from the other folds), and the best k."""
    train, _ = _split(spark, sf)
    train = train.withColumn("fold", F.col("vec_id") % 5)
    p = K.predictions_by_k(K.knn(train, train, 25, exclude_same="fold"), train, list(range(1, 26)))
    # the mean is over all rows, as an exact count: ties between k are real ones
    t = p.groupBy("k").agg(F.count_if(F.col("predicted") == F.col("actual")).alias("hits"), F.count("*").alias("n")).checkpoint()
    top = t.agg(F.max_by("k", F.struct("hits", -F.col("k")))).scalar()
    return t.select("k", r6(F.col("hits") / F.col("n")).alias("cv_accuracy"), (F.col("k") == top).alias("best"))
