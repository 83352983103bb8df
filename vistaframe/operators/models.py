"""Model training, search and comparison with ``pyspark.ml``.

Feature rows stay distributed end to end: ``VectorAssembler`` builds the
vector column, estimators train on executors, and the (fold, parameter map)
fits of a search run concurrently. Only fitted parameters (coefficients, a few
numbers per model) ever reach the driver.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists

FOLDS = 5


def materialize(df: DataFrame, id_col: str) -> DataFrame:
    """Cut the lineage before iterative training: rows dealt out by a hash of
    their id and written as a reliable checkpoint into ``spark.checkpoint.dir``
    (survives lost executors). The layout depends on the ids and the session's
    shuffle partitions only."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, F.xxhash64(id_col)).sortWithinPartitions(id_col).checkpoint(eager=True)


def with_fold(df: DataFrame, id_col: str, folds: int = FOLDS) -> DataFrame:
    """``fold`` 0..folds-1 from a hash of the id: the same rows whatever the partitions."""
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit("fold")))
    return df.withColumn("fold", (F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % folds).cast("int"))


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def accuracy_evaluator(label: str = "label") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="accuracy")


def cross_validate(est, maps: list[dict], train: DataFrame, score: Callable | None = None, folds: int = FOLDS,
                   parallelism: int = 8) -> list:
    """Mean validation score (a number, or a list of numbers) per parameter
    map over the folds of ``train``'s ``fold`` column. ``score(model, held rows)``; accuracy by default. Every (fold, map) is a task of its own with thread
    properties of its own."""
    spark = train.sparkSession
    score = score or (lambda model, held: accuracy_evaluator().evaluate(model.transform(held)))
    parts = {k: (train.filter(F.col("fold") != k), train.filter(F.col("fold") == k)) for k in range(folds)}

    def run(task):
        k, m = task
        fit, held = parts[k]
        return score(est.copy(maps[m]).fit(fit), held)

    tasks = [(k, m) for m in range(len(maps)) for k in range(folds)]
    with ThreadPool(parallelism) as pool:
        # one wrapped target per task: tasks that share one would share its properties
        got = [pool.apply_async(inheritable_thread_target(spark)(run), (t,)) for t in tasks]
        scores = [g.get() for g in got]
    means = np.array(scores, dtype=float).reshape(len(maps), folds, -1).mean(axis=1)
    return means[:, 0].tolist() if means.shape[1] == 1 else means.tolist()


def search_table(spark: SparkSession, maps: list[dict], scores: list[float], metric: str = "cv_accuracy") -> DataFrame:
    """One row per parameter map: every searched value and the mean score.
    (A handful of rows: the parameter maps, not data.)"""
    plain = [{p.name: (str(v) if isinstance(v, (list, tuple)) else v) for p, v in m.items()} for m in maps]
    names = sorted({n for m in plain for n in m})
    kinds = {n: {str: "string", int: "int", float: "double"}[type(next(m[n] for m in plain if n in m))] for n in names}
    schema = ", ".join(f"{n} {kinds[n]}" for n in names) + f", {metric} double"
    return spark.createDataFrame([(*(m.get(n) for n in names), float(s)) for m, s in zip(plain, scores)], schema)


def logreg_grid(n_train: int, cs: list[float]) -> list[float]:
    """sklearn's inverse strength ``C`` mapped to Spark's ``regParam``
    (lambda = 1 / (C * n))."""
    return [1.0 / (c * n_train) for c in cs]


def full_grid(axes: dict) -> list[dict]:
    return [dict(zip(axes, combo)) for combo in itertools.product(*axes.values())]


def sample_param_maps(axes: dict, draws: int, seed: int = 42) -> list[dict]:
    """``draws`` random picks (without replacement) from the full product of
    the axes - a random search over a grid."""
    combos = full_grid(axes)
    return random.Random(seed).sample(combos, min(draws, len(combos)))


def to_param_maps(est, maps: list[dict]) -> list[dict]:
    return [{est.getParam(k): v for k, v in m.items()} for m in maps]


def fit_or_load(path: str, spark: SparkSession, build):
    """Load a stored pipeline model when present, else fit, store, return."""
    if path_exists(spark, f"{path}/metadata"):
        return PipelineModel.load(path)
    model = build()
    model.write().overwrite().save(path)
    return model


def explained_variance(df: DataFrame, features: str, k: int) -> DataFrame:
    """PCA explained-variance ratios and their running total."""
    model = PCA(k=k, inputCol=features, outputCol="pc").fit(df)
    ev = [float(x) for x in model.explainedVariance.toArray()]
    rows = [(i + 1, v, sum(ev[:i + 1])) for i, v in enumerate(ev)]
    return df.sparkSession.createDataFrame(rows, "component int, explained double, cumulative double")


def positive_probability(df: DataFrame, prob_col: str = "probability", out: str = "p1") -> DataFrame:
    return df.withColumn(out, vector_to_array(F.col(prob_col))[1])
