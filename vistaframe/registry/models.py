"""Model queries (``pyspark.ml``) and the ensemble comparison.

What a learner finds depends on the learner, so a search's row holds the
searched values, the sizes it worked on and booleans that Spark derives from
the scores; those have an exact SQL twin. The functions behind the keys
(``logreg_scores`` and so on) return the scores themselves.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import random

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from ..operators import batched as B
from ..operators import ensembles as EN
from ..operators import features as FE
from ..operators import knn as K
from ..operators import models as M
from ..operators import trees as T
from ..oracle import with_
from ..plans import adapters as A
from ..session import ensure_checkpoint_dir, files_fingerprint
from ..sources.tables import read_table, table_path
from ._base import r6, register
from .aggs import VOTES_LONG
from .features import SPLIT
from .text import census_etl

NUM = ["age", "education_num", "hours_per_week", "capital_gain"]
CODED = ["sex", "from_us", "race_cat_0", "race_cat_1", "race_cat_2",
         "workclass_cat_0", "workclass_cat_1", "workclass_cat_2", "workclass_cat_3"]
FEATURES = [f"sc_{c}" for c in NUM] + CODED


def census_model_frame(spark, sf):
    """census ETL -> one-hot -> stratified split -> train-fitted scaling ->
    feature vector and fold; ``label`` = income code."""
    e = census_etl(spark, sf)
    e = FE.one_hot(FE.one_hot(e, "race_cat", [0, 1, 2]), "workclass_cat", [0, 1, 2, 3])
    e = FE.stratified_split(e, "income", "id")
    e = FE.standard_scale(e, NUM)
    e = e.withColumn("label", F.col("income").cast("double"))
    return M.with_fold(M.assemble(e, FEATURES), "id")


def _train_test(spark, sf):
    df = M.materialize(census_model_frame(spark, sf), "id")
    return df.filter(F.col("split") == "train"), df.filter(F.col("split") == "test")


def _majority(df) -> float:
    """Share of the larger class."""
    return df.agg(F.greatest(F.avg("label"), 1 - F.avg("label"))).first()[0]


SIZES = {"s": SPLIT, "z": """SELECT count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'test') AS n_test,
  count(*) FILTER (split = 'train' AND ('0x' || substr(md5(CAST(id AS VARCHAR) || 'fold'), 1, 8))::BIGINT % 5 = 0) AS n_fold0 FROM s"""}


def _sized(sql_rows: str, columns: str) -> str:
    return with_("census", extra=SIZES) + f"SELECT {columns}, n_train, n_fold0 FROM ({sql_rows}), z"


def _values(rows: list[tuple], names: list[str]) -> str:
    text = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else repr(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {text}) t({', '.join(names)})"


def _checked(table, train, names: list[str], metric: str = "cv_accuracy"):
    """The searched values with the sizes, whether every score is a share and
    whether the best one is no worse than always saying the larger class."""
    best = table.agg(F.max(metric)).first()[0]
    n_train, n_fold0 = train.agg(F.count("*"), F.count_if(F.col("fold") == 0)).first()
    return table.select(*names, F.lit(n_train).cast("long").alias("n_train"), F.lit(n_fold0).cast("long").alias("n_fold0"),
                        F.col(metric).between(0, 1).alias("in_range"),
                        F.lit(best >= _majority(train) - 0.02).alias("best_reaches_majority"))


OK = "true AS in_range, true AS best_reaches_majority"


@register("pca_variance", "SELECT CAST(unnest(range(1, 14)) AS INT) AS component, 13 AS n_features, true AS shares_fall, "
          "true AS shares_sum_to_one, true AS first_covers_largest_column")
def pca_variance(spark, sf):
    """Principal components of all train features, unscaled (the money column dominates)."""
    tr, _ = _train_test(spark, sf)
    ev = pca_shares(tr)
    cols = NUM + CODED
    var = tr.agg(*[F.var_samp(c).alias(c) for c in cols]).first()
    rows = ev.orderBy("component").collect()
    falls = all(a["explained"] >= b["explained"] - 1e-12 for a, b in zip(rows, rows[1:]))
    covers = rows[0]["explained"] >= max(var) / sum(var) - 1e-9
    return ev.select("component", F.lit(len(cols)).alias("n_features"), F.lit(falls).alias("shares_fall"),
                     F.lit(abs(rows[-1]["cumulative"] - 1) < 1e-9).alias("shares_sum_to_one"),
                     F.lit(covers).alias("first_covers_largest_column"))


def pca_shares(train):
    cols = NUM + CODED
    return M.explained_variance(M.assemble(train.drop("features"), cols, "raw"), "raw", len(cols))


@register("pca_component_shares")
def pca_component_shares(spark, sf):
    """The explained shares behind ``pca_variance`` (no SQL: tested against the eigenvalues)."""
    return pca_shares(_train_test(spark, sf)[0])


STRENGTHS = 15


def strengths() -> list[float]:
    return [10 ** (-5 + i * 13 / 14) for i in range(STRENGTHS)]


def logreg_models(tr) -> tuple[list[float], np.ndarray, B.Blocks]:
    """Coefficients per strength and fold left out (the last: none), in one batch of Newton steps."""
    cs = strengths()
    blocks = B.Blocks(tr)
    held = np.tile([*range(M.FOLDS), B.ALL], len(cs))
    w = B.newton(blocks, np.repeat([1.0 / c for c in cs], M.FOLDS + 1), held)
    return cs, w.reshape(len(cs), M.FOLDS + 1, -1), blocks


def logreg_scores(tr, te):
    """Per inverse strength C = 10^-5 .. 10^8: CV, train and test accuracy."""
    cs, w, blocks = logreg_models(tr)
    flat = w.reshape(-1, w.shape[-1])
    zero = np.zeros((2, M.FOLDS + 1, len(flat)))
    inside = B.accuracies(blocks.total(B.linear_hits, (flat, M.FOLDS), zero)).reshape(M.FOLDS + 1, len(cs), M.FOLDS + 1)
    tested = B.Blocks(te)
    outside = B.accuracies(tested.total(B.linear_hits, (flat, M.FOLDS), zero)).reshape(M.FOLDS + 1, len(cs), M.FOLDS + 1)
    blocks.release()
    tested.release()
    n = tr.count()
    rows = [(i, c, 1.0 / (c * max(n, 1)), float(np.mean([inside[k, i, k] for k in range(M.FOLDS)])),
             float(inside[-1, i, -1]), float(outside[-1, i, -1])) for i, c in enumerate(cs)]
    return tr.sparkSession.createDataFrame(
        rows, "step int, c double, regParam double, cv_accuracy double, train_accuracy double, test_accuracy double")


@register("logreg_sweep_scores")
def logreg_sweep_scores(spark, sf):
    """The accuracies behind ``logreg_sweep`` (no SQL: tested against a twin)."""
    return logreg_scores(*_train_test(spark, sf))


@register("logreg_coefficients")
def logreg_coefficients(spark, sf):
    """Coefficient of every feature at every strength, fitted on all train rows."""
    tr, _ = _train_test(spark, sf)
    cs, w, blocks = logreg_models(tr)
    blocks.release()
    rows = [(i, c, name, float(v)) for i, c in enumerate(cs) for name, v in zip([*FEATURES, "intercept"], w[i, -1])]
    return spark.createDataFrame(rows, "step int, c double, feature string, coef double")


@register("logreg_sweep", _sized(f"SELECT CAST(unnest(range(0, {STRENGTHS})) AS INT) AS step", "step")
          .replace(", n_train", f", {OK}, true AS train_and_test_in_range, n_train"))
def logreg_sweep(spark, sf):
    tr, te = _train_test(spark, sf)
    t = logreg_scores(tr, te)
    both = F.col("train_accuracy").between(0, 1) & F.col("test_accuracy").between(0, 1)
    return _checked(t.withColumn("train_and_test_in_range", both), tr, ["step", "train_and_test_in_range"])


def importances(tr):
    """Logistic coefficients and boosted-tree importances by feature name."""
    lr = LogisticRegression(featuresCol="features", labelCol="label", regParam=0.01, maxIter=100).fit(tr)
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxIter=20, seed=42).fit(tr)
    rows = [(name, float(c), float(w)) for name, c, w in
            zip(FEATURES, lr.coefficients.toArray(), gbt.featureImportances.toArray())]
    return tr.sparkSession.createDataFrame(rows, "feature string, coef double, importance double")


@register("coef_importance", "SELECT feature, true AS coef_finite, true AS importance_in_range, true AS importances_sum_to_one, "
          f"true AS some_above_cut FROM (SELECT unnest([{', '.join(repr(f) for f in FEATURES)}]) AS feature)")
def coef_importance(spark, sf):
    """Coefficients and importances of every feature; cuts: 0.2 and 0.05."""
    tr, _ = _train_test(spark, sf)
    t = importances(tr)
    total, above = t.agg(F.sum("importance"), F.count_if(F.col("importance") > 0.05)).first()
    return t.select("feature", (~F.isnan("coef") & (F.abs("coef") < 1e6)).alias("coef_finite"),
                    F.col("importance").between(0, 1).alias("importance_in_range"),
                    F.lit(abs(total - 1) < 1e-6).alias("importances_sum_to_one"), F.lit(above > 0).alias("some_above_cut"))


@register("coef_importance_values")
def coef_importance_values(spark, sf):
    """The coefficients and importances behind ``coef_importance`` by feature."""
    return importances(_train_test(spark, sf)[0])


# The axes of the keys; the scores' own grid has the least number of rows to split as well.
TREE_AXES = {"maxDepth": list(range(1, 10)), "minInstancesPerNode": [1, 2, 3, 4], "impurity": ["gini", "entropy"]}
SPLIT_AXIS = {"minRowsToSplit": list(range(2, 11))}
TREE_DRAWS = 20


def _kind(point: dict) -> tuple:
    return tuple(sorted((k, v) for k, v in point.items() if k != "maxDepth"))


def grown_trees(blocks: T.Binned, maps: list[dict], held: list[int]) -> tuple[list[tuple], T.Forest, np.ndarray]:
    """Points that differ in depth only are one tree per held fold, read at several depths: (kinds of points,
    their trees, accuracy by depth, fold and tree)."""
    deepest, kinds = max(m["maxDepth"] for m in maps), sorted({_kind(m) for m in maps})
    forest = T.grow(blocks, [{**dict(k), "maxDepth": deepest} for k in kinds], held)
    return kinds, forest, T.tree_accuracies(blocks, forest, deepest, M.FOLDS)


def tree_scores(tr, maps: list[dict]):
    """Mean accuracy over the folds left out, per point."""
    blocks = T.Binned(tr)
    kinds, _, by_fold = grown_trees(blocks, maps, list(range(M.FOLDS)))
    blocks.release()

    def score(m):
        kind = kinds.index(_kind(m))
        return float(np.mean([by_fold[m["maxDepth"] - 1, k, kind * M.FOLDS + k] for k in range(M.FOLDS)]))

    names = sorted(maps[0])
    kind = ", ".join(f"{n} {'string' if n == 'impurity' else 'int'}" for n in names)
    return tr.sparkSession.createDataFrame([(*(m[n] for n in names), score(m)) for m in maps], f"{kind}, cv_accuracy double")


def _tree_sql(maps: list[dict]) -> str:
    names = sorted(TREE_AXES)
    return _sized(_values([tuple(m[n] for n in names) for m in maps], names), ", ".join(names)).replace(
        ", n_train", f", {OK}, n_train")


@register("tree_random_search", _tree_sql(M.sample_param_maps(TREE_AXES, TREE_DRAWS)))
def tree_random_search(spark, sf):
    tr, _ = _train_test(spark, sf)
    return _checked(tree_scores(tr, M.sample_param_maps(TREE_AXES, TREE_DRAWS)), tr, sorted(TREE_AXES))


@register("tree_grid_search", _tree_sql(M.full_grid(TREE_AXES)))
def tree_grid_search(spark, sf):
    tr, _ = _train_test(spark, sf)
    return _checked(tree_scores(tr, M.full_grid(TREE_AXES)), tr, sorted(TREE_AXES))


@register("tree_grid_scores")
def tree_grid_scores(spark, sf):
    """Accuracy of all 648 points, the least number of rows to split among them (no SQL: tested against a twin)."""
    return tree_scores(_train_test(spark, sf)[0], M.full_grid(TREE_AXES | SPLIT_AXIS))


@register("tree_random_scores")
def tree_random_scores(spark, sf):
    """Accuracy of 20 draws from the 648 points (no SQL: tested against a twin)."""
    return tree_scores(_train_test(spark, sf)[0], M.sample_param_maps(TREE_AXES | SPLIT_AXIS, TREE_DRAWS))


MLP_AXES = {"hidden": [(50, 50, 50), (50, 100, 50), (100,)], "activation": ["tanh", "relu"], "solver": ["sgd", "adam"],
            "alpha": [0.01, 0.1]}
MLP_DRAWS, MLP_ROUNDS = 10, 300


def _mlp_draws() -> list[dict]:
    return M.sample_param_maps(MLP_AXES, MLP_DRAWS)


def mlp_networks(tr, rounds: int | None = None) -> tuple[list[B.Network], B.Blocks]:
    """The networks of all draws and folds, trained in one batch."""
    nets = [B.Network(m["hidden"], m["activation"], m["solver"], m["alpha"], k) for m in _mlp_draws() for k in range(M.FOLDS)]
    blocks = B.Counted(tr)
    B.train_networks(blocks, nets, rounds or MLP_ROUNDS)
    return nets, blocks


def mlp_scores(tr):
    """Mean accuracy over the folds left out, per draw."""
    nets, blocks = mlp_networks(tr)
    by_fold = B.network_accuracies(blocks, nets, M.FOLDS)
    blocks.release()
    scores = [float(np.mean([by_fold[k, i * M.FOLDS + k] for k in range(M.FOLDS)])) for i in range(len(nets) // M.FOLDS)]
    rows = [(str(list(m["hidden"])), m["activation"], m["solver"], m["alpha"], x) for m, x in zip(_mlp_draws(), scores)]
    return tr.sparkSession.createDataFrame(rows, "layers string, activation string, solver string, alpha double, cv_accuracy double")


@register("mlp_classify", _sized(_values([(str(list(m["hidden"])), m["activation"], m["solver"], m["alpha"]) for m in _mlp_draws()],
                                         ["layers", "activation", "solver", "alpha"]),
                                 "layers, activation, solver, CAST(alpha AS DOUBLE) AS alpha").replace(", n_train", f", {OK}, n_train"))
def mlp_classify(spark, sf):
    tr, _ = _train_test(spark, sf)
    return _checked(mlp_scores(tr), tr, ["layers", "activation", "solver", "alpha"])


@register("mlp_scores")
def mlp_search_scores(spark, sf):
    """The accuracies behind ``mlp_classify`` (no SQL: gradients are tested numerically)."""
    return mlp_scores(_train_test(spark, sf)[0])


def _subsets_sql() -> str:
    vals = []
    for r in (2, 3, 4):
        for combo in itertools.combinations("abcd", r):
            vals.extend(f"('{'+'.join(combo)}', '{m}')" for m in combo)
    return "SELECT * FROM (VALUES " + ", ".join(vals) + ") t(subset, model)"


@register("soft_vote", with_("votes", extra={"vl": VOTES_LONG, "sub": _subsets_sql()}) + """
SELECT subset, round(avg(CASE WHEN CAST(p > 0.5 AS INT) = y THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS accuracy, count(*) AS n
FROM (SELECT subset, id, y, list_reduce(list_sort(list(p)), lambda a, x: a + x) / count(*) AS p
      FROM vl JOIN sub ON vl.model = sub.model GROUP BY subset, id, y) GROUP BY subset""")
def soft_vote(spark, sf):
    """Every subset of 2..4 of the given models, averaging probabilities
    (summed in sorted order so the vote does not depend on row order)."""
    v = A.votes(spark, sf)
    sv = EN.soft_vote_wide(v, {"a": "p_a", "b": "p_b", "c": "p_c", "d": "p_d"}, label="y")
    return sv.select("subset", r6("accuracy").alias("accuracy"), "n")


STACK_MODELS = ["logreg", "tree", "mlp", "vote", "stack"]  # the rows of the key; the scores hold the neighbours' too
NEIGHBOURS = list(range(1, 26))


def _stack_layers() -> list[dict]:
    """The networks that the stack chooses from: the draws of the search."""
    return [{**m, "layers": [len(FEATURES), *m["hidden"], 2]} for m in _mlp_draws()]


def _best(by_point: list[np.ndarray]) -> int:
    """The point of the best mean accuracy over the folds left out (ties: the first)."""
    means = [float(np.mean(a)) for a in by_point]
    return min(range(len(means)), key=lambda k: (-means[k], k))


def searched_bases(tr) -> dict:
    """The best model of each search with those of its folds, as functions from rows to probabilities. The searches
    have trained a model without each fold and one on all rows, so nothing is fitted again."""
    held, per, folds = [*range(M.FOLDS), B.ALL], M.FOLDS + 1, range(M.FOLDS)
    cs, w, blocks = logreg_models(tr)
    hits = B.accuracies(blocks.total(B.linear_hits, (w.reshape(len(cs) * per, -1), M.FOLDS), np.zeros((2, per, len(cs) * per))))
    bases = {"logreg": functools.partial(B.linear_shares, weights=w[_best([hits[folds, [i * per + k for k in folds]] for i in range(len(cs))])])}

    maps = M.full_grid(TREE_AXES)
    binned = T.Binned(tr)
    kinds, forest, by_fold = grown_trees(binned, maps, held)
    binned.release()
    best = maps[_best([by_fold[m["maxDepth"] - 1, folds, [kinds.index(_kind(m)) * per + k for k in folds]] for m in maps])]
    own = np.arange(per) + kinds.index(_kind(best)) * per
    bases["tree"] = functools.partial(T.tree_shares, cuts=binned.cuts, trees=forest.arrays(own), sums=forest.sums[own], depth=best["maxDepth"])

    points = _stack_layers()
    nets = [B.Network(tuple(p["layers"][1:-1]), p.get("activation", "tanh"), p.get("solver", "adam"), p.get("alpha", 0.01), k)
            for p in points for k in held]
    blocks.release()
    blocks = B.Counted(tr)
    B.train_networks(blocks, nets, MLP_ROUNDS)
    hits = B.network_accuracies(blocks, nets, M.FOLDS)
    blocks.release()
    best = _best([hits[folds, [i * per + k for k in folds]] for i in range(len(points))])
    bases["mlp"] = functools.partial(B.network_shares, nets=[(n.weights, n.activation) for n in nets[best * per:(best + 1) * per]])
    return bases


def neighbour_shares(tr, te):
    """``(id, p_knn)`` of the train rows, from the other folds, and of the test
    rows: the share of label 1 among the k nearest train rows, and the k of the
    best out-of-fold accuracy (ties: the smallest)."""
    tr, te = (d.select("id", "label", "fold", vector_to_array("features").alias("vector")) for d in (tr, te))
    unseen = K.labels_in_order(K.knn_by_region(tr, tr, max(NEIGHBOURS), id_col="id", vec="vector", exclude_same="fold"),
                               tr, id_col="id").checkpoint()
    best = K.hits_by_k(unseen, tr, NEIGHBOURS, id_col="id").agg(F.max_by("k", F.struct("hits", -F.col("k")))).first()[0]

    def shares(near):
        some = F.filter("near", lambda v: (v["rank"] <= best) & v["label"].isNotNull())
        total = F.aggregate(some, F.lit(0.0), lambda a, v: a + v["label"])
        return near.select(F.col("q_id").alias("id"), F.try_divide(total, F.size(some)).alias("p_knn"))

    tested = K.knn_by_region(tr, te, best, id_col="id", vec="vector")
    return shares(unseen), shares(K.labels_in_order(tested, tr, id_col="id")), best


def stacking_scores(tr, te):
    """Second-level logistic regression on the probabilities of the base
    models (the best of each search, and nearest neighbours), of their best
    soft vote, and on the original features. The second level learns from
    out-of-fold probabilities."""
    bases = searched_bases(tr)
    near_train, near_test, _ = neighbour_shares(tr, te)
    unseen = B.add_shares(tr, bases, F.col("fold")).join(near_train, "id").checkpoint()
    tested = B.add_shares(te, bases, F.lit(-1)).join(near_test, "id").checkpoint()
    names = [*bases, "knn"]
    votes = EN.soft_vote_wide(unseen, {k: f"p_{k}" for k in names}, label="label")
    best = votes.orderBy(F.col("accuracy").desc(), "subset").first()["subset"].split("+")
    vote = sum((F.col(f"p_{k}") for k in best), F.lit(0.0)) / len(best)
    inputs = [f"p_{k}" for k in names] + ["p_vote", "features"]
    second = LogisticRegression(featuresCol="meta", labelCol="label", maxIter=100)
    model = second.fit(M.assemble(unseen.withColumn("p_vote", vote), inputs, "meta"))
    scored = model.transform(M.assemble(tested.withColumn("p_vote", vote), inputs, "meta"))
    scored = M.positive_probability(scored, out="p_stack")
    shown = [*names, "vote", "stack"]
    hits = [F.avg(((F.col(f"p_{k}") > 0.5).cast("double") == F.col("label")).cast("double")).alias(k) for k in shown]
    row = scored.agg(*hits).first()
    return tr.sparkSession.createDataFrame([(k, float(row[k])) for k in shown], "model string, test_accuracy double")


@register("stacking_accuracies")
def stacking_accuracies(spark, sf):
    """The test accuracies behind ``stacking``, the neighbours' among them (no SQL: the parts are tested against twins)."""
    return stacking_scores(*_train_test(spark, sf))


@register("stacking", with_("census", extra=SIZES) + f"SELECT model, n_test, true AS in_range, true AS stack_reaches_majority FROM "
          f"(SELECT unnest({STACK_MODELS!r}) AS model), z")
def stacking(spark, sf):
    tr, te = _train_test(spark, sf)
    t = stacking_scores(tr, te).filter(F.col("model").isin(STACK_MODELS))
    stack = t.filter(F.col("model") == "stack").first()["test_accuracy"]
    return t.select("model", F.lit(te.count()).cast("long").alias("n_test"), F.col("test_accuracy").between(0, 1).alias("in_range"),
                    F.lit(stack >= _majority(te) - 0.1).alias("stack_reaches_majority"))


GBT_AXES = {"maxDepth": [3, 4, 5], "stepSize": [0.01, 0.05, 0.1]}
GBT_ROUNDS = [100, 200, 300]


def gbt_scores(tr):
    """With Spark's own learner, a fit per (fold, point): mean log loss over the validation folds for every depth, rate and number of
    rounds. Boosting with fewer rounds is a prefix of boosting with more, so a
    (depth, rate) is fitted once, to the largest number."""
    gbt = GBTClassifier(featuresCol="features", labelCol="label", seed=42, maxIter=max(GBT_ROUNDS))
    maps = M.to_param_maps(gbt, M.full_grid(GBT_AXES))
    losses = M.cross_validate(gbt, maps, tr,
                              score=lambda model, held: [model.evaluateEachIteration(held)[r - 1] for r in GBT_ROUNDS])
    rows = [(m[gbt.maxDepth], m[gbt.stepSize], r, x) for m, loss in zip(maps, losses) for r, x in zip(GBT_ROUNDS, loss)]
    return tr.sparkSession.createDataFrame(rows, "maxDepth int, stepSize double, maxIter int, log_loss double")


def boosted_losses(tr):
    """Mean log loss over the folds left out for every depth, rate and number of
    rounds. Boosting with fewer rounds is a prefix of boosting with more, so a
    (depth, rate) is boosted once per fold, all of them together."""
    points = M.full_grid(GBT_AXES)
    held = np.tile(range(M.FOLDS), len(points))
    depths, rates = (np.repeat([p[n] for p in points], M.FOLDS) for n in ("maxDepth", "stepSize"))
    blocks, seen = T.Binned(tr, models=len(held)), {}
    watch = {r: lambda r=r: seen.__setitem__(r, blocks.total(T.margin_scores, M.FOLDS)) for r in GBT_ROUNDS}
    T.boost(blocks, held, depths, rates, np.full(len(held), max(GBT_ROUNDS)), watch)
    blocks.release()
    rows = [(p["maxDepth"], p["stepSize"], r, _left_out(seen[r], 0, i)) for i, p in enumerate(points) for r in GBT_ROUNDS]
    return tr.sparkSession.createDataFrame(rows, "maxDepth int, stepSize double, maxIter int, log_loss double")


def _left_out(sums: np.ndarray, what: int, point: int, per_point: int = M.FOLDS, finish=lambda mean: mean) -> float:
    """Mean over the folds of a point's score on the fold left out."""
    return float(np.mean([finish(sums[what, k, point * per_point + k] / max(sums[3, k, 0], 1.0)) for k in range(M.FOLDS)]))


@register("gbt_search_scores")
def gbt_search_scores(spark, sf):
    """The log losses behind ``gbt_classify`` (no SQL: tested against a twin)."""
    return boosted_losses(_train_test(spark, sf)[0])


@register("gbt_classify", _sized(_values([(d, x, r) for d in GBT_AXES["maxDepth"] for x in GBT_AXES["stepSize"] for r in GBT_ROUNDS],
                                         ["maxDepth", "stepSize", "maxIter"]),
                                 "maxDepth, CAST(stepSize AS DOUBLE) AS stepSize, maxIter, true AS loss_positive, true AS best_below_start"))
def gbt_classify(spark, sf):
    tr, _ = _train_test(spark, sf)
    t = boosted_losses(tr)
    best = t.agg(F.min("log_loss")).first()[0]
    n_train, n_fold0 = tr.agg(F.count("*"), F.count_if(F.col("fold") == 0)).first()
    # before the first round: log(2)
    return t.select("maxDepth", "stepSize", "maxIter", F.lit(n_train).cast("long").alias("n_train"),
                    F.lit(n_fold0).cast("long").alias("n_fold0"), (F.col("log_loss") > 0).alias("loss_positive"),
                    F.lit(best < 0.6931471805599453).alias("best_below_start"))


RANDOM_DRAWS = 13


def random_draws() -> list[dict]:
    rnd = random.Random(42)
    return [{"maxDepth": rnd.randint(3, 10), "maxIter": rnd.randint(100, 200), "stepSize": round(1 - rnd.random(), 6)}
            for _ in range(RANDOM_DRAWS)]


def random_search_scores(tr, te):
    """With Spark's own learner: root mean squared error of the probability, mean of the validation folds, per
    draw, and of the best draw (fitted on all train rows) on the test rows."""
    gbt = GBTClassifier(featuresCol="features", labelCol="label", seed=42)
    maps = M.to_param_maps(gbt, random_draws())

    def rmse(model, held):
        p = M.positive_probability(model.transform(held), out="p")
        return p.agg(F.sqrt(F.avg(F.pow(F.col("p") - F.col("label"), 2)))).first()[0]

    scores = M.cross_validate(gbt, maps, tr, score=rmse)
    best = min(range(len(maps)), key=lambda k: (scores[k], k))
    t = M.search_table(tr.sparkSession, maps, scores, "rmse")
    return t, rmse(gbt.copy(maps[best]).fit(tr), te)


def boosted_errors(tr, te):
    """Root mean squared error of the probability, mean of the folds left out, per
    draw, and of the best draw on the test rows. Per draw, a model on all train rows
    is boosted beside those of the folds."""
    draws, per = random_draws(), M.FOLDS + 1
    held = np.tile([*range(M.FOLDS), B.ALL], len(draws))
    depths, rates, rounds = (np.repeat([d[n] for d in draws], per) for n in ("maxDepth", "stepSize", "maxIter"))
    both = tr.unionByName(te.withColumn("fold", F.lit(T.UNSEEN)))
    blocks = T.Binned(both, models=len(held))
    T.boost(blocks, held, depths, rates, rounds)
    sums = blocks.total(T.margin_scores, M.FOLDS)
    blocks.release()
    scores = [_left_out(sums, 1, i, per, np.sqrt) for i in range(len(draws))]
    best = min(range(len(draws)), key=lambda k: (scores[k], k))
    rows = [(d["maxDepth"], d["maxIter"], d["stepSize"], x) for d, x in zip(draws, scores)]
    table = tr.sparkSession.createDataFrame(rows, "maxDepth int, maxIter int, stepSize double, rmse double")
    return table, float(np.sqrt(sums[1, -1, best * per + M.FOLDS] / max(sums[3, -1, 0], 1.0)))


@register("random_search_errors")
def random_search_errors(spark, sf):
    """The errors behind ``random_search``, the best draw's test error beside it (no SQL: tested against a twin)."""
    table, error = boosted_errors(*_train_test(spark, sf))
    low = table.agg(F.min("rmse")).first()[0]
    return table.withColumn("test_rmse", F.when(F.col("rmse") == low, F.lit(error)))


@register("random_search", _sized(_values([(m["maxDepth"], m["maxIter"], m["stepSize"]) for m in random_draws()],
                                          ["maxDepth", "maxIter", "stepSize"]),
                                  "maxDepth, maxIter, CAST(stepSize AS DOUBLE) AS stepSize, true AS in_range, true AS test_in_range"))
def random_search(spark, sf):
    """Uniform draws of boosting parameters."""
    tr, te = _train_test(spark, sf)
    t, test_rmse = boosted_errors(tr, te)
    n_train, n_fold0 = tr.agg(F.count("*"), F.count_if(F.col("fold") == 0)).first()
    return t.select("maxDepth", "maxIter", "stepSize", F.lit(n_train).cast("long").alias("n_train"),
                    F.lit(n_fold0).cast("long").alias("n_fold0"), F.col("rmse").between(0, 1).alias("in_range"),
                    F.lit(0 <= test_rmse <= 1).alias("test_in_range"))


def _tracks_keyed(spark, sf):
    li = read_table(spark, sf, "lineitem")
    part = read_table(spark, sf, "part")
    return (li.join(part, li.l_partkey == part.p_partkey)
              .select("l_orderkey", "l_linenumber", "l_partkey", F.year("l_shipdate").cast("double").alias("year"),
                      (F.col("l_extendedprice") / 200).alias("duration"), (F.col("l_quantity") / 50).alias("artist_familiarity"),
                      (F.col("l_discount") * 10).alias("artist_hotttnesss"), F.col("p_size").cast("double").alias("size"))
              .withColumn("fold", F.conv(F.substring(F.md5(F.concat_ws(
                  "-", "l_orderkey", "l_linenumber", "l_partkey")), 1, 8), 16, 10).cast("bigint") % 10))


def forest_predictions(spark, sf):
    """Forest trained on 70 % of the rows predicts the year of the rest; the
    prediction stays beside its own row (keyed, no positional paste)."""
    t = M.materialize(M.assemble(_tracks_keyed(spark, sf), ["duration", "artist_familiarity", "artist_hotttnesss", "size"]),
                      "l_orderkey")
    rf = RandomForestRegressor(featuresCol="features", labelCol="year", numTrees=20, maxDepth=6, seed=42)
    model = rf.fit(t.filter(F.col("fold") < 7))
    pred = model.transform(t.filter(F.col("fold") >= 7))
    return (pred.select("l_orderkey", "l_linenumber", "year", F.col("prediction").alias("predicted_year")),
            t.filter(F.col("fold") < 7).agg(F.min("year"), F.max("year"), F.avg("year")).first())


@register("rf_predicted_years")
def rf_predicted_years(spark, sf):
    """The predicted year beside the real one, per held-out row (no SQL: a forest's draws are Spark's own)."""
    return forest_predictions(spark, sf)[0]


@register("rf_predict", """
SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS DOUBLE) AS year, true AS in_train_range, true AS near_mean_error
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE ('0x' || substr(md5(l_orderkey || '-' || l_linenumber || '-' || l_partkey), 1, 8))::BIGINT % 10 >= 7""")
def rf_predict(spark, sf):
    """Held-out rows; whether the prediction lies among the years of training,
    and whether the squared error is at most 2 % over that of the train mean."""
    pred, (low, high, mean) = forest_predictions(spark, sf)
    mse, base = pred.agg(F.avg(F.pow(F.col("predicted_year") - F.col("year"), 2)), F.avg(F.pow(F.lit(mean) - F.col("year"), 2))).first()
    return pred.select("l_orderkey", "l_linenumber", "year", F.col("predicted_year").between(low, high).alias("in_train_range"),
                       F.lit(mse <= 1.02 * base).alias("near_mean_error"))


@register("model_cache", with_("census", extra={"s": SPLIT}) + """
SELECT id, CAST(CASE income WHEN '>50K' THEN 1 ELSE 0 END AS DOUBLE) AS label, true AS valid_class, true AS reload_agrees
FROM s WHERE split = 'test'""")
def model_cache(spark, sf):
    """Fit once and store the pipeline in the shared folder; later calls load
    it. The stored model belongs to the input files as they are now."""
    key = hashlib.sha1((sf + files_fingerprint(spark, [table_path(sf, t) for t in ("customer", "orders", "nation")])).encode()).hexdigest()[:16]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/vistaframe/models/logreg-{key}"
    tr, te = _train_test(spark, sf)
    lr = LogisticRegression(featuresCol="features", labelCol="label", regParam=0.01, maxIter=100)
    fitted = Pipeline(stages=[lr])
    model = M.fit_or_load(path, spark, lambda: fitted.fit(tr))
    again = M.fit_or_load(path, spark, lambda: fitted.fit(tr))  # from the store
    both = again.transform(model.transform(te).select("id", "label", "features", F.col("prediction").alias("first")))
    return both.select("id", "label", F.col("prediction").isin(0.0, 1.0).alias("valid_class"),
                       (F.col("first") == F.col("prediction")).alias("reload_agrees"))
