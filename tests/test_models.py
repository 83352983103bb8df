"""Searches: every point is scored, the same way each time, on folds that don't depend on partitions."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from tests.conftest import SF_SMALL
from vistaframe.operators import models as M
from vistaframe.registry import models as RM


@pytest.fixture(scope="module")
def parts(spark):
    return RM._train_test(spark, SF_SMALL)


def test_every_model_key_has_an_oracle():
    keys = {"pca_variance", "logreg_sweep", "coef_importance", "tree_random_search", "tree_grid_search", "mlp_classify",
            "soft_vote", "stacking", "gbt_classify", "random_search", "rf_predict", "model_cache", "knn_join", "knn_sweep", "knn_cv"}
    assert keys <= set(oracle_sql()) and keys <= set(queries())


def test_full_axes():
    assert len(M.full_grid(RM.TREE_AXES)) == 9 * 4 * 2
    assert RM.GBT_ROUNDS == [100, 200, 300] and len(M.full_grid(RM.GBT_AXES)) == 9
    assert len(RM.random_draws()) == 13 and len(RM._mlp_draws()) == 10


def test_folds_do_not_depend_on_partitions(spark):
    df = spark.range(500)
    a = {r["id"]: r["fold"] for r in M.with_fold(df.repartition(7), "id").collect()}
    b = {r["id"]: r["fold"] for r in M.with_fold(df.coalesce(1), "id").collect()}
    assert a == b and set(a.values()) == set(range(5))


def test_search_repeats(parts):
    """Concurrent fits don't disturb each other: five runs, the same scores."""
    tr, _ = parts
    dt = DecisionTreeClassifier(featuresCol="features", labelCol="label", seed=42)
    maps = M.to_param_maps(dt, M.full_grid({"maxDepth": [2, 5], "impurity": ["gini", "entropy"]}))
    first = M.cross_validate(dt, maps, tr)
    assert len(first) == 4 and all(0 < x <= 1 for x in first)
    assert all(M.cross_validate(dt, maps, tr) == first for _ in range(4))


def test_search_table_keeps_every_axis(parts):
    tr, _ = parts
    dt = DecisionTreeClassifier()
    maps = M.to_param_maps(dt, M.full_grid(RM.TREE_AXES))
    rows = M.search_table(tr.sparkSession, maps, [0.5] * len(maps)).collect()
    assert len({(r["maxDepth"], r["minInstancesPerNode"], r["impurity"]) for r in rows}) == 72


def test_boosting_prefixes(parts, monkeypatch):
    monkeypatch.setattr(RM, "GBT_ROUNDS", [1, 3])
    monkeypatch.setattr(RM, "GBT_AXES", {"maxDepth": [2], "stepSize": [0.1]})
    rows = {r["maxIter"]: r["log_loss"] for r in RM.gbt_scores(parts[0]).collect()}
    assert set(rows) == {1, 3} and all(x > 0 for x in rows.values())


def test_random_search_scores(parts, monkeypatch):
    monkeypatch.setattr(RM, "random_draws", lambda: [{"maxDepth": 2, "maxIter": n, "stepSize": 0.1} for n in (1, 2)])
    table, test_rmse = RM.random_search_scores(*parts)
    assert all(0 <= r["rmse"] <= 1 for r in table.collect()) and 0 <= test_rmse <= 1


def test_principal_components(parts):
    rows = RM.pca_shares(parts[0]).orderBy("component").collect()
    assert len(rows) == 13 and abs(rows[-1]["cumulative"] - 1) < 1e-9 and rows[0]["explained"] > 0.5


def test_component_shares_equal_the_eigenvalues(spark, parts):
    x = np.array(parts[0].select(*RM.NUM, *RM.CODED).collect(), float)
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    got = [r["explained"] for r in queries()["pca_component_shares"](spark, SF_SMALL).orderBy("component").collect()]
    assert np.allclose(got, values / values.sum(), atol=1e-9)


def test_values_behind_the_keys(spark):
    rows = queries()["coef_importance_values"](spark, SF_SMALL).collect()
    assert [r["feature"] for r in rows] == RM.FEATURES and abs(sum(r["importance"] for r in rows) - 1) < 1e-6
    years = queries()["rf_predicted_years"](spark, SF_SMALL)
    assert years.columns == ["l_orderkey", "l_linenumber", "year", "predicted_year"] and years.filter("predicted_year is null").count() == 0


def test_forest_predictions_are_years(spark):
    pred, (low, high, _) = RM.forest_predictions(spark, SF_SMALL)
    got = pred.agg(F.min("predicted_year"), F.max("predicted_year"), F.count("*")).first()
    assert low <= got[0] and got[1] <= high and got[2] > 0


def test_boosting_searches_hold_out_every_fold(parts, monkeypatch):
    """The score of a point is the mean over all five folds, each fitted on the other four."""
    tr, te = parts
    monkeypatch.setattr(RM, "GBT_ROUNDS", [1, 2])
    monkeypatch.setattr(RM, "GBT_AXES", {"maxDepth": [2], "stepSize": [0.1]})
    monkeypatch.setattr(RM, "random_draws", lambda: [{"maxDepth": 2, "maxIter": 2, "stepSize": 0.1}])
    losses, errors = [], []
    for k in range(M.FOLDS):
        held = tr.filter(F.col("fold") == k)
        model = GBTClassifier(maxDepth=2, maxIter=2, stepSize=0.1, seed=42).fit(tr.filter(F.col("fold") != k))
        losses.append(model.evaluateEachIteration(held)[1])
        p = M.positive_probability(model.transform(held), out="p")
        errors.append(p.agg(F.sqrt(F.avg(F.pow(F.col("p") - F.col("label"), 2)))).first()[0])
    got = {r["maxIter"]: r["log_loss"] for r in RM.gbt_scores(tr).collect()}
    assert got[2] == pytest.approx(sum(losses) / 5, abs=1e-9)
    assert RM.random_search_scores(tr, te)[0].first()["rmse"] == pytest.approx(sum(errors) / 5, abs=1e-9)


def test_neighbour_shares_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    x, y, fold = rng.normal(size=(60, 3)), rng.integers(0, 2, 60).astype(float), np.arange(60) % 5
    df = M.assemble(spark.createDataFrame([(i, *map(float, x[i]), float(y[i]), int(fold[i])) for i in range(60)],
                                          "id long, a double, b double, c double, label double, fold int"), ["a", "b", "c"])
    train, test, k = RM.neighbour_shares(df.filter("id < 45"), df.filter("id >= 45"))
    got = {r["id"]: r["p_knn"] for r in train.unionByName(test).collect()}
    assert len(got) == 60 and k in RM.NEIGHBOURS
    for i in range(60):
        others = [j for j in range(45) if i >= 45 or fold[j] != fold[i]]
        near = sorted(others, key=lambda j: (float(np.linalg.norm(x[i] - x[j])), j))[:k]
        assert got[i] == pytest.approx(y[near].mean())


def test_stacking_holds_tuned_bases_and_neighbours(parts, monkeypatch):
    monkeypatch.setattr(RM, "STRENGTHS", 2)
    monkeypatch.setattr(RM, "TREE_AXES", {"maxDepth": [1, 3]})
    monkeypatch.setattr(RM, "MLP_ROUNDS", 3)
    monkeypatch.setattr(RM, "_stack_layers", lambda: [{"layers": [len(RM.FEATURES), n, 2]} for n in (2, 3)])
    rows = {r["model"]: r["test_accuracy"] for r in RM.stacking_scores(*parts).collect()}
    assert set(rows) == {"logreg", "tree", "mlp", "knn", "vote", "stack"} and all(0 <= v <= 1 for v in rows.values())


def test_the_stacks_neighbours_are_found_by_region(parts, monkeypatch):
    """All pairs of rows would not end on large tables."""
    monkeypatch.setattr(RM.K, "knn", None)
    near_train, near_test, _ = RM.neighbour_shares(*parts)
    assert near_train.count() == parts[0].count() and near_test.count() == parts[1].count()
