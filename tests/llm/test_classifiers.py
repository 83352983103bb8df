import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import awkward
from vistaframe.llm import linear, mixture, nb_svm, toxicity_chain
from vistaframe.llm.common import id_remainder, materialise, prepare


def labelled(seed=3, n=300):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randint(0, 30)) for _ in range(rng.randint(5, 40))]
        good, toxic = i % 3 != 0, i % 5 == 0
        if not good:
            words = [w.upper() + "!!" for w in words]
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "moron", "trash"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


EXTRA = [(1000, None), (1001, ""), (None, "alpha1 beta2"), (1002, "WORD!! " * 20_000)]


def test_quality_scores_held_out_documents(spark):
    rows, labels = labelled()
    docs = awkward(prepare(spark), rows + EXTRA + rows[:1])
    table = spark.createDataFrame(labels + [(5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = nb_svm.fit_quality(docs, nb_svm.training_labels(table))
    scored = nb_svm.score_quality(docs, model).withColumn("out", id_remainder("doc_id", 5) == 0).collect()
    assert len(scored) == len(rows) + len(EXTRA) + 1 and all(0 <= r.score <= 1 for r in scored)
    truth = {d: q for d, q, _ in labels}
    held = [r for r in scored if r.out and r.doc_id in truth]
    assert len(held) > 30 and np.mean([(r.score >= 0.3) == truth[r.doc_id] for r in held]) > 0.97
    by = {r.doc_id: r.score for r in scored}
    assert by[1002] < 0.3 and by[1000] == by[1001]
    kept = nb_svm.keep_good(docs, model, 0.3)
    assert kept.schema == docs.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in scored if r.score >= 0.3)


def test_same_model_whatever_the_partitions(spark):
    rows, labels = labelled(n=120)
    table = prepare(spark).createDataFrame(labels, "doc_id long, quality int, toxic int")
    a = nb_svm.fit_quality(awkward(spark, rows).repartition(1), table)
    b = nb_svm.fit_quality(awkward(spark, rows).repartition(9), table.repartition(4))
    assert np.array_equal(a["w"], b["w"]) and (a["a"], a["b"]) == (b["a"], b["b"])


def test_training_set_is_bounded(spark):
    _, labels = labelled()
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert nb_svm.bounded_sample(table, "quality", 50).count() == 50


def test_one_class_or_no_labels(spark):
    docs = awkward(prepare(spark), [(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in nb_svm.score_quality(docs, nb_svm.fit_quality(docs, none)).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert [r.score for r in nb_svm.score_quality(docs, nb_svm.fit_quality(docs, one)).collect()] == [0.75, 0.75]
    empty = awkward(spark, [])
    assert nb_svm.score_quality(empty, nb_svm.fit_quality(empty, one)).count() == 0
    assert toxicity_chain.score_chain(empty, toxicity_chain.fit_chain(empty, none)).count() == 0


def test_dual_coordinate_descent_reaches_the_optimum():
    """The duality gap of the hinge-loss problem closes."""
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 40, 6)).astype("uint32") for _ in range(80)]
    y = np.array([int(3 in r or rng.random() < 0.3) for r in rows])
    xs = [np.ones(len(r)) for r in rows]
    dense = np.ones((80, 1))
    w, v = linear.dual_coordinate_descent(xs, dense, rows, y, 0.5, 3000, 1)
    sign = np.where(y == 1, 1.0, -1.0)
    upper = np.where(y == 1, 0.5 * 80 / (2 * (y == 1).sum()), 0.5 * 80 / (2 * (y == 0).sum()))

    def primal(w, v):
        m = np.array([w[r].sum() + v[0] for r in rows])
        return (w @ w + v @ v) / 2 + (upper * np.maximum(0, 1 - sign * m)).sum()

    best = primal(w, v)
    for _ in range(300):
        assert primal(w + rng.normal(size=len(w)) * (np.arange(len(w)) < 40) * 0.01, v + rng.normal(size=1) * 0.01) > best - 1e-3


def test_chain_feeds_earlier_probabilities(spark):
    rows, labels = labelled()
    docs = awkward(prepare(spark), rows + EXTRA)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    models = toxicity_chain.fit_chain(docs, nb_svm.training_labels(table))
    assert [len(m["v"]) - 1 for m in models] == [0, 1, 2]  # dense inputs per category
    scored = toxicity_chain.score_chain(docs, models).withColumn("out", id_remainder("doc_id", 5) == 0).collect()
    assert len(scored) == len(rows) + len(EXTRA)
    truth = {d: t for d, _, t in labels}
    held = [r for r in scored if r.out and r.doc_id in truth]
    assert np.mean([(r.p_toxic >= 0.5) == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r[f"p_{c}"] <= 1 for r in scored for c in toxicity_chain.CHAIN)


def test_raking_meets_the_targets():
    rng = np.random.default_rng(2)
    cells = rng.random((4, 3, 5)) * 1000
    targets = [rng.dirichlet(np.ones(n)) for n in cells.shape]
    fitted = mixture.rake(cells, targets)
    for axis, target in enumerate(targets):
        others = tuple(a for a in range(3) if a != axis)
        assert np.allclose(fitted.sum(axis=others), target, atol=1e-8)


def test_mixture(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(["common", "topical", "rareword", "of", "it"], k=rng.randint(1, 30))),
             rng.choice(["a", "a", "a", "b", "c"]), rng.choice(["en", "de"]), 1.5) for i in range(2000)]
    rows += [(3000, None, "a", None, None), (None, "of it", None, "en", 0.0), (3001, "", "zz", "xx", 1.0)]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string, source string, lang string, weight double")
    out, _ = mixture.calibrate(docs, source_targets={"a": 0.3, "*": 0.7}, lang_targets={"en": 0.5, "de": 0.5})
    got = out.collect()
    assert len(got) == len(rows)
    total = sum(r.tokens * r.probability for r in got)
    assert abs(sum(r.tokens * r.probability for r in got if r.source_group == "a") / total - 0.3) < 1e-6
    assert max(r.probability for r in got) == 1.0
    kept = mixture.sample(docs, source_targets={"a": 0.3, "*": 0.7})
    assert kept.schema == docs.schema and 0 < kept.count() < len(rows)
    again = mixture.sample(docs.repartition(5), source_targets={"a": 0.3, "*": 0.7})
    assert sorted(map(str, kept.collect())) == sorted(map(str, again.collect()))
    assert mixture.sample(docs.limit(0)).count() == 0
    assert mixture.sample(docs).agg(F.count("*")).scalar() is not None


def test_mixture_gives_every_small_source_its_target(spark, monkeypatch):
    """One hot source and 300 of less than 1 % each: each has a target of its own, also when cells are raked by joins."""
    rng = random.Random(9)
    names = ["hot"] * 150 + [f"s{k:03d}" for k in range(300)]
    rows = [(i, " ".join(rng.choices(["topical", "rareword", "of", "it"], k=rng.randint(1, 12))), s, rng.choice(["en", "de", None]))
            for i, s in enumerate(names * 4)]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r for r in mixture.calibrate(docs)[0].collect()}
    own, fitted = {}, {}
    for _, _, s, _ in rows:
        own[s] = 0
    for i, _, s, _ in rows:
        assert got[i].source_group == s
        own[s] += got[i].tokens
        fitted[s] = fitted.get(s, 0) + got[i].tokens * got[i].weight
    wanted = {s: n ** mixture.SOURCE_TARGETS for s, n in own.items()}
    for s in own:
        assert abs(fitted[s] / sum(fitted.values()) - wanted[s] / sum(wanted.values())) < 1e-6
    monkeypatch.setattr(mixture, "CELLS", 100)
    monkeypatch.setattr(mixture, "ROUNDS", 3)
    few, _ = mixture.calibrate(docs)
    by_joins = {r.doc_id: r.weight for r in few.collect()}
    monkeypatch.setattr(mixture, "CELLS", 50_000)
    in_memory = {r.doc_id: r.weight for r in mixture.calibrate(docs)[0].collect()}
    assert by_joins.keys() == in_memory.keys() == got.keys()
    assert all(abs(by_joins[i] - w) < 1e-9 * max(w, 1) for i, w in in_memory.items())


def test_mixture_budget_survives_a_rare_source(spark, monkeypatch):
    monkeypatch.setattr(mixture, "ROUNDS", 3)
    text = "some words of a plain text here"
    rows = [(i, f"{text} {i}", "big", "en") for i in range(1500)] + [(i, f"{text} {i}", "mid", "en") for i in range(1500, 2000)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    rare = plain.unionByName(spark.createDataFrame([(9999, "one rare", "rare", "en"), (9998, None, None, None)], plain.schema))
    kept = {k: {r.doc_id for r in mixture.sample(d, token_share=0.6).collect()} for k, d in (("plain", plain), ("rare", rare))}
    assert abs(len(kept["plain"]) - 1200) < 100 and 9999 in kept["rare"]
    assert len(kept["plain"] ^ (kept["rare"] - {9999, 9998})) < 100  # two documents change little
    out = materialise(mixture.calibrate(rare, token_share=0.6)[0], "mixture_test")
    total, expected = out.agg(F.sum("tokens"), F.sum(F.col("tokens") * F.col("probability"))).first()
    assert expected == pytest.approx(0.6 * total) and out.agg(F.max("probability")).first()[0] <= 1
    shares = {(r.axis, r.category): r for r in mixture.reached(out).collect()}
    assert shares["source", "rare"].expected < shares["source", "rare"].target  # all there is
    assert shares["source", "mid"].target > 0.25 and shares["source", "mid"].expected == pytest.approx(shares["source", "mid"].target, abs=0.02)
    assert sum(r.expected for r in shares.values()) == pytest.approx(3)
    assert mixture.reached(mixture.calibrate(rare.limit(0), token_share=0.6)[0]).count() == 0
    in_memory = {r.doc_id: r.probability for r in out.collect()}
    monkeypatch.setattr(mixture, "CELLS", 1)
    by_joins = {r.doc_id: r.probability for r in mixture.calibrate(rare, token_share=0.6)[0].collect()}
    assert in_memory == pytest.approx(by_joins, abs=1e-6)


@given(st.lists(st.tuples(st.integers(1, 10**6), st.floats(1e-3, 1e3)), min_size=1, max_size=12), st.floats(0.01, 1.5))
def test_mixture_scale_meets_the_budget(cells, share):
    n, w = np.array([c[0] for c in cells], float), np.array([c[1] for c in cells])
    scale = mixture._scale(lambda s: (n[s * w >= 1].sum(), (n * w)[s * w < 1].sum()), share * n.sum())
    assert (n * np.minimum(1, scale * w)).sum() == pytest.approx(min(share, 1.0) * n.sum(), rel=1e-6)


def test_mixture_ties_and_very_long_text(spark):
    long = "alpha " * 200_000 + "omega " * 200_000
    docs = spark.createDataFrame([(1, long, "a", "en"), (2, "omega alpha", "a", "en"), (2, "omega alpha", "a", "en"), (3, "", "b", "en")],
                                 "doc_id long, text string, source string, lang string")
    out = mixture.calibrate(docs, token_share=0.5)[0].collect()
    assert {r.doc_id: r.tokens for r in out} == {1: 400_000, 2: 2, 3: 1} and len(out) == 4
    assert len({(r.topic, r.sampled) for r in out if r.doc_id == 2}) == 1
