import re

import duckdb
import pytest

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward, components, lower_ascii
from vistaframe.llm import license_scan
from vistaframe.llm.common import prepare
from vistaframe.llm.queries import ORACLE, QUERIES
from vistaframe.sources.tables import TABLES

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
ROWS = [(1, "Under the MIT License! Under the MIT-license."), (2, None), (3, ""), (4, "CC BY-NC 4.0; Apache License, Version 2.0"),
        (5, "mit license under the"), (6, "cc by nc cc by nc by nc"), (None, "under the mit license"), (1, "cc by"),
        (7, "Redistribution and use in source and binary forms, with changes"), (8, "x " * 50_000 + "apache license version 2"),
        (9, "Permission is hereby granted, free of charge, to any person"), (10, "free of charge " * 500), (11, "ünder the mit license"),
        (12, "GNU General Public License and the GNU Lesser General Public License"),
        (13, "Redistribution and use in source and binary forms with or without modification are permitted provided that")]


def brute(text):
    words = WORDS.findall(lower_ascii(text or ""))
    places, labels = [], set()
    for phrase, label in BASE.items():
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def test_base_places_equal_brute_force(spark):
    got = license_scan.summary(license_scan.scan(awkward(prepare(spark), ROWS))).collect()
    assert sorted(str((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in got) == sorted(
        str((d, *brute(t))) for d, t in ROWS)
    labels = {r.doc_id: (r.labels, r.score) for r in got}
    assert labels[12] == ("gpl,lgpl", labels[12][1]) and labels[13][0] == "bsd" and labels[9][0] == "mit"
    assert labels[7] == ("", 0.0)  # one of two mandatory phrases
    assert all(0 <= r.score <= 1 for r in got) and labels[5] == ("", 0.0)
    assert license_scan.scan(awkward(spark, [])).count() == 0


def test_no_python_in_the_native_plans(spark):
    for name in ("op6_exact_dedup", "op7_license_scan"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL)
    want = duck.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(str, map(tuple, got.select(columns).collect()))) == sorted(map(str, want.fetchall()))


def documents(duck):
    return duck.execute("SELECT doc_id, text FROM documents").fetchall()


def test_jaccard_query_equals_brute_force(spark, duck):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op10_signature_join"](spark, SF_SMALL).collect()}
    assert got == components(documents(duck), 3, 90)


def test_every_query_returns_each_document_once(spark, duck):
    ids = sorted(d for d, _ in documents(duck))
    for name in ("op2_toxicity_chain", "op4_token_files", "op5_mixture", "op8_hmm_lm", "op9_nb_svm"):
        assert sorted(r.doc_id for r in QUERIES[name](spark, SF_SMALL).select("doc_id").collect()) == ids, name


def test_pipeline_stages_equal_their_brute_force_twins(spark, duck):
    docs = prepare(spark).read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        docs = stage(spark, docs, SF_SMALL)
        after = docs.collect()
        if k < 4:
            assert docs.columns == columns
            assert set(map(str, after)) <= set(map(str, before)) and after
        if name == "exact_duplicates":
            largest = {}
            for r in before:
                largest[r.text] = max(largest.get(r.text, -1), r.doc_id)
            assert sorted(r.doc_id for r in after) == sorted(largest.values())
        if name == "near_duplicates":
            groups = components([(r.doc_id, r.text) for r in before], 5, 80)
            assert sorted(r.doc_id for r in after) == sorted({c for _, c in groups.values()})
        if name == "packing":
            assert {r.doc_id for r in after} == {r.doc_id for r in before}
        docs = docs.sparkSession.createDataFrame(after, docs.schema)


def test_pipeline_on_an_empty_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = prepare(spark).createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0


def test_near_duplicates_of_repeated_ids(spark):
    """A clean text stays though its id is also that of a near copy; of near copies with one id one stays."""
    words = [[f"{k}w{i}" for i in range(80)] for k in range(3)]
    text = lambda k, end="": " ".join(words[k][:-1] + [end or words[k][-1]])
    rows = [(3, text(0)), (5, text(1)), (5, text(0, "changed")), (7, text(2)), (7, text(2, "changed")), (9, text(2, "other")),
            (None, text(0))]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, SF_SMALL).collect()]
    assert (5, text(1)) in got and (3, text(0)) in got and (None, text(0)) in got
    assert len(got) == 4 and sorted(i for i, _ in got if i is not None) == [3, 5, 7]


def test_near_duplicates_leave_clashing_columns_alone(spark):
    text = " ".join(f"w{i}" for i in range(60))
    schema = "doc_id long, text string, _row int, _doc string, component_id long, _often boolean, key string"
    rows = [(1, text, 7, "a", 9, True, "k"), (2, text + " x", 7, "b", 9, False, "k"), (3, "else", 7, "c", 1, None, None),
            (4, None, 7, "d", 1, None, None), (5, "", 8, "e", 1, None, None)]
    docs = prepare(spark).createDataFrame(rows, schema)
    got = corpus_pipeline.near_duplicates(spark, docs, SF_SMALL)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect()), key=lambda r: r[0]) == [rows[0], *rows[2:]]
