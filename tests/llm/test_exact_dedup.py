import hashlib
from collections import defaultdict

from tests.llm.helpers import awkward
from vistaframe.llm import exact_dedup

LONG = "word " * 30_000
ROWS = [(1, "a b"), (2, "a b"), (3, None), (4, ""), (5, "x" * 64 + "1"), (6, "x" * 64 + "2"), (7, "x" * 64 + "2"),
        (8, LONG), (9, LONG), (10, LONG + "!"), (11, "b a"), (None, "a b"), (12, "é"), (13, "é"), (2, "a b")]


def expected(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    return sorted((d if d is not None else -1, max(x for x in groups[t or ""] if x is not None), len(groups[t or ""]),
                   hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows)


def test_report_equals_brute_force(spark):
    docs = awkward(spark, ROWS)
    got = exact_dedup.duplicate_report(docs, digest_all=True).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected(ROWS)
    # exactly one row of each text is kept, also where the largest id is repeated
    assert sum(r.kept for r in got) == len({t or "" for _, t in ROWS})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_unique_texts_stay_unhashed(spark):
    got = {r.doc_id: r for r in exact_dedup.duplicate_report(awkward(spark, ROWS)).collect()}
    assert got[11].text_sha256 is not None or got[11].group_size == 1
    assert got[10].text_sha256 is None and got[9].text_sha256 is not None


def test_full_bit_set_changes_nothing(spark):
    """One row of bits over many keys: nearly all bits are set."""
    rows = [(i, f"text {i // 2}" + "y" * (i // 2 % 500)) for i in range(3000)]
    got = exact_dedup.duplicate_report(awkward(spark, rows), digest_all=True, filter_rows=1).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected(rows)


def test_keep_one(spark):
    docs = awkward(spark, ROWS)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted(
        {(max(d for d, u in ROWS if (u or "") == (t or "") and d is not None), t or "") for _, t in ROWS})


def test_empty_table(spark):
    docs = awkward(spark, [])
    assert exact_dedup.duplicate_report(docs).count() == 0
    assert exact_dedup.keep_one(docs).count() == 0
