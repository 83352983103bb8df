import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import awkward, components
from vistaframe.llm import block_ann, signature_join
from vistaframe.llm import components as cc
from vistaframe.llm.common import Scratch, prepare


def corpus(seed):
    """Families of near copies around the threshold, shared passages, short texts, copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 5)))
    passage = [word() for _ in range(40)]
    rows, k = [], 0
    for family in range(12):
        base = [word() for _ in range(rng.choice((6, 11, 25, 80, 200)))]
        if family % 3 == 0:
            base = base[:20] + passage + base[20:]
        for _ in range(rng.randint(1, 14)):
            copy = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 3, 5))):
                copy[rng.randrange(len(copy))] = word()
            rows.append((k, " ".join(copy)))
            k += 1
    rows += [(k + i, t) for i, t in enumerate([None, "", " \t\n", "one", "ONE", "one two", "one  two", "two one", "É x", "é x"])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (3, 60)])
def test_components_equal_brute_force(spark, n, percent):
    rows = corpus(n * percent)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in signature_join.similar_components(awkward(prepare(spark), rows), words=n, percent=percent).collect()}
    assert got == components(rows, n, percent)


def test_components_with_small_blocks(spark, monkeypatch):
    """Blocks of a few sets: links across blocks are found, too."""
    monkeypatch.setattr(signature_join, "BLOCK_SETS", 5)
    monkeypatch.setattr(signature_join, "LEAF", 2)
    monkeypatch.setattr(signature_join, "MIN_BITS", 64)
    rows = corpus(77)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in signature_join.similar_components(awkward(prepare(spark), rows), words=3, percent=80).collect()}
    assert got == components(rows, 3, 80)


def test_near_threshold_pairs(spark):
    base = [f"w{i}" for i in range(102)]  # 100 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:92])), (3, " ".join(base[:91])), (4, " ".join(base + ["z"] * 1))]
    assert components(rows, 3, 90) == {
        r.doc_id: (r.n_shingles, r.component_id) for r in signature_join.similar_components(awkward(prepare(spark), rows)).collect()}


def test_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (5, text), (None, text), (9, text + " x"), (7, "else")]
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id) for r in
                 signature_join.similar_components(awkward(prepare(spark), rows)).collect())
    assert got == [(0, 48, None), (5, 48, 5), (5, 48, 5), (7, 1, 7), (9, 49, 5)]


def test_empty_documents(spark):
    assert signature_join.similar_components(awkward(prepare(spark), [])).count() == 0


def test_connected_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 101 + i) for i in range(200)]
    links = spark.createDataFrame(chain + star + [(400, 350), (400, 400)], "a long, b long")
    got = {r.node: r.component for r in cc.components(links).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[101 + i] == 100 for i in range(200))
    assert got[400] == got[350] == 350
    assert cc.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_nearest(rows, k):
    valid = [(i, np.array(v, float)) for i, v in rows
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in valid:
        if q % 3:
            continue
        scored = sorted((-float((x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum()))), i)
                        for i, y in valid if i != q and len(y) == len(x))
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def nearest(spark, rows, k):
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, rank int, dim string")
    got = {}
    for r in block_ann.nearest(frame, F.col("vec_id") % 3 == 0, k=k).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


def compare(got, want):
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items() if v}
    for q, v in got.items():
        assert np.allclose([s for _, s in v], [s for _, s in want[q]], atol=1e-12)


def test_nearest_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(block_ann, "BLOCK", 16)
    monkeypatch.setattr(block_ann, "QUERY_BLOCKS", 1)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(200)]
    rows += [(200 + i, rows[7][1]) for i in range(60)]  # one very common vector
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [1.0, None] + [0.0] * 6), (304, [float("nan")] * 8),
             (305, [float("inf")] * 8), (306, [1.0, 2.0]), (309, [2.0, 1.0]), (None, rows[1][1]), (312, [5.0])]
    compare(nearest(prepare(spark), rows, 5), brute_nearest(rows, 5))


def test_nearest_counts_a_repeated_id_once(spark, monkeypatch):
    monkeypatch.setattr(block_ann, "BLOCK", 64)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=4).round(1).tolist()) for i in range(90)]
    rows += [(3, rows[3][1])] * 8 + [(3, rng.normal(size=4).tolist()), (7, rows[3][1]), (8, rows[3][1])]
    rows += [(50 + i, (np.array(rows[6][1]) + 1e-3 * j).tolist()) for i in range(2) for j in range(6)]
    best = {}
    for q, v in rows:
        for c, w in rows:
            if q % 3 == 0 and c != q:
                score = float(np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w)))
                best[q, c] = max(best.get((q, c), -2.0), score)
    got = nearest(prepare(spark), rows, 5)
    for q in {q for q, _ in best}:
        want = sorted((s for (a, _), s in best.items() if a == q), reverse=True)[:5]
        assert len({c for c, _ in got[q]}) == 5
        assert np.allclose([s for _, s in got[q]], want, atol=1e-12)
        assert all(abs(best[q, c] - s) < 1e-12 for c, s in got[q])


def test_nearest_of_few_rows(spark):
    compare(nearest(prepare(spark), [(0, [1.0, 0.0]), (1, [0.0, 1.0])], 5), {0: [(1, 0.0)]})
    assert nearest(prepare(spark), [], 5) == {}


def test_bound_holds_for_every_pair():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(60, 1500)), rng.normal(size=(70, 1500)) * 1e-3
    (a, sa, ea), (b, sb, eb) = block_ann.quantise(x), block_ann.quantise(y)
    near = block_ann.tile_product(a, b) * (sa[:, None] * sb[None, :])
    exact = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ (y / np.linalg.norm(y, axis=1, keepdims=True)).T
    assert (np.abs(near - exact) <= ea[:, None] + eb[None, :] + ea[:, None] * eb[None, :]).all()
    assert (block_ann.tile_product(a, b) == a.astype("int64") @ b.astype("int64").T).all()


def test_an_id_with_several_texts_is_one_node(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(50)) for c in "tu")
    rows = [(3, a), (5, a), (5, b), (8, b + " x"), (9, "else")]
    got = sorted(tuple(r) for r in signature_join.similar_components(awkward(prepare(spark), rows)).collect())
    assert got == [(3, 48, 3), (5, 48, 3), (5, 48, 3), (8, 49, 3), (9, 1, 9)]


def test_pairs_of_blocks_keep_own_widths():
    """A short set among long ones doesn't fold their bitmaps, and pairs without
    a shared first shingle don't leave the task."""
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2 ** 64, n, dtype="uint64")) for n in [20] + [1500] * 12]
    sets.append(np.unique(np.r_[sets[1][:-20], rng.integers(0, 2 ** 64, 20, dtype="uint64")]))
    members = [(i, i, len(s), signature_join._signature(s), s[:200].view("int64").tolist()) for i, s in enumerate(sets)]
    assert signature_join._pairs_of_blocks(members, None, 80) == [(1, 13)]
    assert signature_join._pairs_of_blocks(members[:7], members[7:], 80) == [(1, 13)]
    apart = [m[:4] + ([i],) for i, m in enumerate(members)]
    assert signature_join._pairs_of_blocks(apart, None, 80) == []


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_linked_sets_share_a_key(percent):
    """Any two linked sets have a key in common, at sizes on both sides of class bounds."""
    rng, keys, missed, met = np.random.default_rng(percent), signature_join.Keys(percent), 0, 0
    for n in list(range(1, 60)) * 4 + [150, 333, 1000, 2500] * 5:
        x = np.unique(rng.integers(0, 2 ** 64, n, dtype="uint64"))
        for lost in {0, 1, n // 20, n * (100 - percent) // 200, n * (100 - percent) // 100}:
            for new in {0, 1, n // 20, n * (100 - percent) // 200, n * (100 - percent) // percent}:
                y = np.unique(np.r_[x[rng.permutation(len(x))[lost:]], rng.integers(0, 2 ** 64, new, dtype="uint64")])
                if len(y) and signature_join.linked(x, y, percent) and not np.array_equal(x, y):
                    met += 1
                    missed += not len(np.intersect1d(keys.of(x), keys.of(y)))
    assert met > 500 and missed == 0


def test_few_full_parts_fall_back_on_first_shingles(monkeypatch):
    """Where no set has enough parts, the first shingles still find every link."""
    monkeypatch.setattr(signature_join, "PARTS", 0.01)
    test_linked_sets_share_a_key(80)


@pytest.mark.parametrize("listed", [64, 1])
def test_meetings_of_blocks(spark, monkeypatch, listed):
    """Listed or joined, the same blocks meet where members differ in component and are near in size."""
    monkeypatch.setattr(signature_join, "KEY_BLOCKS", listed)
    rows = [(1, 10, 5, 5, 100, 110), (1, 11, 6, 6, 100, 110), (1, 12, 5, 5, 500, 510), (2, 10, 5, 5, 100, 110), (2, 11, 6, 6, 100, 110),
            (3, 13, 7, 8, 50, 60), (4, 14, 9, 9, 50, 60), (4, 15, 9, 9, 50, 60)]
    at = prepare(spark).createDataFrame(rows, "key long, block long, c0 long, c1 long, n0 long, n1 long")
    assert sorted(map(tuple, signature_join._meetings(at, 80).collect())) == [(10, 11), (13, 13)]


@pytest.mark.parametrize("classes,tile", [(0, 16), (2, 1), (1000, 16)])
def test_components_however_keys_are_paired(spark, monkeypatch, classes, tile):
    """Classes paired one by one, in tiles of blocks, or both ways: the same components."""
    monkeypatch.setattr(signature_join, "BLOCK_SETS", 4)
    monkeypatch.setattr(signature_join, "KEY_CLASSES", classes)
    monkeypatch.setattr(signature_join, "TILE_BLOCKS", tile)
    rows = corpus(78)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in signature_join.similar_components(awkward(prepare(spark), rows), words=3, percent=80).collect()}
    assert got == components(rows, 3, 80)


def test_a_block_is_copied_once_a_tile(spark):
    """64 blocks that all meet, in 2080 pairs: a copy per pair would be 4096 or more of them."""
    ids = [(p << 33) + k for p in range(8) for k in range(8)]
    blocks = prepare(spark).createDataFrame([(i, b"x") for i in ids], "block long, payload binary")
    meet = spark.createDataFrame([(i, j) for i in ids for j in ids if i <= j], "i long, j long")
    rows = signature_join._tiles(meet, blocks).collect()
    asked = [r for r in rows if r.block is None]
    assert sorted((p.i, p.j) for r in asked for p in r.pairs) == sorted((i, j) for i in ids for j in ids if i <= j)
    held = {}
    for r in rows:
        held.setdefault((r.ti, r.tj), set()).add(r.block)
    assert all({p.i, p.j} <= held[r.ti, r.tj] for r in asked for p in r.pairs)
    assert len(asked) > 100 and len(rows) - len(asked) < 1300


@pytest.mark.parametrize("listed", [64, 1])
def test_a_joined_group_meets_only_what_else_has_its_keys(spark, monkeypatch, listed):
    """40 blocks of one component share a key with a block of another: 40 meetings by that key, not 820 more."""
    monkeypatch.setattr(signature_join, "KEY_BLOCKS", listed)
    rows = [(1, b, 5, 5, 100, 110) for b in range(40)] + [(1, 40, 6, 6, 100, 110)]
    rows += [(100 + b, b, 5, 7, 100, 110) for b in range(40)]  # each block holds another component, too
    at = prepare(spark).createDataFrame(rows, "key long, block long, c0 long, c1 long, n0 long, n1 long")
    assert sorted(map(tuple, signature_join._meetings(at, 80).collect())) == sorted(
        [(b, 40) for b in range(40)] + [(b, b) for b in range(40)])


def test_blocks_are_full_however_many_partitions(spark, monkeypatch):
    """Blocks follow the number of classes: 40 partitions of a few classes each are no 40 blocks."""
    monkeypatch.setattr(signature_join, "BLOCK_SETS", 30)
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: prepare(spark).conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        members = spark.range(100).selectExpr("id % 7 AS key", "id AS node", "10 + id % 3 AS n", "id % 5 AS component", "id % 2 AS lo")
        places = signature_join._places(members.unionAll(members), Scratch(spark, "test")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    order = sorted(range(100), key=lambda i: (i % 2, i % 5, 10 + i % 3, i))
    assert {r.node: r.block for r in places} == {i: k // 30 for k, i in enumerate(order)} and len(places) == 100
