import random
import zlib
from collections import defaultdict
from math import ceil

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import awkward
from vistaframe.llm import bin_slack, bpe, token_files
from vistaframe.llm.bpe import WordMemoEncoder, default_tokenizer
from vistaframe.llm.common import prepare
from vistaframe.session import scratch_path

TEXTS = ["", " ", "a", "a  b", "x\n\ny", "\n", "it's don't 'll", "<|endoftext|> a <|endoftext|>b", "a\tb  c", "é à b",
         "1 2 33\n4 a1b2", "a b ", " a b", "a\x1cb c  d", "\u0085 a", "Ünï &&& a&& b*** x", "don't.. ñ! ß,", "á b",
         "x y z", "×a a÷ a^ b_c `x`", "a(b) [c] {d}, a&&&.%%%", "日本 語。 x", "a\r\nb", "😀 a😀 ​b", "A,B c'd 'e"]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(100, None), (None, "no id"), (7, TEXTS[7]), (101, "long text here " * 9000)]


@pytest.fixture(scope="module")
def plain():
    tok = Tokenizer.from_file(default_tokenizer())
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


def raw(ids):
    return np.asarray(ids, "<u4").tobytes()


def test_memo_encoder_equals_tokenizer(plain):
    rng = random.Random(3)
    marks = [" ", "\n", "  ", "a", "Bc", "é", ",", "'s", "1", "\t", "ß!", "\n\n", "$%", " ", "word"]
    texts = TEXTS + ["".join(rng.choices(marks, k=rng.randint(1, 30))) for _ in range(3000)]
    coder = WordMemoEncoder(default_tokenizer())
    for _ in range(2):  # the second time from the memo
        got = coder.encode(texts)
        assert [t for t, g in zip(texts, got) if g != raw(plain(t))] == []


def test_plain_words_go_straight_to_the_model(plain, monkeypatch):
    """A word of letters is neither matched nor cut into pieces; words of the generation before are not encoded again."""
    monkeypatch.setattr(bpe, "_LETTERS_THEN_MARKS", None)
    monkeypatch.setattr(bpe, "MEMO_WORDS", 3)
    coder = WordMemoEncoder(default_tokenizer())
    coder._memo["\nsome"] = raw(plain("\nsome"))
    assert coder.encode(["some plain words Here"]) == [raw(plain("some plain words Here"))]
    monkeypatch.setattr(coder, "_tokenize", None)
    assert coder.encode(["some Here words"]) == [raw(plain("some Here words"))]


@pytest.mark.parametrize("coding", ["dictionary", "delta"])
def test_token_files_round_trip(spark, plain, coding):
    docs = awkward(prepare(spark), ROWS)
    path = scratch_path(spark, "test", "tokens")
    token_files.write_token_files(docs, path, default_tokenizer(), coding=coding)
    rows = token_files.read_token_files(spark, path)
    assert sorted((r.doc_id if r.doc_id is not None else -1, tuple(r.tokens)) for r in rows.collect()) == sorted(
        (d if d is not None else -1, tuple([*plain(t), 0])) for d, t in ROWS)
    meta = token_files.read_token_metadata(spark, path)
    assert "array<int>" not in meta._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].split("\n")[0]
    at = 0
    for r in sorted(meta.collect(), key=lambda r: (r.part, r.pos)):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(meta.collect(), key=lambda r: r.start)]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    some = token_files.read_token_files(spark, path, 3, 5)
    assert sorted(r.doc_id for r in some.collect()) == [3, 4, 5]
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,3), LessThanOrEqual(doc_id,5)]" in \
        some._jdf.queryExecution().executedPlan().toString()
    digests = {(r.doc_id, r.n_tokens): r.ids_crc32 for r in token_files.token_digests(rows).collect()}
    assert all(digests[d, len(plain(t)) + 1] == zlib.crc32(raw([*plain(t), 0])) for d, t in ROWS)


def test_files_have_indexes_and_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq
    path = scratch_path(spark, "test", "groups")
    docs = prepare(spark).range(4000).selectExpr("id AS doc_id", "array_join(transform(sequence(1, 300), i -> substring(md5(concat(id, ' ', i)), 1, 5)), ' ') AS text")
    token_files.write_token_files(docs, path, default_tokenizer(), row_group_bytes=1 << 17, page_bytes=1 << 13)
    import glob
    files = sorted(glob.glob(path.removeprefix("file:") + "/*.parquet"))
    groups = [pq.ParquetFile(f).metadata for f in files]
    assert max(m.num_row_groups for m in groups) > 1
    column = groups[0].row_group(0).column(0)
    assert column.has_column_index and column.has_offset_index
    assert "DELTA_BINARY_PACKED" in column.encodings


def test_empty_tables(spark):
    docs = awkward(prepare(spark), [])
    path = scratch_path(spark, "test", "empty")
    token_files.write_token_files(docs, path, default_tokenizer())
    assert token_files.read_token_metadata(spark, path).count() == 0
    assert bin_slack.pack(bin_slack.cut_pieces(docs, default_tokenizer())).count() == 0


def check_packing(spark, docs, plain, rows, capacity):
    pieces = bin_slack.cut_pieces(docs, default_tokenizer(), end_id=2, capacity=capacity)
    packed = bin_slack.pack(pieces, capacity)
    got = packed.collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append(r)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    want = sorted((d if d is not None else -1, zlib.crc32(raw(p)), len(p), k, s)
                  for d, t in rows for k, s, p in cut([*plain(t), 2], capacity))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids_crc32, r.length, r.piece, r.start) for r in got) == want
    text = {r.sequence_id: r.ids for r in bin_slack.sequences(pieces, packed).collect()}
    assert all(zlib.crc32(raw(text[r.sequence_id][r.offset:r.offset + r.length])) == r.ids_crc32 for r in got)
    return len(by_sequence), sum(x[2] for x in want)


def cut(ids, capacity):
    first = (len(ids) - 1) % capacity + 1
    bounds = [0, *range(first, len(ids) + 1, capacity)]
    return [(k, a, ids[a:b]) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]


def test_packing(spark, plain):
    used, total = check_packing(spark, awkward(prepare(spark), ROWS), plain, ROWS, 1024)
    assert used == ceil(total / 1024)


def test_packing_with_a_hot_length(spark, plain):
    rng = random.Random(1)
    rows = [(i, "a b c") for i in range(500)] + [(500 + i, "w " * rng.randint(1, 60)) for i in range(500)]
    used, total = check_packing(spark, awkward(prepare(spark), rows).repartition(7), plain, rows, 64)
    assert used <= ceil(total / 64) + 3


def test_fullest_combination_equals_brute_force():
    from itertools import product
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randint(1, 15): rng.randint(1, 3) for _ in range(4)}
        room = rng.randint(0, 30)
        best = max(sum(k * n for k, n in zip(counts, ns)) for ns in product(*(range(n + 1) for n in counts.values()))
                   if sum(k * n for k, n in zip(counts, ns)) <= room)
        chosen = bin_slack.fullest(counts, room)
        assert sum(chosen) == best and all(chosen.count(k) <= counts[k] for k in set(chosen))


def test_plan_uses_up_the_histogram():
    rng = random.Random(4)
    histogram = {k: rng.randint(1, 5000) for k in rng.sample(range(1, 1025), 400)}
    plan = bin_slack.plan_bins(histogram, 1024)
    used = defaultdict(int)
    for pattern, times in plan:
        assert sum(pattern) <= 1024
        for k in pattern:
            used[k] += times
    assert dict(used) == histogram
    total = sum(k * n for k, n in histogram.items())
    large = sum(n for k, n in histogram.items() if k > 512)  # no two of these share a sequence
    assert sum(t for _, t in plan) <= max(total / 1024, large) * 1.02 + 2
