import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward, lower_ascii
from vistaframe.llm import importance_resampling as ir
from vistaframe.llm.common import prepare
from vistaframe.llm.queries import QUERIES

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORDS.findall(lower_ascii(text or ""))
    return len(words), [" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute(rows, target, least=20, percent=5):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    own = [(d, *features(t)) for d, t in rows]
    s, t = Counter(), Counter()
    for _, _, fs in own:
        s.update(map(bucket, fs))
    for text in target:
        t.update(map(bucket, features(text)[1]))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)}
    out = []
    for d, n, fs in own:
        weight = sum(gain[bucket(f)] for f in fs)
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    some = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(some[:percent * len(some) // 100]):
        r[5] = k + 1
    return [tuple(r) for r in out]


@pytest.mark.parametrize("distances", [1, 3, 64])
def test_position_crc_equals_zlib(distances):
    rng = np.random.default_rng(distances)
    data = rng.integers(0, 256, 30_000, dtype="uint8")
    lengths = np.r_[np.arange(1, 200), 64, 65, 128, 129, 5000]
    starts = np.array([int(rng.integers(0, len(data) - n + 1)) for n in lengths])
    got = ir.PositionCrc(distances).of(data, starts, lengths)
    assert got.tolist() == [zlib.crc32(data[a:a + n].tobytes()) for a, n in zip(starts, lengths)]


def test_resample_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ir, "BLOCK_BYTES", 700)
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcXYZ019é大", k=rng.randint(1, 6)))
    rows = [(i, rng.choice([" ", "  ", "-", ".\n"]).join(word() for _ in range(rng.randint(0, 90)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "...\n"), (203, "One"), (204, "x" * 5000 + " a b"), (205, " ".join(["same"] * 3000)),
             (206, rows[3][1]), (207, rows[3][1])]
    target = [rows[5][1], None, "", "One two", rows[9][1] + " end"]
    docs = awkward(prepare(spark), rows)
    got = ir.resample(docs, spark.createDataFrame([(t, 1) for t in target], "text string, n_words int"), percent=20)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, target, percent=20))
    drawn = ir.drawn_documents(docs, got)
    assert drawn.columns == docs.columns
    assert sorted(r.doc_id for r in drawn.collect()) == sorted(r[0] for r in brute(rows, target, percent=20) if r[5])


def test_ties_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(None, text), (None, text), (4, text), (4, text), (4, "else")], "doc_id long, text string")
    got = sorted(map(tuple, ir.resample(docs, docs.limit(0), percent=75).collect()), key=str)
    rows = brute([(None, text), (None, text), (4, text), (4, text), (4, "else")], [], percent=75)
    assert sorted(rows, key=str) == got and sorted(r[5] for r in got if r[5]) == [1, 2, 3]


def test_empty_tables(spark):
    docs = awkward(prepare(spark), [])
    assert ir.resample(docs, docs).count() == 0


def test_query_equals_brute_force(spark):
    prepare(spark)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op11_importance_resampling"](spark, SF_SMALL).collect()))
    want = sorted((d, n, w, s, k) for d, _, n, w, s, k in brute(rows, target))
    assert got == want and sum(r[4] is not None for r in got) > 5
