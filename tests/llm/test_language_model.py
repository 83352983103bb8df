import itertools
import math
import random
import zlib

import numpy as np

from tests.llm.helpers import awkward, counts, end_tokens
from vistaframe.llm import hmm_lm
from vistaframe.llm.common import id_remainder, prepare


def corpus():
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices(["the", "The", "cat", "sat", "on", "mat", f"rare{i}", f"odd{i % 7}"], k=rng.randint(0, 25))))
            for i in range(150)]
    return rows + [(500, None), (501, " \t"), (None, "the cat"), (3, "the cat"), (502, "unseen é É words " * 3000)]


def test_scores(spark):
    rows = corpus()
    got = hmm_lm.score_texts(awkward(prepare(spark), rows), id_remainder("doc_id", 7) == 2, states=3, rounds=2, head_words=8).collect()
    assert len(got) == len(rows)
    out = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    c = counts(t for d, t in rows if not out(d))
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), out(d), len(w), sum(c[x] > 0 for x in w), n,
                   round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6))
                  for d, t in rows for w in [end_tokens(t)])
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_several_parts_and_slices(spark, monkeypatch):
    monkeypatch.setattr(hmm_lm, "PART_TEXTS", 7)
    monkeypatch.setattr(hmm_lm, "HELD", 200)
    monkeypatch.setattr(hmm_lm, "CELLS", 60)
    monkeypatch.setattr(hmm_lm, "SLICE_WORDS", 5)
    test_scores(spark)


def tiny_model(symbols=5, states=3):
    rng = np.random.default_rng(0)
    return {"start": rng.dirichlet(np.ones(states)), "move": rng.dirichlet(np.ones(states), states),
            "emit": rng.dirichlet(np.ones(symbols), states).T.copy()}


def path_sum(model, seq):
    total = 0.0
    states = len(model["start"])
    for path in itertools.product(range(states), repeat=len(seq)):
        p = model["start"][path[0]] * model["emit"][seq[0], path[0]]
        for a, b, o in zip(path, path[1:], seq[1:]):
            p *= model["move"][a, b] * model["emit"][o, b]
        total += p
    return total


def test_forward_equals_the_sum_over_paths():
    model, seqs = tiny_model(), [np.array(s) for s in ([0], [1, 2], [4, 4, 0, 1], [3, 2, 1, 0, 2, 2])]
    for group in hmm_lm._groups(seqs):
        log = hmm_lm.forward(model, hmm_lm._laid(seqs, group), False)[0]
        assert np.allclose(np.exp(log), [path_sum(model, seqs[i]) for i in group])


def test_expected_counts_equal_posteriors():
    model, seqs = tiny_model(), [np.array(s) for s in ([0, 3], [1, 2, 2], [4], [4, 0, 1])]
    states = 3
    starts, moves, emits = np.zeros(states), np.zeros((states, states)), np.zeros((5, states))
    for seq in seqs:
        total = path_sum(model, seq)
        for path in itertools.product(range(states), repeat=len(seq)):
            p = model["start"][path[0]] * model["emit"][seq[0], path[0]]
            for a, b, o in zip(path, path[1:], seq[1:]):
                p *= model["move"][a, b] * model["emit"][o, b]
            p /= total
            starts[path[0]] += p
            for a, b in zip(path, path[1:]):
                moves[a, b] += p
            for s, o in zip(path, seq):
                emits[o, s] += p
    got = hmm_lm.expected_counts(model, seqs)
    assert np.allclose(got[0], starts) and np.allclose(got[1], moves) and np.allclose(got[2], emits)


def test_training_raises_the_likelihood():
    rng = np.random.default_rng(3)
    seqs = [np.array(rng.integers(0, 4, 30) + 4 * (i % 2)) for i in range(60)]
    share = np.full(8, 1 / 8)
    model, before = hmm_lm.first_model(share, 2), -np.inf
    for _ in range(8):
        log = 0.0
        for group in hmm_lm._groups(seqs):
            log += hmm_lm.forward(model, hmm_lm._laid(seqs, group), False)[0].sum()
        assert log >= before - 5  # the prior may cost a little
        before = log
        starts, moves, emits = hmm_lm.expected_counts(model, seqs)
        rows = [{"key": -1, "s0": starts[0], "s1": starts[1]}]
        rows += [{"key": -2 - a, "s0": moves[a, 0], "s1": moves[a, 1]} for a in range(2)]
        rows += [{"key": o, "s0": emits[o, 0], "s1": emits[o, 1]} for o in range(8)]
        model = hmm_lm.next_model(rows, share, 2)
    assert before / (60 * 30) > -math.log(8) + 0.4


def test_probabilities_of_one_token_texts_sum_to_one(spark):
    """All words known or not, plus one unseen slot per class: the emissions are whole."""
    rows = [(i, f"w{i % 5} x{i}") for i in range(40)]
    frame = awkward(prepare(spark), rows)
    scored = hmm_lm.score_texts(frame, id_remainder("doc_id", 7) == 2, states=2, rounds=1, head_words=3).collect()
    assert all(r.score < 0 and r.n_tokens == 3 for r in scored)


def test_empty_and_untrained(spark):
    empty = awkward(prepare(spark), [])
    assert hmm_lm.score_texts(empty, id_remainder("doc_id", 7) == 2).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    only = hmm_lm.score_texts(awkward(spark, [(held, "a b")]), id_remainder("doc_id", 7) == 2, head_words=4).collect()
    assert len(only) == 1 and only[0].n_known == 0 and only[0].train_tokens == 0
