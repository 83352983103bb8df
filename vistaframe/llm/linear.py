"""Sparse linear models over hashed n-gram indicators, for tasks and bounded training sets.

Numpy helpers of the classifiers: features of a text, class log-count ratios,
hinge loss by dual coordinate descent, and probabilities from margins.
"""

from __future__ import annotations

import re
import zlib

import numpy as np

DIM_BITS = 18
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype="uint64")


def _shape(token: str) -> int:
    """Capitals, lower case, capitalised, digits, mixed; marks by their first three characters."""
    if not (token[0].isalnum() or token[0] == "_"):
        return 8 + zlib.crc32(token[:3].encode()) % 240
    if token.isupper() and len(token) > 1:
        return 1
    if token.islower():
        return 2
    if token.istitle():
        return 3
    return 4 if token.isdigit() else 5


class NgramFeatures:
    """``of(text)``: the distinct hashed features of a whole text, sorted.

    ``word``, ``bigram``: words and marks, without case; ``prefix``: their
    first four and five characters; ``shape``: one to three neighbouring token
    shapes, where a token equal to the one before has a shape of its own."""

    def __init__(self, kinds: tuple[str, ...]):
        self._kinds = kinds
        self._memo: dict[str, tuple[int, int, int, int]] = {}

    def _learn(self, token: str) -> tuple[int, int, int, int]:
        low = token.lower()
        self._memo[token] = got = (zlib.crc32(low.encode()), _shape(token), zlib.crc32(low[:4].encode()),
                                   zlib.crc32(low[:5].encode()))
        return got

    def of(self, text: str) -> np.ndarray:
        tokens = _TOKEN.findall(text)
        if not tokens:
            return np.empty(0, "uint32")
        if len(self._memo) > 150_000:
            self._memo.clear()
        memo = self._memo
        rows = np.array([memo.get(t) or self._learn(t) for t in tokens], dtype="uint64")
        h, shape = rows[:, 0], rows[:, 1].copy()
        shape[1:][h[1:] == h[:-1]] = 6
        out = []
        if "word" in self._kinds:
            out.append(h * _K[0])
        if "bigram" in self._kinds:
            out.append((h[:-1] * _K[0] + h[1:] * _K[1]) ^ np.uint64(1))
        if "prefix" in self._kinds:
            out += [rows[:, 2] * _K[1] ^ np.uint64(2), rows[:, 3] * _K[2] ^ np.uint64(3)]
        if "shape" in self._kinds:
            s = shape + np.uint64(1)
            two = s[:-1] * np.uint64(256) + s[1:]
            out += [s * _K[2], two * _K[1] ^ np.uint64(4), (two[:-1] * np.uint64(256) + s[2:]) * _K[0] ^ np.uint64(5)]
        mixed = np.concatenate(out)
        mixed ^= mixed >> np.uint64(29)
        mixed *= _K[0]
        return np.unique((mixed >> np.uint64(64 - DIM_BITS)).astype("uint32"))


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray, prior: float = 10.0) -> np.ndarray:
    """Per feature: log of its document rate in class 1 over that in class 0.
    ``prior`` pseudo-documents, split as the classes are, keep rare features near 0."""
    n = len(y)
    counts = [np.zeros(1 << DIM_BITS) for _ in range(2)]
    for idx, label in zip(rows, y):
        counts[int(label)][idx] += 1
    sizes = [max(1, int((y == k).sum())) for k in range(2)]
    rate = [(counts[k] + prior * sizes[k] / n) / sizes[k] for k in range(2)]
    return np.log(rate[1] / rate[0])


def _vector(ratio: np.ndarray, idx: np.ndarray) -> np.ndarray:
    x = ratio[idx]
    norm = np.sqrt(x @ x)
    return x / norm if norm else x


def dual_coordinate_descent(xs, dense: np.ndarray, rows, y: np.ndarray, cost: float, epochs: int, seed: int):
    """min |w|^2/2 + cost * sum of hinge losses; each dual variable stays in
    [0, cost of its class], where both classes weigh the same in sum."""
    rng = np.random.default_rng(seed)
    n = len(y)
    sign = np.where(y == 1, 1.0, -1.0)
    upper = np.where(y == 1, cost * n / (2 * max(1, (y == 1).sum())), cost * n / (2 * max(1, (y == 0).sum())))
    w, v, alpha = np.zeros(1 << DIM_BITS), np.zeros(dense.shape[1]), np.zeros(n)
    square = np.array([x @ x for x in xs]) + (dense * dense).sum(axis=1)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(n).tolist():
            if not square[i]:
                continue
            idx, x = rows[i], xs[i]
            gradient = sign[i] * (w[idx] @ x + dense[i] @ v) - 1
            a = alpha[i]
            new = min(max(a - gradient / square[i], 0.0), upper[i])
            if new != a:
                step = (new - a) * sign[i]
                alpha[i] = new
                w[idx] += step * x
                v += step * dense[i]
                moved = max(moved, abs(new - a))
        if moved < 1e-3:
            break
    return w, v


def sigmoid_fit(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) of 1/(1+exp(-(a*margin+b))), by Newton steps on smoothed targets."""
    pos, neg = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -35, 35)))
        g = np.array([((p - t) * margins).sum(), (p - t).sum()])
        s = p * (1 - p)
        h = np.array([[(s * margins ** 2).sum(), (s * margins).sum()], [(s * margins).sum(), s.sum()]])
        step = np.linalg.solve(h + 1e-6 * np.eye(2), g)
        size = np.abs(step).max()
        step = step / max(1.0, size / 5)
        a, b = a - step[0], b - step[1]
        if size < 1e-8:
            break
    return (float(a), float(b)) if a > 0 else (1e-3, float(np.log((pos + 1) / (neg + 1))))


# A model is a plain dict (it travels between tasks and driver): ratios, weights
# of features and of dense inputs with the constant last, and the sigmoid; or,
# for a training set without both classes, the smoothed share of class 1.

def constant_model(y: np.ndarray) -> dict:
    return {"p": (float((y == 1).sum()) + 1) / (len(y) + 2)}


def margin(model: dict, idx: np.ndarray, dense=()) -> float:
    x = _vector(model["ratio"], idx)
    return float(model["w"][idx] @ x + model["v"][:-1] @ np.asarray(dense, dtype=float) + model["v"][-1])


def probability(model: dict, idx: np.ndarray, dense=()) -> float:
    if "p" in model:
        return model["p"]
    return float(1 / (1 + np.exp(-np.clip(model["a"] * margin(model, idx, dense) + model["b"], -35, 35))))


def fit(rows: list[np.ndarray], y: np.ndarray, fold: np.ndarray, dense: np.ndarray | None = None, cost: float = 1.0,
        epochs: int = 10, seed: int = 7):
    """(model, out-of-fold probabilities). The sigmoid is fitted on margins of
    models that did not see the row; ``fold`` numbers each row's fold."""
    y = np.asarray(y)
    if len(set(y.tolist())) < 2:
        model = constant_model(y)
        return model, np.full(len(y), model["p"])
    dense = np.empty((len(y), 0)) if dense is None else dense
    full = np.hstack([dense, np.ones((len(y), 1))])

    def train(at: np.ndarray) -> dict:
        part, labels = [rows[i] for i in at], y[at]
        ratio = log_count_ratio(part, labels)
        w, v = dual_coordinate_descent([_vector(ratio, r) for r in part], full[at], part, labels, cost, epochs, seed)
        return {"ratio": ratio.astype("float32"), "w": w.astype("float32"), "v": v}

    margins = np.zeros(len(y))
    for k in np.unique(fold).tolist():
        seen, unseen = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if len(set(y[seen].tolist())) == 2:
            model = train(seen)
            margins[unseen] = [margin(model, rows[i], dense[i]) for i in unseen]
    model = train(np.arange(len(y)))
    model["a"], model["b"] = sigmoid_fit(margins, y)
    return model, 1 / (1 + np.exp(-np.clip(model["a"] * margins + model["b"], -35, 35)))
