"""A hierarchical navigable small-world graph over unit vectors, in numpy.

Nodes are ordered by level, highest first, so every layer holds a prefix of
them and extends the layer above. They are inserted batch by batch: the graph so
far is searched for all nodes of a batch at once, their neighbours are chosen
so that none is nearer to another chosen one than to the node (places left are
filled with the nearest of the rest), and neighbours link back, keeping their
own best. Searches of many queries advance side by side.
"""

from __future__ import annotations

import numpy as np

LINKS = 16  # chosen per node; on the lowest layer twice as many are kept
BUILD_BEAM = 48
BATCH = 512
CELLS = 1 << 22  # entries of a (queries x nodes) table
FLOATS = 1 << 23  # of gathered vectors


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of integers."""
    x = x.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(29))


def _beam(x: np.ndarray, adjacent: np.ndarray, q: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, similarities), both queries x ``ef``, nearest first, -1 where
    fewer were met. ``entry``: queries x any number of nodes, -1 for none."""
    n, wide = len(q), max(4, ef // 16)
    claim = np.full((n, len(adjacent)), -1, "int32")  # the first place at which a node was met
    node, sim = np.full((n, ef), -1, "int64"), np.full((n, ef), -np.inf, "float32")
    done = np.ones((n, ef), bool)
    rows, met = np.arange(n), entry
    while len(rows):
        r, c = np.nonzero(met >= 0)
        found = met[r, c]
        fresh = claim[rows[r], found] < 0
        r, c, found = r[fresh], c[fresh], found[fresh]
        claim[rows[r], found] = c
        first = claim[rows[r], found] == c  # met once a step
        r, c, found = r[first], c[first], found[first]
        new = np.full(met.shape, -np.inf, "float32")
        for at in range(0, len(r), max(1, FLOATS // x.shape[1])):
            s = slice(at, at + max(1, FLOATS // x.shape[1]))
            new[r[s], c[s]] = np.einsum("ij,ij->i", x[found[s]], q[rows[r[s]]])
        all_sim = np.concatenate([sim[rows], new], axis=1)
        all_node = np.concatenate([node[rows], met], axis=1)
        all_done = np.concatenate([done[rows], np.isneginf(new)], axis=1)
        best = np.argpartition(-all_sim, ef - 1, axis=1)[:, :ef]
        sim[rows], node[rows] = np.take_along_axis(all_sim, best, 1), np.take_along_axis(all_node, best, 1)
        done[rows] = np.take_along_axis(all_done, best, 1)
        todo = np.where(done[rows], -np.inf, sim[rows])
        pick = np.argpartition(-todo, wide - 1, axis=1)[:, :wide] if wide < ef else np.tile(np.arange(ef), (len(rows), 1))
        valid = ~np.isneginf(np.take_along_axis(todo, pick, 1))
        going = valid.any(axis=1)
        rows, pick, valid = rows[going], pick[going], valid[going]
        expand = np.where(valid, node[rows[:, None], pick], 0)
        done[rows[:, None], pick] = True
        met = np.where(valid[:, :, None], adjacent[expand], -1).reshape(len(rows), pick.shape[1] * adjacent.shape[1])
    order = np.argsort(-sim, axis=1, kind="stable")
    sim, node = np.take_along_axis(sim, order, 1), np.take_along_axis(node, order, 1)
    return np.where(np.isneginf(sim), -1, node), sim


def _choose(x: np.ndarray, node: np.ndarray, sim: np.ndarray, most: int) -> np.ndarray:
    """Rows of candidates -> ``most`` neighbours each, -1 where there are fewer."""
    out = np.full((len(node), most), -1, "int32")
    step = max(1, FLOATS // (node.shape[1] * max(x.shape[1], node.shape[1])))
    for at in range(0, len(node), step):
        sims = np.where(node[at:at + step] < 0, -np.inf, sim[at:at + step])
        order = np.argsort(-sims, axis=1, kind="stable")
        cand, sims = np.take_along_axis(node[at:at + step], order, 1), np.take_along_axis(sims, order, 1)
        v = x[np.maximum(cand, 0)]
        between = v @ v.transpose(0, 2, 1)
        kept = np.zeros(cand.shape, bool)
        count = np.zeros(len(cand), int)
        for c in range(cand.shape[1]):
            good = (cand[:, c] >= 0) & (count < most) & ~(kept & (between[:, c, :] > sims[:, c, None])).any(axis=1)
            kept[:, c] = good
            count += good
        order = np.argsort(~kept, axis=1, kind="stable")[:, :most]  # the rest by nearness
        picked = np.take_along_axis(cand, order, 1)
        out[at:at + step, :picked.shape[1]] = picked
    return out


class Graph:
    """The graph over the rows of ``x``; ``keys`` (integers) decide levels and order."""

    def __init__(self, x: np.ndarray, keys: np.ndarray):
        h = mix(keys)
        u = (h >> np.uint64(11)).astype("float64") / float(1 << 53)
        level = np.floor(-np.log(np.maximum(u, 2.0 ** -53)) / np.log(LINKS)).astype(int)
        self.order = np.lexsort((h, -level))  # node -> row of ``x``
        x, level = x[self.order], level[self.order]
        self.x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype("float32")
        sizes = [int((level >= k).sum()) for k in range(int(level.max(initial=0)), -1, -1)]
        self.layers: list[np.ndarray] = []  # highest first
        for k, size in enumerate(sizes):
            self._extend(size, LINKS * 2 if k == len(sizes) - 1 else LINKS)

    def _extend(self, size: int, width: int) -> None:
        """A layer of ``size`` nodes below the last one."""
        adjacent = np.full((size, width), -1, "int32")
        held = len(self.layers[-1]) if self.layers else 0
        if held:
            adjacent[:held, :self.layers[-1].shape[1]] = self.layers[-1]
        while held < size:
            to = min(size, max(2 * held, 32), held + BATCH)
            self._insert(adjacent, held, to)
            held = to
        self.layers.append(adjacent)

    def _insert(self, adjacent: np.ndarray, held: int, to: int) -> None:
        q = self.x[held:to]
        among = q @ q.T
        np.fill_diagonal(among, -np.inf)
        top = min(LINKS, len(q) - 1) if held else len(q) - 1
        near = np.argpartition(-among, max(top - 1, 0), axis=1)[:, :top]
        node, sim = near + held, np.take_along_axis(among, near, 1)
        if held:
            old, old_sim = self._search(adjacent[:held], q, BUILD_BEAM)
            node, sim = np.concatenate([old, node], axis=1), np.concatenate([old_sim, sim], axis=1)
        if not node.shape[1]:
            return
        chosen = _choose(self.x, node, sim, LINKS)
        adjacent[held:to, :LINKS] = chosen
        r, c = np.nonzero(chosen >= 0)  # links back
        end, source = chosen[r, c], r + held
        order = np.argsort(end, kind="stable")
        end, source = end[order], source[order]
        first = np.flatnonzero(np.r_[True, end[1:] != end[:-1]]) if len(end) else np.empty(0, int)
        count = np.diff(np.r_[first, len(end)])
        for some in (count <= 64, count > 64):  # narrow tables for most
            f, n = first[some], count[some]
            if not len(f):
                continue
            new = np.full((len(f), int(n.max())), -1, "int64")
            at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            new[np.repeat(np.arange(len(f)), n), at] = source[np.repeat(f, n) + at]
            ends = end[f]
            both = np.sort(np.concatenate([adjacent[ends], new], axis=1), axis=1)[:, ::-1]
            both = np.where(np.c_[np.zeros(len(both), bool), both[:, 1:] == both[:, :-1]], -1, both)  # each once
            step = max(1, FLOATS // (both.shape[1] * self.x.shape[1]))
            for at in range(0, len(both), step):
                part = both[at:at + step]
                sims = np.einsum("ijk,ik->ij", self.x[np.maximum(part, 0)], self.x[ends[at:at + step]])
                adjacent[ends[at:at + step]] = _choose(self.x, part, sims, adjacent.shape[1])

    def _entry(self, q: np.ndarray, layers: list[np.ndarray]) -> np.ndarray:
        entry = np.zeros((len(q), 1), "int64")
        for adjacent in layers:
            entry = _beam(self.x, adjacent, q, entry, 4)[0]
        return entry

    def _search(self, adjacent: np.ndarray, q: np.ndarray, ef: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        layers = [a for a in self.layers if len(a) <= len(adjacent) and a is not adjacent]
        ef = min(ef, len(adjacent))
        node, sim = np.full((len(q), ef), -1, "int64"), np.full((len(q), ef), -np.inf, "float32")
        step = max(1, CELLS // max(len(adjacent), ef * 8))
        for at in range(0, len(q), step):
            s = slice(at, at + step)
            entry = self._entry(q[s], layers)
            if own is not None:
                entry = np.concatenate([own[s, None], np.where(entry == own[s, None], -1, entry)], axis=1)
            node[s], sim[s] = _beam(self.x, adjacent, q[s], entry, ef)
        return node, sim

    def search(self, q: np.ndarray, ef: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, similarities) of the ``ef`` nearest met per unit row of ``q``;
        ``own``: the nodes that the queries are themselves."""
        return self._search(self.layers[-1], q, ef, own)
