"""N-gram Jaccard self-join with signature trees; exact, as classes and components.

Documents are sets of word shingles. Equal sets are one class, represented by
its smallest id. Linked sets differ in few shingles, at most ``k`` for their
sizes. Shingles are dealt into about 1.5 * (k + 1) parts by their hash; a
difference spoils one part, so of a set with more than ``k`` parts that hold
something, all but ``k`` are the same in a linked set. Under any fixed order of
parts with their contents (here: fullest first) the first ``k + 1`` of two
linked sets therefore have one in common; sets with fewer parts keep the first
shingles under the order of their hashes, too. Only classes that share such a
key are compared: it stands for several shingles at once, so texts that merely
share passages or words rarely meet, however many there are.
A class has a signature, the bitmap of its shingles; two signatures bound the
overlap of their sets, and only pairs that pass the bound have their sets
compared.

1. For each shared key, every class against the one among its classes that
   shares most of its own keys. The links found join copies of one
   text, however many, without their pairs.
2. A key whose classes are all in one component is done. The classes of another
   that few have are paired one by one, and pairs that pass the bound compared. The
   classes of the rest are laid out in full blocks, related ones side by side; two blocks
   meet if they share such a key among classes of different components and of sizes
   that can be linked. Blocks meet in tiles of neighbours, so that one is copied once
   per tile and not once per block that it meets. Members of a block with bitmaps of one length are one
   signature tree, whose nodes hold the OR of their members' bitmaps and their
   range of sizes. Two trees are traversed together, at the shorter of the two
   lengths: a pair of nodes is dropped when no member pair can overlap enough, or
   when all members are in one component already. What is left of a pair of
   leaves must share a key.

No caps: every pair of classes that can be linked is linked, or joined already
by other links. Defined cases: null and empty texts have no shingles and no
links; a null id takes no part in links and has a null component; rows that
repeat an id are one node with the links of all its texts; texts of any length
are cut whole; of equal sets the smallest id stands for all; an empty table gives
no rows; other columns take no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, id_text, lean
from .components import components
from .exact_dedup import bit_set, mark_held, repeated_keys

PARTS = 1.5  # of a set, times the most differences plus one
FILTER_ROWS = 1024  # bit sets of 1024 * 4 KB
BLOCK_SETS = 512
KEY_CLASSES = 16  # classes of a key that are paired one by one
KEY_BLOCKS = 64  # blocks of a key that are listed in one row
TILE_BLOCKS = 16  # blocks on each side of a tile, about
CHUNK_PAIRS = 64  # pairs that share one copy of a set when they are compared
MIN_BITS, MAX_BITS, BITS_PER_SHINGLE = 256, 16384, 8  # of a signature: a power of two
LEAF = 16
_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype="uint64")


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _K[3]
    h = (h ^ (h >> np.uint64(29))) * _K[0]
    return h ^ (h >> np.uint64(32))


class Shingler:
    """``of(text)``: sorted distinct 64-bit hashes of the ``n``-word shingles;
    words are runs of anything but ASCII white space, A-Z in lower case."""

    def __init__(self, n: int):
        self._n = n
        self._memo: dict[bytes, int] = {}

    def _word(self, word: bytes) -> int:
        self._memo[word] = h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h

    def of(self, text: str) -> np.ndarray:
        words = text.encode("utf-8").lower().split()  # bytes: only ASCII is lowered and split at
        if not words:
            return np.empty(0, "uint64")
        memo = self._memo
        if len(memo) > 150_000:
            memo.clear()
        found = list(map(memo.get, words))
        if None in found:
            found = [self._word(w) if h is None else h for w, h in zip(words, found)]
        h = np.array(found, dtype="uint64")
        n = min(self._n, len(h))  # fewer words: the whole sequence, told apart by its length
        out = np.full(len(h) - n + 1, n, dtype="uint64")
        for k in range(n):
            out = _mix(out * _K[1] + h[k:len(h) - n + 1 + k])
        return np.unique(out)


def needed(n, percent: int):
    """The least overlap of a set of ``n`` with any set it is linked to."""
    return -(-percent * n // 100)


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def least_overlap(n, m, percent: int):
    """The least overlap of linked sets of ``n`` and ``m``: from
    100 * both >= percent * (n + m - both)."""
    return -(-percent * (n + m) // (100 + percent))


def size_classes(percent: int) -> list[int]:
    """Least sizes of classes such that linked sets are of one class or of two neighbours."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(100 * out[-1] // percent + 1)
    return out


class Keys:
    """``of(set)``: its keys (see above). Pairs of the size class ``c`` and of
    ``c - 1`` with ``c`` use the parts of ``c``, so a set has those of its own
    class and, if it can be linked with larger ones there, of the next."""

    def __init__(self, percent: int):
        self._percent, self._least = percent, np.array(size_classes(percent))

    def differences(self, c: int) -> int:
        """The most shingles in which linked sets of class ``c`` or ``c - 1`` differ:
        n + m - 2 * both, with the least overlap of the largest sizes."""
        return 2 * (int(self._least[c + 1]) - 1) * (100 - self._percent) // (100 + self._percent)

    def _parts(self, s: np.ndarray, c: int, k: int) -> tuple[np.ndarray, bool]:
        """(keys, whether more than ``k`` parts hold something)"""
        salt = np.uint64((c * int(_K[1])) & (2 ** 64 - 1))
        h = _mix(s ^ salt)
        part = ((h >> np.uint64(32)) * np.uint64(int(PARTS * (k + 1)) + 1)) >> np.uint64(32)
        order = np.argsort(part, kind="stable")
        part, h = part[order], _mix(h[order] + _K[2])
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        keys = _mix(np.add.reduceat(h, starts) * _K[0] + part[starts] + salt)
        held = np.diff(np.r_[starts, len(s)])
        return keys[np.lexsort((keys, -held))[:k + 1]], len(starts) > k

    def of(self, s: np.ndarray) -> np.ndarray:
        n = len(s)
        if not n:
            return s
        c, out, full = int(np.searchsorted(self._least, n, side="right")) - 1, [], True
        for label in (c, c + 1):
            k = self.differences(label)
            if k and (label == c or 100 * n >= self._percent * int(self._least[label])):
                keys, enough = self._parts(s, label, k)
                out.append(keys)
                full = full and enough
        if not full:
            out.append(np.sort(_mix(s + _K[0]))[:n - needed(n, self._percent) + 1])
        return np.unique(np.concatenate(out)) if out else s[:0]


def _signature(s: np.ndarray) -> bytes:
    """Bitmap of a set; its length follows the set's size within bounds."""
    bits = min(max(MIN_BITS, 1 << (BITS_PER_SHINGLE * len(s) - 1).bit_length()), MAX_BITS)
    flags = np.zeros(bits, bool)
    flags[(s & np.uint64(bits - 1)).astype("int64")] = True
    return np.packbits(flags).tobytes()


def _folded(signature: bytes, size: int) -> np.ndarray:
    """A bitmap of ``size`` bytes of the same set: halves are laid over each other."""
    x = np.frombuffer(signature, "uint8")
    while len(x) > size:
        x = x[:len(x) // 2] | x[len(x) // 2:]
    return x


def may_link(x: bytes, y: bytes, n: int, m: int, percent: int) -> bool:
    """False only if the signatures show too many shingles on one side alone:
    a bit that the other bitmap lacks is of a shingle that the other set lacks."""
    size = min(len(x), len(y))
    a, b = _folded(x, size), _folded(y, size)
    both = least_overlap(n, m, percent)
    return (int(np.bitwise_count(a & ~b).sum()) <= n - both) and (int(np.bitwise_count(b & ~a).sum()) <= m - both)


def _signatures(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, keys = Shingler(n), Keys(percent)
        for batch in batches:
            sizes, marks, firsts, bitmaps = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingler.of(text)
                sizes.append(len(s))
                marks.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                firsts.append(keys.of(s).view("int64"))  # none: linked with equal sets only
                bitmaps.append(_signature(s) if len(firsts[-1]) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()),
                 pa.array(firsts, pa.list_(pa.int64())), pa.array(bitmaps, pa.binary())],
                names=["doc_id", "n", "mark", "firsts", "signature"])
    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            sets = [shingler.of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             names=["node", "items"])
    return run


def _compare(percent: int):
    """Rows of a centre's chunk stand together, the centre's own set or sets first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, centre = None, []
        for batch in batches:
            good = []
            for a, chunk, b, items in zip(*(batch.column(c).to_pylist() for c in ("a", "chunk", "b", "items"))):
                if (a, chunk) != at:
                    at, centre = (a, chunk), []
                own = np.frombuffer(items, "uint64")
                if b is None:
                    centre.append(own)
                good.append(b is not None and any(linked(x, own, percent) for x in centre))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
    return run


def _bounded(percent: int):
    """Pairs whose signatures allow a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [may_link(x, y, n, m, percent) for x, y, n, m in
                    zip(*(batch.column(c).to_pylist() for c in ("x", "y", "n", "m")))]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
    return run


class _Tree:
    """A signature tree over members (node, component, size, signature, keys),
    ordered by size, with bitmaps of ``width`` bytes; nodes are (low, high)
    ranges of members, children are halves."""

    def __init__(self, members: list[tuple], width: int):
        members = sorted(members, key=lambda m: (m[2], m[1]))
        self.ids = np.array([m[0] for m in members])
        self.groups = np.array([m[1] for m in members])
        self.sizes = np.array([m[2] for m in members])
        self.bits = np.stack([_folded(m[3], width) for m in members]).view("uint64")
        self.keys = [frozenset(m[4]) for m in members]
        self.count = np.bitwise_count(self.bits).sum(axis=1).astype("int64")
        self.nodes: dict[tuple[int, int], tuple] = {}
        self._build(0, len(members))

    def _build(self, low: int, high: int) -> None:
        """(OR of the bitmaps, least and largest size, the one component of all members or None)"""
        group = self.groups[low] if (self.groups[low:high] == self.groups[low]).all() else None
        self.nodes[low, high] = (np.bitwise_or.reduce(self.bits[low:high], axis=0), int(self.sizes[low]),
                                 int(self.sizes[high - 1]), group)
        if high - low > LEAF:
            mid = (low + high) // 2
            self._build(low, mid)
            self._build(mid, high)

    def least_common(self, node, percent: int) -> int:
        """Bits that any member shares at least with a set it is linked to: it
        loses at most one per shingle that the other set lacks."""
        low, high = node
        return int((self.count[low:high] - (self.sizes[low:high] - needed(self.sizes[low:high], percent))).min())


def _traverse(left: _Tree, right: _Tree, same: bool, percent: int) -> list[tuple[int, int]]:
    """Pairs of members of different components whose signatures allow a link
    and who share a key."""
    need = [{k: t.least_common(k, percent) for k in t.nodes} for t in (left, right)]
    found, stack = [], [((0, len(left.ids)), (0, len(right.ids)))]
    while stack:
        a, b = stack.pop()
        x, y = left.nodes[a], right.nodes[b]
        if 100 * x[2] < percent * y[1] or 100 * y[2] < percent * x[1]:
            continue  # no two sizes are near enough
        if x[3] is not None and x[3] == y[3]:
            continue  # all in one component
        if int(np.bitwise_count(x[0] & y[0]).sum()) < max(need[0][a], need[1][b]):
            continue  # the largest possible overlap is too small
        split_a, split_b = a[1] - a[0] > LEAF, b[1] - b[0] > LEAF
        if split_a or split_b:
            mid_a, mid_b = sum(a) // 2, sum(b) // 2
            lefts = [(a[0], mid_a), (mid_a, a[1])] if split_a else [a]
            rights = [(b[0], mid_b), (mid_b, b[1])] if split_b else [b]
            stack += [(p, q) for p in lefts for q in rights if not same or p[0] <= q[0]]
            continue
        i, j = slice(*a), slice(*b)
        common = np.bitwise_count(left.bits[i, None, :] & right.bits[None, j, :]).sum(axis=2).astype("int64")
        n, m = left.sizes[i, None], right.sizes[None, j]
        both = least_overlap(n, m, percent)
        fits = ((100 * np.minimum(n, m) >= percent * np.maximum(n, m))
                & (left.groups[i, None] != right.groups[None, j])
                & (left.count[i, None] - common <= n - both) & (right.count[None, j] - common <= m - both))
        for k, h in zip(*(v.tolist() for v in np.nonzero(fits))):
            if (not same or k + a[0] < h + b[0]) and not left.keys[k + a[0]].isdisjoint(right.keys[h + b[0]]):
                found.append((int(left.ids[k + a[0]]), int(right.ids[h + b[0]])))
    return found


def _cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block stand together -> one row a block."""
    at, held = None, []

    def block() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([pickle.dumps(held)], pa.binary())],
                                          names=["block", "payload"])

    for batch in batches:
        for number, *row in zip(*(batch.column(c).to_pylist() for c in ("block", "node", "component", "n", "signature", "keys"))):
            if number != at:
                if held:
                    yield block()
                at, held = number, []
            held.append(tuple(row))
    if held:
        yield block()


def _by_width(members: list[tuple]) -> dict[int, list[tuple]]:
    """Members by the length of their bitmaps."""
    out: dict[int, list[tuple]] = {}
    for m in members:
        out.setdefault(len(m[3]), []).append(m)
    return out


def _pairs_of_blocks(x: list[tuple], y: list[tuple] | None, percent: int) -> list[tuple[int, int]]:
    """Pairs between two blocks, or within one (``y`` None)."""
    left = _by_width(x)
    right = left if y is None else _by_width(y)
    trees: dict[tuple, _Tree] = {}

    def tree(side: int, own: int, width: int) -> _Tree:
        if (side, own, width) not in trees:
            trees[side, own, width] = _Tree((left, right)[side][own], width)
        return trees[side, own, width]

    found = []
    for v in left:
        for w in right:
            low, high = sorted((v, w))
            if y is None and v > w:
                continue  # met the other way round
            largest, least = max(m[2] for p, o in ((left, v), (right, w)) if o == low for m in p[o]), min(
                m[2] for p, o in ((left, v), (right, w)) if o == high for m in p[o])
            if 100 * largest < percent * least:
                continue  # bitmap lengths follow sizes
            found += _traverse(tree(0, v, low), tree(0 if y is None else 1, w, low), y is None and v == w, percent)
    return found


def _block_pairs(percent: int):
    """Rows of a tile stand together, its pairs of blocks first, then the blocks."""
    def found(pairs: list, members: dict) -> Iterator[pa.RecordBatch]:
        for i, j in pairs:
            links = _pairs_of_blocks(members[i], None if i == j else members[j], percent)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()),
                                                  pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pairs, members = None, [], {}
        for batch in batches:
            for ti, tj, block, asked, payload in zip(*(batch.column(c).to_pylist() for c in ("ti", "tj", "block", "pairs", "payload"))):
                if (ti, tj) != at:
                    yield from found(pairs, members)
                    at, pairs, members = (ti, tj), [], {}
                if block is None:
                    pairs = [(p["i"], p["j"]) for p in asked]
                else:
                    members[block] = pickle.loads(payload)
        yield from found(pairs, members)
    return run


def _tiles(meet: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows for ``_block_pairs``: a block goes once to each tile of (i, j) that needs it. Blocks are numbered in
    the order of the layout, so neighbours fall into one tile."""
    size = min(TILE_BLOCKS, max(1, blocks.count() // TILE_BLOCKS))  # few blocks: small tiles, for the sake of many tasks
    placed = meet.select("i", "j", F.expr(f"i div {size}").alias("ti"), F.expr(f"j div {size}").alias("tj"))
    asked = placed.groupBy("ti", "tj").agg(F.collect_list(F.struct("i", "j")).alias("pairs"))
    needed_blocks = placed.select("ti", "tj", F.explode(F.array("i", "j")).alias("block")).distinct()
    rows = needed_blocks.join(blocks, "block").unionByName(asked, allowMissingColumns=True)
    partitions = int(meet.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select("ti", "tj", "block", "pairs", "payload").repartition(partitions, "ti", "tj").sortWithinPartitions(
        "ti", "tj", F.col("block").asc_nulls_first())


def _of_nodes(rows: DataFrame, nodes: DataFrame, name: str, scratch: Scratch) -> DataFrame:
    """``rows`` (column ``node``) without most of those of other nodes: a bit
    set keeps them out of the shuffle that a join needs."""
    bits = scratch.write(bit_set(nodes.distinct().select(F.xxhash64("node").alias("key")), FILTER_ROWS), name)
    return mark_held(rows, F.xxhash64("node"), bits, FILTER_ROWS, "_in").filter("_in").drop("_in")


def _pairs_of_keys(members: DataFrame, percent: int) -> DataFrame:
    """``a, b, n, m``: classes of different components and of near sizes that share a key, from ``key, node,
    component, n`` of keys that at most KEY_CLASSES classes have. Equal lists of classes are paired once."""
    lists = members.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("node", "component", "n"))).alias("held"))
    pair = F.transform("held", lambda x, k: F.transform(F.slice("held", k + 2, F.lit(KEY_CLASSES)),
                                                        lambda y: F.struct(x.alias("x"), y.alias("y"))))
    pairs = lists.select("held").distinct().select(F.explode(F.flatten(pair)).alias("p")).filter("p.x.component <> p.y.component")
    pairs = pairs.select(*(F.col(f"p.{c}").alias(name) for c, name in (("x.node", "a"), ("y.node", "b"), ("x.n", "n"), ("y.n", "m"))))
    return pairs.filter(100 * F.least("n", "m") >= percent * F.greatest("n", "m")).distinct()


def _hopeful(pairs: DataFrame, classes: DataFrame, percent: int, name: str, scratch: Scratch) -> DataFrame:
    """The written ``pairs`` (a, b, n, m) whose signatures allow a link."""
    sides = _of_nodes(classes.select("node", "signature"), pairs.select(F.explode(F.array("a", "b")).alias("node")),
                      f"{name}_nodes", scratch)
    half = pairs.join(sides.select(F.col("node").alias("b"), F.col("signature").alias("y")), "b")
    both = scratch.write(half, f"{name}_pairs").join(sides.select(F.col("node").alias("a"), F.col("signature").alias("x")), "a")
    hopeful = scratch.write(both.select("a", "b", "x", "y", "n", "m").mapInArrow(lean(_bounded(percent)), "a long, b long").distinct(),
                            f"{name}_hopeful")
    scratch.release(f"{name}_pairs", f"{name}_nodes")
    return hopeful


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int, name: str, scratch: Scratch) -> DataFrame:
    """The pairs whose sets are linked. Only texts of the ids in question are
    cut into shingles. A set goes once to each chunk of pairs that needs it: a
    node ``a`` with many partners has several chunks."""
    degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CHUNK_PAIRS).alias("chunks"))
    dealt = scratch.write(pairs.join(degree, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk")),
                          f"{name}_dealt")
    wanted = (dealt.select("a", "chunk").distinct().select(F.col("a").alias("node"), "a", "chunk", F.lit(None).cast("long").alias("b"))
              .unionByName(dealt.select(F.col("b").alias("node"), "a", "chunk", "b")))
    own = _of_nodes(texts.filter("doc_id is not null").withColumn("node", F.col("doc_id")), wanted.select("node"),
                    f"{name}_ids", scratch)
    sets = own.select("doc_id", "text").mapInArrow(lean(_sets(words)), "node long, items binary")
    rows = sets.join(wanted, "node").select("a", "chunk", "b", "items").repartition("a", "chunk")
    rows = rows.sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
    return scratch.write(rows.mapInArrow(lean(_compare(percent)), "a long, b long").distinct(), name)


def _places(open_members: DataFrame, scratch: Scratch) -> DataFrame:
    """The written ``node, block``: BLOCK_SETS consecutive classes of the layout are a block, however many
    partitions they are sorted in."""
    order = ["lo", "component", "n", "node"]
    nodes = open_members.groupBy("node").agg(F.first("component").alias("component"), F.min("lo").alias("lo"), F.first("n").alias("n"))
    at = F.monotonically_increasing_id()  # the partition, and the place there
    sorted_in = scratch.write(nodes.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "node", F.shiftright(at, 33).alias("part"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("pos")), "layout")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    base = sorted_in.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    placed = scratch.write(sorted_in.join(base, "part").select("node", F.expr(f"(base + pos) div {BLOCK_SETS}").alias("block")), "places")
    scratch.release("layout")
    return placed


def _meetings(at: DataFrame, percent: int) -> DataFrame:
    """Pairs (i, j), i <= j, of blocks that share a key among members who can be
    linked, from ``key, block, c0, c1, n0, n1``: least and largest component and
    size of a key's members in a block. Where a key's members in two blocks are all
    of the component that has most such blocks of the key, the key doesn't pair
    these two: a large group that is joined already is paired with what else has
    its keys, and not with itself. The many keys of a group of similar texts lie in
    the same few blocks: equal lists of blocks are paired once. Keys in more than
    KEY_BLOCKS blocks are paired by a join."""
    pure = at.filter("c0 = c1").groupBy("key", "c0").agg(F.count(F.lit(1)).alias("blocks"))
    main = pure.groupBy("key").agg(F.max(F.struct("blocks", "c0"))["c0"].alias("main"))
    held = at.groupBy("key").agg(F.count(F.lit(1)).alias("held"))
    counted = at.join(held, "key").join(main, "key", "left").withColumn(
        "joined", F.coalesce((F.col("c0") == F.col("c1")) & (F.col("c0") == F.col("main")), F.lit(False)))
    lists = counted.filter(F.col("held") <= KEY_BLOCKS).groupBy("key").agg(
        F.sort_array(F.collect_set(F.struct("block", "joined"))).alias("blocks"))
    pair = F.transform("blocks", lambda b, k: F.transform(
        F.filter(F.slice("blocks", k + 1, F.lit(KEY_BLOCKS)), lambda c: ~(b["joined"] & c["joined"])),
        lambda c: F.struct(b["block"].alias("i"), c["block"].alias("j"))))
    few = lists.select("blocks").distinct().select(F.explode(F.flatten(pair)).alias("p")).select("p.i", "p.j").distinct()
    whole = at.groupBy("block").agg(F.min("c0").alias("c0"), F.max("c1").alias("c1"), F.min("n0").alias("n0"), F.max("n1").alias("n1"))
    side = lambda t, name: t.select(*(["key", F.col("joined").alias(f"{name}joined")] if "key" in t.columns else []),
                                    F.col("block").alias(name), *(F.col(c).alias(f"{name}{c}") for c in ("c0", "c1", "n0", "n1")))
    few = few.join(side(whole, "i"), "i").join(side(whole, "j"), "j")
    wide = counted.filter(F.col("held") > KEY_BLOCKS)
    # a block that is not joined against all of its key; two of these meet in both orders, so one is left out
    wide = side(wide.filter("not joined"), "x").join(side(wide, "y"), "key").filter("yjoined or x <= y")
    ends = lambda name, first: [F.when(F.col("x") <= F.col("y"), F.col(f"{first}{c}")).otherwise(
        F.col(f"{'y' if first == 'x' else 'x'}{c}")).alias(f"{name}{c}") for c in ("", "c0", "c1", "n0", "n1")]
    both = few.unionByName(wide.select(*ends("i", "x"), *ends("j", "y")))
    both = both.filter(F.least("ic0", "jc0") < F.greatest("ic1", "jc1"))  # not of one component
    both = both.filter((100 * F.col("in1") >= percent * F.col("jn0")) & (100 * F.col("jn1") >= percent * F.col("in0")))
    return both.select("i", "j").distinct()


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                       percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row: linked are sets with
    100 * |intersection| >= percent * |union|."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "signature_join")
    texts = id_text(docs, id_col, text_col)

    rows = scratch.write(texts.mapInArrow(lean(_signatures(words, percent)),
                                          "doc_id long, n long, mark binary, firsts array<long>, signature binary"), "signatures")
    some = rows.filter("n > 0 and doc_id is not null")
    # one row a class: where the mark is surely unique, the row itself, which passes no shuffle
    mark = F.xxhash64("mark")
    marks = scratch.write(repeated_keys(some.select(mark.alias("key")), FILTER_ROWS), "repeated_marks")
    some = mark_held(some, mark, marks, FILTER_ROWS, "_often")
    several = scratch.write(some.filter("_often").groupBy("mark").agg(
        F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("firsts").alias("firsts"),
        F.first("signature").alias("signature")), "classes")
    classes = several.unionByName(some.filter("not _often").select("mark", F.col("doc_id").alias("node"), "n", "firsts", "signature"))

    # keys that several classes have, and those classes
    firsts = classes.select("node", "n", F.size("firsts").alias("p"), F.explode("firsts").alias("key"))
    shared = scratch.write(firsts.groupBy("key").count().filter("count > 1").select("key"), "shared")
    bits = scratch.write(bit_set(shared, FILTER_ROWS), "shared_bits")
    likely = mark_held(firsts, F.col("key"), bits, FILTER_ROWS, "_shared").filter("_shared").drop("_shared")
    members = scratch.write(likely.join(shared, "key"), "members")
    scratch.release("shared", "shared_bits")

    # 1. each class against the one of each of its keys that shares most
    of_node = members.groupBy("node").agg((F.count(F.lit(1)) / F.first("p")).alias("w"))
    weighted = members.join(of_node, "node")
    centres = scratch.write(weighted.groupBy("key").agg(F.max(F.struct("w", (-F.col("node")).alias("a"), "n")).alias("c")), "centres")
    pairs = members.join(centres, "key").select((-F.col("c.a")).alias("a"), F.col("node").alias("b"),
                                                F.col("c.n").alias("n"), F.col("n").alias("m")).filter("a <> b")
    pairs = pairs.filter(100 * F.least("n", "m") >= percent * F.greatest("n", "m")).distinct()
    pairs = scratch.write(pairs, "sized_pairs")
    scratch.release("centres")
    hopeful = _hopeful(pairs, classes, percent, "star", scratch)
    scratch.release("sized_pairs")
    stars = _verified(hopeful, texts, words, percent, "star_links", scratch)
    joined = scratch.write(components(stars), "star_components")
    scratch.release("star_hopeful", "star_links_dealt", "star_links_ids")

    # 2. keys that still have several components
    known = members.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = scratch.write(known.select("key", "node", "n", "component"), "known")
    mixed = scratch.write(known.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("held"))
                          .filter("lo <> hi").select("key", "lo", "held"), "mixed")
    all_open = scratch.write(known.join(mixed, "key"), "all_open")
    scratch.release("members", "star_components", "known", "mixed")
    few = scratch.write(_pairs_of_keys(all_open.filter(F.col("held") <= KEY_CLASSES), percent), "few_sized")
    few = _hopeful(few, classes, percent, "few", scratch)
    scratch.release("few_sized")
    open_members = all_open.filter(F.col("held") > KEY_CLASSES)
    place = _places(open_members, scratch)
    # a class has as many open keys as keys at most
    open_nodes = open_members.groupBy("node").agg(F.first("component").alias("component"), F.collect_set("key").alias("keys"))
    laid = open_nodes.join(place, "node").join(
        _of_nodes(classes.select("node", "n", "signature"), place.select("node"), "open_nodes", scratch), "node")
    laid = laid.select("block", "node", "component", "n", "signature", "keys").repartition("block").sortWithinPartitions("block", "n", "node")
    blocks = scratch.write(laid.mapInArrow(_cut_blocks, "block long, payload binary"), "blocks")
    at = open_members.join(place, "node").groupBy("key", "block").agg(
        F.min("component").alias("c0"), F.max("component").alias("c1"), F.min("n").alias("n0"), F.max("n").alias("n1"))
    at = scratch.write(at, "key_blocks")
    scratch.release("all_open", "open_nodes", "places")
    meet = scratch.write(_meetings(at, percent), "block_pairs")
    near = scratch.write(_tiles(meet, blocks).mapInArrow(lean(_block_pairs(percent)), "a long, b long").unionByName(few).distinct(),
                         "block_hopeful")
    scratch.release("blocks", "key_blocks", "block_pairs", "few_hopeful")
    rest = _verified(near, texts, words, percent, "block_links", scratch)

    # an id with several texts ties their classes together (more ids may seem repeated: that adds no link)
    twice = repeated_keys(some.select(F.xxhash64("doc_id").alias("key")), FILTER_ROWS)
    tied = mark_held(some.filter("_often").select("doc_id", "mark"), F.xxhash64("doc_id"), scratch.write(twice, "repeated_ids"),
                     FILTER_ROWS, "_twice").filter("_twice").join(several.select("mark", "node"), "mark")
    tied = tied.select(F.col("doc_id").alias("a"), F.col("node").alias("b")).filter("a <> b")
    final = scratch.write(components(stars.unionByName(rest).unionByName(tied)), "components").withColumnRenamed("node", "_node")
    scratch.release("star_links", "block_links", "block_hopeful", "block_links_dealt", "block_links_ids", "repeated_ids")
    # a row whose mark is unique is its class's node; the others look their class up
    classed = scratch.write(several.select("mark", "node").join(final, F.col("node") == F.col("_node"), "left").select(
        "mark", F.coalesce("component", "node").alias("component_id")), "class_components")
    scratch.release("classes")
    alone = (some.filter("not _often").select("doc_id", "n").join(final, F.col("doc_id") == F.col("_node"), "left")
             .select("doc_id", "n", F.coalesce("component", "doc_id").alias("component_id")))
    linkable = some.filter("_often").select("doc_id", "n", "mark").join(classed, "mark").select(
        "doc_id", "n", "component_id").unionByName(alone)
    return linkable.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(
        rows.filter("n = 0 or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"),
                                                      F.col("doc_id").alias("component_id")))
