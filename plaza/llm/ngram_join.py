"""Jaccard join of documents on word n-grams, with an R-tree over their count vectors.

The points are vectors that count, for each of a number of groups, the shingles hashed to it. Two sets
share at most the sum of the smaller counts, and so two R-tree nodes at most the sum over the smaller
of their upper corners; pairs below the wanted overlap are skipped. Such bounds are loose near the
root, where random texts of one length look alike, so the tree's upper levels are exact: documents
with equal sets are one point, and points meet only if they share one of the first shingles in the
order below (any pair that links shares one) and have similar sizes. Survivors are compared by
their whole sets.

Shingles of many documents, such as those of a licence line, come last in that order: otherwise all documents with
the line meet each other, and the work grows with the square of their number. Any order that is the same for all sets
gives the same links.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaza.llm.common import ROWS, Scratch, gathered, pieces, small_batches
from plaza.llm.components import connected_components

SHINGLE = 5
PERCENT = 80
GROUPS = 128  # at least, for a set; a power of two
PER_GROUP = 8  # shingles in a group at most, on average: with more, random texts look alike
FULL = 255  # a count of so many or more
LEAF = 32  # points in a leaf of the tree
BLOCK = 1024  # points of one group and size that meet in one task
LEADERS = 6  # points that each point is compared with first
COMMON = 64  # a shingle of more documents comes last in the order, if it is found
SEEN = 4  # documents that a shingle is seen in among those counted together, to be counted at all
COUNTED = 1 << 21  # shingles that are counted together
MOST_COMMON = 1 << 18  # so many at most come last, the most frequent ones: every task holds them
BATCH_BYTES = 4 << 20
SEGMENT = 1 << 20  # bytes that are hashed at once; cut at a space

_R = 0x9E3779B97F4A7C15  # odd, so that powers have an inverse modulo 2**64
_WRAP = np.errstate(over="ignore")


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random 64-bit number per byte, where A-Z count as a-z; the spaces; a multiplier per word of a shingle."""
    rng = np.random.default_rng(2024)
    byte = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    byte[65:91] = byte[97:123]
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    return byte, space, rng.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.multiply.accumulate(np.full(n, _R, np.uint64))
        down = np.multiply.accumulate(np.full(n, pow(_R, -1, 1 << 64), np.uint64))
    return up, down


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of UTF-8 bytes that begin and end with a space or not."""
    byte, space, _ = _tables()
    gap = space[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    up, down = _powers(1 << max(SEGMENT.bit_length(), int(len(data)).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(byte[data] * up[: len(data)])))
        return _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts: Sequence[str | None]) -> list[np.ndarray]:
    """The set of each text as a sorted array of 64-bit hashes; empty without words."""
    raw = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    begins = np.cumsum([0, *[len(x) + 1 for x in raw]])
    hashes, starts = [], []
    at = 0
    while at < len(data):  # cut at spaces, so that a slice holds whole words
        end = min(len(data), at + SEGMENT)
        if end < len(data):
            spaces = np.flatnonzero(_tables()[1][data[at:end]])
            end = at + int(spaces[-1]) + 1 if len(spaces) else int(begins[np.searchsorted(begins, end)])
        own, places = _word_hashes(data[at:end])
        hashes.append(own)
        starts.append(places + at)
        at = end
    words, places = np.concatenate(hashes), np.concatenate(starts)
    first = np.searchsorted(places, begins)
    factors = _tables()[2]
    # Windows over all texts at once; those that reach into the next text are left out below.
    windows = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(SHINGLE):
            windows += words[k : k + len(windows)] * factors[k]
        windows = _mix(windows)
    found = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if a == b:
            found.append(np.zeros(0, np.uint64))
        elif b - a < SHINGLE:
            with np.errstate(over="ignore"):
                found.append(_mix((words[a:b] * factors[: b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            own = np.sort(windows[a : b - SHINGLE + 1])
            new = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=new[1:])
            found.append(own if new.all() else own[new])
    return found


def count_vector(shingles: np.ndarray) -> bytes:
    """How many shingles fall into each group, in a byte each."""
    groups = max(GROUPS, 1 << max(0, (len(shingles) - 1) // PER_GROUP).bit_length())
    counts = np.bincount((shingles & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return np.minimum(counts, FULL).astype(np.uint8).tobytes()


def vectors(packed: Sequence[bytes]) -> np.ndarray:
    """Count vectors of one length: longer ones are folded, as their groups are parts of the shorter ones'.

    A count that did not fit into a byte is taken as a very large one, so that a bound stays one.
    """
    groups = min(map(len, packed))
    found = np.empty((len(packed), groups), np.int32)
    for k, one in enumerate(packed):
        counts = np.frombuffer(one, np.uint8).astype(np.int32)
        counts[counts == FULL] = 1 << 20
        found[k] = counts.reshape(-1, groups).sum(axis=0) if len(counts) > groups else counts
    return found


def _wanted(a, b, percent: int):
    """The overlap that sets of these sizes need to link."""
    return -(-percent * (a + b) // (100 + percent))


class CountTree:
    """An R-tree over count vectors, packed bottom-up in the order of set size."""

    def __init__(self, sizes: np.ndarray, counts: np.ndarray):
        self.order = np.lexsort((counts[:, 0], sizes))
        self.sizes, self.counts = sizes[self.order], counts[self.order]
        starts = np.arange(0, len(sizes), LEAF)
        self.levels = [(np.maximum.reduceat(self.counts, starts, axis=0), np.minimum.reduceat(self.sizes, starts), np.maximum.reduceat(self.sizes, starts))]
        while len(self.levels[-1][1]) > 1:
            top, low, high = self.levels[-1]
            starts = np.arange(0, len(low), 8)
            self.levels.append((np.maximum.reduceat(top, starts, axis=0), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))

    def _node_pairs(self, percent: int) -> np.ndarray:
        """Pairs of leaves that may hold a pair of points that links, from the root down."""
        pairs = np.zeros((1, 2), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            top, low, high = self.levels[depth]
            if depth < len(self.levels) - 1:
                step = np.arange(8)
                wide = (pairs[:, :, None] * 8 + step)
                a, b = np.broadcast_arrays(wide[:, 0, :, None], wide[:, 1, None, :])
                pairs = np.stack((a.ravel(), b.ravel()), axis=1)
                pairs = pairs[(pairs[:, 0] <= pairs[:, 1]) & (pairs[:, 1] < len(low))]
            a, b = pairs.T
            pairs = pairs[100 * high[a] >= percent * low[b]]
            a, b = pairs.T
            kept = [
                np.minimum(top[a[k : k + 512]], top[b[k : k + 512]]).sum(axis=1) >= _wanted(low[a[k : k + 512]], low[b[k : k + 512]], percent)
                for k in range(0, len(pairs), 512)
            ]
            pairs = pairs[np.concatenate(kept)] if kept else pairs
        return pairs

    def join(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of points whose bounds allow a link, as positions in the arrays given, first below second in size."""
        for x, y, _ in self.bounded_pairs(percent):
            yield x, y

    def bounded_pairs(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """These pairs with the ratio of their bound to the overlap that they need."""
        for i, j in self._node_pairs(percent):
            a, b = slice(i * LEAF, (i + 1) * LEAF), slice(j * LEAF, (j + 1) * LEAF)
            most = np.minimum(self.counts[a, None], self.counts[None, b]).sum(axis=2)
            wanted = _wanted(self.sizes[a, None], self.sizes[None, b], percent)
            x, y = np.nonzero(most >= wanted)
            share = most[x, y] / wanted[x, y]
            x, y = x + i * LEAF, y + j * LEAF
            keep = (x < y) & (100 * self.sizes[x] >= percent * self.sizes[y])
            yield self.order[x[keep]], self.order[y[keep]], share[keep]


def common_shingles(docs: DataFrame, text_col: str) -> np.ndarray:
    """The shingles that many documents have, sorted. All texts are read; what is missed costs time and no link."""
    small_batches(docs.sparkSession)

    def often(sets: dict[bytes, np.ndarray]) -> pa.RecordBatch:
        found = np.sort(np.concatenate([np.zeros(0, np.uint64), *sets.values()]))
        edges = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else np.zeros(0, np.int64)
        many = np.diff(np.append(edges, len(found)))
        keep = many >= SEEN
        return pa.RecordBatch.from_arrays([pa.array(found[edges[keep]].view(np.int64)), pa.array(many[keep], pa.int64())], names=["token", "many"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, np.ndarray] = {}  # equal sets are one point
        size = 0
        for batch in pieces(batches, "text", BATCH_BYTES):
            for one in shingle_sets(batch.column("text").to_pylist()):
                if held.setdefault(one.tobytes(), one) is one:
                    size += len(one)
                if size >= COUNTED:
                    yield often(held)
                    held, size = {}, 0
        yield often(held)

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "token long, many long")
    totals = counted.groupBy("token").agg(F.sum("many").alias("many")).filter(F.col("many") > COMMON)
    rows = totals.orderBy(F.desc("many"), "token").limit(MOST_COMMON).select("token").toArrow()
    return np.sort(rows.column("token").to_numpy().astype(np.int64).view(np.uint64))


def first_shingles(own: np.ndarray, percent: int, common: np.ndarray, maybe: np.ndarray) -> np.ndarray:
    """The first shingles of a set by (common, hash), so many that any two sets that link share one.

    ``maybe`` says of the last 16 bits whether a common shingle has them.
    """
    if not len(own):
        return own
    many = len(own) - (percent * len(own) + 99) // 100 + 1
    some = np.flatnonzero(maybe[own & np.uint64(0xFFFF)])
    if len(some):
        place = np.minimum(np.searchsorted(common, own[some]), len(common) - 1)
        last = np.zeros(len(own), bool)
        last[some] = common[place] == own[some]
        own = np.concatenate((own[~last], own[last]))
    return own[:many]


def profiles(docs: DataFrame, percent: int, id_col: str, text_col: str, common: np.ndarray | None = None) -> DataFrame:
    """Per document: a number, its id, the size and a digest of its set, its count vector and first shingles."""
    small_batches(docs.sparkSession)
    common = np.zeros(0, np.uint64) if common is None else common
    maybe = np.zeros(1 << 16, bool)
    maybe[common & np.uint64(0xFFFF)] = True
    id_type = docs.select(id_col).schema[0].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    names = ["row", "doc_id", "n", "sig", "counts", "firsts"]

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in pieces(batches, "text", BATCH_BYTES):
            sets = shingle_sets(batch.column("text").to_pylist())
            firsts = [first_shingles(x, percent, common, maybe) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(row, row + len(sets)), pa.int64()),
                    batch.column("doc_id").cast(to_arrow_type(id_type)),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets], pa.binary()),
                    pa.array([count_vector(x) for x in sets], pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0, *[len(x) for x in firsts]]), pa.int32()),
                        pa.array(np.concatenate([np.zeros(0, np.uint64), *firsts]).view(np.int64)),
                    ),
                ],
                names=names,
            )
            row += len(sets)

    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return given.mapInArrow(profile, f"row long, doc_id {id_type.simpleString()}, n long, sig binary, counts binary, firsts array<long>")


def _similar_sizes(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose count vectors allow a link."""
    left = points.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("counts").alias("ca"))
    right = points.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("counts").alias("cb"))
    met = pairs.join(left, "a").join(right, "b").filter(_similar_sizes(F.col("na"), F.col("nb"), percent))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                both = zip(batch.column("ca").to_pylist(), batch.column("cb").to_pylist(), strict=True)
                most = np.array([np.minimum(*vectors(pair)).sum() for pair in both])
                wanted = _wanted(batch.column("na").to_numpy(), batch.column("nb").to_numpy(), percent)
                yield batch.select(["a", "b"]).filter(pa.array(most >= wanted))

    return met.select("a", "b", "na", "nb", "ca", "cb").mapInArrow(keep, "a long, b long")


def sets_of(docs: DataFrame, points: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles) of the wanted nodes, made again from the texts of their documents."""
    needed = points.join(wanted, "node", "left_semi").select("node", "doc_id", "sig")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    texts = texts.join(needed, F.col("_id").eqNullSafe(F.col("doc_id"))).select("node", "sig", "text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", BATCH_BYTES):
            sets = [x.tobytes() for x in shingle_sets(batch.column("text").to_pylist())]
            # Another document may have the same id: only the text of that digest is the node's.
            same = [hashlib.blake2b(x, digest_size=16).digest() == sig for x, sig in zip(sets, batch.column("sig").to_pylist(), strict=True)]
            made = pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"])
            yield made.filter(pa.array(same))

    return texts.mapInArrow(make, "node long, shingles binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""
    met = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    met = met.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b").select("a", "b", "sa", "sb")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "sa", BATCH_BYTES):
            ok = []
            for sa, sb in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True):
                x, y = np.frombuffer(sa, np.uint64), np.frombuffer(sb, np.uint64)
                place = np.searchsorted(y, x)
                both = int(np.count_nonzero(y[np.minimum(place, len(y) - 1)] == x))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return met.mapInArrow(keep, "a long, b long").distinct()


def tree_pairs(
    groups: DataFrame, roots: DataFrame, points: DataFrame, scratch: Scratch, percent: int, first: bool = False
) -> DataFrame:
    """Pairs of one group that are not yet connected and may link by an R-tree join of their points.

    ``groups`` has a row per point and group: the points of all shingles that have one point as their least are
    a group, so a pair meets once per leader that it shares and not once per shingle.
    With ``first`` each point comes with only the likeliest of its partners in each group, by the bound.
    Points of a group are dealt by size, each to its own size class and as a guest to the one
    below; a class with more than BLOCK points is cut by a hash, and blocks meet pairwise in tasks
    of their own.
    """
    rooted = groups.join(roots, "node", "left").withColumn("root", F.coalesce("component", "node")).drop("component")
    rooted = scratch.write(rooted, f"rooted-{first}")
    # Of groups with the same points one is enough.
    members = [F.bit_xor(F.xxhash64(F.lit(seed), "node")).alias(f"x{seed}") for seed in (1, 2)]
    open_ = rooted.groupBy("token").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.count(F.lit(1)).alias("many"), *members)
    open_ = open_.filter("r1 < r2").groupBy("many", "x1", "x2").agg(F.min("token").alias("token")).select("token")
    rows = rooted.join(open_, "token").join(points.select("node", "n", "counts"), "node")
    size = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int")
    rows = rows.withColumn("size", size).withColumn("class", F.explode(F.array(F.col("size"), F.col("size") - 1)))
    rows = scratch.write(rows.withColumn("home", F.col("class") == F.col("size")), f"tree-rows-{first}")
    cuts = rows.groupBy("token", "class").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("cuts"), F.max("home").alias("any"),
        F.count(F.lit(1)).alias("many"),
    ).filter("any and many > 1").drop("any", "many")
    dealt = rows.join(cuts, ["token", "class"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    dealt = dealt.select(
        "token", "class", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"),
        "node", "root", "n", "counts", "home",
    )

    key = ["token", "class", "i", "j"]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(gathered(batches, "counts", BATCH_BYTES), key):
            # Most groups are of one leaf, where a tree has nothing to skip: they are compared together.
            found = [_leaf_pairs([group for group in part if len(group["node"]) <= LEAF], percent, first)]
            found += [_group_pairs(group, percent, first) for group in part if len(group["node"]) > LEAF]
            a, b = (np.concatenate([np.zeros(0, np.int64), *side]) for side in zip(*found, strict=True))
            pairs = np.unique(np.stack((a, b)), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    return dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(meet, "a long, b long").distinct()


def whole_groups(batches: Iterator[pa.RecordBatch], key: Sequence[str]) -> Iterator[list[dict[str, np.ndarray]]]:
    """Lists of groups of consecutive rows with one key, as columns; a group is never cut, and is held whole."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        last = [batch.column(k)[batch.num_rows - 1] for k in key]
        if [held[0].column(k)[0] for k in key] == last:
            continue
        table = pa.Table.from_batches(held)
        edges = _edges(table, key)
        yield _cut(table, edges)
        held = table.slice(int(edges[-1])).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield _cut(table, np.append(_edges(table, key), table.num_rows))


def _edges(table: pa.Table, key: Sequence[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in key:
        values = table.column(k).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _cut(table: pa.Table, edges: np.ndarray) -> list[dict[str, np.ndarray]]:
    columns = {name: table.column(name).to_numpy() for name in table.column_names}
    return [{name: values[a:b] for name, values in columns.items()} for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _group_pairs(group: dict[str, np.ndarray], percent: int, first: bool) -> tuple[np.ndarray, np.ndarray]:
    node, root, home, n = (group[c] for c in ("node", "root", "home", "n"))
    none = np.zeros(0, np.int64)
    if (root == root[0]).all() or not home.any():
        return none, none
    tree = CountTree(n, vectors(group["counts"]))
    x, y, share = (np.concatenate([none, *side]) for side in zip((none, none, none), *tree.bounded_pairs(percent), strict=True))
    # A point may be in a block of its own twice; both sides of a pair as guests meet in their own class.
    keep = (root[x] != root[y]) & (home[x] | home[y])
    x, y, share = x[keep], y[keep], share[keep]
    a, b = np.minimum(node[x], node[y]), np.maximum(node[x], node[y])
    return _likeliest(a, b, share, np.zeros(len(a), np.int64)) if first else (a, b)


def _likeliest(a: np.ndarray, b: np.ndarray, share: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs of a group the one with the highest share at each point."""
    if not len(a):
        return a, b
    ends, pair = np.concatenate((a, b)), np.tile(np.arange(len(a)), 2)
    order = np.lexsort((pair, -share[pair], ends, group[pair]))
    ends, of = ends[order], group[pair][order]
    best = np.unique(pair[order][np.append(True, (np.diff(ends) != 0) | (np.diff(of) != 0))])
    return a[best], b[best]


def _leaf_pairs(groups: list[dict[str, np.ndarray]], percent: int, first: bool) -> tuple[np.ndarray, np.ndarray]:
    """The same pairs as those of ``_group_pairs`` for groups of one leaf, all of them in one pass."""
    none = np.zeros(0, np.int64)
    if not groups:
        return none, none
    node, root, home, n, counts = (np.concatenate([group[c] for group in groups]) for c in ("node", "root", "home", "n", "counts"))
    many = np.array([len(group["node"]) for group in groups])
    of = np.repeat(np.arange(len(groups)), many)
    met = []
    for step in range(1, int(many.max())):
        x = np.flatnonzero(of[step:] == of[:-step])
        y = x + step
        keep = (root[x] != root[y]) & (home[x] | home[y]) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
        met.append(np.stack((x[keep], y[keep])))
    x, y = np.concatenate([np.zeros((2, 0), np.int64), *met], axis=1)
    most, wanted = _bounds(counts, x, y), _wanted(n[x], n[y], percent)
    keep = most >= wanted
    x, y, share = x[keep], y[keep], most[keep] / wanted[keep]
    a, b = np.minimum(node[x], node[y]), np.maximum(node[x], node[y])
    return _likeliest(a, b, share, of[x]) if first else (a, b)


def _unpacked(packed: np.ndarray, groups: int) -> np.ndarray:
    """Count vectors of one length, folded to ``groups`` counts as :func:`vectors` does."""
    counts = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1).astype(np.int32)
    counts[counts == FULL] = 1 << 20
    return counts if counts.shape[1] == groups else counts.reshape(len(packed), -1, groups).sum(axis=1, dtype=np.int32)


def _bounds(counts: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The summed minima of the count vectors of pairs; a longer one is folded for its pair."""
    length = np.array([len(one) for one in counts])
    short, long = np.where(length[x] <= length[y], x, y), np.where(length[x] <= length[y], y, x)
    most = np.zeros(len(x), np.int64)
    kinds = np.stack((length[short], length[long]))
    for low, high in np.unique(kinds, axis=1).T.tolist():
        own = np.flatnonzero((kinds[0] == low) & (kinds[1] == high))
        step = max(1, BATCH_BYTES // (8 * high))
        for k in range(0, len(own), step):
            some = own[k : k + step]
            left, right = np.unique(short[some], return_inverse=True), np.unique(long[some], return_inverse=True)
            # Both sides are made once for each point, at the length of the shorter one.
            a, b = _unpacked(counts[left[0]], low)[left[1]], _unpacked(counts[right[0]], low)[right[1]]
            most[some] = np.minimum(a, b).sum(axis=1)
    return most


def jaccard_components(
    docs: DataFrame, *, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(row, doc_id, n_shingles, component_id) of every document.

    Documents link when 100 * shared >= percent * united shingles. Documents with equal sets are one
    point. First each point is compared with LEADERS of the least points of its shingles, those with
    which it shares most, which connects most groups of near copies without comparing them pairwise; the R-tree join then finds all links
    between points that are not connected yet, so components are those of all links. NULL and empty
    texts link with nothing. A NULL id is never the smallest; repeated rows are equal documents.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    known = scratch.write(profiles(docs, percent, id_col, text_col, common_shingles(docs, text_col)), "profiles")
    # A set without shingles is a point of its own, which nothing reaches.
    node_of = known.filter("n > 0").groupBy("sig").agg(F.min("row").alias("node"))
    rows = known.select("row", "doc_id", "n", "sig")
    members = rows.filter("n > 0").join(node_of, "sig").select("row", "doc_id", "n", "node")
    members = scratch.write(members.union(rows.filter("n = 0").select("row", "doc_id", "n", F.col("row").alias("node"))), "members")
    first = members.filter("row = node and n > 0").select("row")
    points = known.join(first, "row", "left_semi").select(F.col("row").alias("node"), "doc_id", "sig", "n", "counts")
    points = scratch.write(points, "points")
    tokens = known.join(first, "row", "left_semi").select(F.col("row").alias("node"), F.explode("firsts").alias("token"))
    met = tokens.groupBy("token").agg(F.min("node").alias("leader"), F.max("node").alias("last")).filter("leader < last")
    shared = scratch.write(tokens.join(met.select("token", "leader"), "token"), "shared")
    scratch.drop("profiles")

    # Each point meets the leaders that it shares most shingles with; the tree finds the links of the others.
    led = shared.filter("node > leader").groupBy("node", "leader").agg(F.count(F.lit(1)).alias("many"))
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("many"), "leader"))
    best = led.withColumn("place", place).filter(F.col("place") <= LEADERS)
    stars = best.select(F.col("leader").alias("a"), F.col("node").alias("b"))
    stars = scratch.write(bounded(stars, points, percent), "stars")
    # Any pair that shares a shingle shares the shingle's leader.
    groups = scratch.write(shared.select("node", F.col("leader").alias("token")).distinct(), "groups")
    scratch.drop("shared")
    ends = stars.select(F.col("a").alias("node")).union(stars.select("b")).distinct()
    sets = scratch.write(sets_of(docs, points, ends, id_col, text_col), "star-sets")
    spark.conf.set(ROWS, "64")  # a row holds two whole sets
    links = scratch.write(verified(stars, sets, percent), "star-links")
    small_batches(spark)
    scratch.drop("star-sets", "stars")

    label = "star-links"
    for first in (True, False):
        roots = scratch.write(connected_components(links), "roots")
        more = scratch.write(tree_pairs(groups, roots, points, scratch, percent, first), "tree-pairs")
        scratch.drop(f"rooted-{first}", f"tree-rows-{first}", "roots")
        ends = more.select(F.col("a").alias("node")).union(more.select("b")).distinct()
        sets = scratch.write(sets_of(docs, points, ends, id_col, text_col), "tree-sets")
        spark.conf.set(ROWS, "64")
        links = scratch.write(links.union(verified(more, sets, percent)), f"links-{first}")
        small_batches(spark)
        scratch.drop("tree-sets", "tree-pairs", label)
        label = f"links-{first}"
    scratch.drop("groups", "points")

    found = connected_components(links)
    rooted = members.join(found, "node", "left").withColumn("root", F.coalesce("component", "node"))
    names = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(names, "root").select("row", "doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one_of_each(docs: DataFrame, *, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows without near copies: of each component the one with the smallest id, once.

    Of rows with that id the first in a written table stays, so repeated rows leave one, and a row whose id
    is also that of a copy is judged by its own text. Rows with a NULL id don't stand for others: of those
    in a component one stays beside the one with an id. Rows without words stay, all of them.
    """
    scratch = Scratch(docs.sparkSession)
    number = "_row"
    while number in [name.lower() for name in docs.columns]:
        number += "_"
    numbered = scratch.write(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    # The numbers are the ids of the join, so each row is a document of its own there.
    found = jaccard_components(numbered, percent=percent, id_col=number, text_col=text_col).select("doc_id", "component_id")
    ids = numbered.select(F.col(number).alias("doc_id"), F.col(id_col).alias("_id"))
    least = found.join(ids, "doc_id").groupBy("component_id", F.col("_id").isNull()).agg(F.min(F.struct("_id", "doc_id")).alias("least"))
    return numbered.join(least.select(F.col("least.doc_id").alias(number)), number, "left_semi").select(*docs.columns)
