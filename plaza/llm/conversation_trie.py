"""The trie of all conversations' prefixes, and sums over its subtrees by an Euler tour."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaza.llm.common import Scratch
from plaza.llm.importance import CRC_TABLE, crc_sql
from plaza.llm.scans import running_sums
from plaza.operators.skew import join_groups

WORDS = r"[^\x20\x09-\x0D]+"
GROUP, HEADS = 20, 4  # conversations that share an opening, and how many lengths it may have
PARTS = ("a", "b", "c", "d")


def turn_hash(role: Column, text: Column) -> Column:
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)


def shared_opening(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, key, words) of the rebuilt turns, and (conv_id) of every conversation with its length.

    The opening of conversation c is the first crc32(c) % 4 turns of conversation c - c % 20 (the remainder is
    never negative); c's own turns follow after as many of its own.
    """
    numbered = running_sums(turns, ["conv_id"], [F.col("turn").asc_nulls_first(), "key", "row"], {"at": F.lit(1).cast("long")}, scratch, "turn-ranges")
    numbered = scratch.write(numbered.select("conv_id", "at", "key", "words"), "numbered")
    scratch.drop("turn-ranges")
    head = F.crc32(F.col("conv_id").cast("string")) % HEADS
    first = F.col("conv_id") - F.pmod("conv_id", F.lit(GROUP))
    own = numbered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumns({"head": head, "first": first})
    opener = own.filter("conv_id = first").select("first", F.col("n").alias("_n"))
    given = F.least("head", F.coalesce("_n", F.lit(0)))
    length = given + F.greatest(F.col("n") - F.col("head"), F.lit(0))
    convs = own.join(opener, "first", "left").select("conv_id", "first", "head", given.alias("given"), length.alias("length"))
    convs = scratch.write(convs, "conversations")
    openings = numbered.filter((F.col("conv_id") % GROUP == 0) & (F.col("at") < HEADS)).withColumnRenamed("conv_id", "first")
    opened = convs.filter("head > 0").join(openings, "first").filter("at <= head").select("conv_id", F.col("at").alias("depth"), "key", "words")
    # Only few conversations have an opener that is too short, so the join that moves turns up is a small one.
    short = scratch.write(convs.filter("given < head").select("conv_id", (F.col("head") - F.col("given")).alias("_less")), "short-openings")
    later = join_groups(numbered.filter(F.col("at") > head), short, ["conv_id"], "left")
    later = later.select("conv_id", (F.col("at") - F.coalesce("_less", F.lit(0))).alias("depth"), "key", "words")
    return opened.unionByName(later), convs


def with_paths(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, depth, words, path, parent_path): what identifies each conversation's prefixes.

    A path is the sum of 128 bits of hashes of place and turn, in four parts that can't overflow, so the paths of
    a conversation are running sums and a long one needs no task for itself.
    """
    placed = F.sha2(F.concat_ws(":", F.col("depth"), F.col("key")), 256)
    hashed = turns.select("conv_id", "depth", "words", placed.alias("_hash")).select(
        "conv_id", "depth", "words", *[F.conv(F.substring("_hash", 1 + 8 * k, 8), 16, 10).cast("long").alias(p) for k, p in enumerate(PARTS)])
    summed = running_sums(hashed, ["conv_id"], ["depth"], {f"sum_{p}": F.col(p) for p in PARTS}, scratch, "path-ranges")
    path = F.concat_ws("-", *[F.hex(f"sum_{p}") for p in PARTS])
    parent = F.concat_ws("-", *[F.hex(F.col(f"sum_{p}") - F.col(p)) for p in PARTS])
    return summed.select("conv_id", "depth", "words", path.alias("path"), parent.alias("parent_path"))


ROOT = "0-0-0-0"


def ends_hashes(paths: DataFrame, convs: DataFrame, scratch: Scratch) -> DataFrame:
    """(depth, path, ends_sha256): the hash of the ids, in order, of the conversations that end at a node.

    The ids are sorted into ranges by node and id. Each range joins its own; one hash then runs over a node's
    joined texts, which are at most as many as there are ranges.
    """
    parts = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = paths.groupBy("conv_id").agg(F.max(F.struct("depth", "path")).alias("end")).select("conv_id", "end.*")
    none = convs.filter("length = 0").select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("path"))
    ended = last.unionByName(none).repartitionByRange(parts, "depth", "path", "conv_id").withColumn("_range", F.spark_partition_id())
    ended = scratch.write(ended, "ends")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = ended.groupBy("depth", "path", "_range").agg(joined.alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, done = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if node != (row["depth"], row["path"]):
                    if node:
                        done.append((*node, digest.hexdigest()))
                    node, digest = (row["depth"], row["path"]), hashlib.sha256(row["ids"].encode())
                else:
                    digest.update(b"," + row["ids"].encode())
            if len(done) > 1000:
                yield batch_of(done)
                done = []
        if node:
            yield batch_of([*done, (*node, digest.hexdigest())])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        depths, names, hashes = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(depths, pa.int64()), pa.array(names), pa.array(hashes)], names=["depth", "path", "ends_sha256"])

    ordered = chunks.repartition("depth", "path").sortWithinPartitions("depth", "path", "_range").select("depth", "path", "ids")
    return ordered.mapInArrow(hashed, "depth long, path string, ends_sha256 string")


def euler_arcs(tree: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, depth, leaving, next_conv, next_depth, next_leaving): two arcs per node and which follows which.

    A node's enter arc leads to its first child, or out again; its exit arc to its next sibling, or out of its
    parent. The last arc has no next. Siblings are numbered in sorted ranges, so a node may have any number of them.
    """
    below = tree.filter("depth > 0")
    kids = below.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.min("conv_id").alias("child"))
    ranked = running_sums(below.select("conv_id", "depth", "parent_conv_id"), ["parent_conv_id", "depth"], ["conv_id"], {"at": F.lit(1).cast("long")}, scratch, "sibling-ranges")
    ranked = scratch.write(ranked, "siblings")
    scratch.drop("sibling-ranges")
    later = ranked.select("parent_conv_id", "depth", (F.col("at") - 1).alias("at"), F.col("conv_id").alias("sibling"))
    later = ranked.join(later, ["parent_conv_id", "depth", "at"]).select("conv_id", "depth", "sibling")
    linked = tree.join(kids, ["conv_id", "depth"], "left").join(later, ["conv_id", "depth"], "left")
    enter = F.struct(
        F.lit(False).alias("leaving"), F.coalesce("child", "conv_id").alias("next_conv"),
        F.when(F.col("child").isNotNull(), F.col("depth") + 1).otherwise(F.col("depth")).alias("next_depth"), F.col("child").isNull().alias("next_leaving"))
    leave = F.struct(
        F.lit(True).alias("leaving"), F.coalesce("sibling", "parent_conv_id").alias("next_conv"),
        F.when(F.col("sibling").isNotNull(), F.col("depth")).when(F.col("depth") > 0, F.col("depth") - 1).alias("next_depth"), F.col("sibling").isNull().alias("next_leaving"))
    return linked.select("conv_id", "depth", F.explode(F.array(enter, leave)).alias("arc")).select("conv_id", "depth", "arc.*")


def _local_runs(conv: np.ndarray, arc: np.ndarray, next_conv: np.ndarray, next_arc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each arc of a task: the first arc of its run, its place in the run, and the run's last arc.

    ``arc`` is twice the depth, plus one for an exit; -1 stands for none. A run is a stretch of the tour all of
    whose arcs are in the task; pointers are doubled until they reach its ends.
    """
    n = len(conv)
    order = np.lexsort((arc, conv))
    names = np.unique(conv)
    width = int(arc.max()) + 1
    key = np.searchsorted(names, conv) * width + arc
    at = np.minimum(np.searchsorted(names, next_conv), len(names) - 1)
    wanted = np.where((names[at] == next_conv) & (next_arc >= 0) & (next_arc < width), at * width + next_arc, -1)
    found = np.minimum(np.searchsorted(key[order], wanted), n - 1)
    after = np.where(key[order][found] == wanted, order[found], -1)
    before = np.full(n, -1)
    before[after[after >= 0]] = np.flatnonzero(after >= 0)

    def ends(step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        to, far = np.where(step >= 0, step, np.arange(n)), (step >= 0).astype(np.int64)
        while True:
            further = to[to]
            if (further == to).all():
                return to, far
            far, to = far + far[to], further

    first, place = ends(before)
    return first, place, ends(after)[0]


def tour_positions(arcs: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, depth, leaving, position): each arc's place in the tour, from 0, by distributed list ranking.

    Arcs are sorted into ranges by conversation and depth; each task joins the arcs that follow each other
    within its range to runs. The list of runs, far shorter than that of the arcs, is ranked by pointer doubling:
    a join in each of about log2(runs) rounds, with a written table in between, until every pointer has
    reached the end. No run is the next of two others, so no key of the joins is hot.
    """
    spark = arcs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    coded = arcs.select(
        "conv_id", (2 * F.col("depth") + F.col("leaving").cast("long")).alias("arc"), "next_conv",
        (2 * F.col("next_depth") + F.col("next_leaving").cast("long")).alias("next_arc"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        conv, arc = (rows.column(c).to_numpy() for c in ("conv_id", "arc"))
        next_conv, next_arc = (rows.column(c).fill_null(-1).to_numpy() for c in ("next_conv", "next_arc"))
        first, place, last = _local_runs(conv, arc, next_conv, next_arc)
        base = TaskContext.get().partitionId() << 33
        begins = place == 0
        length = np.bincount(first, minlength=len(conv))
        ended = ~begins | (next_arc[last] < 0)
        columns = [
            pa.array(conv), pa.array(arc), pa.array(base + first), pa.array(place), pa.array(length, mask=~begins),
            pa.array(next_conv[last], mask=ended), pa.array(next_arc[last], mask=ended),
        ]
        yield from pa.Table.from_arrays(columns, names=["conv_id", "arc", "run", "place", "length", "next_conv", "next_arc"]).to_batches(10_000)

    ddl = "conv_id long, arc long, run long, place long, length long, next_conv long, next_arc long"
    placed = scratch.write(coded.repartitionByRange(parts, "conv_id", "arc").mapInArrow(runs, ddl), "runs")
    heads = placed.filter("place = 0")
    named = heads.select(F.col("conv_id").alias("next_conv"), F.col("arc").alias("next_arc"), F.col("run").alias("next"))
    linked = heads.filter("next_conv is not null").join(named, ["next_conv", "next_arc"]).select("run", "next", F.col("length").alias("left"))
    ended = heads.filter("next_conv is null").select("run", F.lit(None).cast("long").alias("next"), F.col("length").alias("left"))
    ranks, number = scratch.write(linked.unionByName(ended), "ranks-0"), 0
    while not ranks.filter("next is not null").isEmpty():
        on = ranks.select(F.col("run").alias("next"), F.col("next").alias("_next"), F.col("left").alias("_left"))
        further = ranks.filter("next is not null").join(on, "next").select("run", F.col("_next").alias("next"), (F.col("left") + F.col("_left")).alias("left"))
        ranks = scratch.write(ranks.filter("next is null").unionByName(further), f"ranks-{number + 1}")
        scratch.drop(f"ranks-{number}")
        number += 1
    total = placed.count()
    found = join_groups(placed.select("conv_id", "arc", "run", "place"), ranks.select("run", "left"), ["run"], "inner")
    return found.select("conv_id", F.floor(F.col("arc") / 2).alias("depth"), (F.col("arc") % 2 == 1).alias("leaving"), (F.lit(total) - F.col("left") + F.col("place")).alias("position"))


def subtree_sums(tree: DataFrame, values: dict[str, Column], scratch: Scratch) -> DataFrame:
    """(conv_id, depth) with the sums of values of nodes over each node's subtree, its top included.

    A value stands at its node's enter arc; a subtree's sum is the running sum at its exit less that before its entry.
    """
    positions = scratch.write(tour_positions(scratch.write(euler_arcs(tree, scratch), "arcs"), scratch), "positions")
    own = tree.select("conv_id", "depth", *[value.cast("long").alias(f"_own_{name}") for name, value in values.items()])
    arcs = positions.join(own, ["conv_id", "depth"])
    arcs = arcs.withColumns({f"_own_{name}": F.when(F.col("leaving"), 0).otherwise(F.col(f"_own_{name}")) for name in values})
    summed = running_sums(arcs, [], ["position"], {name: F.col(f"_own_{name}") for name in values}, scratch, "tour")
    return summed.groupBy("conv_id", "depth").agg(
        *[(F.max(F.when(F.col("leaving"), F.col(name))) - F.max(F.when(~F.col("leaving"), F.col(name) - F.col(f"_own_{name}")))).alias(name) for name in values])


def prefix_trie(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per node of the trie of rebuilt conversations (see ``shared_opening``).

    conv_id (the smallest member) and depth name a node; parent_conv_id is its parent's (NULL at the root), n_convs
    counts the members, n_children the children, n_leaves the childless nodes of the subtree, saved_tokens what
    storing every prefix of the subtree once saves in words, ends_sha256 hashes the ids of members that end there.

    Turns are ordered by number, NULL first, those with one number by a hash of role and text. NULL roles
    and texts are empty. Rows that repeat a turn are turns. Rows without a conv_id belong to no conversation
    and are left out. An empty table has no conversation and no node. Other columns are not looked at.
    Texts are read once and never shuffled: a turn is a hash and a number of words from there on.
    """
    spark = conversations.sparkSession
    scratch = Scratch(spark)
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    turns = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), turn_hash(role, text).alias("key"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"), F.monotonically_increasing_id().alias("row"))
    rebuilt, convs = shared_opening(scratch.write(turns, "turns"), scratch)
    paths = scratch.write(with_paths(rebuilt, scratch), "paths")
    scratch.drop("turns", "numbered", "path-ranges")
    nodes = paths.groupBy("depth", "path").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.max("parent_path").alias("parent_path"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = root.select(F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("path"), "conv_id", "n_convs", F.lit(0).cast("long").alias("words"), F.lit(None).cast("string").alias("parent_path"))
    nodes = scratch.write(nodes.unionByName(root), "nodes")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("path").alias("parent_path"), F.col("conv_id").alias("parent_conv_id"))
    tree = scratch.write(join_groups(nodes, parents, ["depth", "parent_path"], "left"), "tree")
    kids = tree.filter("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    tree = scratch.write(tree.join(kids, ["conv_id", "depth"], "left").na.fill(0, ["n_children"]), "counted")
    scratch.drop("nodes", "tree")
    sums = subtree_sums(tree, {"n_leaves": F.col("n_children") == 0, "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}, scratch)
    ends = ends_hashes(paths, convs, scratch)
    nothing = hashlib.sha256(b"").hexdigest()
    found = tree.join(sums, ["conv_id", "depth"]).join(ends, ["depth", "path"], "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


ORACLE = rf"""
WITH crc AS ({CRC_TABLE}),
given AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY i) AS turns FROM given GROUP BY conv_id),
headed AS (SELECT conv_id, turns, {crc_sql('conv_id::VARCHAR')} % {HEADS} AS h FROM own, crc),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(p.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
  FROM headed c LEFT JOIN own p ON p.conv_id = c.conv_id - (c.conv_id % {GROUP} + {GROUP}) % {GROUP}),
pre AS (SELECT conv_id, d, CASE WHEN d > 0 THEN sha256(to_json(turns[1:d])::VARCHAR) ELSE '' END AS k, CASE WHEN d > 1 THEN sha256(to_json(turns[1:d - 1])::VARCHAR) ELSE '' END AS up,
    CASE WHEN d > 0 THEN len(regexp_extract_all(turns[d].text, '{WORDS}')) ELSE 0 END AS words, d = len(turns) AS ends
  FROM rebuilt, LATERAL (SELECT unnest(range(0, len(turns) + 1)) AS d)),
nodes AS (
  SELECT d, k, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM pre GROUP BY d, k),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY d, up),
tree AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN kids c ON c.d = n.d AND c.k = n.k),
sums AS (
  SELECT a.d, a.k, count(*) FILTER (t.n_children = 0) AS n_leaves, sum((t.n_convs - 1) * t.words) AS saved
  FROM tree t JOIN pre a ON a.conv_id = t.conv_id AND a.d <= t.d GROUP BY a.d, a.k)
SELECT t.conv_id, t.d::BIGINT AS depth, p.conv_id AS parent_conv_id, t.n_convs, t.n_children, s.n_leaves, s.saved::BIGINT AS saved_tokens, t.ends_sha256
FROM tree t JOIN sums s ON s.d = t.d AND s.k = t.k LEFT JOIN nodes p ON t.d > 0 AND p.d = t.d - 1 AND p.k = t.up
"""
