from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plaza.llm import conversation_trie as trie
from plaza.llm.common import Scratch
from plaza.llm.scans import running_sums

TURNS = "conv_id long, turn long, role string, text string"
SMALL = "/root/testdata/sf0.001"


def turn_key(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def plain(rows):
    """The nodes by plain loops over every prefix."""
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            given[conv].append((turn is not None, turn or 0, turn_key(role or "", text or ""), (role or "", text or "")))
    own = {c: [t[3] for t in sorted(turns)] for c, turns in given.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
        for d in range(len(rebuilt) + 1):
            members[rebuilt[:d]].append(c)
        ends[rebuilt].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(trie.WORDS, node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = sum(saved[k] for k in kids[node]) + (len(members[node]) - 1) * words
    return sorted((
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids[node]), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, m in members.items()), key=str)


def found(frame):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(map(tuple, frame.select(*columns).collect()), key=str)


def test_given_conversations(spark):
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet")
    wanted = plain([tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in rows.collect()])
    assert found(trie.prefix_trie(rows)) == wanted


def test_odd_rows(spark):
    rows = [
        (0, 0, "user", "hello there"), (0, 1, "bot", "hi"), (0, 2, None, None), (0, 3, "user", "bye now"),
        (1, 5, "user", "hello there"), (1, None, "x", "first as NULL"), (1, 5, "user", "hello there"), (1, 5, "bot", "tie"),
        (5, None, None, None), (5, None, None, None), (27, 1, "u", "its opener is absent"), (27, 2, "u", "two"), (28, 1, "u", "short"),
        (None, 1, "u", "no conversation"), (40, 1, "ab", "c"), (41, 1, "a", "bc"), (60, 1, "u", "a\u0085b   \x0bc"), (61, 1, "u", "word " * 100_000),
        (2, 0, "user", "hello there"), (3, 0, "user", "hello there"), (3, 1, "bot", "hi"), (-3, 0, "user", "below zero"),
    ]
    frame = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' as depth", "1 as path", "2 as row", "3 as at", "4 as key", "5 as _range")
    assert found(trie.prefix_trie(frame)) == plain(rows)


def test_no_conversations(spark):
    assert found(trie.prefix_trie(spark.createDataFrame([], TURNS))) == []
    assert found(trie.prefix_trie(spark.createDataFrame([(None, 1, "u", "t")], TURNS))) == []


@pytest.mark.parametrize("parts", [2, 7])
def test_random_conversations(spark, parts):
    rng = np.random.default_rng(parts)
    rows = [(int(c), t, "u" if t % 2 else "b", f"text {rng.integers(0, 2)}") for c in rng.choice(400, 150, False) for t in range(rng.integers(1, 9))]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert found(trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_one_long_conversation_and_many_copies(spark):
    """A third of the rows in one conversation, a third in copies of another: both are spread over the ranges."""
    rows = [(100, t, "u", f"turn {t}") for t in range(400)] + [(20 * c, t, "u", f"same {t}") for c in range(200, 400) for t in range(2)] + [(k, 0, "u", f"own {k}") for k in range(5000, 5300)]
    frame = spark.createDataFrame(rows, TURNS)
    assert found(trie.prefix_trie(frame)) == plain(rows)


def test_running_sums_of_a_hot_key(spark):
    rows = [(1 if k % 3 else k, k, k % 7) for k in range(600)]
    frame = spark.createDataFrame(rows, "key long, at long, value long")
    scratch = Scratch(spark)
    got = running_sums(frame.repartition(5), ["key"], ["at"], {"n": F.lit(1), "total": F.col("value")}, scratch, "r").collect()
    totals, wanted = defaultdict(lambda: [0, 0]), set()
    for key, at, value in rows:
        totals[key][0] += 1
        totals[key][1] += value
        wanted.add((key, at, value, *totals[key]))
    assert {tuple(r) for r in got} == wanted and len(got) == 600


def test_runs_of_a_task():
    """Arcs of three nodes; the middle one's exit is elsewhere, so there are two runs."""
    conv, arc = np.array([1, 1, 1, 2, 2]), np.array([0, 1, 2, 4, 5])
    next_conv, next_arc = np.array([1, -1, 2, 2, 1]), np.array([2, -1, 4, 5, 3])
    first, place, last = trie._local_runs(conv, arc, next_conv, next_arc)
    assert first.tolist() == [0, 1, 0, 0, 0] and place.tolist() == [0, 0, 1, 2, 3] and last.tolist() == [4, 1, 4, 4, 4]
