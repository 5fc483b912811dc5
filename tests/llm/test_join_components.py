from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from plaza.llm import embedding_join, ngram_join
from plaza.llm.components import connected_components

from .conftest import words

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def closure(nodes, links):
    root = {k: k for k in nodes}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {k: find(k) for k in nodes}


@pytest.mark.parametrize("links", [
    [(1, 2), (2, 3), (5, 6), (9, 9)],
    [(k, k + 1) for k in range(60)],
    [(0, k) for k in range(1, 50)] + [(100 + k, 49) for k in range(5)],
    [(7, 7)],
    [],
])
def test_components(spark, links):
    found = connected_components(spark.createDataFrame([*links, (None, 1)], "a long, b long"))
    real = [(a, b) for a, b in links if a != b]
    assert {r["node"]: r["component"] for r in found.collect()} == closure({x for p in real for x in p}, real)


def test_components_of_a_random_graph_with_repeats(spark):
    rng = random.Random(4)
    links = [(f"n{rng.randrange(80)}", f"n{rng.randrange(80)}") for _ in range(70)] * 2
    real = [(a, b) for a, b in links if a != b]
    found = connected_components(spark.createDataFrame(links, "a string, b string"))
    assert {r["node"]: r["component"] for r in found.collect()} == closure({x for p in real for x in p}, real)


def plain_sets(text):
    own = WORD.findall((text or "").translate(LOWER))
    return {tuple(own[k : k + 5]) for k in range(len(own) - 4)} if len(own) >= 5 else {tuple(own)} if own else set()


def plain_components(rows, percent=80):
    sets = [plain_sets(t) for _, t in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
        and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    groups = closure(range(len(rows)), links)
    least = {}
    for k, g in groups.items():
        if rows[k][0] is not None:
            least[g] = min(least.get(g, rows[k][0]), rows[k][0])
    return sorted(((rows[k][0], len(sets[k]), least.get(g) if sets[k] else rows[k][0]) for k, g in groups.items()), key=str)


def near(base, rng, changes):
    own = list(base)
    for _ in range(changes):
        own[rng.randrange(len(own))] = f"c{rng.randrange(10**6)}"
    return own


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    passage = words(60, 99)
    for family in range(6):
        base = words(rng.choice([8, 30, 120, 400]), family)
        rows += [" ".join(near(base, rng, rng.choice([0, 0, 1, 2, 4]))) for _ in range(12)]
        rows.append(" ".join(base + passage))
    rows += [" ".join(words(50, 50 + k) + passage) for k in range(15)]
    rows += ["one two", "ONE  two", "one two three", "", None, "\n", "É a b c d e", "é a b c d e", "x", "X"]
    chain = words(100, 77)
    rows += [" ".join(chain[k * 3 :] + words(k * 3, 78)) for k in range(6)]  # linked by steps only
    ids = rng.sample(range(10**6), len(rows))
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_agree_with_all_pairs(docs, seed, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)  # so that shingles are cut into blocks
    rows = corpus(seed)
    rows += [(rows[0][0], rows[0][1]), (rows[1][0], "another text with that id is not it"), (None, rows[2][1]), (None, None)]
    found = ngram_join.jaccard_components(docs(*rows, extra="node"))
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()), key=str) == plain_components(rows)


def test_a_large_group_of_near_copies_is_one_component(docs):
    rng = random.Random(9)
    base = words(60)
    rows = [(k, " ".join(near(base, rng, 1))) for k in range(300)]
    found = ngram_join.jaccard_components(docs(*rows)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == sorted(plain_components(rows))


def test_joins_of_nothing(docs, spark):
    assert ngram_join.jaccard_components(docs()).collect() == []
    assert ngram_join.jaccard_components(docs((1, None), (2, ""))).count() == 2
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_join.near_duplicates(empty).collect() == []


def test_keep_one_of_each(docs):
    text = " ".join(words(40))
    rows = [(5, text), (3, text.upper()), (9, text + " more"), (4, " ".join(words(40, 2))), (6, None), (None, text)]
    kept = ngram_join.keep_one_of_each(docs(*rows, extra="component"))
    assert kept.columns[-1] == "component"
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 3, 4, 6]


def test_keep_one_of_each_decides_per_row(docs):
    rng = random.Random(12)
    base = [words(40, k) for k in range(6)]
    texts = [" ".join(b) for b in base] + [" ".join(b) + " more" for b in base] + [None, "", " "]
    rows = [(1, texts[0]), (1, texts[0]), (9, texts[0]), (9, " ".join(words(40, 77)))]
    rows += [(rng.choice([None, 2, 3, 4, 5]), rng.choice(texts)) for _ in range(60)] + [(None, texts[1])] * 3
    roots = {k: root for k, _, root in plain_components([(k, text) for k, (_, text) in enumerate(rows)])}
    kept = ngram_join.keep_one_of_each(docs(*rows, extra="_row"))
    assert kept.columns[-1] == "_row"
    # Of rows that differ in neither id nor component any may stay: ids are compared per component.
    expected, best = [], {}
    for k, (key, text) in enumerate(rows):
        if not plain_sets(text):
            expected.append((key, "none"))
        elif key is None:
            best[roots[k], True] = None
        else:
            best[roots[k], False] = min(best.get((roots[k], False), key), key)
    expected += [(key, root) for (root, _), key in best.items()]
    root_of = {text: roots[k] if plain_sets(text) else "none" for k, (_, text) in enumerate(rows)}
    assert sorted(map(str, ((r["doc_id"], root_of[r["text"]]) for r in kept.collect()))) == sorted(map(str, expected))
    assert (9, rows[3][1]) in {(r["doc_id"], r["text"]) for r in kept.collect()}


def test_bounds_never_lose_a_pair():
    rng = np.random.default_rng(3)
    base = [np.unique(rng.integers(0, 1 << 62, rng.integers(1, 400)).astype(np.uint64)) for _ in range(60)]
    sets = base + [np.unique(np.concatenate((x[: len(x) * 9 // 10], rng.integers(0, 1 << 62, 1 + len(x) // 12).astype(np.uint64)))) for x in base]
    tree = ngram_join.CountTree(np.array([len(x) for x in sets]), ngram_join.vectors([ngram_join.count_vector(x) for x in sets]))
    found = {(min(a, b), max(a, b)) for x, y in tree.join(80) for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                assert (j, i) in found
    assert len(found) < len(sets) * 4


def test_shingles_of_a_text_do_not_depend_on_its_neighbours_or_slices(monkeypatch):
    texts = ["a b c d e f g", "", None, "x " * 50, "ä ö ü ß é\u2028z", " lead and trail "]
    alone = [ngram_join.shingle_sets([t])[0].tolist() for t in texts]
    assert [x.tolist() for x in ngram_join.shingle_sets(texts)] == alone
    monkeypatch.setattr(ngram_join, "SEGMENT", 8)
    assert [x.tolist() for x in ngram_join.shingle_sets(texts)] == alone
    assert [len(x) for x in alone] == [len(plain_sets(t)) for t in texts]


def plain_vectors(rows, least):
    ok = [e is not None and l is not None and len(e) > 0 and all(x is not None and math.isfinite(x) for x in e) and any(e) for _, e, l in rows]
    links = []
    for i, (_, a, l) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if ok[i] and ok[j] and l == rows[j][2] and len(a) == len(b):
                x, y = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least:
                    links.append((i, j))
    groups = closure(range(len(rows)), links)
    least_id = {}
    for k, g in groups.items():
        if rows[k][0] is not None:
            least_id[g] = min(least_id.get(g, rows[k][0]), rows[k][0])
    n = np.bincount(np.array(links, int).ravel(), minlength=len(rows)) if links else np.zeros(len(rows), int)
    return sorted(((rows[k][0], int(n[k]), least_id.get(g)) for k, g in groups.items()), key=str)


@pytest.mark.parametrize("block, piece", [(4096, 256), (16, 4)])
def test_embeddings_agree_with_all_pairs(spark, monkeypatch, block, piece):
    monkeypatch.setattr(embedding_join, "BLOCK", block)
    monkeypatch.setattr(embedding_join, "PIECE", piece)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 16))
    rows = [(1000 - k, (centres[k % 12] + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.5])).astype(np.float32).tolist(), int(k % 3) if k % 7 else 0) for k in range(160)]
    rows += [(2000 + k, rows[0][1], rows[0][2]) for k in range(40)]  # equal vectors
    rows += [(3000, [0.0] * 16, 0), (3001, None, 0), (3002, [float("nan")] + [1.0] * 15, 0), (3003, [None] + [1.0] * 15, 0), (3004, [float("inf")] * 16, 0)]
    rows += [(3005, rows[0][1], None), (3006, rows[0][1][:8], 0), (3007, rows[0][1][:8], 0), (3008, [], 0), (3009, [1e-30] * 16, 1), (3010, [1e30] * 16, 1)]
    rows += [(None, rows[1][1], rows[1][2]), (999, rows[1][1], rows[1][2])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = embedding_join.near_duplicates(frame).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in found), key=str) == plain_vectors(rows, 0.93)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found if r["vec_id"] is not None)


def test_a_large_group_of_near_copies_makes_few_pairs(spark, docs, monkeypatch):
    """2000 texts with one different word each at either end link in one group: far fewer pairs than n squared meet."""
    made = []
    whole = ngram_join.verified

    def counted(pairs, sets, percent):
        made.append(pairs.count())
        return whole(pairs, sets, percent)

    monkeypatch.setattr(ngram_join, "verified", counted)
    common = " ".join(f"c{k}" for k in range(80))
    frame = docs(*((k, f"a{k} {common} b{k}") for k in range(2000)))
    found = ngram_join.jaccard_components(frame).collect()
    assert {r["component_id"] for r in found} == {0} and len(found) == 2000
    assert sum(made) <= 2 * 2000 * ngram_join.LEADERS


def test_texts_with_one_passage_that_do_not_link_are_not_all_compared(spark, docs, monkeypatch):
    made = []
    whole = ngram_join.verified

    def counted(pairs, sets, percent):
        made.append(pairs.count())
        return whole(pairs, sets, percent)

    monkeypatch.setattr(ngram_join, "verified", counted)
    passage = " ".join(f"p{k}" for k in range(60))
    frame = docs(*((k, f"{passage} " + " ".join(f"w{k}x{j}" for j in range(90))) for k in range(600)))
    found = ngram_join.jaccard_components(frame).collect()
    assert all(r["component_id"] == r["doc_id"] for r in found)
    assert sum(made) <= 600 * ngram_join.LEADERS


def test_documents_with_a_common_line_do_not_meet_by_it(spark, docs, monkeypatch):
    """The shingles of a line that all texts have come last, so groups stay small however many texts there are."""
    largest, real, line = [], ngram_join.tree_pairs, words(40)
    texts = [" ".join(words(60, 2 * k + 1) + line + words(60, 2 * k + 2)) for k in range(300)]
    rows = [*enumerate(texts), *((1000 + k, f"{texts[k]} more") for k in range(0, 300, 50))]

    def counted(groups, *rest, **named):
        largest.append(groups.groupBy("token").count().agg({"count": "max"}).first()[0])
        return real(groups, *rest, **named)

    monkeypatch.setattr(ngram_join, "tree_pairs", counted)
    found = ngram_join.jaccard_components(docs(*rows)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {k: k - 1000 if k >= 1000 else k for k, _ in rows}
    assert max(largest) <= 4


def test_groups_of_one_leaf_are_compared_as_a_tree_does():
    rng = np.random.default_rng(3)
    groups = []
    for many in rng.integers(1, ngram_join.LEAF, 40).tolist():
        base = rng.integers(0, 1 << 62, 900).astype(np.uint64)
        sets = [np.unique(np.concatenate((base[: int(rng.integers(600, 900))], rng.integers(0, 1 << 62, 90).astype(np.uint64)))) for _ in range(many)]
        node = rng.permutation(many)
        groups.append({
            "node": node, "root": node // 2, "home": rng.random(many) < 0.6, "n": np.array([len(one) for one in sets]),
            "counts": np.array([ngram_join.count_vector(one) for one in sets], object),
        })
    def pairs(found):
        return {*zip(*found, strict=True)}

    for group in groups:
        every = pairs(ngram_join._leaf_pairs([group], 80, False))
        assert every == pairs(ngram_join._group_pairs(group, 80, False))
        best = pairs(ngram_join._leaf_pairs([group], 80, True))
        assert best <= every and {*sum(best, ())} == {*sum(every, ())} and len(best) <= len({*sum(every, ())})
    assert pairs(ngram_join._leaf_pairs(groups, 80, False)) == set().union(*(pairs(ngram_join._leaf_pairs([group], 80, False)) for group in groups))
