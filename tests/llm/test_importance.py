from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from plaza.llm import importance

SMALL = "/root/testdata/sf0.001"


def plain(docs, target, most=1, n_buckets=10_000, percent=10, least=20, seed=2024):
    """The draw in a few loops: {(doc_id, n_features, weight, score): rank}, by row."""

    def features(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(importance.WORD, lowered)
        return len(words), [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]

    def bucket(feature):
        return zlib.crc32(feature.encode()) % n_buckets

    raw = Counter(bucket(f) for _, text in docs for f in features(text)[1])
    wanted = Counter(bucket(f) for text in target for f in features(text)[1])
    all_raw, all_wanted = sum(raw.values()), sum(wanted.values())
    rows = []
    for doc, text in docs:
        n, own = features(text)
        gains = [math.floor(1000 * math.log((wanted[b] + 1) * (all_raw + n_buckets) / ((raw[b] + 1) * (all_wanted + n_buckets)))) for b in map(bucket, own)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append((n, (doc, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))))))
    enough = sorted((r for n, r in rows if n >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = {k: row for k, row in enumerate(enough[: len(enough) * percent // 100], 1)}
    found = [(*row, k) for k, row in drawn.items()]
    return sorted(found + [(*r, None) for r in enough[len(drawn) :]] + [(*r, None) for n, r in rows if n < least], key=str)


def found(frame):
    return sorted(map(tuple, frame.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_draw_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    target = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    wanted = plain([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in target.collect()])
    assert found(importance.resample(docs, target)) == wanted
    assert sum(r[4] is not None for r in wanted) == sum(r[1] >= 20 for r in wanted) // 10


@pytest.mark.parametrize("most", [1, 2, 3])
def test_odd_rows(spark, docs, most):
    long = " ".join(f"w{k % 977}" for k in range(60_000))
    given = [
        (1, None), (2, ""), (3, " \n-- "), (4, "ÄÖÜ İstanbul ǅ 漢字 a\u0085b c" * 10), (None, "no id " * 30), (5, "Same words here " * 10),
        (5, "Same words here " * 10), (5, "other words " * 12), (6, long), *((k, f"text {k} of many " * 6) for k in range(10, 40)),
    ]
    target = spark.createDataFrame([("same words",), (None,), ("",), ("漢字 c",)], "text string")
    frame = docs(*given).selectExpr("*", "'x' as score", "'y' as rank", "1 as buckets", "2 as _row")
    drawn = importance.resample(frame, target, most_words=most, n_buckets=997, percent=30, least_words=5)
    assert found(drawn) == plain(given, ["same words", None, "", "漢字 c"], most, 997, 30, 5)


def test_nothing(spark, docs):
    none = docs()
    assert found(importance.resample(none, none)) == []
    one = docs((1, "a few words " * 10))
    assert found(importance.resample(one, none)) == plain([(1, "a few words " * 10)], [])
    assert [r[4] for r in found(importance.resample(one, none, percent=100))] == [1]


def test_windows_are_those_of_the_joined_words():
    text = "One  two,Threeé four"
    n, own = importance.Buckets(3, 1 << 20).of(text)
    words = ["one", "two", "threeé", "four"]
    runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(4 - k + 1)]
    assert n == 4 and own.dtype == np.dtype("<u4")
    assert own.tolist() == [zlib.crc32(r.encode()) % (1 << 20) for r in runs]


def test_many_equal_scores_get_different_ranks(spark, docs):
    frame = docs(*((7, "the same text again and again " * 4) for _ in range(500)))
    ranks = [r[4] for r in found(importance.resample(frame, docs((1, "text")), percent=50))]
    assert sorted(r for r in ranks if r) == list(range(1, 251)) and ranks.count(None) == 250
