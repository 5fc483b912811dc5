from __future__ import annotations

import json

import pytest
from conftest import post, rows
from pyspark.sql import functions as F

from plaza import schemas
from plaza.operators import quality, state
from plaza.sources import paths, snapshots

IDS = "subreddit string, id string"


def ids(spark, *pairs):
    return spark.createDataFrame(list(pairs), IDS)


def test_unseen_ids_decide_per_community(spark):
    seen = ids(spark, ("a", "1"), ("a", "2"), ("b", "1"), ("z", "9"))
    current = ids(spark, ("a", "2"), ("a", "3"), ("a", None), ("b", "1"), ("c", "1"))
    assert rows(state.unseen(current, seen)) == [("a", "3"), ("c", "1")]
    assert rows(state.worth_saving(current, seen)) == [("a", None), ("a", "2"), ("a", "3"), ("c", "1")]
    assert rows(state.next_seen(current, seen)) == [("a", "2"), ("a", "3"), ("b", "1"), ("c", "1"), ("z", "9")]


def test_an_id_that_left_is_new_again(spark):
    seen = state.next_seen(ids(spark, ("a", "2")), ids(spark, ("a", "1")))
    assert rows(state.unseen(ids(spark, ("a", "1")), seen)) == [("a", "1")]


def test_comment_candidates(spark):
    posts = spark.createDataFrame(
        [("s", "p1", 10, 5), ("s", "p2", 0, 20), ("s", "p3", 100, 4), ("s", "p4", None, 6), ("s", "p5", 1, None), ("t", "q", 1, 9)],
        "subreddit string, id string, score bigint, num_comments bigint",
    )
    cache = spark.createDataFrame([("p1", 5), ("p2", 19)], "post_id string, num_comments bigint")
    got = state.comment_candidates(posts, cache, min_comments=5, top_k=2)
    assert rows(got, "id", "engagement", "place", "changed") == [
        ("p1", 20, 2, False), ("p2", 40, 1, True), ("q", 19, 1, True)
    ]
    assert rows(state.candidate_stats(got)) == [("s", 2, 1, 1), ("t", 1, 0, 1)]
    fetched = got.where("changed").select(F.col("id").alias("post_id"), "num_comments")
    assert rows(state.next_comment_cache(cache, fetched)) == [("p1", 5), ("p2", 20), ("q", 9)]


def test_the_quota_applies_before_finished_communities_leave(spark):
    posts = ids(spark, *[("big", str(n)) for n in range(5)], *[("mid", str(n)) for n in range(4)],
                *[("low", str(n)) for n in range(3)], ("tiny", "1"))
    done = spark.createDataFrame([("big",)], "subreddit string")
    assert rows(state.eligible_communities(posts, done)) == [("low", 3), ("mid", 4)]
    assert rows(state.eligible_communities(posts, done, limit=2)) == [("mid", 4)]
    assert rows(state.eligible_communities(posts, limit=2)) == [("big", 5), ("mid", 4)]


@pytest.fixture
def envelopes(spark, tmp_path, put):
    def without(name):
        return {key: value for key, value in post("x").items() if key != name}

    put(tmp_path, "good", "2024-03-30", "raw_a.json", {"posts": [post("1", score=4), post("2", title=None, score=6), without("title"), post("3")]})
    put(tmp_path, "half", "2024-03-30", "raw_a.json", {"posts": [without("id"), post("4", subreddit="other")]})
    put(tmp_path, "bad", "2024-03-30", "raw_a.json", {"posts": [without("id"), without("created_utc"), post("5")]})
    put(tmp_path, "none", "2024-03-30", "raw_a.json", {"posts": []})
    return snapshots.read_envelopes(spark, paths.snapshot_glob(str(tmp_path)), schemas.RAW_POST_SNAPSHOT)


def test_profile_and_gates(spark, envelopes):
    checked = quality.with_checks(quality.raw_posts(envelopes))
    profile = quality.quality_profile(checked)
    assert rows(profile, "community", "posts", "invalid", "communities") == [
        ("bad", 3, 2, 1), ("good", 4, 1, 1), ("half", 2, 1, 2), ("none", 0, 0, 0)
    ]
    good = profile.where("community = 'good'").first()
    assert (good["avg_score"], good["max_score"]) == (7.5, 10)
    assert rows(quality.communities_found(checked)) == [("bad", "tools"), ("good", "tools"), ("half", "other"), ("half", "tools")]
    kept = quality.lenient_gate(checked, profile)
    assert {row["community"] for row in kept.select("community").distinct().collect()} == {"good", "half"}
    with pytest.raises(quality.QualityError, match="bad"):
        quality.strict_gate(checked, profile)
    fine = checked.where("community IN ('good', 'half')")
    assert quality.strict_gate(fine, quality.quality_profile(fine)).count() == 6


def test_null_counts_as_missing_only_on_request(spark, envelopes):
    raw = quality.raw_posts(envelopes).where("community = 'good'")
    strict = quality.quality_profile(quality.with_checks(raw, not_null=True))
    assert rows(strict, "invalid") == [(2,)]


def test_text_that_is_no_object_is_invalid(spark):
    raw = spark.createDataFrame([("a", "[1]"), ("a", json.dumps(post("1"))), ("a", "x")], "community string, raw string")
    assert rows(quality.quality_profile(quality.with_checks(raw)), "posts", "invalid") == [(3, 2)]
