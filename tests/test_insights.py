from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from plaza.operators.nesting import collect_in_parts
from plaza.plans import gold, insights, publish
from plaza.session import new_folder

DAY = dt.date(2024, 1, 30)
NOW = dt.datetime(2024, 1, 30, 12)


def table(spark, *items):
    full = [(s, k, n, m, f"about {n}", NOW, d, "m") for s, k, n, m, d in items]
    ddl = ("subreddit string, insight_type string, item_name string, mentions int, context string, "
           "generated_at timestamp, execution_date date, model_version string")
    return spark.createDataFrame(full, ddl)


def days_ago(n):
    return DAY - dt.timedelta(days=n)


def answers(spark, *texts):
    return spark.createDataFrame([(f"c{at}", text) for at, text in enumerate(texts)], "subreddit string, answer string")


def test_answers_are_accepted_by_shape(spark):
    good = json.dumps({"trending_tools": [{"name": "x", "mentions": 3, "context": "c"}], "other": 1})
    texts = [good, '{"other": []}', "[1]", "no json", None, '{"solutions": []}', '"text"']
    assert rows(insights.parse_answers(answers(spark, *texts)), "subreddit") == [("c0",), ("c5",)]


def test_rows_of_answers_have_defaults(spark):
    answer = {
        "trending_tools": [{"name": "x", "mentions": "3"}, {"topic": "not a name"}, None],
        "pain_points": [{"topic": "slow", "mentions": 2, "context": "c"}],
        "solutions": None,
    }
    parsed = insights.parse_answers(answers(spark, json.dumps(answer)))
    got = insights.answers_to_rows(parsed, execution_date=F.lit(DAY), model_version=F.lit("m"))
    assert rows(got, "insight_type", "item_name", "mentions", "context") == [
        ("pain_points", "slow", 2, "c"), ("trending_tools", "", 0, ""), ("trending_tools", "x", 3, "")
    ]
    assert tuple(insights.answer_sizes(parsed).select(*insights.NAME_FIELD).first()) == (3, 1, 0)


def test_upsert_keeps_what_is_not_in_the_run(spark):
    old = table(spark, ("a", "solutions", "x", 1, DAY), ("a", "solutions", "y", 1, DAY), ("a", "solutions", "x", 1, days_ago(1)))
    new = table(spark, ("a", "solutions", "x", 5, DAY), ("b", "solutions", "x", 2, DAY))
    got = insights.upsert_insights(old, new)
    assert rows(got, "subreddit", "item_name", "mentions", "execution_date") == [
        ("a", "x", 1, days_ago(1)), ("a", "x", 5, DAY), ("a", "y", 1, DAY), ("b", "x", 2, DAY)
    ]


def test_latest_run_is_global_unless_asked(spark):
    known = table(spark, ("a", "solutions", "old", 1, days_ago(3)), ("b", "solutions", "new", 1, DAY))
    assert insights.community_insights(known, "a").count() == 0
    assert rows(insights.community_insights(known, "a", per_community=True), "item_name") == [("old",)]
    assert rows(insights.latest_run_per_community(known), "item_name") == [("new",), ("old",)]


def test_weeks_overlap_on_day_seven_unless_half_open(spark):
    known = table(
        spark, ("a", "trending_tools", "both", 4, days_ago(7)), ("a", "trending_tools", "now", 2, days_ago(1)),
        ("b", "trending_tools", "now", 1, days_ago(2)), ("a", "trending_tools", "before", 5, days_ago(14)),
        ("a", "trending_tools", "gone", 9, days_ago(15)), ("a", "solutions", "now", 50, DAY),
        ("a", "trending_tools", "empty", None, days_ago(1)),
    )
    assert rows(insights.compare_weeks(known, as_of=DAY)) == [
        ("before", 0, 5, -5), ("both", 4, 4, 0), ("empty", 0, 0, 0), ("now", 3, 0, 3)
    ]
    apart = insights.compare_weeks(known, as_of=str(DAY), half_open=True)
    assert ("both", 4, 0, 4) in rows(apart)


def test_recent_items(spark):
    known = table(spark, ("a", "pain_points", "in", 1, days_ago(7)), ("a", "pain_points", "out", 1, days_ago(8)))
    assert rows(insights.recent_items(known, as_of=DAY), "pain_point") == [("in",)]


def test_stale_communities(spark):
    posts = spark.createDataFrame([("fresh",), ("stale",), ("none",), ("none",)], "subreddit string")
    known = table(spark, ("fresh", "solutions", "x", 1, days_ago(7)), ("stale", "solutions", "x", 1, days_ago(8)),
                  ("unknown", "solutions", "x", 1, days_ago(90)))
    got = insights.stale_communities(posts, known, as_of=DAY)
    assert [tuple(row) for row in got.select("subreddit", "days_since_update").collect()] == [("stale", 8), ("none", None)]


def test_nested_lists_split_but_keep_every_item(spark):
    known = table(spark, *[("big", "solutions", f"i{n:03}", n, DAY) for n in range(60)], ("small", "pain_points", "x", 1, DAY))
    nested = insights.insights_by_community(known, max_items=10).collect()
    big = [row for row in nested if row["subreddit"] == "big"]
    assert [len(row["insights"]) for row in big] == [10] * 6
    in_order = [item["item_name"] for row in sorted(big, key=lambda row: row["part"]) for item in row["insights"]]
    assert in_order == [f"i{n:03}" for n in range(60)]
    assert {(row["subreddit"], row["parts"], row["total"]) for row in nested} == {("big", 6, 60), ("small", 1, 1)}
    whole = insights.nested_insights(known).where("subreddit = 'big'").first()["insights"]
    assert len(whole["solutions"]) == 60


def test_kinds_may_span_parts_or_be_missing(spark):
    known = table(spark, *[("a", kind, f"{kind}{n}", n, DAY) for kind in ("pain_points", "solutions") for n in range(5)],
                  ("a", None, "loose", 1, DAY))
    for at_most, parts in ((1000, 1), (4, 3)):
        got = sorted(insights.nested_insights(known, at_most).collect(), key=lambda row: row["part"])
        assert [(row["part"], row["parts"]) for row in got] == [(part, parts) for part in range(parts)]
        kinds = {}
        for row in got:
            for kind, items in row["insights"].items():
                kinds.setdefault(kind, []).extend(item["item_name"] for item in items)
        assert kinds == {
            "pain_points": [f"pain_points{n}" for n in range(5)], "solutions": [f"solutions{n}" for n in range(5)],
            "unknown": ["loose"],
        }


def test_parts_keep_the_group_without_a_key(spark):
    data = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    got = collect_in_parts(data, ["k"], ["v"], ["v"], into="vs")
    assert {row["k"]: [item["v"] for item in row["vs"]] for row in got.collect()} == {None: [1, 2], "a": [3]}


@pytest.mark.parametrize("with_insights", [True, False])
def test_published_document(spark, with_insights):
    posts = spark.createDataFrame(
        [(str(n), "s", f"t{n}", "x", "a", n, 0.5, 1, "d", "l", "f", True, "d", 1711800000.0) for n in range(60)],
        "id string, subreddit string, title string, selftext string, author string, score bigint, upvote_ratio double, "
        "num_comments bigint, created_date string, permalink string, flair string, is_self boolean, ingest_date string, "
        "created_utc double",
    )
    said = posts.select("subreddit", "author", "score", F.col("id").alias("post_id"), "created_utc")
    out = new_folder(spark, "out")
    publish.publish_snapshot(
        posts, gold.subreddit_week(posts, said), gold.top_commenters(said),
        table(spark, ("s", "solutions", "x", 1, DAY)) if with_insights else None, out,
    )
    document = spark.read.json(f"{out}/document").first()
    assert [layer["name"] for layer in document["layers"]] == ["Bronze", "Silver", "Gold"]
    assert [layer["records"] for layer in document["layers"]] == [60, 60, 60]
    assert len(document["silver_posts"]) == 50 and document["silver_posts"][0]["id"] == "59"
    assert document["gold"]["subreddit_rankings"][0]["posts"] == 60
    assert document["gold"]["summary"]["total_unique_commenters"] == 1
    if with_insights:
        assert spark.read.json(f"{out}/insights").first()["subreddit"] == "s"


def test_publishing_reads_the_weeks_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(community):
        read.add(1)
        return community

    posts = spark.createDataFrame(
        [("1", "s", "t", "x", "a", 1, 0.5, 1, "d", "l", "f", True, "d", 1711800000.0)],
        "id string, subreddit string, title string, selftext string, author string, score bigint, upvote_ratio double, "
        "num_comments bigint, created_date string, permalink string, flair string, is_self boolean, ingest_date string, "
        "created_utc double",
    )
    said = posts.select("subreddit", "author", "score", F.col("id").alias("post_id"), "created_utc")
    weeks = gold.subreddit_week(posts, said).withColumn("subreddit", seen.asNondeterministic()("subreddit"))
    out = new_folder(spark, "out")
    publish.publish_snapshot(posts, weeks, gold.top_commenters(said), None, out)
    assert read.value == 1
    assert spark.read.json(f"{out}/document").first()["gold"]["summary"]["total_posts"] == 1
