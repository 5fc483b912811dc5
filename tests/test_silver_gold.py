from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from plaza import schemas
from plaza.operators.dedupe import dedupe_loaded
from plaza.plans import gold, serve, silver

SUNDAY, MONDAY = 1711929599.0, 1711929600.0


def bronze_posts(spark, *items):
    names = schemas.columns(schemas.BRONZE_POSTS)
    return spark.createDataFrame([tuple(item.get(name) for name in names) for item in items], schemas.struct(schemas.BRONZE_POSTS))


def bronze_comments(spark, *items):
    names = schemas.columns(schemas.BRONZE_COMMENTS)
    return spark.createDataFrame([tuple(item.get(name) for name in names) for item in items], schemas.struct(schemas.BRONZE_COMMENTS))


def test_silver_posts_filters_and_defaults(spark):
    good = {"id": "1", "title": "t", "author": "a", "created_utc": 5.0}
    posts = bronze_posts(
        spark, good, {**good, "id": None}, {**good, "id": "2", "title": None}, {**good, "id": "3", "author": None},
        {**good, "id": "4", "author": "[deleted]"}, {**good, "id": "5", "author": "[removed]", "score": 3, "is_self": False},
    )
    got = silver.silver_posts(posts, "2024-03-30")
    assert got.columns == schemas.columns(schemas.SILVER_POSTS)
    shown = rows(got, "id", "score", "upvote_ratio", "num_comments", "is_self", "ingest_date")
    assert shown == [("1", 0, 0.0, 0, True, "2024-03-30"), ("5", 3, 0.0, 0, False, "2024-03-30")]
    assert rows(silver.silver_posts(posts, "d", silver.DELETED_OR_REMOVED), "id") == [("1",)]


def test_silver_comments_types(spark):
    said = bronze_comments(
        spark, {"id": "1", "body": "b", "author": "a", "depth": 2}, {"id": "2", "author": "a"},
        {"id": "3", "body": "b", "author": "a"},
    )
    got = silver.silver_comments(said, "d")
    assert dict(got.dtypes)["depth"] == "int"
    assert rows(got, "id", "depth", "score") == [("1", 2, 0), ("3", 0, 0)]


def test_text_numbers_are_cast_and_junk_becomes_the_default(spark):
    base = bronze_posts(spark, {"id": "1", "title": "t", "author": "a"})
    typed = base.withColumns({"score": F.lit("12"), "num_comments": F.lit("many")})
    assert rows(silver.silver_posts(typed, "d"), "score", "num_comments") == [(12, 0)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_the_kept_copy_does_not_depend_on_row_order(spark, seed):
    copies = [{"id": "1", "title": f"t{n}", "author": "a", "score": n} for n in range(20)]
    shuffled = bronze_posts(spark, *copies).orderBy(F.rand(seed)).repartition(4)
    assert rows(silver.silver_posts(shuffled, "d"), "title") == [("t19",)]  # the highest score


def test_bronze_duplicates_prefer_the_last_file_and_position_then_post(spark):
    said = spark.createDataFrame(
        [("c", "d", "f1", 9, "p9"), ("c", "d", "f2", 0, "p1"), ("c", "d", "f2", 0, "p2"), ("c", "e", "f0", 0, None)],
        "id string, _ingest_date string, file_name string, position int, post_id string",
    )
    assert rows(dedupe_loaded(said), "_ingest_date", "post_id") == [("d", "p2"), ("e", None)]


def posts_and_comments(spark):
    posts = silver.silver_posts(
        bronze_posts(
            spark,
            {"id": "1", "subreddit": "s", "title": "t", "author": "a", "score": 4, "num_comments": 1, "created_utc": SUNDAY},
            {"id": "2", "subreddit": "s", "title": "t", "author": "a", "score": 2, "num_comments": 2, "created_utc": SUNDAY},
            {"id": "3", "subreddit": "s", "title": "t", "author": "a", "score": 1, "created_utc": MONDAY},
        ), "d",
    )
    said = silver.silver_comments(
        bronze_comments(
            spark,
            {"id": "c1", "post_id": "1", "subreddit": "s", "author": "x", "body": "b", "score": 3, "created_utc": SUNDAY},
            {"id": "c2", "post_id": "1", "subreddit": "s", "author": "x", "body": "b", "score": 4, "created_utc": SUNDAY},
            {"id": "c3", "post_id": "1", "subreddit": "s", "author": "y", "body": "b", "created_utc": SUNDAY - 700000},
        ), "d",
    )
    return posts, said


def test_weeks_without_comments_without_posts_and_without_any(spark):
    posts, said = posts_and_comments(spark)
    columns = ["week_start", "post_count", "sum_score", "avg_comments_per_post", "total_comments_extracted", "unique_commenters"]
    assert rows(gold.subreddit_week(posts, said), *columns) == [
        ("2024-03-25", 2, 6, 1.5, 2, 1), ("2024-04-01", 1, 1, 0.0, None, None)
    ]
    assert rows(gold.subreddit_week(posts, said, fill_zero=True), *columns)[1] == ("2024-04-01", 1, 1, 0.0, 0, 0)
    assert rows(gold.subreddit_week(posts), *columns) == [
        ("2024-03-25", 2, 6, 1.5, 0, 0), ("2024-04-01", 1, 1, 0.0, 0, 0)
    ]
    approximate = gold.subreddit_week(posts, said, approximate=True)
    assert rows(approximate, *columns) == rows(gold.subreddit_week(posts, said), *columns)


def test_column_types_of_gold_match_the_table(spark):
    posts, said = posts_and_comments(spark)
    made = gold.stamped(gold.subreddit_week(posts, said), "d")
    assert dict(made.dtypes) == {f.name: f.dataType.simpleString() for f in schemas.struct(schemas.GOLD_WEEK)}
    people = gold.stamped(gold.top_commenters(said), "d")
    assert dict(people.dtypes) == {f.name: f.dataType.simpleString() for f in schemas.struct(schemas.GOLD_COMMENTERS)}


def test_commenters_and_summaries(spark):
    posts, said = posts_and_comments(spark)
    assert rows(gold.top_commenters(said)) == [("s", "x", 2, 7, 3.5, 1), ("s", "y", 1, 0, 0.0, 1)]
    weeks = gold.subreddit_week(posts, said)
    assert tuple(gold.gold_summary(weeks).first()) == (1, 3, 2.0, 2, 1)  # mean of the means 3 and 1
    assert rows(gold.exact_summary(posts, said)) == [("s", 3, 2.3, 3, 2)]


def test_layers(spark):
    posts, said = posts_and_comments(spark)
    got = serve.layer_status(posts, posts, gold.subreddit_week(posts, said))
    assert rows(got, "layer", "records", "subreddits") == [("Bronze", 3, 1), ("Gold", 3, 1), ("Silver", 3, 1)]
    best = got.where("layer = 'Silver'").select(F.get_json_object("sample", "$.id")).first()[0]
    assert best == "1"
