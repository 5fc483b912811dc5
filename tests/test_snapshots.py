from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import comment, plan, post, rows
from pyspark.sql import functions as F

from plaza import schemas
from plaza.operators.dedupe import dedupe_across_communities, dedupe_latest_snapshot
from plaza.plans import serve
from plaza.sources import paths, sinks, snapshots

DAY = "2024-03-30"


def read(spark, root):
    return snapshots.read_post_snapshots(spark, paths.snapshot_glob(str(root)))


@pytest.fixture
def two_snapshots(tmp_path, put):
    first = {"snapshot_at": "2024-03-30T10:00:00", "posts": [post("p1", title="old", score=5), post("p2")]}
    second = {"snapshot_at": "2024-03-30T14:00:00", "posts": [post("p1", title="new", score=50), post("p3")]}
    put(tmp_path, "tools", DAY, "raw_2024-03-30T10_00_00.json", first)
    put(tmp_path, "tools", DAY, "raw_2024-03-30T14_00_00.json", second)
    return tmp_path


def test_single_snapshot(spark, tmp_path, put):
    put(tmp_path, "tools", DAY, "raw_a.json", {"posts": [post("p1"), post("p2", flair=None), post("p3")]})
    got = read(spark, tmp_path)
    assert rows(got, "id", "community", "ingest_date", "position") == [
        ("p1", "tools", DAY, 0), ("p2", "tools", DAY, 1), ("p3", "tools", DAY, 2)
    ]


def test_a_file_is_read_at_once_and_whole(spark, tmp_path, put):
    """Numbers are wanted as text, which makes Spark seek for each of them if files are read with multiLine."""
    many = [post(f"p{k}", title="a\u2028b\nc", score=k) for k in range(3000)]
    put(tmp_path, "tools", DAY, "raw_a.json", {"posts": many})
    put(tmp_path, "tools", DAY, "raw_b.json", json.dumps({"posts": [post("q", score=1.50, title=2)]}, indent=1).replace("1.5", "1.50"))
    put(tmp_path, "tools", DAY, "raw_c.json", "{broken\nin two lines")
    put(tmp_path, "tools", DAY, "raw_d.json", " \n")
    put(tmp_path, "tools", f"{DAY}/hour=1", "raw_e.json", {"posts": [post("below")]})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        glob = paths.snapshot_glob(str(tmp_path))
        found = read(spark, tmp_path)
        assert sorted(rows(found, "id", "title", "score")) == sorted([(f"p{k}", "a\u2028b\nc", k) for k in range(3000)] + [("q", "2", 1)])
        assert snapshots.read_envelopes(spark, glob, schemas.POST_SNAPSHOT).count() == 3
        assert rows(paths.list_files(spark, glob).select("file_name")) == [(f"raw_{x}.json",) for x in "abcd"]
        # Folders are listed, not each of the files that a glob names.
        assert "InMemoryFileIndex(1 paths)" in plan(snapshots.read_envelopes(spark, glob, schemas.POST_SNAPSHOT))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_latest_version_wins(spark, two_snapshots):
    got = dedupe_latest_snapshot(read(spark, two_snapshots))
    assert rows(got, "id", "title", "score") == [("p1", "new", 50), ("p2", "title p2", 10), ("p3", "title p3", 10)]


def test_last_position_wins_within_a_file_and_blank_ids_go(spark, tmp_path, put):
    posts = [post("p1", score=1), post("p1", score=2), post(""), post(None)]
    put(tmp_path, "tools", DAY, "raw_a.json", {"posts": posts})
    assert rows(dedupe_latest_snapshot(read(spark, tmp_path)), "id", "score") == [("p1", 2)]


def test_missing_and_empty_folders(spark, tmp_path, put):
    assert read(spark, tmp_path / "nowhere").count() == 0
    put(tmp_path, "tools", DAY, "readme.txt", "x")
    assert read(spark, tmp_path).count() == 0
    assert paths.list_files(spark, paths.snapshot_glob(str(tmp_path))).count() == 0


def test_corrupt_file_is_counted_but_gives_no_rows(spark, tmp_path, put):
    put(tmp_path, "tools", DAY, "raw_corrupt.json", "{invalid json")
    put(tmp_path, "tools", DAY, "raw_valid.json", {"posts": [{"id": "ok", "title": "Valid"}]})
    files = paths.list_files(spark, paths.snapshot_glob(str(tmp_path)))
    assert rows(paths.snapshot_counts(files), "snapshots") == [(2,)]
    assert rows(read(spark, tmp_path), "id") == [("ok",)]


def test_mistyped_fields_do_not_lose_the_file(spark, tmp_path, put):
    odd = [post("p1", score="12"), post("p2", score="many"), post("p3", created_utc=1711800000, score=7.0)]
    put(tmp_path, "tools", DAY, "raw_a.json", {"posts": odd})
    assert rows(read(spark, tmp_path), "id", "score", "created_utc") == [
        ("p1", 12, 1711800000.0), ("p2", None, 1711800000.0), ("p3", 7, 1711800000.0)
    ]


def test_missing_payload_is_empty(spark, tmp_path, put):
    put(tmp_path, "tools", DAY, "raw_a.json", {"snapshot_at": "x"})
    assert read(spark, tmp_path).count() == 0


def test_comments_take_the_community_of_the_path(spark, tmp_path, put):
    said = {"snapshot_at": "s", "comments": [comment("c1", subreddit="wrong"), comment("c2", depth=1)]}
    put(tmp_path, "tools", DAY, "comments_a.json", said)
    put(tmp_path, "tools", DAY, "raw_a.json", {"posts": [post("p1")]})
    glob = paths.snapshot_glob(str(tmp_path), paths.COMMENT_FILES)
    got = snapshots.read_comment_snapshots(spark, glob)
    assert rows(got, "id", "subreddit", "depth") == [("c1", "tools", 0), ("c2", "tools", 1)]


def test_last_snapshot_time_skips_blank_ones(spark, tmp_path, put):
    put(tmp_path, "tools", DAY, "raw_a.json", {"snapshot_at": "first", "posts": []})
    put(tmp_path, "tools", DAY, "raw_b.json", {"snapshot_at": "", "saved_at": "second", "posts": []})
    put(tmp_path, "tools", DAY, "raw_c.json", {"snapshot_at": "", "posts": []})
    heads = snapshots.read_envelopes(spark, paths.snapshot_glob(str(tmp_path)), schemas.POST_SNAPSHOT)
    assert rows(snapshots.last_snapshot_times(heads), "last_snapshot_at") == [("second",)]


def test_reading_one_community_and_day(spark, tmp_path, put):
    for community in ("tools", "books"):
        for day in (DAY, "2024-03-31"):
            put(tmp_path, community, day, "raw_a.json", {"posts": [post(f"{community}{day}")]})
    glob = paths.snapshot_glob(str(tmp_path), community="books", date=DAY)
    assert rows(snapshots.read_post_snapshots(spark, glob), "id") == [(f"books{DAY}",)]


def test_pages(spark, two_snapshots):
    unique = dedupe_latest_snapshot(read(spark, two_snapshots))
    files = paths.list_files(spark, paths.snapshot_glob(str(two_snapshots)))
    first = serve.posts_page(unique, "tools", DAY, number=1, per_page=2).select("id").collect()
    second = serve.posts_page(unique, "tools", DAY, number=2, per_page=2).select("id").collect()
    assert [row[0] for row in first] == ["p1", "p2"]
    assert [row[0] for row in second] == ["p3"]
    info = serve.page_summary(unique, files, "tools", DAY, per_page=2)
    assert rows(info, "total", "pages", "snapshots") == [(3, 2, 2)]
    nothing = serve.page_summary(unique, files, "absent", DAY)
    assert rows(nothing, "total", "pages", "snapshots") == [(0, 0, 0)]
    with pytest.raises(ValueError):
        serve.posts_page(unique, "tools", DAY, sort_by="author")


def test_statistics_and_catalog(spark, two_snapshots, put):
    put(two_snapshots, "tools", DAY, "comments_a.json", {"comments": [comment("c1"), comment("c2", post_id=None)]})
    put(two_snapshots, "empty", DAY, "raw_a.json", {"posts": []})
    root = str(two_snapshots)
    unique = dedupe_latest_snapshot(read(spark, root))
    said = dedupe_latest_snapshot(
        snapshots.read_comment_snapshots(spark, paths.snapshot_glob(root, paths.COMMENT_FILES))
    )
    files = paths.list_files(spark, paths.snapshot_glob(root, "*.json"))
    heads = snapshots.read_envelopes(spark, paths.snapshot_glob(root), schemas.POST_SNAPSHOT)
    stats = serve.post_stats(unique, files, snapshots.last_snapshot_times(heads)).first()
    assert (stats["total"], stats["snapshots"], stats["score_max"], stats["score_min"]) == (3, 2, 50, 10)
    assert stats["score_avg"] == 23.3
    assert stats["flairs"] == {"Talk": 3}
    assert [row["title"] for row in stats["top_posts"]] == ["new", "title p2", "title p3"]
    assert stats["last_snapshot_at"] == "2024-03-30T14:00:00"
    talk = serve.comment_stats(said, files, snapshots.last_snapshot_times(heads)).first()
    assert (talk["total"], talk["unique_posts_with_comments"], talk["unique_authors"]) == (2, 2, 1)
    catalog = {row["subreddit"]: row for row in serve.community_catalog(unique, said, files).collect()}
    assert catalog["tools"]["total_posts"] == 3
    assert catalog["tools"]["dates"][0].asDict() == {
        "date": DAY, "count": 3, "snapshots": 2, "comments_count": 2, "comment_snapshots": 1
    }
    assert catalog["empty"]["total_posts"] == 0


def test_across_communities_the_last_path_wins_or_the_latest_time(spark, tmp_path, put):
    put(tmp_path, "a", DAY, "raw_b.json", {"snapshot_at": "2", "posts": [post("p1", score=1)]})
    put(tmp_path, "b", DAY, "raw_a.json", {"snapshot_at": "1", "posts": [post("p1", score=2)]})
    got = read(spark, tmp_path)
    assert rows(dedupe_across_communities(got), "score") == [(2,)]
    assert rows(dedupe_across_communities(got, by_time=True), "score") == [(1,)]


def test_sink_splits_a_large_community_and_loses_nothing(spark, tmp_path):
    posts = spark.range(100).select(
        F.concat(F.lit("p"), "id").alias("id"), F.when(F.col("id") < 95, "big").otherwise("small").alias("subreddit"),
        F.col("id").alias("score"), F.col("id").alias("place"),
    )
    at = dt.datetime(2024, 3, 30, 10)
    sinks.write_snapshots(posts, str(tmp_path), date=DAY, snapshot_at=at, order=["place"], max_items=20)
    files = paths.list_files(spark, paths.snapshot_glob(str(tmp_path)))
    counted = {row["community"]: row["n"] for row in files.groupBy("community").agg(F.count("*").alias("n")).collect()}
    assert counted["big"] == 5 and counted["small"] == 1
    assert rows(paths.snapshot_counts(files), "community", "snapshots") == [("big", 1), ("small", 1)]
    assert paths.latest_file_per_community(files).where("community = 'big'").count() == 5
    heads = spark.read.json(paths.snapshot_glob(str(tmp_path)))
    assert rows(heads.where("subreddit = 'big'"), "part", "parts", "count") == [(part, 5, 95) for part in range(5)]
    got = read(spark, tmp_path)
    assert rows(got, "id", "score") == rows(posts, "id", "score")
    assert got.groupBy("file_name").count().agg(F.max("count")).first()[0] == 20
    # A later run adds files and replaces none.
    sinks.write_snapshots(
        posts.where("id = 'p1'"), str(tmp_path), date=DAY, snapshot_at=at.replace(hour=11), order=["place"]
    )
    assert read(spark, tmp_path).count() == 101


@pytest.mark.parametrize(
    ("key", "is_post", "valid"),
    [
        ("reddit/python/date=2026-03-30/raw_2026-03-30T12_00_00.json", True, True),
        ("reddit/python/date=2026-03-30/comments_2026.json", False, True),
        ("reddit/python/posts_cache.json", False, False),
        ("reddit/python/date=2026-03-30/raw_data.csv", False, False),
        ("raw_test.json", True, False),
        ("readme.md", False, False),
        ("reddit/python/2026-03-30/raw_data.json", True, False),
        ("reddit/date=2026-03-30/raw_data.json", True, False),
        ("other/python/date=2026-03-30/raw_data.json", True, False),
        ("reddit/python/date=2026-3-30/raw_data.json", True, False),
    ],
)
def test_keys(spark, key, is_post, valid):
    got = spark.createDataFrame([(key,)], "path string").select(
        paths.is_post_snapshot(F.col("path")), paths.is_valid_path(F.col("path"))
    )
    assert rows(got) == [(is_post, valid)]


def test_decoding_of_keys(spark):
    keys = spark.createDataFrame([("a+b%2Fc",), ("100%",)], "k string")
    assert rows(keys.select(paths.decode_key(F.col("k")))) == [("100%",), ("a b/c",)]
