"""The plans Spark makes: what is pruned, pushed down, broadcast, and kept out of Python."""

from __future__ import annotations

import re

import pytest
from conftest import SMALL, plan
from pyspark.sql import functions as F

from checks import bindings as b
from checks.queries import QUERIES
from plaza.functions.dates import week_of
from plaza.operators import dedupe, merge, state
from plaza.plans import context, fallback, gold, insights, serve
from plaza.plans.medallion import created_within
from plaza.session import new_folder
from plaza.sources import listings

LAZY = [
    name for name in QUERIES
    if not re.search("read|streamed|replayed|snapshot_|daily|table|published_posts|last_snapshot", name)
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert not re.search("CartesianProduct|NestedLoopJoin|PythonUDF|ArrowEval|MapInPandas|PythonEval", text)


def physical(df):
    return plan(df).split("== Physical Plan ==")[1]


def test_deduplication_prunes_before_the_shuffle(spark):
    posts = b.snapshot_posts(spark, SMALL)
    for frame in (
        dedupe.dedupe_latest_snapshot(posts), dedupe.dedupe_across_communities(posts),
        dedupe.dedupe_first(posts, ["id"], ["position"]),
        dedupe.dedupe_loaded(posts.withColumnRenamed("ingest_date", "_ingest_date")),
    ):
        # Read upwards: a partial limit, the exchange, then the final limit.
        assert re.search(r"Final.*Exchange hashpartitioning.*Partial", physical(frame), re.DOTALL)


def test_best_rows_per_group_are_pruned_before_the_shuffle(spark):
    built = context.build_context(b.documents_as_posts(spark, SMALL), b.lines_as_comments(spark, SMALL))
    text = physical(built)
    assert text.count("row_number(), 15, Partial") == 1 and text.count("row_number(), 20, Partial") == 1
    cache = spark.createDataFrame([], "post_id string, num_comments bigint")
    assert "row_number(), 50, Partial" in physical(state.comment_candidates(b.snapshot_posts(spark, SMALL), cache))


def test_top_lists_do_not_sort_everything(spark):
    assert "TakeOrderedAndProject(limit=30" in physical(QUERIES["top_silver_posts"](spark, SMALL))
    assert "TakeOrderedAndProject(limit=15" in physical(QUERIES["tool_rankings"](spark, SMALL))


def test_scans_read_only_what_is_used(spark):
    text = physical(gold.weekly_post_metrics(b.bronze_posts(spark, SMALL)))
    schema = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {"o_totalprice", "o_orderdate", "o_orderpriority"}


def test_tools_are_extracted_once(spark):
    silver = fallback.fallback_silver(b.documents_as_posts(spark, SMALL))
    for frame in (fallback.tool_rankings(silver), fallback.fallback_summary(silver)):
        assert physical(frame).count("regexp_extract_all") == 1


def test_a_listing_is_parsed_once(spark):
    assert physical(listings.parse_post_listing(b.post_listings(spark, SMALL))).count("from_json") == 1


def test_a_small_source_leaves_the_target_unshuffled(spark):
    path = new_folder(spark, "target")
    spark.range(20000).select(F.col("id").alias("k"), F.lit(1).alias("v")).write.parquet(path)
    spark.createDataFrame([(1, 2)], "k bigint, v int").write.parquet(path + "-s")
    text = physical(merge.upsert(spark.read.parquet(path), spark.read.parquet(path + "-s"), ["k"]))
    assert "SortMergeJoin" not in text
    # The target (without the suffix) is scanned right below a join, as the streamed side.
    for line in [line for line in text.splitlines() if re.search(r"target-\w+[,\]]", line) and "FileScan" in line]:
        above = text[: text.index(line)].splitlines()
        indent = len(line) - len(line.lstrip(" :+-"))
        parents = [row for row in above if len(row) - len(row.lstrip(" :+-")) < indent]
        assert "Exchange" not in next(row for row in reversed(parents) if "Join" in row or "Exchange" in row)


def test_a_large_source_is_not_broadcast(spark):
    path = new_folder(spark, "large")
    spark.range(2000).select(F.col("id").alias("k"), F.lit(1).alias("v")).write.parquet(path)
    frame = spark.read.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = physical(merge.upsert(frame, frame.where("k > 5"), ["k"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in text and "SortMergeJoin" in text and "FullOuter" not in text


def test_the_latest_run_prunes_partitions(spark):
    path = new_folder(spark, "insights")
    b.insights(spark, SMALL).write.partitionBy("execution_date").parquet(path)
    text = physical(insights.latest_run(spark.read.parquet(path)))
    assert re.search(r"PartitionFilters: \[isnotnull\(execution_date#\d+\), \(execution_date#\d+ = Subquery", text)


def test_week_ranges_reach_the_scan(spark):
    path = new_folder(spark, "weeks")
    posts = b.bronze_posts(spark, SMALL).select("id", "created_utc")
    posts.write.parquet(path)
    stored = spark.read.parquet(path)
    weeks = [row[0] for row in stored.select(week_of(F.col("created_utc")).cast("date")).distinct().collect()]
    two = sorted(weeks)[3:5]
    found = stored.where(created_within(two))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(created_utc", physical(found))
    expected = stored.where(week_of(F.col("created_utc")).cast("date").isin(two)).count()
    assert found.count() == expected > 0
    assert stored.where(created_within(weeks)).count() == stored.count()
    assert stored.where(created_within([])).count() == 0


def test_both_weeks_of_a_trend_come_from_one_scan(spark):
    text = physical(insights.compare_weeks(b.insights(spark, SMALL), as_of="2024-01-30"))
    assert text.count("FileScan") == 1 and "Join" not in text


def test_stats_of_all_days_need_no_window_over_everything(spark):
    files = b.snapshot_files(spark, SMALL)
    posts = dedupe.dedupe_latest_snapshot(b.snapshot_posts(spark, SMALL))
    times = posts.select("community", "ingest_date", F.lit("x").alias("last_snapshot_at")).distinct()
    assert "SinglePartition" not in physical(serve.post_stats(posts, files, times))
