"""One key with a third of all rows: no row lost, no list unbounded, no task with all of it."""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from plaza.operators import dedupe, merge, skew, topk
from plaza.operators.nesting import collect_in_parts

N = 30000


@pytest.fixture
def skewed(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    return spark.range(0, N, 1, 8).select(hot.alias("k"), F.col("id").alias("v"))


def test_one_row_per_key_and_task_is_shuffled(spark, skewed):
    kept = dedupe.dedupe_ranked(skewed, ["k"], [F.col("v").desc()])
    assert rows(kept.where("k = 'hot'"), "v") == [(N - 3,)]
    assert kept.count() == skewed.select("k").distinct().count()
    shuffled = kept._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in shuffled


def test_hot_target_key_is_updated_everywhere(spark, skewed):
    source = spark.createDataFrame([("hot", -1), ("k1", -2), ("new", -3)], "k string, v bigint")
    for threshold in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            merged = merge.upsert(skewed, source, ["k"])
            got = merged.agg(
                F.count_if(F.col("v") == -1), F.count_if(F.col("v") == -3), F.count(F.lit(1))
            ).first()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert tuple(got) == (N // 3, 1, N + 1)


def test_hot_key_without_a_value_never_matches(spark, skewed):
    loose = skewed.withColumn("k", F.when(F.col("k") != "hot", F.col("k")))
    merged = merge.upsert(loose, spark.createDataFrame([(None, -1), ("k1", -2)], "k string, v bigint"), ["k"])
    assert merged.where("k IS NULL").count() == N // 3 + 1
    assert merged.where("v = -1").count() == 1


def test_hot_list_is_split(spark, skewed):
    nested = collect_in_parts(skewed, ["k"], ["v"], ["v"], into="vs", max_items=500)
    sizes = nested.select("k", F.size("vs").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] == 500
    assert sizes.agg(F.sum("n")).first()[0] == N
    assert sizes.where("k = 'hot'").count() == N // 3 // 500
    assert nested.select(F.explode("vs.v").alias("v")).distinct().count() == N


@pytest.mark.parametrize("hot", [1, 400, 100_000])
def test_lists_do_not_depend_on_which_keys_are_hot(spark, skewed, hot):
    nested = collect_in_parts(skewed, ["k"], ["v"], ["v"], into="vs", max_items=300, hot=hot)
    wanted = collect_in_parts(skewed, ["k"], ["v"], ["v"], into="vs", max_items=300)
    columns = ["k", "part", "parts", "total", F.col("vs.v").alias("v")]
    assert sorted(map(str, nested.select(*columns).collect())) == sorted(map(str, wanted.select(*columns).collect()))


def test_best_rows_of_a_hot_group(spark, skewed):
    best = topk.top_per_group(skewed, ["k"], [F.col("v").desc()], 3)
    assert rows(best.where("k = 'hot'"), "v", "rank") == [(N - 9, 3), (N - 6, 2), (N - 3, 1)]


def test_rows_meet_their_group_once_in_every_kind_of_join(spark, skewed):
    groups = spark.createDataFrame([("hot", 1), ("k1", 2), ("absent", 3)], "k string, g int")
    found = {
        how: skew.join_groups(skewed, groups, ["k"], how).count()
        for how in ("inner", "left", "left_semi", "left_anti")
    }
    plain = {how: skewed.join(groups, "k", how).count() for how in found}
    assert found == plain and plain["inner"] > N // 3


def test_a_hot_group_is_split_by_what_was_measured(spark, skewed):
    """Without a broadcast, AQE splits the hot key's partition; no row is repeated for it."""
    groups = skewed.groupBy("k").agg(F.count("*").alias("n"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = skew.join_groups(skewed, groups, ["k"], "inner")
        assert "Generate" not in joined._jdf.queryExecution().executedPlan().toString()
        dealt = joined.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    tasks = Counter(row["task"] for row in dealt if row["k"] == "hot")
    assert len(tasks) > 1 and tasks.total() == N // 3 and max(tasks.values()) < N // 4


def test_a_join_that_cannot_be_split_is_refused(skewed):
    with pytest.raises(ValueError):
        skew.join_groups(skewed, skewed, ["k"], "full")


def test_the_passes_of_a_listing_share_the_rows(spark):
    counted = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    data = spark.range(50).selectExpr("id % 3 AS k", "id AS v").mapInArrow(seen, "k long, v long")
    lists = collect_in_parts(data, ["k"], ["v"], ["v"], into="vs", max_items=5, hot=16)
    assert sorted(row["v"] for part in lists.collect() for row in part["vs"]) == list(range(50))
    assert counted.value == 50
