from __future__ import annotations

import random
from pathlib import Path

import pytest
from conftest import plan, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from plaza.operators import merge
from plaza.session import freeing, new_folder, shared_dir, stage
from plaza.sources import tables

DDL = "k string, v bigint, d string"


def frame(spark, data):
    return spark.createDataFrame(data, DDL)


def test_insert_only_leaves_known_rows(spark):
    target = frame(spark, [("a", 1, "x"), (None, 2, "x")])
    source = frame(spark, [("a", 9, "y"), ("b", 3, "y"), ("b", 4, "y"), (None, 5, "y")])
    assert rows(merge.insert_new(target, source, ["k"])) == rows(
        frame(spark, [("a", 1, "x"), (None, 2, "x"), ("b", 3, "y"), ("b", 4, "y"), (None, 5, "y")])
    )


def test_guard_and_null_guard(spark):
    target = frame(spark, [("a", 1, "2"), ("b", 1, "2"), ("c", 1, None)])
    source = frame(spark, [("a", 9, "1"), ("b", 9, "2"), ("c", 9, "3")])
    got = merge.upsert(target, source, ["k"], guard=merge.not_older("d"))
    assert rows(got) == [("a", 1, "2"), ("b", 9, "2"), ("c", 1, None)]


def test_newer_wins_and_a_missing_time_gives_way(spark):
    def timed(data):
        return spark.createDataFrame(data, "k string, v int, t string").withColumn("t", F.col("t").cast("timestamp"))

    target = timed([("a", 1, "2024-01-02"), ("b", 1, None), ("c", 1, "2024-01-02")])
    source = timed([("a", 2, "2024-01-02"), ("b", 2, "2024-01-01"), ("c", 2, "2024-01-03")])
    got = merge.upsert(target, source, ["k"], guard=merge.strictly_newer("t"))
    assert rows(got, "k", "v") == [("a", 1), ("b", 2), ("c", 2)]


def test_partial_update_and_extra_source_columns(spark):
    target = frame(spark, [("a", 1, "old")])
    source = frame(spark, [("a", 2, "new"), ("b", 3, "new")]).withColumn("extra", F.lit(1))
    got = merge.upsert(target, source, ["k"], update=["v"])
    assert rows(got) == [("a", 2, "old"), ("b", 3, "new")]


def test_two_source_rows_for_one_target_row_raise(spark):
    target = frame(spark, [("a", 1, "x")])
    twice = frame(spark, [("a", 2, "x"), ("a", 3, "x")])
    for act in (lambda df: df.collect(), lambda df: df.count()):
        with pytest.raises(PySparkException, match="several source rows"):
            act(merge.upsert(target, twice, ["k"]))
    unknown = frame(spark, [("b", 2, "x"), ("b", 3, "x")])
    assert merge.upsert(target, unknown, ["k"]).count() == 3


def test_copies_in_the_target_are_all_updated(spark):
    target = frame(spark, [("a", 1, "x"), ("a", 2, "x"), ("b", 1, "x")])
    got = merge.upsert(target, frame(spark, [("a", 9, "y")]), ["k"])
    assert rows(got) == [("a", 9, "y"), ("a", 9, "y"), ("b", 1, "x")]


def test_file_order_breaks_ties_of_a_day(spark):
    first, second = frame(spark, [("a", 1, "d1")]), frame(spark, [("a", 2, "d1")])
    guard = merge.not_older("d", "v")
    for one, other in ((first, second), (second, first)):
        assert rows(merge.upsert(one, other, ["k"], guard=guard)) == [("a", 2, "d1")]


KEYS = ["case", "k"]


def random_case(seed):
    """Old and new rows of one case, at most one per key and side, and what a merge must give."""
    pick = random.Random(seed)

    def side():
        chosen = pick.sample(["a", "b", "c", None], pick.randint(0, 4))
        return [(seed, key, pick.randint(0, 3), pick.choice("123")) for key in chosen]

    old, new = side(), side()
    expected = {row[1]: row for row in old if row[1] is not None}
    for row in new:
        if row[1] is not None and (row[1] not in expected or row[3] >= expected[row[1]][3]):
            expected[row[1]] = row
    loose = [row for row in old + new if row[1] is None]
    return old, new, [*expected.values(), *loose]


def test_upsert_agrees_with_a_dictionary_and_repeats(spark):
    cases = [random_case(seed) for seed in range(300)]
    old, new, expected = ([row for case in cases for row in case[at]] for at in range(3))
    ddl = "case int, k string, v int, d string"
    target, source = spark.createDataFrame(old, ddl), spark.createDataFrame(new, ddl)
    once = stage(merge.upsert(target, source, KEYS, guard=merge.not_older("d")))
    assert rows(once) == rows(spark.createDataFrame(expected, ddl))
    again = merge.upsert(once, source.where("k IS NOT NULL"), KEYS, guard=merge.not_older("d"))
    assert rows(again) == rows(once)


@pytest.fixture
def table(spark):
    name = "t" + new_folder(spark, "x").rsplit("-", 1)[1]
    tables.create_table(spark, name, "k STRING, v BIGINT, d STRING, p STRING", location=new_folder(spark, "t"), partition="p")
    return name


def with_p(spark, data):
    return spark.createDataFrame(data, "k string, v bigint, d string, p string")


def test_table_merge_keeps_rows_in_their_folder(spark, table):
    merge.merge_table(spark, table, with_p(spark, [("a", 1, "1", "p1"), ("b", 1, "1", "p1"), ("c", 1, "1", "p2")]), ["k"], partition="p")
    merge.merge_table(
        spark, table, with_p(spark, [("a", 2, "2", "p3"), ("d", 1, "1", "p3"), ("c", 0, "0", "p2")]), ["k"], partition="p",
        guard=merge.not_older("d"),
    )
    assert rows(tables.open_table(spark, table)) == [
        ("a", 2, "2", "p1"), ("b", 1, "1", "p1"), ("c", 1, "1", "p2"), ("d", 1, "1", "p3")
    ]


def test_table_merge_does_not_touch_other_folders(spark, table):
    merge.merge_table(spark, table, with_p(spark, [("a", 1, "1", "p1"), ("c", 1, "1", "p2")]), ["k"], partition="p")

    def files_of(folder):
        files = spark.table(table).where(F.col("p") == folder).select(F.input_file_name()).distinct()
        spark.catalog.refreshTable(table)
        return rows(files)

    before = files_of("p2")
    merge.merge_table(spark, table, with_p(spark, [("a", 2, "2", "p1")]), ["k"], partition="p")
    assert files_of("p2") == before


def test_table_append_is_repeatable(spark, table):
    batch = with_p(spark, [("a", 1, "1", "p1"), ("a", 1, "1", "p2"), ("b", 1, "1", None)])
    for _ in range(2):
        merge.append_new(spark, table, batch.where("p IS NOT NULL"), ["k", "p"], "p")
    assert rows(tables.open_table(spark, table), "k", "p") == [("a", "p1"), ("a", "p2")]


def test_replacing_rows_removes_those_without_a_fresh_one(spark, table):
    merge.merge_table(
        spark, table, with_p(spark, [("a", 1, "1", "p1"), ("b", 1, "1", "p1"), ("c", 1, "1", "p2"), (None, 1, "1", None)]),
        ["k"], partition="p",
    )
    touched = with_p(spark, [("a", 0, "", "p1"), ("c", 0, "", "p2"), (None, 0, "", None)]).select("k", "p")
    fresh = with_p(spark, [("a", 5, "5", "p1")])
    merge.replace_rows(spark, table, touched, fresh, ["k"], "p")
    assert rows(tables.open_table(spark, table)) == [("a", 5, "5", "p1"), ("b", 1, "1", "p1")]


def test_a_later_session_finds_the_stored_rows(spark, table):
    merge.merge_table(spark, table, with_p(spark, [("a", 1, "1", "p1")]), ["k"], partition="p")
    location = [row["data_type"] for row in tables.describe(spark, table).collect() if row["col_name"] == "Location"][0]
    again = table + "_again"
    tables.create_table(spark, again, "k STRING, v BIGINT, d STRING, p STRING", location=location, partition="p")
    assert rows(tables.open_table(spark, again)) == [("a", 1, "1", "p1")]
    assert tables.open_table(spark, location).count() == 1


def test_row_level_formats_get_the_native_merge(spark, table, monkeypatch):
    monkeypatch.setattr(merge, "ROW_LEVEL_PROVIDERS", ("parquet",))
    with pytest.raises(PySparkException, match="MERGE"):  # parquet itself has none
        merge.merge_table(
            spark, table, with_p(spark, [("a", 1, "1", "p1")]), ["k"], partition="p", guard=merge.not_older("d")
        )
    one = with_p(spark, [("a", 1, "1", "p1")])
    with pytest.raises(PySparkException, match="MERGE"):
        merge.replace_rows(spark, table, one.select("k", "p"), one, ["k"], "p")


def test_other_file_formats(spark):
    name = "t" + new_folder(spark, "x").rsplit("-", 1)[1]
    tables.create_table(
        spark, name, "k STRING, v BIGINT, d STRING, p STRING", location=new_folder(spark, "orc"), partition="p",
        provider="orc",
    )
    for v in (1, 2):
        merge.merge_table(spark, name, with_p(spark, [("a", v, "1", "p1"), (f"b{v}", v, "1", "p2")]), ["k"], partition="p")
    assert rows(tables.open_table(spark, name), "k", "v") == [("a", 2), ("b1", 1), ("b2", 2)]


def test_staged_folders_are_freed(spark):
    name = "freed_" + new_folder(spark, "t").rsplit("-", 1)[1]
    tables.create_table(spark, name, "k INT, v INT, p INT", location=new_folder(spark, "freed"), partition="p")

    def left():
        return {path.name for path in Path(shared_dir(spark)).iterdir() if path.name.split("-")[0] in ("merge", "append", "replace", "s")}

    before = left()
    for value in (1, 2):
        merge.merge_table(spark, name, spark.createDataFrame([(1, value, 0)], "k int, v int, p int"), ["k"], partition="p")
        merge.append_new(spark, name, spark.createDataFrame([(9, value, 0)], "k int, v int, p int"), ["k", "p"], "p")
    assert left() == before and sorted(map(tuple, spark.table(name).collect())) == [(1, 2, 0), (9, 1, 0)]
    with pytest.raises(RuntimeError), freeing(spark):
        stage(spark.range(3), "s")
        raise RuntimeError
    assert left() == before


def test_rows_without_a_key_are_appended_once(spark):
    name = "loose_" + new_folder(spark, "t").rsplit("-", 1)[1]
    tables.create_table(spark, name, "id STRING, v INT, _loaded_at INT, p INT", location=new_folder(spark, "loose"), partition="p", comment="it's one")
    batch = [("a", 1, 0, 0), (None, 1, 0, 0), (None, 2, 0, 0), (None, None, 0, 0)]
    for run in range(3):
        rows_ = [(key, v, run, p) for key, v, _, p in batch]
        merge.append_new(spark, name, spark.createDataFrame(rows_, "id string, v int, _loaded_at int, p int"), ["id", "p"], "p")
    assert sorted((tuple(row) for row in spark.table(name).collect()), key=str) == sorted(batch, key=str)


def test_one_wide_and_one_key_scan_of_the_target(spark):
    path = new_folder(spark, "wide")
    spark.range(2000).select(F.col("id").alias("k"), F.lit(1).alias("v"), F.lit("x").alias("w")).write.parquet(path)
    spark.range(1500, 2500).select(F.col("id").alias("k"), F.lit(2).alias("v"), F.lit("y").alias("w")).write.parquet(path + "-s")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(merge.upsert(spark.read.parquet(path), spark.read.parquet(path + "-s"), ["k"])).split("== Physical Plan ==")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [line for line in text.splitlines() if "FileScan" in line]
    # The target once whole and once for its keys; the source twice whole and once for its keys.
    assert len(scans) == 5 and sum("w#" in line for line in scans) == 3
