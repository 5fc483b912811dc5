"""Keep one row per key, chosen by a total order.

All of these rank rows in a window and keep rank 1 directly on the rank column, so Spark
prunes each partition to one row per key before the shuffle. A key that a third of the rows
share costs one row per map task, not one overloaded task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaza.functions.values import is_filled

SNAPSHOT_ORDER = ("community", "ingest_date", "file_name", "position")


def dedupe_ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def newest_first(df: DataFrame, leading: Sequence[str]) -> list[Column]:
    """Descending by ``leading`` (those the frame has), then by all other columns.

    With every column in the order, two runs over the same rows keep the same row.
    """
    first = [name for name in leading if name in df.columns]
    rest = sorted(name for name in df.columns if name not in first)
    return [F.col(name).desc_nulls_last() for name in first + rest]


def dedupe_latest_snapshot(
    df: DataFrame, keys: Sequence[str] = ("community", "ingest_date", "id")
) -> DataFrame:
    """Per id, the version in the last file (by name), and there the last position."""
    known = df.where(is_filled(F.col("id")))
    return dedupe_ranked(known, keys, [F.col(name).desc() for name in ("file_name", "position")])


def dedupe_across_communities(df: DataFrame, by_time: bool = False) -> DataFrame:
    """Per id over all communities, the version in the last path, or the latest by time."""
    leading = ["snapshot_at"] if by_time else []
    order = [F.col(name).desc_nulls_last() for name in (*leading, *SNAPSHOT_ORDER)]
    return dedupe_ranked(df.where(is_filled(F.col("id"))), ["id"], order)


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first occurrence per id; rows without an id are dropped."""
    return dedupe_ranked(df.where(is_filled(F.col("id"))), keys, [F.col(name).asc() for name in order])


def dedupe_loaded(df: DataFrame, keys: Sequence[str] = ("id", "_ingest_date")) -> DataFrame:
    """One Bronze row per id and day: latest load, then last file and position, then post_id.

    Rows without an id are no versions of each other: all of them stay.
    """
    leading = ["_loaded_at", "_source_file", "file_name", "position", "post_id"]
    known = dedupe_ranked(df.where(F.col("id").isNotNull()), keys, newest_first(df, leading))
    return known.unionByName(df.where(F.col("id").isNull()))
