"""Write snapshot files: one JSON envelope per file, below community and day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaza.operators.nesting import collect_in_parts

_PREFIX = {"posts": "raw", "comments": "comments"}


def _envelopes(items: DataFrame, payload: str, order: Sequence[str], date: str, max_items: int) -> DataFrame:
    fields = [name for name in items.columns if name not in order or name == "id"]
    # A community of several files is cut by ranges, so that different tasks write them.
    grouped = collect_in_parts(
        items, ["subreddit"], fields, [*order, "id"], into=payload, max_items=max_items, hot=max_items
    )
    return grouped.select(
        F.col("subreddit").alias("community"),
        F.lit(date).alias("date"),
        "subreddit",
        F.lit(date).alias("execution_date"),
        F.col("total").alias("count"),
        "part",
        "parts",
        payload,
    )


def write_snapshots(
    items: DataFrame,
    root: str,
    *,
    date: str,
    snapshot_at: dt.datetime,
    payload: str = "posts",
    order: Sequence[str] = (),
    stats: Column | None = None,
    max_items: int = 1000,
) -> None:
    """Append the snapshot of one run: ``reddit/community=…/date=…/raw_<time>-….json``.

    A file holds one envelope of at most ``max_items`` items; a community with more gets more
    files, written by different tasks. They share the time in their names and say which ``part``
    of how many ``parts`` they are; ``count`` is the number of items of the whole extraction, and
    only the first part has the ``stats``. ``items`` must be distinct by id within a community.
    """
    envelopes = _envelopes(items, payload, order, date, max_items)
    envelopes = envelopes.withColumn("snapshot_at", F.lit(snapshot_at.isoformat()))
    if stats is not None:
        envelopes = envelopes.withColumn("stats", F.when(F.col("part") == 0, stats))
    _write(envelopes, root, "append", f"{_PREFIX[payload]}_{snapshot_at:%Y-%m-%dT%H_%M_%S}")


def write_daily(
    items: DataFrame, root: str, *, date: str, extracted_at: dt.datetime, order: Sequence[str] = (),
    max_items: int = 1000,
) -> None:
    """Replace the day's files of the communities in ``items``; other days and communities stay."""
    envelopes = _envelopes(items, "posts", order, date, max_items)
    envelopes = envelopes.withColumn("extracted_at", F.lit(extracted_at.isoformat()))
    _write(envelopes, root, "overwrite", "raw")


def _write(envelopes: DataFrame, root: str, mode: str, base_name: str) -> None:
    (
        envelopes.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        # The readers take one JSON object per file and find the files by their prefix.
        .option("maxRecordsPerFile", 1)
        .option("mapreduce.output.basename", base_name)
        .partitionBy("community", "date")
        .json(f"{root.rstrip('/')}/reddit")
    )
