"""Nest rows into lists without ever building an unbounded list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaza.operators.skew import join_groups
from plaza.session import stage


def _ranks(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Number the rows of each key from 0 in the stated order, however many a key has.

    Rows are sorted into ranges by key and order; a row's rank is its place within its range plus
    the sizes of the key's earlier ranges. The ranges are written, so that both sides see the same.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *keys, *order).withColumn("_range", F.spark_partition_id())
    ranged = stage(ranged, "ranges")
    sizes = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range", *keys).orderBy(*order))
    numbered = join_groups(ranged.withColumn("_place", place), starts, [*keys, "_range"], "inner", null_safe=True)
    return numbered.withColumn("_rank", F.col("_start") + F.col("_place") - 1).drop("_start", "_place", "_range")


def collect_in_parts(
    df: DataFrame,
    keys: Sequence[str],
    items: Sequence[str],
    order: Sequence[str],
    *,
    into: str,
    max_items: int = 1000,
    hot: int = 100_000,
) -> DataFrame:
    """Per key, the rows as sorted lists of structs: keys, part, parts, total and the list.

    Every list but the last of a key has ``max_items`` rows, and the parts follow each other in
    the stated order, so their concatenation is sorted; ``total`` counts the key's rows. The
    ``order`` columns must tell the rows of a key apart. No row is dropped.

    A narrow pass finds the keys with more than ``hot`` rows. All others are numbered, cut and
    listed in one shuffle by key; those are numbered in sorted ranges, so that no task has to
    sort a whole hot key. The passes share the rows, which are written first.
    """
    df = stage(df.select(*dict.fromkeys([*keys, *items, *order])), "items")
    element = F.struct(
        *[F.col(name).alias(f"_order{at}") for at, name in enumerate(order)],
        F.struct(*items).alias("_item"),
    )
    listed = F.transform(F.array_sort(F.collect_list(element)), lambda row: row["_item"]).alias(into)
    part: Column = F.floor(F.col("_rank") / max_items).cast("int").alias("part")
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"))
    parts = F.ceil(F.col("total") / max_items).cast("int").alias("parts")
    shown = [*keys, "part", parts, "total", into]

    def numbered_by_key(rows: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
        lists = rows.withColumn("_rank", place).groupBy(*keys, part).agg(listed)
        total = F.sum(F.size(into)).over(Window.partitionBy(*keys))
        return lists.withColumn("total", total).select(*shown)

    if (sizes.agg(F.max("total")).first()[0] or 0) <= hot:
        return numbered_by_key(df)
    large = stage(sizes.where(F.col("total") > hot), "large-keys")
    ranked = _ranks(join_groups(df, large.select(*keys), keys, "left_semi", null_safe=True), keys, order)
    cut = join_groups(ranked.groupBy(*keys, part).agg(listed), large, keys, "inner", null_safe=True).select(*shown)
    rest = join_groups(df, large.select(*keys), keys, "left_anti", null_safe=True)
    return numbered_by_key(rest).unionByName(cut)
