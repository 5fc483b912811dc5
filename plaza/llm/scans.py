"""Running sums over sorted rows, spread over ranges of the order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaza.llm.common import Scratch
from plaza.operators.skew import join_groups


def running_sums(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str], sums: Mapping[str, Column], scratch: Scratch, label: str) -> DataFrame:
    """Add columns with the sums over the rows of a key up to and with each row, in the stated order.

    The rows are sorted into ranges by key and order, which are written to the shared folder; a sum is
    that within the range plus those of the key's earlier ranges. So no task holds a whole key, however
    many rows it has. ``order`` must tell the rows of a key apart; keys must not be NULL.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    valued = rows.withColumns({f"_value_{name}": value for name, value in sums.items()})
    ranged = scratch.write(valued.repartitionByRange(parts, *keys, *order).withColumn("_range", F.spark_partition_id()), label)
    totals = ranged.groupBy(*keys, "_range").agg(*[F.sum(f"_value_{name}").alias(f"_total_{name}") for name in sums])
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*keys, "_range", *[F.coalesce(F.sum(f"_total_{name}").over(earlier), F.lit(0)).alias(f"_before_{name}") for name in sums])
    upto = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = ranged.withColumns({f"_value_{name}": F.sum(f"_value_{name}").over(upto) for name in sums})
    found = join_groups(within, before, [*keys, "_range"], "inner")
    summed = found.withColumns({name: F.col(f"_value_{name}") + F.col(f"_before_{name}") for name in sums})
    return summed.drop("_range", *[f"_{kind}_{name}" for name in sums for kind in ("value", "before")])
