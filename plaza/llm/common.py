"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plaza.session import new_folder

# Rows per Arrow batch: a batch of documents stays small although some are very long.
BATCH_ROWS = "512"
ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Python tasks that read whole texts."""
    spark.conf.set(ROWS, BATCH_ROWS)


def pieces(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``most_bytes`` in each piece, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        first, held = 0, 0
        for row, size in enumerate(sizes):
            if held and held + size > most_bytes:
                yield batch.slice(first, row - first)
                first, held = row, 0
            held += size
        yield batch.slice(first)


def gathered(batches: Iterable[pa.RecordBatch], column: str, least_bytes: int, most: int = 16) -> Iterator[pa.RecordBatch]:
    """Put following record batches together until ``column`` takes ``least_bytes``, at most ``most`` of them."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= least_bytes or len(held) == most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def hash52(*parts: Column | str) -> Column:
    """52 bits of the md5 of the parts joined by ':', as a long; other engines can compute it too."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``: a plain reference may be computed for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def unit(hashed: Column) -> Column:
    """A 52-bit hash as a number strictly between 0 and 1."""
    return (hashed.cast("double") + 0.5) / float(2**52)


def log_factorials(most: int) -> list[float]:
    return [math.lgamma(k + 1) for k in range(most + 1)]


# Shuffle files of a finished write go at once instead of when the driver collects garbage.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Intermediate tables of one operator in the shared folder, which are dropped when they have served.

    Lineage is cut by them, so a lost executor costs the running step only.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path, before = new_folder(self.spark, label), self.spark.conf.get(CLEAN, "false")
        self.spark.conf.set(CLEAN, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(CLEAN, before)
        self.paths[label] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *labels: str) -> None:
        for label in labels:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(label))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
