"""Run registered queries beside their SQL and compare rows.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def differences(frame: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between the rows of a frame and of a SQL statement; nothing if equal."""
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} but SQL has {sorted(names)}"]
    expected = Counter(tuple(map(repr, row)) for row in cursor.fetchall())
    actual = Counter(tuple(map(repr, row)) for row in frame.select(*names).collect())
    found = [f"{len(names)} columns, {actual.total()} rows but SQL has {expected.total()}"] if (
        actual.total() != expected.total()
    ) else []
    found += [f"only Spark: {row}" for row in list(actual - expected)[:3]]
    found += [f"only SQL:   {row}" for row in list(expected - actual)[:3]]
    return found


def compare(spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> list[str]:
    """What differs for one registered query; errors are reported like differences."""
    try:
        frame = QUERIES[name](spark, sf_dir)
        if name in ORACLES:
            return differences(frame, connection.cursor(), ORACLES[name])
        return [] if frame.count() else ["no rows"]
    except Exception as error:  # noqa: BLE001 - reported per query
        return [f"{type(error).__name__}: {str(error)[:600]}"]


def compare_all(
    spark: SparkSession, sf_dir: str, names: Iterable[str], jobs: int = 6
) -> Iterator[tuple[str, list[str]]]:
    """Queries run side by side: on small tables each is short and mostly planning."""
    names, connection = list(names), connect(sf_dir)
    with ThreadPoolExecutor(jobs) as pool:
        yield from zip(names, pool.map(lambda name: compare(spark, connection, sf_dir, name), names), strict=True)


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    chosen = arguments[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    failed = 0
    for name, found in compare_all(spark, sf_dir, chosen):
        failed += bool(found)
        print(("FAIL " if found else "ok   ") + name + "".join(f"\n       {line}" for line in found), flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
