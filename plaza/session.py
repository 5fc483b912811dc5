"""Session settings the operators rely on, and the folder all executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Weeks and ISO dates are computed in the session zone, so it must be UTC. The join and
# shuffle sizes are left to AQE: it sees the real bytes of each side and each partition.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app_name: str = "plaza", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may fall back to a
    temporary folder; on a cluster a missing setting is an error.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="plaza-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_held = threading.local()


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Delete the folders that are staged inside the block when it ends, also after an error.

    For steps that have written their result by then; a frame that is handed on must not need them.
    """
    outer, _held.paths = getattr(_held, "paths", None), []
    try:
        yield
    finally:
        for path in _held.paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        _held.paths = outer


def together(spark: SparkSession, *steps: Callable[[], None]) -> None:
    """Run steps that write different tables at the same time; all have ended when an error is raised.

    What they stage is deleted with the block around them.
    """
    paths = getattr(_held, "paths", None)

    def run(step: Callable[[], None]) -> None:
        _held.paths = paths
        step()

    with ThreadPoolExecutor(len(steps)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(run), step) for step in steps]
    for one in started:
        one.result()


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage for frames that several later jobs read. Unlike a cached block the
    files survive a lost executor, and the scan that replaces the plan has exact sizes, so
    the optimizer can choose a broadcast from them.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    if getattr(_held, "paths", None) is not None:
        _held.paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
