"""Read JSON snapshot files of posts and comments."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from plaza import schemas
from plaza.functions.values import if_blank, to_double, to_long
from plaza.sources.paths import folders_and_files, in_day, with_path_columns

WHERE_FROM = ["community", "ingest_date", "file_name", "source_file"]
_CAST = {LongType(): to_long, DoubleType(): to_double}
# A file is one record: JSON has no unescaped control characters, so nothing in a file ends a line. With
# multiLine, Spark reads every number that is wanted as text by a seek and a read of the file.
WHOLE_FILE = {"multiLine": "false", "lineSep": "\x1e-- no line of a snapshot ends --\x1e"}


def read_envelopes(
    spark: SparkSession, paths: str | list[str], schema: str, files: str | None = None
) -> DataFrame:
    """One row per file. An unreadable file has a NULL payload; no file at all gives no rows."""
    reader = spark.read.schema(schema).options(**WHOLE_FILE).option("mode", "PERMISSIVE")
    listed = None
    if isinstance(paths, str) and not files:
        paths, listed = folders_and_files(paths)
    if files or listed:
        reader = reader.option("pathGlobFilter", files or listed)
    if listed:
        reader = reader.option("recursiveFileLookup", True)
    try:
        raw = reader.json(paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame([], schema).withColumn("_path", F.lit(""))
        return with_path_columns(raw, F.col("_path")).drop("_path")
    rows = with_path_columns(raw)
    return rows.where(in_day(F.col("source_file"))) if listed else rows


def stream_files(spark: SparkSession, glob: str, schema: str, max_files: int) -> DataFrame:
    """New files as :func:`read_envelopes` reads them, some per trigger."""
    folders, files = folders_and_files(glob)
    reader = spark.readStream.schema(schema).options(**WHOLE_FILE).option("maxFilesPerTrigger", max_files)
    if files:
        reader = reader.option("pathGlobFilter", files).option("recursiveFileLookup", True)
    rows = with_path_columns(reader.json(folders))
    return rows.where(in_day(F.col("source_file"))) if files else rows


def snapshot_time() -> Column:
    return F.coalesce(F.nullif("snapshot_at", F.lit("")), F.nullif("saved_at", F.lit("")))


def _items(envelopes: DataFrame, payload: str, ddl: str) -> DataFrame:
    fields = schemas.struct(ddl).fields
    taken_at = snapshot_time().alias("snapshot_at")
    rows = envelopes.select(*WHERE_FROM, taken_at, F.posexplode(payload).alias("position", "item"))
    values = [
        _CAST.get(field.dataType, lambda column: column)(F.col(f"item.{field.name}")).alias(field.name)
        for field in fields
    ]
    return rows.select(*WHERE_FROM, "snapshot_at", "position", *values)


def posts_of(envelopes: DataFrame) -> DataFrame:
    """One row per post, with its place (file and position) in the snapshots."""
    return _items(envelopes, "posts", schemas.BRONZE_POSTS)


def comments_of(envelopes: DataFrame) -> DataFrame:
    """One row per comment; the subreddit is the one in the path."""
    return _items(envelopes, "comments", schemas.BRONZE_COMMENTS).withColumn("subreddit", F.col("community"))


def read_post_snapshots(spark: SparkSession, paths: str | list[str], files: str | None = None) -> DataFrame:
    return posts_of(read_envelopes(spark, paths, schemas.POST_SNAPSHOT, files))


def read_comment_snapshots(spark: SparkSession, paths: str | list[str], files: str | None = None) -> DataFrame:
    return comments_of(read_envelopes(spark, paths, schemas.COMMENT_SNAPSHOT, files))


def last_snapshot_times(envelopes: DataFrame) -> DataFrame:
    """Per community and day, the time stamp of the last file that carries one."""
    return (
        envelopes.select("community", "ingest_date", "file_name", snapshot_time().alias("taken_at"))
        .where(F.col("taken_at").isNotNull())
        .groupBy("community", "ingest_date")
        .agg(F.max_by("taken_at", "file_name").alias("last_snapshot_at"))
    )


def with_lineage(items: DataFrame) -> DataFrame:
    """The Bronze lineage columns, from the path columns."""
    return items.withColumns(
        {
            "_ingest_date": F.col("ingest_date"),
            "_source_file": F.col("source_file"),
            "_loaded_at": F.current_timestamp(),
        }
    )


def labelled(flair: Column, default: str = "Sem flair") -> Column:
    return if_blank(flair, default)
