"""What the path of a snapshot file says, and lists of such files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The layout reddit/{community}/date=YYYY-MM-DD/{file}. The community level may
# also be written name=value, as a partitioned Spark write does.
LAYOUT = r"(?:^|/)reddit/(?:[^/=]+=)?([^/]+)/date=(\d{4}-\d{2}-\d{2})/(.+)$"
VALID_KEY = r"^reddit/[^/]+/date=\d{4}-\d{2}-\d{2}/.+\.json$"
POST_FILES = "raw_*.json"
COMMENT_FILES = "comments_*.json"
# A time stamp in a file's name; an extraction of many items is several files that share it.
EXTRACTION = r"^(?:raw|comments)_\d{4}-\d{2}-\d{2}T\d{2}_\d{2}_\d{2}"
DAILY_FILES = "raw[.-]*json"


def snapshot_glob(root: str, files: str = POST_FILES, community: str = "*", date: str = "*") -> str:
    """The glob of one kind of file below ``root``; naming a community or day prunes the listing."""
    level = community if community == "*" else f"{{{community},*={community}}}"
    return f"{root.rstrip('/')}/reddit/{level}/date={date}/{files}"


def folders_and_files(glob: str) -> tuple[str, str | None]:
    """A glob of :func:`snapshot_glob` as the glob of its folders and the pattern of its files; others stay whole.

    Spark lists a folder in one call, but every file that a glob names in a call (and task) of its own.
    """
    folders, _, files = glob.rpartition("/")
    return (folders, files) if folders.rpartition("/")[2].startswith("date=") else (glob, None)


def in_day(source_file: Column) -> Column:
    """True for files right below their day's folder. Folders are listed with all below them, as Spark would take
    a further ``name=value`` level for partitions."""
    return source_file.rlike(r"/date=[^/]*/[^/]+$")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def is_post_snapshot(path: Column) -> Column:
    return base_name(path).startswith("raw_") & base_name(path).endswith(".json")


def is_comment_snapshot(path: Column) -> Column:
    return base_name(path).rlike(r"^comments_.*\.json$")


def is_valid_path(path: Column) -> Column:
    return path.rlike(VALID_KEY)


def decode_key(key: Column) -> Column:
    """Undo URL encoding of an object key (``+`` is a space); a key that is none stays as it is."""
    return F.coalesce(F.try_url_decode(key), key)


def read_path() -> Column:
    """The path of the file a row was read from, with its URL encoding undone."""
    return decode_key(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def with_path_columns(df: DataFrame, path: Column | None = None) -> DataFrame:
    """Add community, ingest_date, file_name and source_file; rows outside the layout are dropped."""
    source = read_path() if path is None else path

    def part(group: int) -> Column:
        return F.regexp_extract("source_file", LAYOUT, group)

    return (
        df.withColumn("source_file", source)
        .withColumns({"community": part(1), "ingest_date": part(2), "file_name": base_name(part(3))})
        .where(F.col("community") != "")
    )


def list_files(spark: SparkSession, glob: str) -> DataFrame:
    """One row per file, without reading any content."""
    return list_files_in(spark, *folders_and_files(glob))


def list_files_in(spark: SparkSession, folders: str | list[str], pattern: str | None) -> DataFrame:
    """The same of the files with such a name in some days' folders."""
    schema = "path string, modificationTime timestamp, length bigint"
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    try:
        files = reader.load(folders).select("path", "modificationTime", "length")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], schema)
    return with_path_columns(files.where(in_day(F.col("path"))) if pattern else files, F.col("path"))


def extraction(path: Column) -> Column:
    """What the files of one extraction share: kind and time stamp, or else the file's own name."""
    stamp = F.regexp_extract(base_name(path), EXTRACTION, 0)
    return F.when(stamp != "", stamp).otherwise(base_name(path))


def snapshot_counts(files: DataFrame) -> DataFrame:
    """Extractions per community and day, unreadable ones included; the files of a large one count once."""
    path = F.col("path")
    taken = files.select(
        "community", "ingest_date", is_post_snapshot(path).alias("posts"),
        is_comment_snapshot(path).alias("comments"), extraction(path).alias("extraction"),
    ).distinct()
    return taken.groupBy("community", "ingest_date").agg(
        F.count_if("posts").alias("snapshots"), F.count_if("comments").alias("comment_snapshots")
    )


def latest_file_per_community(files: DataFrame) -> DataFrame:
    """The files of the extraction with the greatest path, per community: one, or its parts."""
    post_files = files.where(is_post_snapshot(F.col("path"))).withColumn("_taken", extraction(F.col("path")))
    last = post_files.groupBy("community").agg(F.max("path").alias("_last"))
    last = last.select(
        "community", F.regexp_replace("_last", "/[^/]+$", "").alias("_folder"), extraction(F.col("_last")).alias("_taken")
    )
    folder = F.regexp_replace("path", "/[^/]+$", "")
    found = post_files.withColumn("_folder", folder).join(last, ["community", "_folder", "_taken"], "left_semi")
    return found.select("community", "path")
