"""Clean Bronze rows into Silver rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaza import schemas
from plaza.operators.dedupe import dedupe_ranked, newest_first

DELETED = ("[deleted]",)
DELETED_OR_REMOVED = ("[deleted]", "[removed]")

# What a missing number or flag becomes.
DEFAULTS = {
    "score": 0,
    "upvote_ratio": 0.0,
    "num_comments": 0,
    "is_self": True,
    "depth": 0,
}
LINEAGE = ["_source_file"]


def _clean(
    bronze: DataFrame, ddl: str, required: Sequence[str], ingest_date: str | None,
    drop_authors: Sequence[str],
) -> DataFrame:
    fields = [field for field in schemas.struct(ddl).fields if field.name != "ingest_date"]
    kept = bronze.where(~F.col("author").isin(*drop_authors))
    for name in required:
        kept = kept.where(F.col(name).isNotNull())

    def value(name: str, kind: str) -> Column:
        column = F.col(name) if kind == bronze.schema[name].dataType.simpleString() else F.col(name).try_cast(kind)
        return F.coalesce(column, F.lit(DEFAULTS[name]).cast(kind)) if name in DEFAULTS else column

    day = F.col("_ingest_date") if ingest_date is None else F.lit(ingest_date)
    place = [name for name in ("_source_file", "file_name", "position") if name in bronze.columns]
    typed = kept.select(
        *[value(field.name, field.dataType.simpleString()).alias(field.name) for field in fields],
        day.cast("string").alias("ingest_date"),
        *place,
    )
    return typed


def _newest(typed: DataFrame) -> DataFrame:
    place = ["ingest_date", "_source_file", "file_name", "position"]
    return dedupe_ranked(typed, ["id"], newest_first(typed, place)).drop("file_name", "position")


def clean_posts(
    bronze: DataFrame, ingest_date: str | None = None, drop_authors: Sequence[str] = DELETED
) -> DataFrame:
    """Posts with id, title and a known author, typed and defaulted, with their place: all versions."""
    return _clean(bronze, schemas.SILVER_POSTS, ["id", "title"], ingest_date, drop_authors)


def clean_comments(
    bronze: DataFrame, ingest_date: str | None = None, drop_authors: Sequence[str] = DELETED
) -> DataFrame:
    return _clean(bronze, schemas.SILVER_COMMENTS, ["id", "body"], ingest_date, drop_authors)


def silver_posts(
    bronze: DataFrame, ingest_date: str | None = None, drop_authors: Sequence[str] = DELETED
) -> DataFrame:
    """Posts with id, title and a known author, typed, defaulted, one per id.

    The day is the argument, or each row's ``_ingest_date``. ``_source_file`` is kept if the
    input has it: the merge uses it to order files of one day.
    """
    return _newest(clean_posts(bronze, ingest_date, drop_authors))


def silver_comments(
    bronze: DataFrame, ingest_date: str | None = None, drop_authors: Sequence[str] = DELETED
) -> DataFrame:
    return _newest(clean_comments(bronze, ingest_date, drop_authors))
