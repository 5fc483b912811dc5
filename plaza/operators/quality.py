"""Profile extracted posts and gate on the share of broken ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaza.functions.values import to_long
from plaza.operators.skew import join_groups
from plaza.sources.snapshots import WHERE_FROM

# The fields every post must have.
REQUIRED = ("id", "subreddit", "title", "created_utc")


class QualityError(ValueError):
    """A batch has no posts or too many broken ones."""


def raw_posts(envelopes: DataFrame) -> DataFrame:
    """One row per post as JSON text; a snapshot without posts keeps one row with NULL."""
    return envelopes.select(*WHERE_FROM, F.explode_outer("posts").alias("raw"))


def with_checks(raw: DataFrame, required: Sequence[str] = REQUIRED, not_null: bool = False) -> DataFrame:
    """Mark posts that lack a required field; with ``not_null`` a NULL field lacks, too."""
    wanted = F.array(*[F.lit(name) for name in required])
    keys = F.coalesce(F.json_object_keys("raw"), F.array().cast("array<string>"))
    invalid = F.size(F.array_except(wanted, keys)) > 0
    if not_null:
        for name in required:
            invalid = invalid | F.get_json_object("raw", f"$.{name}").isNull()
    return raw.withColumn("invalid", F.col("raw").isNotNull() & invalid)


def quality_profile(checked: DataFrame, batch: Sequence[str] = ("community",)) -> DataFrame:
    """Per batch: posts, broken posts, score statistics, and how many communities they name."""
    score = F.coalesce(to_long(F.get_json_object("raw", "$.score")), F.lit(0))
    present = F.col("raw").isNotNull()
    return (
        checked.withColumn("_score", F.when(present, score))
        .groupBy(*batch)
        .agg(
            F.count("raw").alias("posts"),
            F.count_if("invalid").alias("invalid"),
            F.avg("_score").alias("avg_score"),
            F.max("_score").alias("max_score"),
            F.count_distinct(F.get_json_object("raw", "$.subreddit")).alias("communities"),
        )
    )


def communities_found(checked: DataFrame, batch: Sequence[str] = ("community",)) -> DataFrame:
    """The names behind the profile's count, one row per batch and name."""
    named = checked.select(*batch, F.get_json_object("raw", "$.subreddit").alias("subreddit"))
    return named.where(F.col("subreddit").isNotNull()).distinct()


def passing(profile: DataFrame, max_invalid: float = 0.5) -> DataFrame:
    return profile.where((F.col("posts") > 0) & (F.col("invalid") <= F.col("posts") * max_invalid))


def failing(profile: DataFrame, batch: Sequence[str] = ("community",), max_invalid: float = 0.5) -> DataFrame:
    """The batches without posts or with too many broken ones."""
    good = passing(profile, max_invalid).select(*batch)
    return join_groups(profile, good, batch, "left_anti").select(*batch, "posts", "invalid")


def lenient_gate(posts: DataFrame, profile: DataFrame, batch: Sequence[str] = ("community",)) -> DataFrame:
    """Only the posts of passing batches."""
    return join_groups(posts, passing(profile).select(*batch), batch, "left_semi")


def strict_gate(posts: DataFrame, profile: DataFrame, batch: Sequence[str] = ("community",)) -> DataFrame:
    """The posts as they are, or an error naming some failing batches."""
    examples = failing(profile, batch).orderBy(*batch).head(5)
    if examples:
        raise QualityError(f"batches without posts or mostly invalid, first ones: {examples}")
    return posts
