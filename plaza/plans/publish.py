"""The published snapshot: a bounded document of the leading rows, and all insights beside it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaza.operators.topk import ranked
from plaza.plans.gold import gold_summary
from plaza.plans.insights import nested_insights
from plaza.plans.serve import top_commenter_rows, top_silver_posts, top_weeks
from plaza.session import freeing, stage, together

# How many rows of each list are published.
POSTS, WEEKS, COMMENTERS = 50, 30, 20


def _listed(rows: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """A short list in one row; ``limit`` bounds it."""
    fields = rows.columns
    placed = ranked(rows, order, limit, "_place")
    entries = F.array_sort(F.collect_list(F.struct("_place", F.struct(*fields).alias("row"))))
    return placed.agg(F.transform(entries, lambda entry: entry["row"]).alias("rows"))


def snapshot_document(posts: DataFrame, weeks: DataFrame, commenters: DataFrame) -> DataFrame:
    """One row with ``layers``, ``silver_posts`` and ``gold``."""
    shown = top_silver_posts(posts, POSTS).withColumns(
        {"tools_mentioned": F.array().cast("array<string>"), "tools_count": F.lit(0)}
    )
    by_score = [F.col("score").desc(), F.col("id").asc()]
    by_posts = [F.col("post_count").desc(), F.col("week_start").asc(), F.col("subreddit").asc()]
    by_count = [F.col("comment_count").desc(), F.col("subreddit").asc(), F.col("author").asc()]
    totals = gold_summary(weeks)
    summary = totals.select(
        F.struct(
            *totals.columns, F.lit(0).alias("unique_tools"), F.lit(0).alias("posts_with_tools")
        ).alias("summary")
    )

    cleaned = posts.agg(F.count(F.lit(1)).alias("n"))
    document = summary.select(
        cleaned.scalar().alias("cleaned"),
        _listed(shown, by_score, POSTS).scalar().alias("silver_posts"),
        _listed(top_weeks(weeks, WEEKS), by_posts, WEEKS).scalar().alias("subreddit_week"),
        _listed(top_commenter_rows(commenters, COMMENTERS), by_count, COMMENTERS).scalar().alias("top_commenters"),
        "summary",
    )
    rankings = F.transform(
        "subreddit_week",
        lambda week: F.struct(
            week["subreddit"].alias("subreddit"),
            week["post_count"].alias("posts"),
            week["sum_score"].alias("total_score"),
            F.round(week["avg_score"], 1).alias("avg_score"),
        ),
    )
    gold = F.struct(
        rankings.alias("subreddit_rankings"),
        "subreddit_week",
        "top_commenters",
        F.array().cast("array<string>").alias("tool_rankings"),
        "summary",
    )
    total, first = F.col("summary.total_posts"), F.get(F.col("silver_posts"), F.lit(0))

    def layer(name: str, records: Column, sample: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"), F.lit("active").alias("status"),
            records.cast("bigint").alias("records"), F.to_json(sample).alias("sample"),
        )

    leaders = F.struct(
        F.get(rankings, F.lit(0)).alias("top_subreddit"),
        F.get(F.col("top_commenters"), F.lit(0)).alias("top_commenter"),
        "summary",
    )
    layers = F.array(
        layer("Bronze", total, F.struct(F.col("summary.unique_subreddits").alias("subreddits"))),
        layer("Silver", F.col("cleaned"), first),
        layer("Gold", total, leaders),
    )
    return document.select(layers.alias("layers"), "silver_posts", gold.alias("gold"))


def publish_snapshot(
    posts: DataFrame, weeks: DataFrame, commenters: DataFrame, insights: DataFrame | None, out: str
) -> None:
    """Write ``out/document`` (one JSON row) and ``out/insights`` (a JSON row per community).

    The lists in the document have fixed lengths. Insights grow with the communities, so they
    are written by many tasks next to it rather than inside it; without new insights the
    published ones stay. Both are written at the same time. The weeks are read for the totals and
    for the leading ones, so they are written first.
    """
    spark = posts.sparkSession

    def document() -> None:
        snapshot_document(posts, stage(weeks, "weeks"), commenters).write.mode("overwrite").json(f"{out}/document")

    def beside() -> None:
        nested_insights(insights).write.mode("overwrite").json(f"{out}/insights")

    with freeing(spark):
        together(spark, document, *([] if insights is None else [beside]))
