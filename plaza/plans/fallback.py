"""Rankings straight from Bronze posts: strict cleaning, tool mentions, top lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaza.functions.text import TOOL_ALIASES, clip, extract_tools, title_and_body
from plaza.functions.values import is_filled
from plaza.operators.topk import top, top_per_group
from plaza.plans.silver import DELETED_OR_REMOVED
from plaza.session import stage


def fallback_silver(posts: DataFrame, aliases: Mapping[str, str] = TOOL_ALIASES) -> DataFrame:
    """Posts with a known author and a title, and the tools their whole text mentions."""
    known = posts.where(is_filled(F.col("title")) & ~F.col("author").isin(*DELETED_OR_REMOVED))
    tools = extract_tools(title_and_body(F.col("title"), F.col("selftext")), aliases)
    return known.select(
        "id",
        "subreddit",
        "title",
        clip(F.coalesce(F.col("selftext"), F.lit("")), 500).alias("selftext_clean"),
        "author",
        *[F.coalesce(F.col(name), F.lit(0)).alias(name) for name in ("score", "num_comments")],
        "created_date",
        "flair",
        tools.alias("tools_mentioned"),
    ).withColumn("tools_count", F.size("tools_mentioned"))


def _scored() -> list:
    return [F.sum("score").alias("total_score"), F.round(F.avg("score"), 1).alias("avg_score")]


def tool_rankings(silver: DataFrame, limit: int = 15) -> DataFrame:
    # An outer explode, because Spark puts a size filter below an inner one and would then
    # extract the tools twice.
    mentions = silver.select("score", F.explode_outer("tools_mentioned").alias("tool"))
    counted = mentions.where(F.col("tool").isNotNull()).groupBy("tool").agg(F.count(F.lit(1)).alias("mentions"), *_scored())
    return top(counted, [F.col("mentions").desc(), F.col("tool").asc()], limit)


def subreddit_rankings(silver: DataFrame, limit: int = 10) -> DataFrame:
    counted = silver.groupBy("subreddit").agg(F.count(F.lit(1)).alias("posts"), *_scored())
    return top(counted, [F.col("posts").desc(), F.col("subreddit").asc()], limit)


def fallback_summary(silver: DataFrame) -> DataFrame:
    """One row of totals in one pass: each post once without a tool, and once per tool."""
    once = F.array(F.lit(None).cast("string"))
    rows = silver.select(
        "subreddit", "score", "tools_count", F.explode_outer(F.concat(once, "tools_mentioned")).alias("tool")
    )
    is_post = F.col("tool").isNull()
    return rows.agg(
        F.count_if(is_post).alias("total_posts"),
        F.count_distinct("tool").alias("unique_tools"),
        F.count_distinct("subreddit").alias("unique_subreddits"),
        F.round(F.avg(F.when(is_post, F.col("score"))), 1).alias("avg_score"),
        F.count_if(is_post & (F.col("tools_count") > 0)).alias("posts_with_tools"),
    )


def fallback_report(silver: DataFrame, tools: int = 15, communities: int = 10) -> DataFrame:
    """Tool rankings, community rankings and totals together: one scan, one aggregation over grouping sets.

    Rows have a ``section`` (tools, communities, totals) and the ``place`` in it, from 1. A post counts once without a tool for
    communities and totals, and once per tool it mentions. ``posts`` are mentions for a tool. The totals carry the numbers of
    different tools and communities; they come from the groups, so nothing is counted twice or kept per value.
    """
    once = F.array(F.lit(None).cast("string"))
    rows = silver.select("subreddit", "score", "tools_count", F.explode_outer(F.concat(once, "tools_mentioned")).alias("tool"))
    # The rows of posts and of mentions are told apart by a key, as a NULL community is a community of its own.
    rows = rows.withColumn("mention", F.col("tool").isNotNull())
    by = ["subreddit", "tool", "mention"]
    sets = [[F.col("mention"), F.col("tool")], [F.col("mention"), F.col("subreddit")]]
    grouped = rows.groupingSets(sets, *[F.col(name) for name in by]).agg(
        F.grouping("tool").alias("no_tool"), F.count(F.lit(1)).alias("posts"), F.sum("score").alias("total_score"),
        F.count("score").alias("scored"), F.count_if(F.col("tools_count") > 0).alias("posts_with_tools"),
    )
    is_tool = (F.col("no_tool") == 0) & F.col("mention")
    is_community = (F.col("no_tool") == 1) & ~F.col("mention")
    section = F.when(is_tool, "tools").when(is_community, "communities")
    groups = grouped.select(section.alias("section"), F.when(is_tool, F.col("tool")).otherwise(F.col("subreddit")).alias("name"), "posts", "total_score", "scored", "posts_with_tools")
    # A row per tool and community, which the rankings and the totals read; the posts are read once.
    groups = stage(groups.where(F.col("section").isNotNull()), "groups")
    best = top_per_group(groups, ["section"], [F.col("posts").desc(), F.col("name").asc()], max(tools, communities), rank="place")
    limit = F.when(F.col("section") == "tools", tools).otherwise(communities)
    average = F.round(F.col("total_score") / F.col("scored"), 1)
    nothing = [F.lit(None).cast("bigint").alias(name) for name in ("posts_with_tools", "unique_tools", "unique_subreddits")]
    shown = best.where(F.col("place") <= limit).select("section", "place", "name", "posts", "total_score", average.alias("avg_score"), *nothing)

    def of(name: str) -> Column:
        return F.sum(F.when(F.col("section") == "communities", F.col(name)))

    totals = groups.agg(
        of("posts").alias("posts"), of("total_score").alias("total_score"), F.round(of("total_score") / of("scored"), 1).alias("avg_score"),
        of("posts_with_tools").alias("posts_with_tools"), F.count_if(F.col("section") == "tools").alias("unique_tools"),
        F.count(F.when(F.col("section") == "communities", F.col("name"))).alias("unique_subreddits"),
    )
    totals = totals.select(F.lit("totals").alias("section"), F.lit(1).alias("place"), F.lit(None).cast("string").alias("name"), "posts", "total_score", "avg_score", "posts_with_tools", "unique_tools", "unique_subreddits")
    return shown.unionByName(totals)
