"""What earlier runs have seen, and what this run still has to do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaza.functions.values import engagement, is_filled
from plaza.operators.merge import upsert
from plaza.operators.skew import join_groups
from plaza.operators.topk import top_per_group

SEEN_KEY = ["subreddit", "id"]


def unseen(current: DataFrame, seen: DataFrame) -> DataFrame:
    """Posts of this run whose id the last run of the same community did not have."""
    return current.where(is_filled(F.col("id"))).join(seen, SEEN_KEY, "left_anti")


def communities_with_news(current: DataFrame, seen: DataFrame) -> DataFrame:
    return unseen(current, seen).select("subreddit").distinct()


def worth_saving(current: DataFrame, seen: DataFrame) -> DataFrame:
    """All posts of the communities that have at least one unseen post."""
    return join_groups(current, communities_with_news(current, seen), ["subreddit"], "left_semi")


def next_seen(current: DataFrame, seen: DataFrame) -> DataFrame:
    """The ids to remember: replaced for communities with news, kept for the others."""
    fresh = worth_saving(current, seen).where(is_filled(F.col("id"))).select(*SEEN_KEY).distinct()
    old = join_groups(seen, communities_with_news(current, seen), ["subreddit"], "left_anti")
    return fresh.unionByName(old.select(*SEEN_KEY))


def comment_candidates(
    posts: DataFrame, cache: DataFrame, *, min_comments: int = 5, top_k: int = 50,
    per: Sequence[str] = ("subreddit",),
) -> DataFrame:
    """The most engaging posts of each community and whether their comment count changed.

    ``cache`` has the last known ``num_comments`` per ``post_id``; posts it does not know
    count as changed.
    """
    count = F.coalesce(F.col("num_comments"), F.lit(0))
    eligible = top_per_group(
        posts.where(count >= min_comments).withColumn("engagement", engagement()),
        per,
        [F.col("engagement").desc(), F.col("id").asc()],
        top_k,
        rank="place",
    )
    known = cache.select(F.col("post_id").alias("id"), F.col("num_comments").alias("cached"))
    checked = eligible.join(known, "id", "left")
    return checked.withColumn("changed", F.coalesce(F.col("cached"), F.lit(-1)) != count)


def candidate_stats(candidates: DataFrame, per: Sequence[str] = ("subreddit",)) -> DataFrame:
    return candidates.groupBy(*per).agg(
        F.count(F.lit(1)).alias("total_eligible"),
        F.count_if(~F.col("changed")).alias("skipped_cache"),
        F.count_if(F.col("changed")).alias("to_fetch"),
    )


def next_comment_cache(cache: DataFrame, fetched: DataFrame) -> DataFrame:
    """The cache with the counts of the posts whose comments were fetched."""
    return upsert(cache, fetched.select("post_id", "num_comments"), ["post_id"])


def eligible_communities(
    posts: DataFrame, insights: DataFrame | None = None, *, min_posts: int = 3,
    limit: int | None = None,
) -> DataFrame:
    """Communities with enough posts, largest first; those with insights already are left out.

    As the limit is a quota per run over the whole list, it applies before the finished
    communities are taken out. Give no ``insights`` to redo all of them.
    """
    order = [F.col("posts").desc(), F.col("subreddit").asc()]
    sizes = posts.groupBy("subreddit").agg(F.count(F.lit(1)).alias("posts")).where(F.col("posts") >= min_posts)
    listed = sizes.orderBy(*order).limit(limit) if limit else sizes
    if insights is not None:
        listed = listed.join(insights.select("subreddit").distinct(), "subreddit", "left_anti")
    return listed
