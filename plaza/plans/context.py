"""The text about each community that a model is asked to summarise."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaza.functions.text import PROMPT, clip, render_prompt, with_snippet
from plaza.functions.values import is_filled
from plaza.operators.topk import top_per_group


@dataclass(frozen=True)
class ContextSize:
    """How many posts and comments go in, and how many characters of each."""

    posts: int = 15
    comments: int = 20
    max_chars: int = 6000
    selftext: int = 150
    body: int = 120


# The sizes for a run over all communities and for one community alone.
ALL_COMMUNITIES = ContextSize()
ONE_COMMUNITY = ContextSize(posts=80, comments=120, max_chars=12000, selftext=280, body=200)
MIN_CONTEXT = 100


def build_context(posts: DataFrame, comments: DataFrame, size: ContextSize = ALL_COMMUNITIES) -> DataFrame:
    """One text per community: its best posts, then its best comments, a line each.

    All communities in one job. The rank filter runs before the lists are built, so a list
    never has more than ``size.posts + size.comments`` lines.
    """
    best_first = [F.coalesce(F.col("score"), F.lit(0)).desc(), F.col("id").asc()]
    best_posts = top_per_group(
        posts.select("subreddit", "id", "score", "title", "selftext"), ["subreddit"], best_first, size.posts
    )
    best_comments = top_per_group(
        comments.select("subreddit", "id", "score", "body"), ["subreddit"], best_first, size.comments
    )
    lines = best_posts.select(
        "subreddit",
        F.lit(0).alias("kind"),
        "rank",
        with_snippet(F.col("title"), F.col("selftext"), size.selftext).alias("line"),
    ).unionByName(
        best_comments.where(is_filled(F.col("body"))).select(
            "subreddit", F.lit(1).alias("kind"), "rank", clip(F.col("body"), size.body).alias("line")
        )
    )
    listed = F.array_sort(F.collect_list(F.struct("kind", "rank", "line")))
    text = F.array_join(F.transform(listed, lambda row: row["line"]), "\n")
    gathered = lines.groupBy("subreddit").agg(
        text.alias("text"), F.max(1 - F.col("kind")).alias("_has_posts")
    )
    return gathered.where(F.col("_has_posts") == 1).select(
        "subreddit", clip(F.col("text"), size.max_chars).alias("content")
    )


def long_enough(contexts: DataFrame, least: int = MIN_CONTEXT) -> DataFrame:
    return contexts.where(F.length("content") >= least)


def render_prompts(contexts: DataFrame, template: str = PROMPT) -> DataFrame:
    return contexts.withColumn("prompt", render_prompt(F.col("subreddit"), F.col("content"), template))
