"""The results that pages and reports read."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaza.functions.text import clip
from plaza.operators.topk import page, page_info, sort_columns, top, top_per_group
from plaza.sources.paths import snapshot_counts
from plaza.sources.snapshots import labelled

PLACE = ["community", "ingest_date"]

# The columns each served list shows.
SERVED = {
    "silver_posts": [
        "id", "subreddit", "title", "selftext", "author", "score", "upvote_ratio",
        "num_comments", "created_date", "permalink", "flair", "is_self", "ingest_date",
    ],
    "silver_comments": [
        "id", "post_id", "subreddit", "author", "body", "score", "depth", "created_date",
    ],
    "gold_week": [
        "week_start", "subreddit", "post_count", "sum_score", "sum_num_comments", "avg_score",
        "avg_comments_per_post", "total_comments_extracted", "avg_comment_score", "unique_commenters",
    ],
    "gold_commenters": [
        "subreddit", "author", "comment_count", "total_score", "avg_score", "posts_commented",
    ],
}


def _served(df: DataFrame, name: str, measure: str, ties: Sequence[str], limit: int) -> DataFrame:
    return top(df.select(*SERVED[name]), [F.col(measure).desc(), *[F.col(tie).asc() for tie in ties]], limit)


def top_silver_posts(posts: DataFrame, limit: int = 30) -> DataFrame:
    return _served(posts, "silver_posts", "score", ["id"], limit)


def top_silver_comments(comments: DataFrame, limit: int = 50) -> DataFrame:
    return _served(comments, "silver_comments", "score", ["id"], limit)


def top_weeks(weeks: DataFrame, limit: int = 20) -> DataFrame:
    return _served(weeks, "gold_week", "post_count", ["week_start", "subreddit"], limit)


def top_commenter_rows(commenters: DataFrame, limit: int = 20) -> DataFrame:
    return _served(commenters, "gold_commenters", "comment_count", ["subreddit", "author"], limit)


def in_directory(items: DataFrame, community: str, date: str) -> DataFrame:
    return items.where((F.col("community") == community) & (F.col("ingest_date") == date))


def posts_page(
    posts: DataFrame, community: str, date: str, *, number: int = 1, per_page: int = 20, sort_by: str = "score"
) -> DataFrame:
    """One page of the deduplicated posts of a community and day."""
    return page(in_directory(posts, community, date), number, per_page, sort_by)


def comments_page(
    comments: DataFrame, community: str, date: str, *, post_id: str | None = None, number: int = 1,
    per_page: int = 50, sort_by: str = "score",
) -> DataFrame:
    rows = in_directory(comments, community, date)
    if post_id:
        rows = rows.where(F.col("post_id") == post_id)
    return page(rows, number, per_page, sort_by)


def page_summary(items: DataFrame, files: DataFrame, community: str, date: str, *, number: int = 1,
                 per_page: int = 20, kind: str = "snapshots") -> DataFrame:
    """What surrounds a page: total, pages, and how many snapshot files there are."""
    info = page_info(in_directory(items, community, date), number, per_page)
    counted = snapshot_counts(in_directory(files, community, date)).agg(F.sum(kind).alias("snapshots"))
    return info.select(
        F.lit(community).alias("community"),
        F.lit(date).alias("ingest_date"),
        *info.columns,
        F.coalesce(counted.scalar(), F.lit(0)).alias("snapshots"),
    )


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _join_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    return reduce(lambda left, right: left.join(right, PLACE, "left"), others, first)


def _top_five(items: DataFrame, fields: Sequence[Column], into: str) -> DataFrame:
    best = top_per_group(items, PLACE, sort_columns("score"), 5)
    listed = F.array_sort(F.collect_list(F.struct("rank", F.struct(*fields).alias("item"))))
    return best.groupBy(*PLACE).agg(F.transform(listed, lambda row: row["item"]).alias(into))


def label_counts(posts: DataFrame, limit: int = 10) -> DataFrame:
    """The most frequent flairs per community and day; counted first, then ranked."""
    counted = posts.groupBy(*PLACE, labelled(F.col("flair")).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return top_per_group(counted, PLACE, [F.col("n").desc(), F.col("label").asc()], limit)


def post_stats(posts: DataFrame, files: DataFrame, last_times: DataFrame) -> DataFrame:
    """Statistics of every community and day at once."""
    numbers = posts.groupBy(*PLACE).agg(
        F.count(F.lit(1)).alias("total"),
        F.round(F.avg(_zero("score")), 1).alias("score_avg"),
        F.max(_zero("score")).alias("score_max"),
        F.min(_zero("score")).alias("score_min"),
        F.round(F.avg(_zero("num_comments")), 1).alias("comments_avg"),
        F.sum(_zero("num_comments")).alias("comments_total"),
    )
    entry = F.struct("rank", F.struct("label", "n").alias("entry"))
    flairs = label_counts(posts).groupBy(*PLACE).agg(
        F.map_from_entries(
            F.transform(F.array_sort(F.collect_list(entry)), lambda row: row["entry"])
        ).alias("flairs")
    )
    best = _top_five(posts, [F.col(c) for c in ("title", "score", "num_comments", "author")], "top_posts")
    counts = snapshot_counts(files).select(*PLACE, "snapshots")
    return _join_all(numbers, counts, flairs, best, last_times)


def comment_stats(comments: DataFrame, files: DataFrame, last_times: DataFrame) -> DataFrame:
    """As ``post_stats``. All comments without a post count as one post, as in a set of ids."""
    # Two distinct counts in one aggregation would repeat every comment; instead each is a count
    # over pairs, and the numbers are summed up from those of the posts.
    score, depth, one = _zero("score"), _zero("depth"), F.count(F.lit(1))
    by_post = comments.groupBy(*PLACE, "post_id").agg(
        one.alias("n"), F.sum(score).alias("score"), F.max(score).alias("top"),
        F.sum(depth).alias("depth"), F.max(depth).alias("deepest"),
    )
    numbers = by_post.groupBy(*PLACE).agg(
        F.sum("n").alias("total"),
        one.alias("unique_posts_with_comments"),
        F.round(F.sum("score") / F.sum("n"), 1).alias("score_avg"),
        F.max("top").alias("score_max"),
        F.round(F.sum("depth") / F.sum("n"), 1).alias("avg_depth"),
        F.max("deepest").alias("max_depth"),
    )
    named = comments.select(*PLACE, F.nullif("author", F.lit("")).alias("author")).distinct()
    authors = named.groupBy(*PLACE).agg(F.count("author").alias("unique_authors"))
    shown = [clip(F.col("body"), 200).alias("body"), *[F.col(c) for c in ("score", "author", "post_id")],
             _zero("depth").alias("depth")]
    best = _top_five(comments, shown, "top_comments")
    counts = snapshot_counts(files).select(*PLACE, F.col("comment_snapshots").alias("snapshots"))
    return _join_all(numbers, authors, counts, best, last_times)


def community_catalog(posts: DataFrame, comments: DataFrame, files: DataFrame) -> DataFrame:
    """Per community its days with counts of posts, comments and files, and all posts.

    Days come from the post files, so a day whose files are all unreadable is listed with
    zero posts. The list per community has one entry per day.
    """
    days = snapshot_counts(files).where(F.col("snapshots") > 0)
    written = posts.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("count"))
    answered = comments.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("comments_count"))
    counted = _join_all(days, written, answered).fillna(0, ["count", "comments_count"])
    entry = F.struct(
        F.col("ingest_date").alias("date"), "count", "snapshots", "comments_count", "comment_snapshots"
    )
    return (
        counted.groupBy(F.col("community").alias("subreddit"))
        .agg(F.array_sort(F.collect_list(entry)).alias("dates"), F.sum("count").alias("total_posts"))
        .orderBy("subreddit")
    )


def all_posts(posts: DataFrame, limit: int = 500) -> DataFrame:
    """The best posts over all communities; ``posts`` are deduplicated across them."""
    return top(posts, sort_columns("score"), limit)


def _layer(df: DataFrame, name: str, records: Column, measure: str, ties: Sequence[str]) -> DataFrame:
    """Counts by hash aggregation, and the leading row as JSON by a top-1, which carries one row per task."""
    order = [_zero(measure).desc(), *[F.col(tie).desc() for tie in ties]]
    leader = df.orderBy(*order).limit(1).select(F.to_json(F.struct(*df.columns)).alias("sample"))
    groups = df.groupBy("subreddit").agg(records.alias("records"))
    counted = groups.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("records"), F.count("subreddit").alias("subreddits"))
    return counted.select(F.lit(name).alias("layer"), "records", "subreddits", leader.scalar().alias("sample"))


def layer_status(bronze: DataFrame, silver: DataFrame, weeks: DataFrame) -> DataFrame:
    """One row per layer: records, communities, and the leading record as a sample."""
    rows = F.count(F.lit(1))
    return (
        _layer(bronze, "Bronze", rows, "score", ["id"])
        .unionByName(_layer(silver, "Silver", rows, "score", ["id"]))
        .unionByName(_layer(weeks, "Gold", F.sum("post_count"), "post_count", ["week_start", "subreddit"]))
    )


def status_with_fallback(
    bronze: DataFrame, silver: DataFrame, weeks: DataFrame, fallback: DataFrame
) -> DataFrame:
    """The layers' status; empty Silver and Gold layers stand for what ``fallback`` cleans from Bronze.

    ``mode`` is active for a stored layer, fallback for one that was computed, and empty if
    neither has a row. ``fallback`` is the result of ``plans.fallback.fallback_silver``.
    """
    computed = fallback.agg(
        F.count(F.lit(1)).alias("_records"), F.count_distinct("subreddit").alias("_subreddits"),
    )
    records, subreddits = computed.select("_records").scalar(), computed.select("_subreddits").scalar()
    missing = (F.col("layer") != "Bronze") & (F.col("records") == 0)
    status = layer_status(bronze, silver, weeks)
    mode = F.when(missing & (records > 0), "fallback").when(F.col("records") > 0, "active").otherwise("empty")
    return status.select(
        "layer", mode.alias("mode"),
        F.when(missing, records).otherwise(F.col("records")).alias("records"),
        F.when(missing, subreddits).otherwise(F.col("subreddits")).alias("subreddits"), "sample",
    )
