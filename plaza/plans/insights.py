"""From structured model answers to the insight table, and the reports on it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plaza.functions.dates import day
from plaza.functions.values import to_long
from plaza.operators.merge import merge_table, upsert
from plaza.operators.nesting import collect_in_parts
from plaza.operators.skew import join_groups
from plaza.operators.topk import top

# The three kinds of insight, and where each keeps its item's name.
NAME_FIELD = {"trending_tools": "name", "pain_points": "topic", "solutions": "topic"}
INSIGHT_KEY = ["subreddit", "insight_type", "item_name", "execution_date"]
INSIGHT_VALUES = ["mentions", "context", "generated_at", "model_version"]
ANSWER = ", ".join(
    f"{kind} ARRAY<STRUCT<{name}: STRING, mentions: STRING, context: STRING>>"
    for kind, name in NAME_FIELD.items()
)


def parse_answers(answers: DataFrame) -> DataFrame:
    """Answers that are a JSON object with at least one of the three lists; others are rejected."""
    expected = F.array(*[F.lit(kind) for kind in NAME_FIELD])
    usable = F.arrays_overlap(F.json_object_keys("answer"), expected)
    return answers.where(usable).withColumn("parsed", F.from_json("answer", ANSWER))


def answer_sizes(parsed: DataFrame) -> DataFrame:
    """How many items of each kind an answer has."""
    counts = {kind: F.coalesce(F.array_size(F.col(f"parsed.{kind}")), F.lit(0)) for kind in NAME_FIELD}
    return parsed.withColumns(counts)


def answers_to_rows(
    parsed: DataFrame, *, execution_date: Column, model_version: Column, generated_at: Column | None = None
) -> DataFrame:
    """One insight row per item, all three lists in one pass over the answers."""
    lists = [
        F.coalesce(F.transform(F.array_compact(f"parsed.{kind}"), _item(kind, name)), F.array().cast(_ITEMS))
        for kind, name in NAME_FIELD.items()
    ]
    rows = parsed.select(
        "subreddit",
        F.explode_outer(F.concat(*lists)).alias("item"),
        (F.current_timestamp() if generated_at is None else generated_at).alias("generated_at"),
        execution_date.cast("date").alias("execution_date"),
        model_version.alias("model_version"),
    )
    return rows.where(F.col("item").isNotNull()).select(
        "subreddit",
        "item.insight_type",
        "item.item_name",
        F.coalesce(to_long(F.col("item.mentions")), F.lit(0)).try_cast("int").alias("mentions"),
        "item.context",
        "generated_at",
        "execution_date",
        "model_version",
    )


_ITEMS = "array<struct<insight_type: string, item_name: string, mentions: string, context: string>>"


def _item(kind: str, name: str) -> Callable[[Column], Column]:
    def fields(item: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("insight_type"),
            F.coalesce(item[name], F.lit("")).alias("item_name"),
            item["mentions"].alias("mentions"),
            F.coalesce(item["context"], F.lit("")).alias("context"),
        )

    return fields


def upsert_insights(insights: DataFrame, rows: DataFrame) -> DataFrame:
    """All new rows in one merge; a known item gets new mentions, context, time and model.

    As for every merge, give written tables: both sides are read more than once.
    """
    return upsert(insights, rows, INSIGHT_KEY, update=INSIGHT_VALUES)


def store_insights(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Merge answers' rows into the stored insight table; only the run's date is read and rewritten."""
    merge_table(spark, table, rows, INSIGHT_KEY, partition="execution_date", update=INSIGHT_VALUES)


def latest_run(insights: DataFrame) -> DataFrame:
    """The rows of the latest execution date; a scalar subquery, so it prunes partitions."""
    newest = insights.agg(F.max("execution_date")).scalar()
    return insights.where(F.col("execution_date") == newest)


def latest_run_per_community(insights: DataFrame) -> DataFrame:
    newest = insights.groupBy("subreddit").agg(F.max("execution_date").alias("execution_date"))
    return join_groups(insights, newest, ["subreddit", "execution_date"], "left_semi")


def community_insights(insights: DataFrame, subreddit: str, per_community: bool = False) -> DataFrame:
    """The latest insights of one community, by kind and mentions.

    The latest run is that of the whole table, or with ``per_community`` the community's own.
    """
    mine = F.col("subreddit") == subreddit
    rows = latest_run(insights.where(mine)) if per_community else latest_run(insights).where(mine)
    return rows.select("insight_type", "item_name", "mentions", "context", "generated_at").orderBy(
        "insight_type", F.col("mentions").desc(), "item_name"
    )


def top_items(insights: DataFrame, kind: str = "trending_tools", limit: int = 10) -> DataFrame:
    counted = (
        latest_run(insights)
        .where(F.col("insight_type") == kind)
        .groupBy(F.col("item_name").alias("tool"))
        .agg(F.sum("mentions").alias("total_mentions"), F.count_distinct("subreddit").alias("communities_count"))
    )
    return top(counted, [F.col("total_mentions").desc(), F.col("tool").asc()], limit)


def recent_items(
    insights: DataFrame, kind: str = "pain_points", *, days: int = 7, as_of: dt.date | str | None = None
) -> DataFrame:
    recent = F.col("execution_date") >= F.date_sub(day(as_of), days)
    return (
        insights.where((F.col("insight_type") == kind) & recent)
        .select("subreddit", F.col("item_name").alias("pain_point"), "mentions", "context", "execution_date")
        .orderBy(F.col("execution_date").desc(), F.col("mentions").desc(), "subreddit", "pain_point")
    )


def compare_weeks(
    insights: DataFrame, kind: str = "trending_tools", *, as_of: dt.date | str | None = None,
    limit: int = 20, half_open: bool = False,
) -> DataFrame:
    """Mentions per item this week and the week before, and the difference.

    Both weeks come out of one scan and one aggregation, which gives the rows of a full outer
    join of two weekly sums. The day seven days ago is in both weeks, or with ``half_open``
    in the current one only.
    """
    today, date = day(as_of), F.col("execution_date")
    middle, start = F.date_sub(today, 7), F.date_sub(today, 14)
    in_current = date >= middle
    in_previous = (date >= start) & ((date < middle) if half_open else (date <= middle))
    mentions = F.coalesce(F.col("mentions"), F.lit(0))

    def total(week: Column) -> Column:
        return F.sum(F.when(week, mentions).otherwise(0))

    counted = (
        insights.where((F.col("insight_type") == kind) & (date >= start))
        .groupBy(F.col("item_name").alias("tool"))
        .agg(total(in_current).alias("current_week"), total(in_previous).alias("previous_week"))
        .withColumn("trend", F.col("current_week") - F.col("previous_week"))
    )
    return top(counted, [F.col("trend").desc(), F.col("tool").asc()], limit)


def insights_by_community(insights: DataFrame, max_items: int = 1000) -> DataFrame:
    """The latest insights nested per community; a very large one comes in parts that follow each other."""
    fields = ["insight_type", "item_name", "mentions", "context", "generated_at"]
    return collect_in_parts(
        latest_run(insights), ["subreddit"], fields, ["insight_type", "item_name"],
        into="insights", max_items=max_items,
    )


def nested_insights(insights: DataFrame, max_items: int = 1000) -> DataFrame:
    """Per community a map from kind to its items, as served to a page, and which part of how many it is.

    Parts are cut in the order of kind and name, so a kind's items are sorted over the parts, too.
    Items without a kind are under the key ``unknown``.
    """
    fields = ["insight_type", "item_name", "mentions", "context"]
    named = latest_run(insights).withColumn("insight_type", F.coalesce("insight_type", F.lit("unknown")))
    lists = collect_in_parts(
        named, ["subreddit"], fields, ["insight_type", "item_name"], into="items", max_items=max_items
    )

    def of(kind: Column) -> Column:
        own = F.filter("items", lambda item: item["insight_type"] == kind)
        shown = F.transform(own, lambda item: F.struct(*[item[name].alias(name) for name in fields[1:]]))
        return F.struct(kind.alias("kind"), shown.alias("items"))

    kinds = F.array_distinct(F.transform("items", lambda item: item["insight_type"]))
    return lists.select("subreddit", "part", "parts", F.map_from_entries(F.transform(kinds, of)).alias("insights"))


def insight_counts(insights: DataFrame) -> DataFrame:
    kinds = {"tools_count": "trending_tools", "pains_count": "pain_points", "solutions_count": "solutions"}
    return (
        latest_run(insights)
        .groupBy("subreddit")
        .agg(
            F.count(F.lit(1)).alias("total_insights"),
            *[F.count_if(F.col("insight_type") == kind).alias(name) for name, kind in kinds.items()],
            F.max("generated_at").alias("last_updated"),
        )
        .orderBy(F.col("total_insights").desc(), "subreddit")
    )


def stale_communities(
    posts: DataFrame, insights: DataFrame, *, days: int = 7, as_of: dt.date | str | None = None
) -> DataFrame:
    """Communities with posts whose last insight is older than ``days``, or that have none.

    Both sides are reduced to one row per community before they meet.
    """
    last = insights.groupBy("subreddit").agg(F.max("execution_date").alias("last_insight_date"))
    age = F.datediff(day(as_of), F.col("last_insight_date"))
    return (
        posts.select("subreddit")
        .distinct()
        .join(last, "subreddit", "left")
        .withColumn("days_since_update", age)
        .where(F.col("days_since_update").isNull() | (F.col("days_since_update") > days))
        .orderBy(F.col("days_since_update").desc(), "subreddit")
    )
