"""One entry per operator or served result: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import bindings as b
from plaza import configure, schemas
from plaza.functions import dates, text, values
from plaza.operators import dedupe, merge, quality, state, topk
from plaza.plans import context, fallback, gold, insights, publish, serve, silver
from plaza.plans.medallion import Tables, run_medallion
from plaza.session import freeing, new_folder, stage
from plaza.sources import listings, paths, sinks, snapshots, tables
from plaza.streaming import incremental, ingest, stateful

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2024-01-30"
LATER = "2024-02-05"
SPLIT = "2024-01-16"
PLACE = ["community", "ingest_date"]


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return function


def flat(items: Column | str, *fields: str) -> Column:
    """A list of structs as text: fields joined by ``:``, items by ``|``."""
    def one(item: Column) -> Column:
        return F.concat_ws(":", *[F.coalesce(item[name].cast("string"), F.lit("")) for name in fields])

    return F.array_join(F.transform(items, one), "|")


def as_text(moment: Column | str) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


# --- sources and sinks ---


@query
def post_snapshots_read(spark, sf_dir):
    rows = snapshots.read_post_snapshots(spark, paths.snapshot_glob(b.snapshot_root(spark, sf_dir)))
    return rows.select(
        "community", "ingest_date", dates.as_day(dates.stamp_of_file(F.col("file_name"))).alias("file_day"),
        "snapshot_at", "id", "subreddit", "title", "author", "score", "num_comments", "created_utc",
        "created_date", "flair",
    )


@query
def comment_snapshots_read(spark, sf_dir):
    glob = paths.snapshot_glob(b.snapshot_root(spark, sf_dir), paths.COMMENT_FILES)
    rows = snapshots.read_comment_snapshots(spark, glob)
    return rows.select(
        "community", "ingest_date", "id", "post_id", "subreddit", "author", "body", "score", "depth", "created_utc"
    )


@query
def snapshot_lineage(spark, sf_dir):
    """Rows per lineage value, and whether all were stamped."""
    rows = snapshots.with_lineage(
        snapshots.read_post_snapshots(spark, paths.snapshot_glob(b.snapshot_root(spark, sf_dir)))
    )
    return rows.groupBy("_ingest_date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(paths.is_post_snapshot(F.col("_source_file"))).alias("from_post_files"),
        F.count("_loaded_at").alias("loaded"),
        F.count_distinct("_loaded_at").alias("load_times"),
    )


@query
def snapshot_counts_with_corrupt_file(spark, sf_dir):
    """An unreadable file beside good ones counts as a snapshot and gives no rows.

    Every run of a community with more than 20 items is several files, and still one snapshot.
    """
    root = _split_snapshots(spark, sf_dir)
    b.put_file(spark, f"{root}/reddit/community=click/date={b.RUNS[0]}/raw_broken.json", "{invalid json")
    glob = paths.snapshot_glob(root)
    rows = snapshots.read_post_snapshots(spark, glob).groupBy(*PLACE).agg(F.count(F.lit(1)).alias("posts"))
    files = paths.snapshot_counts(paths.list_files(spark, glob)).select(*PLACE, "snapshots")
    return files.join(rows, PLACE, "left")


def _split_snapshots(spark, sf_dir):
    """All runs written with at most 20 items per file, so that most are several files."""
    root = new_folder(spark, "split")
    last = dedupe.dedupe_latest_snapshot(b.snapshot_posts(spark, sf_dir))
    dropped = ["ingest_date", "community", "file_name", "source_file", "snapshot_at"]
    for date in b.RUNS:
        rows = last.where(F.col("ingest_date") == date).drop(*dropped)
        at = dt.datetime.fromisoformat(f"{date}T06:00:00")
        sinks.write_snapshots(rows, root, date=date, snapshot_at=at, order=["position"], max_items=20)
    return root


@query
def split_snapshot_envelopes(spark, sf_dir):
    """What the envelopes of split extractions say: each part of how many, and the count of the whole."""
    glob = paths.snapshot_glob(_split_snapshots(spark, sf_dir))
    schema = f"{schemas.POST_SNAPSHOT}, part INT, parts INT"
    heads = snapshots.read_envelopes(spark, glob, schema)
    return heads.select(*PLACE, "part", "parts", "count", F.size("posts").cast("bigint").alias("items"))


@query
def latest_files_of_split_snapshots(spark, sf_dir):
    """The posts in the files of each community's latest extraction."""
    glob = paths.snapshot_glob(_split_snapshots(spark, sf_dir))
    chosen = [r["path"] for r in paths.latest_file_per_community(paths.list_files(spark, glob)).select("path").collect()]
    rows = snapshots.read_post_snapshots(spark, chosen)
    return rows.select("community", "ingest_date", "id", "score")


@query
def last_snapshot_times(spark, sf_dir):
    glob = paths.snapshot_glob(b.snapshot_root(spark, sf_dir))
    return snapshots.last_snapshot_times(snapshots.read_envelopes(spark, glob, schemas.POST_SNAPSHOT))


@query
def daily_snapshot_overwrite(spark, sf_dir):
    """The day's file written twice: the second write replaces only its own community and day."""
    root = new_folder(spark, "daily")
    posts = b.snapshot_posts(spark, sf_dir)
    dropped = ["ingest_date", "community", "file_name", "source_file", "snapshot_at"]
    for date in b.RUNS:
        rows = dedupe.dedupe_latest_snapshot(posts.where(F.col("ingest_date") == date)).drop(*dropped)
        at = dt.datetime.fromisoformat(f"{date}T00:00:00")
        sinks.write_daily(rows, root, date=date, extracted_at=at, order=["position"])
        if date == b.RUNS[1]:
            again = rows.where(F.col("subreddit") == "click").withColumn("score", F.lit(-1).cast("bigint"))
            sinks.write_daily(again, root, date=date, extracted_at=at, order=["position"])
    read = snapshots.read_post_snapshots(spark, paths.snapshot_glob(root, paths.DAILY_FILES))
    return read.select("community", "ingest_date", "id", "score")


@query
def object_key_checks(spark, sf_dir):
    """Keys of four shapes, URL-encoded, decoded and checked."""
    name = F.col("event_type")
    event_key = (
        F.when(name == "view", b.text("reddit/", name, "/date=", b.day_of("ts"), "/raw_", b.key("event_id"), ".json"))
        .when(name == "click", b.text("reddit/", name, "/date=", b.day_of("ts"), "/comments_", b.key("event_id"), ".json"))
        .when(name == "error", b.text("reddit/", name, "/", b.day_of("ts"), "/raw_", b.key("event_id"), ".json"))
        .otherwise(b.text("reddit/a b/date=", b.day_of("ts"), "/raw_", b.key("event_id"), ".csv"))
    )
    keys = b.table(spark, sf_dir, "events").select("event_id", F.url_encode(event_key).alias("encoded"))
    decoded = keys.select("event_id", paths.decode_key(F.col("encoded")).alias("path"))
    return decoded.select(
        "event_id", "path",
        paths.is_post_snapshot(F.col("path")).alias("is_post"),
        paths.is_comment_snapshot(F.col("path")).alias("is_comment"),
        paths.is_valid_path(F.col("path")).alias("is_valid"),
    )


@query
def path_columns(spark, sf_dir):
    keys = b.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(
            F.col("event_type") != "error",
            b.text("s3://x/reddit/community=", F.col("event_type"), "/date=", b.day_of("ts"), "/raw_", b.key("user_id"), ".json"),
        ).otherwise("elsewhere/raw_1.json").alias("path"),
    )
    parts = paths.with_path_columns(keys, F.col("path"))
    return parts.select("event_id", "community", "ingest_date", "file_name")


@query
def latest_file_per_community(spark, sf_dir):
    return paths.latest_file_per_community(b.snapshot_files(spark, sf_dir))


@query
def post_listing_parsed(spark, sf_dir):
    rows = listings.parse_post_listing(b.post_listings(spark, sf_dir), keep=("page",))
    return rows.drop("permalink", "url")


@query
def post_listing_first_occurrence(spark, sf_dir):
    rows = listings.parse_post_listing(b.post_listings(spark, sf_dir), keep=("page",))
    unique = dedupe.dedupe_first(rows, ["id"], ["page", "position"])
    return unique.select("id", "position", "title", "score", "flair")


@query
def comment_tree_flattened(spark, sf_dir):
    rows = listings.flatten_comment_tree(b.comment_trees(spark, sf_dir), levels=2)
    return rows.select("id", "post_id", "parent_id", "author", "body", "score", "depth", "created_date")


@query
def deep_comment_tree_flattened(spark, sf_dir):
    """Chains of replies as deep as a document has lines, which is far beyond one round."""
    rows = listings.flatten_comment_tree(b.deep_trees(spark, sf_dir))
    return rows.select("id", "post_id", "body", "depth", F.size("path").alias("path_length"))


@query
def insight_table_check(spark, sf_dir):
    """The partitioned insight table: created, filled, read back and validated."""
    name = "insights_" + new_folder(spark, "t").rsplit("-", 1)[1]
    tables.create_table(
        spark, name, schemas.INSIGHTS, location=new_folder(spark, "insights"), partition="execution_date"
    )
    tables.insert(b.insights(spark, sf_dir), name, "execution_date")
    checked = tables.check_insights(tables.open_table(spark, name))
    return checked.withColumn("latest_execution", F.col("latest_execution").cast("string"))


# --- Bronze, Silver, Gold ---


def silver_posts_frame(spark, sf_dir):
    return silver.silver_posts(b.bronze_posts(spark, sf_dir))


def silver_comments_frame(spark, sf_dir):
    return silver.silver_comments(b.bronze_comments(spark, sf_dir))


def weeks_frame(spark, sf_dir):
    return gold.subreddit_week(silver_posts_frame(spark, sf_dir), silver_comments_frame(spark, sf_dir))


@query
def bronze_comments_deduplicated(spark, sf_dir):
    rows = dedupe.dedupe_loaded(b.bronze_comments(spark, sf_dir))
    return rows.select("id", "_ingest_date", "post_id", "author", "body", "score", "position")


@query
def silver_posts(spark, sf_dir):
    return silver_posts_frame(spark, sf_dir)


@query
def silver_posts_strict_authors(spark, sf_dir):
    strict = silver.silver_posts(b.bronze_posts(spark, sf_dir), AS_OF, silver.DELETED_OR_REMOVED)
    return strict.select("id", "author", "score", "is_self", "ingest_date")


@query
def silver_comments(spark, sf_dir):
    return silver_comments_frame(spark, sf_dir).drop("_source_file")


@query
def weekly_post_metrics(spark, sf_dir):
    rows = gold.weekly_post_metrics(silver_posts_frame(spark, sf_dir))
    return rows.withColumn("week", dates.as_day(F.col("week")))


@query
def weekly_comment_metrics(spark, sf_dir):
    rows = gold.weekly_comment_metrics(silver_comments_frame(spark, sf_dir))
    return rows.withColumn("week", dates.as_day(F.col("week")))


@query
def gold_subreddit_week(spark, sf_dir):
    return weeks_frame(spark, sf_dir)


@query
def gold_subreddit_week_zero_filled(spark, sf_dir):
    return gold.subreddit_week(
        silver_posts_frame(spark, sf_dir), silver_comments_frame(spark, sf_dir), fill_zero=True
    ).select("week_start", "subreddit", "post_count", *gold.NO_COMMENTS)


@query
def gold_subreddit_week_posts_only(spark, sf_dir):
    return gold.subreddit_week(silver_posts_frame(spark, sf_dir))


@query
def gold_top_commenters(spark, sf_dir):
    return gold.top_commenters(silver_comments_frame(spark, sf_dir))


@query
def gold_summary(spark, sf_dir):
    return gold.gold_summary(weeks_frame(spark, sf_dir))


@query
def gold_exact_summary(spark, sf_dir):
    return gold.exact_summary(silver_posts_frame(spark, sf_dir), silver_comments_frame(spark, sf_dir))


# --- deduplication over snapshots ---


@query
def latest_snapshot_version(spark, sf_dir):
    rows = dedupe.dedupe_latest_snapshot(b.snapshot_posts(spark, sf_dir))
    return rows.select("community", "ingest_date", "id", "file_name", "position", "score", "title")


@query
def latest_version_across_communities(spark, sf_dir):
    rows = dedupe.dedupe_across_communities(b.snapshot_posts(spark, sf_dir))
    return rows.select("id", "community", "ingest_date", "position", "score")


@query
def latest_version_by_time(spark, sf_dir):
    rows = dedupe.dedupe_across_communities(b.snapshot_posts(spark, sf_dir), by_time=True)
    return rows.select("id", "community", "snapshot_at", "position", "score")


# --- merge ---


def _before_and_after(spark, sf_dir):
    """The last state per user before the split day, and the last one from then on."""
    events = b.table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.col("value").cast("bigint").alias("score"), b.day_of("ts").alias("day"),
        b.moment("ts").alias("computed_at"),
    )
    order = [F.col("event_id").desc()]
    before = dedupe.dedupe_ranked(events.where(F.col("day") < SPLIT), ["user_id"], order)
    after = dedupe.dedupe_ranked(events.where(F.col("day") >= SPLIT), ["user_id"], order)
    return stage(before, "before"), stage(after, "after")


@query
def merge_insert_only(spark, sf_dir):
    """Insert-only by user and day: known pairs stay as they are."""
    events = b.table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.col("value").cast("bigint").alias("score"), b.day_of("ts").alias("day"), "event_type"
    )
    known = dedupe.dedupe_ranked(
        events.where(F.col("event_type") == "view"), ["user_id", "day"], [F.col("event_id").asc()]
    )
    batch = dedupe.dedupe_ranked(events, ["user_id", "day"], [F.col("event_id").desc()])
    return merge.insert_new(known, stage(batch), ["user_id", "day"])


@query
def merge_guarded_update(spark, sf_dir):
    """Both ways round: newer days replace older ones, older days change nothing."""
    before, after = _before_and_after(spark, sf_dir)
    guard = merge.not_older("day")
    forward = stage(merge.upsert(before, after, ["user_id"], guard=guard))
    return merge.upsert(forward, before, ["user_id"], guard=guard).drop("computed_at")


@query
def merge_newer_wins(spark, sf_dir):
    before, after = _before_and_after(spark, sf_dir)
    late = F.when(F.col("score") >= 10, F.col("computed_at"))
    merged = merge.upsert(
        before.withColumn("computed_at", late), after, ["user_id"], guard=merge.strictly_newer("computed_at")
    )
    return merged.withColumn("computed_at", as_text("computed_at"))


@query
def merge_file_order_guard(spark, sf_dir):
    """Ordered by day, then event: the later event of a day wins whichever is merged last."""
    before, after = _before_and_after(spark, sf_dir)
    guard = merge.not_older("day", "event_id")
    return merge.upsert(after, before, ["user_id"], guard=guard).drop("computed_at")


@query
def merge_insights(spark, sf_dir):
    """The second half of the days merged into the first, each item under its first day of the month's half."""
    rows = b.insight_events(spark, sf_dir)
    half = F.when(F.col("execution_date") < SPLIT, F.to_date(F.lit("2024-01-01"))).otherwise(
        F.to_date(F.lit("2024-01-16"))
    )
    old = dedupe.dedupe_ranked(
        rows.where(F.col("execution_date") < "2024-01-21").withColumn("execution_date", half),
        insights.INSIGHT_KEY, [F.col("event_id").desc()],
    ).drop("event_id")
    new = dedupe.dedupe_ranked(
        rows.where(F.col("execution_date") >= SPLIT).withColumns({"execution_date": half, "model_version": F.lit("m2")}),
        insights.INSIGHT_KEY, [F.col("event_id").desc()],
    ).drop("event_id")
    merged = insights.upsert_insights(stage(old), stage(new))
    return merged.withColumns(
        {"generated_at": as_text("generated_at"), "execution_date": F.col("execution_date").cast("string")}
    )


@query
def stored_insights(spark, sf_dir):
    """The insight rows of each half of the days merged into the stored table, the second twice."""
    rows = b.insight_events(spark, sf_dir)
    name = "stored_" + new_folder(spark, "t").rsplit("-", 1)[1]
    tables.create_table(spark, name, schemas.INSIGHTS, location=new_folder(spark, "stored"), partition="execution_date")
    one = dedupe.dedupe_ranked(rows, insights.INSIGHT_KEY, [F.col("event_id").asc()]).drop("event_id")
    last = dedupe.dedupe_ranked(rows, insights.INSIGHT_KEY, [F.col("event_id").desc()]).drop("event_id")
    late = last.where(F.col("execution_date") >= SPLIT).withColumn("model_version", F.lit("m2"))
    for batch in (one, late, late):
        insights.store_insights(spark, name, batch)
    found = tables.open_table(spark, name)
    return found.select(
        "subreddit", "insight_type", "item_name", "mentions", "model_version",
        as_text("generated_at").alias("generated_at"), F.col("execution_date").cast("string").alias("execution_date"),
    )


@query
def merge_into_partitioned_table(spark, sf_dir):
    """A guarded merge into a stored table that rewrites only the touched partitions."""
    before, after = _before_and_after(spark, sf_dir)
    name = "merged_" + new_folder(spark, "t").rsplit("-", 1)[1]
    ddl = "user_id BIGINT, event_id BIGINT, score BIGINT, day STRING, stored_day STRING"
    tables.create_table(spark, name, ddl, location=new_folder(spark, "merged"), partition="stored_day")
    guard = merge.not_older("day")
    for rows in (before, after, before):
        source = rows.drop("computed_at").withColumn("stored_day", F.col("day"))
        merge.merge_table(spark, name, source, ["user_id"], partition="stored_day", guard=guard)
    return tables.open_table(spark, name)


# --- state between runs ---


def _runs(spark, sf_dir):
    """Ids per community of the last run and of the current one; signup and error have nothing new.

    The last run has not seen the ids of other communities whose number divides by five.
    """
    ids = b.snapshot_posts(spark, sf_dir).select("subreddit", "id", "ingest_date").distinct()
    old = F.pmod(F.substring("id", 2, 20).cast("bigint"), F.lit(5)) != 0
    seen = ids.where(old | F.col("subreddit").isin("signup", "error"))
    current = ids.where(F.col("ingest_date") == b.RUNS[2]).select("subreddit", "id")
    return current, seen.select("subreddit", "id").distinct()


@query
def unseen_posts(spark, sf_dir):
    posts = b.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("subreddit"),
        b.text(b.key("user_id"), "-", b.number_in_props().cast("string")).alias("id"),
        b.day_of("ts").alias("day"),
    )
    seen = posts.where(F.col("day") < SPLIT).select("subreddit", "id").distinct()
    return state.unseen(posts.where(F.col("day") >= SPLIT).select("subreddit", "id").distinct(), seen)


@query
def snapshots_worth_saving(spark, sf_dir):
    current, seen = _runs(spark, sf_dir)
    return state.worth_saving(current, seen)


@query
def next_seen_ids(spark, sf_dir):
    current, seen = _runs(spark, sf_dir)
    return state.next_seen(current, seen)


def _candidates(spark, sf_dir):
    posts = b.snapshot_posts(spark, sf_dir)
    current = dedupe.dedupe_latest_snapshot(posts, ["community", "id"])
    first = posts.where(F.col("ingest_date") == b.RUNS[0])
    known = dedupe.dedupe_ranked(first, ["id"], [F.col("position").desc()])
    cache = known.select(F.col("id").alias("post_id"), "num_comments")
    return state.comment_candidates(current, cache, min_comments=5, top_k=50), cache


@query
def posts_needing_comments(spark, sf_dir):
    return _candidates(spark, sf_dir)[0].select("subreddit", "id", "engagement", "place", "cached", "changed")


@query
def comment_fetch_stats(spark, sf_dir):
    return state.candidate_stats(_candidates(spark, sf_dir)[0])


@query
def next_comment_counts(spark, sf_dir):
    candidates, cache = _candidates(spark, sf_dir)
    fetched = candidates.where(F.col("changed") & (F.col("subreddit") == "view"))
    return state.next_comment_cache(cache, fetched.select(F.col("id").alias("post_id"), "num_comments"))


@query
def communities_needing_insights(spark, sf_dir):
    posts = b.posts_by_customer(spark, sf_dir)
    return state.eligible_communities(posts, b.insights(spark, sf_dir), min_posts=3)


@query
def communities_quota(spark, sf_dir):
    posts = b.posts_by_customer(spark, sf_dir)
    return state.eligible_communities(posts, b.insights(spark, sf_dir), min_posts=3, limit=100)


# --- quality ---


def _checked(spark, sf_dir, not_null=False):
    fields = [
        F.col("id"),
        F.when(F.col("score") % 2 == 0, F.col("subreddit")).otherwise(F.concat("subreddit", F.lit("2"))).alias("subreddit"),
        F.when((F.col("community") != "error") & (F.col("score") < 50), F.col("title")).alias("title"),
        "created_utc", "score",
    ]
    raw = b.snapshot_posts(spark, sf_dir).select("community", "ingest_date", F.to_json(F.struct(*fields)).alias("raw"))
    return quality.with_checks(raw, not_null=not_null)


@query
def quality_profile(spark, sf_dir):
    return quality.quality_profile(_checked(spark, sf_dir), PLACE)


@query
def quality_communities_found(spark, sf_dir):
    return quality.communities_found(_checked(spark, sf_dir))


@query
def quality_strict_gate_failures(spark, sf_dir):
    """The batches that the strict gate names when it stops."""
    checked = _checked(spark, sf_dir, not_null=True)
    return quality.failing(quality.quality_profile(checked, PLACE), PLACE)


@query
def quality_strict_gate_passed(spark, sf_dir):
    """The strict gate lets a run through in which no community fails."""
    checked = _checked(spark, sf_dir, not_null=True).where(~F.col("invalid"))
    kept = quality.strict_gate(checked, quality.quality_profile(checked))
    return kept.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("posts"))


@query
def quality_lenient_gate(spark, sf_dir):
    checked = _checked(spark, sf_dir, not_null=True)
    kept = quality.lenient_gate(checked, quality.quality_profile(checked))
    return kept.groupBy("community").agg(F.count(F.lit(1)).alias("posts"), F.count_if("invalid").alias("invalid"))


# --- text ---


def documents_silver(spark, sf_dir):
    return fallback.fallback_silver(b.documents_as_posts(spark, sf_dir), b.WORDS)


@query
def word_mentions(spark, sf_dir):
    rows = documents_silver(spark, sf_dir)
    return rows.select("id", F.array_join("tools_mentioned", "|").alias("tools"), "tools_count", "selftext_clean")


@query
def tool_mentions_in_documents(spark, sf_dir):
    rows = fallback.fallback_silver(b.documents_as_posts(spark, sf_dir))
    return rows.select("id", F.array_join("tools_mentioned", "|").alias("tools"), "tools_count")


@query
def tool_aliases_in_documents(spark, sf_dir):
    """The given tool names, found in texts that hold them."""
    rows = fallback.fallback_silver(b.documents_with_tools(spark, sf_dir))
    return rows.select("id", F.array_join("tools_mentioned", "|").alias("tools"), "tools_count")


@query
def tool_rankings(spark, sf_dir):
    return fallback.tool_rankings(documents_silver(spark, sf_dir))


@query
def subreddit_rankings(spark, sf_dir):
    return fallback.subreddit_rankings(documents_silver(spark, sf_dir))


@query
def fallback_summary(spark, sf_dir):
    return fallback.fallback_summary(documents_silver(spark, sf_dir))


@query
def fallback_report(spark, sf_dir):
    return fallback.fallback_report(documents_silver(spark, sf_dir))


@query
def fallback_silver_posts(spark, sf_dir):
    rows = fallback.fallback_silver(b.bronze_posts(spark, sf_dir))
    return rows.select("id", "subreddit", "title", "selftext_clean", "author", "score", "num_comments", "tools_count")


@query
def text_functions(spark, sf_dir):
    docs = b.table(spark, sf_dir, "documents")
    body, name = F.col("text"), F.col("source")
    return docs.select(
        "doc_id",
        text.ellipsis(body, 280).alias("shown"),
        text.with_snippet(name, body, 150).alias("snippet"),
        text.strip_kind(F.concat(F.lit("t3_"), name, F.lit("_x"))).alias("stripped"),
        text.strip_kind(name).alias("unprefixed"),
        text.strip_kind(F.when(F.col("lang") == "en", F.lit("")).otherwise(F.lit("t1_"))).alias("emptied"),
        text.is_community_name(name).alias("valid_name"),
        text.is_community_name(body).alias("valid_text"),
        values.if_blank(F.when(F.col("lang") == "de", F.lit("")).otherwise(name), "none").alias("defaulted"),
        text.title_and_body(F.when(F.col("lang") == "fr", name), F.when(F.col("lang") != "es", F.col("lang"))).alias("joined"),
    )


@query
def date_functions(spark, sf_dir):
    events = b.table(spark, sf_dir, "events")
    seconds = F.when(F.col("event_type") != "error", b.epoch("ts"))
    return events.select(
        "event_id",
        dates.as_day(dates.week_of(b.epoch("ts"))).alias("week"),
        dates.iso_utc(F.floor(seconds).cast("double")).alias("iso"),
        dates.file_stamp(b.moment("ts")).alias("stamp"),
        as_text(dates.stamp_of_file(F.concat(F.lit("raw_"), dates.file_stamp(b.moment("ts")), F.lit(".json")))).alias("parsed"),
        F.datediff(dates.day(AS_OF), b.moment("ts")).cast("bigint").alias("age"),
    )


@query
def number_functions(spark, sf_dir):
    events = b.table(spark, sf_dir, "events")
    as_words = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(b.key("event_id"))
    return events.select(
        "event_id",
        values.to_long(as_words).alias("whole"),
        values.to_long(F.concat(as_words, F.lit(".7"))).alias("cut"),
        values.to_double(F.concat(as_words, F.lit(".5"))).alias("double"),
        values.pages(F.col("event_id"), 20).alias("pages"),
    )


@query
def community_context(spark, sf_dir):
    built = context.build_context(b.documents_as_posts(spark, sf_dir), b.lines_as_comments(spark, sf_dir))
    return context.long_enough(built)


@query
def community_context_large(spark, sf_dir):
    return context.build_context(
        b.documents_as_posts(spark, sf_dir), b.lines_as_comments(spark, sf_dir), context.ONE_COMMUNITY
    )


@query
def community_prompts(spark, sf_dir):
    built = context.build_context(b.documents_as_posts(spark, sf_dir), b.lines_as_comments(spark, sf_dir))
    return context.render_prompts(built, "r/{subreddit} {x}\n{content}").drop("content")


@query
def community_default_prompts(spark, sf_dir):
    """The default template around each context: what stands before, between and after its two parts."""
    built = context.build_context(b.documents_as_posts(spark, sf_dir), b.lines_as_comments(spark, sf_dir))
    rows = context.render_prompts(built)
    return rows.select(
        "subreddit", "content", (F.length("prompt") - F.length("content")).cast("bigint").alias("template_length"),
        F.contains("prompt", "content").alias("holds_content"), F.col("prompt").contains("{content}").alias("unfilled"),
    )


# --- insights ---


@query
def answers_to_insight_rows(spark, sf_dir):
    rows = insights.answers_to_rows(
        insights.parse_answers(b.answers(spark, sf_dir)),
        execution_date=F.to_date("answered_at"),
        model_version=F.lit("m1"),
        generated_at=F.col("answered_at"),
    )
    return rows.withColumns(
        {"generated_at": as_text("generated_at"), "execution_date": F.col("execution_date").cast("string")}
    )


@query
def answer_sizes(spark, sf_dir):
    sizes = insights.answer_sizes(insights.parse_answers(b.answers(spark, sf_dir)))
    return sizes.select("event_id", *[F.col(kind).cast("bigint").alias(kind) for kind in insights.NAME_FIELD])


@query
def latest_insights_of_community(spark, sf_dir):
    rows = insights.community_insights(b.insights(spark, sf_dir), "c8")
    return rows.withColumn("generated_at", as_text("generated_at"))


@query
def latest_insights_of_community_own_run(spark, sf_dir):
    rows = insights.community_insights(b.insights(spark, sf_dir), "c8", per_community=True)
    return rows.withColumn("generated_at", as_text("generated_at"))


@query
def latest_insights_per_community(spark, sf_dir):
    rows = insights.latest_run_per_community(b.insights(spark, sf_dir))
    return rows.select("subreddit", "insight_type", "item_name", "mentions")


@query
def top_insight_items(spark, sf_dir):
    return insights.top_items(b.insights(spark, sf_dir))


@query
def recent_pain_points(spark, sf_dir):
    rows = insights.recent_items(b.insights(spark, sf_dir), as_of=AS_OF)
    return rows.withColumn("execution_date", F.col("execution_date").cast("string"))


@query
def trend_between_weeks(spark, sf_dir):
    return insights.compare_weeks(b.insights(spark, sf_dir), as_of=AS_OF)


@query
def trend_between_separate_weeks(spark, sf_dir):
    return insights.compare_weeks(b.insights(spark, sf_dir), as_of=AS_OF, half_open=True)


@query
def insights_nested(spark, sf_dir):
    rows = insights.insights_by_community(b.insights(spark, sf_dir), max_items=3)
    return rows.select(
        "subreddit", "part", "parts", "total", flat("insights", "insight_type", "item_name", "mentions", "context").alias("insights")
    )


@query
def insights_by_kind(spark, sf_dir):
    rows = insights.nested_insights(b.insights(spark, sf_dir), max_items=3)
    return rows.select(
        "subreddit", "part", "parts",
        *[flat(F.col("insights")[kind], "item_name", "mentions").alias(kind) for kind in insights.NAME_FIELD],
    )


@query
def insight_counts(spark, sf_dir):
    rows = insights.insight_counts(b.insights(spark, sf_dir))
    return rows.withColumn("last_updated", as_text("last_updated"))


@query
def stale_communities(spark, sf_dir):
    rows = insights.stale_communities(
        silver.silver_posts(b.posts_by_customer(spark, sf_dir)), b.insights(spark, sf_dir), as_of=LATER
    )
    return rows.select(
        "subreddit", F.col("last_insight_date").cast("string").alias("last_insight_date"),
        F.col("days_since_update").cast("bigint").alias("days_since_update"),
    )


# --- served results ---


def _latest(spark, sf_dir):
    return dedupe.dedupe_latest_snapshot(b.snapshot_posts(spark, sf_dir))


def _latest_comments(spark, sf_dir):
    return dedupe.dedupe_latest_snapshot(b.snapshot_comments(spark, sf_dir))


def _last_times(spark, sf_dir, prefix):
    posts = b.snapshot_posts(spark, sf_dir) if prefix == "raw" else b.snapshot_comments(spark, sf_dir)
    heads = posts.select(*PLACE, "file_name", "snapshot_at", F.lit(None).cast("string").alias("saved_at")).distinct()
    return snapshots.last_snapshot_times(heads)


@query
def top_silver_posts(spark, sf_dir):
    return serve.top_silver_posts(silver_posts_frame(spark, sf_dir))


@query
def top_silver_comments(spark, sf_dir):
    return serve.top_silver_comments(silver_comments_frame(spark, sf_dir))


@query
def top_gold_weeks(spark, sf_dir):
    return serve.top_weeks(weeks_frame(spark, sf_dir))


@query
def top_commenters_served(spark, sf_dir):
    return serve.top_commenter_rows(gold.top_commenters(silver_comments_frame(spark, sf_dir)))


@query
def top_commenters_ranked(spark, sf_dir):
    rows = gold.top_commenters(silver_comments_frame(spark, sf_dir))
    order = [F.col("total_score").desc(), F.col("subreddit").asc(), F.col("author").asc()]
    return topk.ranked(rows, order, 20).select("rank", "subreddit", "author", "total_score")


@query
def community_posts_by_bound_parameters(spark, sf_dir):
    """A registered view, read by SQL with bound parameters."""
    silver_posts_frame(spark, sf_dir).createOrReplaceTempView("silver_posts_view")
    return spark.sql(
        "SELECT id, title, score FROM silver_posts_view WHERE subreddit = :sub "
        "ORDER BY score DESC, id LIMIT :lim",
        args={"sub": "1-URGENT", "lim": 15},
    )


@query
def community_catalog(spark, sf_dir):
    rows = serve.community_catalog(
        _latest(spark, sf_dir), _latest_comments(spark, sf_dir), b.snapshot_files(spark, sf_dir)
    )
    entry = ("date", "count", "snapshots", "comments_count", "comment_snapshots")
    return rows.select("subreddit", flat("dates", *entry).alias("dates"), "total_posts")


@query
def posts_page_by_score(spark, sf_dir):
    rows = serve.posts_page(_latest(spark, sf_dir), "click", b.RUNS[0], number=2, per_page=20)
    return rows.select("id", "score", "num_comments", "title")


@query
def posts_page_by_comments(spark, sf_dir):
    rows = serve.posts_page(_latest(spark, sf_dir), "view", b.RUNS[2], number=1, per_page=30, sort_by="comments")
    return rows.select("id", "score", "num_comments", "title")


@query
def comments_page_by_date(spark, sf_dir):
    rows = serve.comments_page(_latest_comments(spark, sf_dir), "view", b.RUNS[1], number=3, sort_by="date")
    return rows.select("id", "post_id", "score", "depth", "created_utc")


@query
def comments_page_of_post(spark, sf_dir):
    rows = serve.comments_page(_latest_comments(spark, sf_dir), "view", b.RUNS[1], post_id="e7", per_page=100)
    return rows.select("id", "post_id", "score", "depth")


@query
def posts_page_summary(spark, sf_dir):
    rows = serve.page_summary(_latest(spark, sf_dir), b.snapshot_files(spark, sf_dir), "click", b.RUNS[0])
    return rows.select("community", "ingest_date", "total", "pages", "snapshots")


@query
def post_stats(spark, sf_dir):
    rows = serve.post_stats(
        _latest(spark, sf_dir), b.snapshot_files(spark, sf_dir), _last_times(spark, sf_dir, "raw")
    )
    labels = F.map_entries("flairs")
    return rows.withColumns(
        {
            "flairs": flat(labels, "key", "value"),
            "top_posts": flat("top_posts", "title", "score", "num_comments", "author"),
        }
    )


@query
def comment_stats(spark, sf_dir):
    rows = serve.comment_stats(
        _latest_comments(spark, sf_dir), b.snapshot_files(spark, sf_dir), _last_times(spark, sf_dir, "comments")
    )
    return rows.withColumn("top_comments", flat("top_comments", "body", "score", "author", "post_id", "depth"))


@query
def all_posts(spark, sf_dir):
    rows = serve.all_posts(dedupe.dedupe_across_communities(b.snapshot_posts(spark, sf_dir)), 500)
    return rows.select("id", "community", "score")


@query
def layer_status(spark, sf_dir):
    rows = serve.layer_status(
        b.bronze_posts(spark, sf_dir), silver_posts_frame(spark, sf_dir), weeks_frame(spark, sf_dir)
    )
    return rows.select(
        "layer", "records", "subreddits",
        F.get_json_object("sample", "$.subreddit").alias("sample_subreddit"),
        F.coalesce(F.get_json_object("sample", "$.id"), F.get_json_object("sample", "$.week_start")).alias("sample_key"),
    )


@query
def status_with_fallback(spark, sf_dir):
    """Silver and Gold still empty: their status comes from what Bronze gives."""
    bronze = b.bronze_posts(spark, sf_dir)
    none = F.lit(False)
    rows = serve.status_with_fallback(
        bronze, silver_posts_frame(spark, sf_dir).where(none), weeks_frame(spark, sf_dir).where(none),
        fallback.fallback_silver(bronze),
    )
    return rows.select("layer", "mode", "records", "subreddits")


def _published(spark: SparkSession, sf_dir: str) -> str:
    """Where the snapshot is. Weeks and commenters share the cleaned comments, of which the columns they read are written."""
    out = new_folder(spark, "published")
    posts = silver_posts_frame(spark, sf_dir)
    with freeing(spark):
        comments = stage(
            silver_comments_frame(spark, sf_dir).select("post_id", "subreddit", "author", "score", "created_utc"), "silver_comments"
        )
        publish.publish_snapshot(
            posts, gold.subreddit_week(posts, comments), gold.top_commenters(comments), b.insights(spark, sf_dir), out
        )
    return out


@query
def published_posts(spark, sf_dir):
    """The snapshot document written, read back, and its posts listed."""
    out = _published(spark, sf_dir)
    document = spark.read.json(f"{out}/document")
    rows = document.select(F.col("gold.summary.total_posts").alias("total_posts"), F.inline("silver_posts"))
    return rows.select("id", "score", "tools_count", "total_posts")


@query
def published_insights(spark, sf_dir):
    """The insights beside the document, read back."""
    out = _published(spark, sf_dir)
    rows = spark.read.schema(
        "subreddit STRING, part INT, parts INT, insights MAP<STRING, ARRAY<STRUCT<item_name: STRING, mentions: INT, context: STRING>>>"
    ).json(f"{out}/insights")
    return rows.select(
        "subreddit", *[flat(F.col("insights")[kind], "item_name", "mentions").alias(kind) for kind in insights.NAME_FIELD]
    )


@query
def published_rankings(spark, sf_dir):
    comments = silver_comments_frame(spark, sf_dir)
    document = publish.snapshot_document(
        silver_posts_frame(spark, sf_dir), weeks_frame(spark, sf_dir), gold.top_commenters(comments)
    )
    return document.select(F.inline("gold.subreddit_rankings"))


@query
def published_layers(spark, sf_dir):
    comments = silver_comments_frame(spark, sf_dir)
    document = publish.snapshot_document(
        silver_posts_frame(spark, sf_dir), weeks_frame(spark, sf_dir), gold.top_commenters(comments)
    )
    return document.select(F.inline("layers")).select("name", "status", "records")


# --- streams ---


def _new_tables(spark: SparkSession, label: str) -> Tables:
    base = new_folder(spark, label)
    return Tables(spark, base, prefix="t" + base.rsplit("-", 1)[1] + "_", buckets=4).create()


def _load_runs(made: Tables, posts: DataFrame, dates: Sequence[str]) -> None:
    """Load the runs one after the other. A row's day is part of its key, so all are deduplicated in one pass, written once."""
    with freeing(made.spark):
        latest = stage(dedupe.dedupe_latest_snapshot(posts.where(F.col("ingest_date").isin(*dates))), "runs")
        for date in dates:
            run_medallion(made, latest.where(F.col("ingest_date") == date), ingest_date=date, scope="batch")


@query
def medallion_of_one_batch(spark, sf_dir):
    """Gold from the batch alone: two runs, each loaded twice."""
    made = _new_tables(spark, "batch")
    _load_runs(made, b.snapshot_posts(spark, sf_dir), [b.RUNS[0], b.RUNS[0], b.RUNS[1], b.RUNS[1], b.RUNS[2]])
    return made.open("bronze_posts").groupBy("_ingest_date").agg(F.count(F.lit(1)).alias("posts"))


@query
def batch_scope_gold_weeks(spark, sf_dir):
    """Gold rows of three runs, each from its batch alone; a later batch replaces a week of a community."""
    made = _new_tables(spark, "batch-gold")
    _load_runs(made, b.snapshot_posts(spark, sf_dir), b.RUNS)
    return made.open("gold_subreddit_week").select(
        "week_start", "subreddit", "post_count", "sum_score", "sum_num_comments", "avg_score", "avg_comments_per_post", "ingest_date")


def _streamed(spark, sf_dir) -> Tables:
    """The snapshot files fed through the medallion by a stream, some files per batch."""
    root = b.snapshot_root(spark, sf_dir)

    def stream() -> Tables:
        made = _new_tables(spark, "medallion")
        ingest.start_medallion(
            made, root, checkpoint=f"{made.root}/_checkpoint", max_files=8
        ).awaitTermination()
        return made

    return b.once(spark, sf_dir, "medallion", stream)


@query
def streamed_silver_posts(spark, sf_dir):
    rows = _streamed(spark, sf_dir).open("silver_posts")
    return rows.select("id", "subreddit", "title", "author", "score", "num_comments", "created_utc", "ingest_date")


@query
def streamed_gold_weeks(spark, sf_dir):
    rows = _streamed(spark, sf_dir).open("gold_subreddit_week")
    return rows.drop("computed_at", "ingest_date")


@query
def replayed_gold_commenters(spark, sf_dir):
    """The latest file of each community loaded into empty tables, twice."""
    made = _new_tables(spark, "replay")
    files = paths.list_files(spark, paths.snapshot_glob(b.snapshot_root(spark, sf_dir)))
    for _ in range(2):
        ingest.replay_latest(made, files)
    return made.open("gold_top_commenters").drop("computed_at", "ingest_date", "bucket")


def _incremental(spark, sf_dir) -> incremental.States:
    """The same files through the stream with keyed state, some files per batch."""

    def load() -> incremental.States:
        states = incremental.States(_new_tables(spark, "incremental")).create()
        incremental.start_incremental(states, b.snapshot_root(spark, sf_dir), max_files=8).awaitTermination()
        return states

    return b.once(spark, sf_dir, "incremental", load)


@query
def incremental_silver_posts(spark, sf_dir):
    rows = _incremental(spark, sf_dir).tables.open("silver_posts")
    return rows.select("id", "subreddit", "title", "author", "score", "num_comments", "created_utc", "ingest_date")


@query
def incremental_gold_weeks(spark, sf_dir):
    return incremental.gold_weeks(_incremental(spark, sf_dir))


@query
def incremental_gold_commenters(spark, sf_dir):
    return incremental.gold_commenters(_incremental(spark, sf_dir))


def _stream_steps(spark, label, ddl, build, steps) -> DataFrame:
    """Write the rows of each step in turn, which may depend on what came out so far, and stream them as a batch."""
    base, session = new_folder(spark, label), stateful.stateful_session(spark)
    for step in steps:
        step(lambda: spark.read.parquet(f"{base}/out")).write.mode("append").parquet(f"{base}/in")
        made = build(session.readStream.schema(ddl).parquet(f"{base}/in"))
        sink = made.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
        sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query
def new_ids_of_runs(spark, sf_dir):
    """The ids that each of three runs, a batch each, calls new."""
    posts = b.snapshot_posts(spark, sf_dir).select("subreddit", F.col("ingest_date").alias("run"), "id")
    steps = [lambda _, run=run: posts.where(F.col("run") == run) for run in b.RUNS]
    return _stream_steps(spark, "seen-ids", "subreddit string, run string, id string", stateful.new_ids, steps)


@query
def comment_counts_of_runs(spark, sf_dir):
    """Candidates of three runs against the counts of earlier fetches; a fourth of the fetches fail."""
    posts = b.snapshot_posts(spark, sf_dir).withColumn("run", F.col("ingest_date"))
    latest = dedupe.dedupe_latest_snapshot(posts, ["community", "run", "id"])
    nothing = spark.createDataFrame([], "post_id string, num_comments long")
    found = state.comment_candidates(latest, nothing, min_comments=5, top_k=50, per=["run", "subreddit"])
    named = found.select(F.concat_ws("/", "subreddit", "id").alias("post_id"), "run", "num_comments", F.lit(None).cast("boolean").alias("fetched"))

    def step(run: str, before: str | None):
        def rows(out):
            candidates = named.where(F.col("run") == run)
            if before is None:
                return candidates
            due = out().where(F.col("changed") & (F.col("run") == before))
            works = F.substring_index("post_id", "/e", -1).cast("bigint") % 4 != 0
            return candidates.unionByName(due.select("post_id", "run", "num_comments", works.alias("fetched")))

        return rows

    steps = [step(run, before) for run, before in zip(b.RUNS, (None, *b.RUNS), strict=False)]
    ddl = "post_id string, run string, num_comments long, fetched boolean"
    return _stream_steps(spark, "comment-counts", ddl, stateful.count_changes, steps)
