"""The given tables seen as posts, comments, snapshots, documents and insights."""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plaza.functions.dates import iso_utc
from plaza.functions.text import TOOL_ALIASES
from plaza.operators.dedupe import dedupe_ranked
from plaza.session import new_folder
from plaza.sources.paths import with_path_columns
from plaza.sources.sinks import write_snapshots

# The days on which extraction runs end; an event belongs to the first run at or after it.
RUNS = ("2024-01-10", "2024-01-20", "2024-01-30")
KINDS = {
    "view": "trending_tools", "click": "trending_tools", "error": "pain_points",
    "purchase": "solutions", "signup": "solutions",
}
# Frequent words of the documents, standing in for the tool names that invented prose lacks.
WORDS = {
    "the": "Definite", "der": "Definite", "die": "Definite", "le": "Definite", "el": "Definite",
    "of": "Of", "de": "Of", "von": "Of", "and": "And", "und": "And", "et": "And",
    "für": "For", "for": "For", "par": "By", "this": "This", "é": "Accent",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def moment(name: str) -> Column:
    return F.col(name).cast("timestamp")


def epoch(name: str) -> Column:
    return moment(name).cast("double")


def text(*parts: str | Column) -> Column:
    return F.concat(*[part if isinstance(part, Column) else F.lit(part) for part in parts])


def key(name: str) -> Column:
    return F.col(name).cast("string")


def day_of(name: str) -> Column:
    return F.date_format(moment(name), "yyyy-MM-dd")


def bronze_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as posts, with deleted, removed and missing authors, titles, scores and flairs."""
    price = F.col("o_totalprice")
    author = (
        F.when(price < 20000, "[deleted]").when(price < 30000, "[removed]")
        .when(price < 35000, None).otherwise(text("u", key("o_custkey")))
    )
    return table(spark, sf_dir, "orders").select(
        key("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("subreddit"),
        F.when(price < 490000, text("order ", key("o_orderkey"))).alias("title"),
        F.col("o_orderstatus").alias("selftext"),
        author.alias("author"),
        F.when((price < 100000) | (price >= 110000), price.cast("bigint")).alias("score"),
        F.when(F.col("o_orderstatus") != "P", price / 1000000).alias("upvote_ratio"),
        (price / 10000).cast("bigint").alias("num_comments"),
        epoch("o_orderdate").alias("created_utc"),
        iso_utc(epoch("o_orderdate")).alias("created_date"),
        text("/r/", F.col("o_orderpriority"), "/", key("o_orderkey")).alias("permalink"),
        F.lit(None).cast("string").alias("url"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("flair"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus") == "O").alias("is_self"),
        day_of("o_orderdate").alias("_ingest_date"),
    )


def posts_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts whose community is the customer, to meet the communities of the insights."""
    return bronze_posts(spark, sf_dir).join(
        table(spark, sf_dir, "orders").select(key("o_orderkey").alias("id"), "o_custkey"), "id"
    ).withColumn("subreddit", text("c", key("o_custkey")))


def bronze_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as comments of their order's community. Some ids occur several times."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    number = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").join(orders, "l_orderkey").select(
        text(key("l_orderkey"), "-", key("l_linenumber")).alias("id"),
        key("l_orderkey").alias("post_id"),
        F.when(number == 1, key("l_orderkey"))
        .otherwise(text(key("l_orderkey"), "-", (number - 1).cast("string"))).alias("parent_id"),
        F.col("o_orderpriority").alias("subreddit"),
        F.when(F.col("l_tax") == 0.08, "[deleted]").otherwise(text("s", key("l_suppkey"))).alias("author"),
        F.when(F.col("l_quantity") > 1, text(F.col("l_returnflag"), F.col("l_linestatus"))).alias("body"),
        F.col("l_quantity").cast("bigint").alias("score"),
        (number - 1).cast("bigint").alias("depth"),
        epoch("l_shipdate").alias("created_utc"),
        iso_utc(epoch("l_shipdate")).alias("created_date"),
        day_of("l_shipdate").alias("_ingest_date"),
        text("comments_", day_of("l_shipdate")).alias("_source_file"),
        F.col("l_partkey").alias("position"),
    )


def run_of(name: str) -> Column:
    date = F.to_date(moment(name))
    return F.when(date <= RUNS[0], RUNS[0]).when(date <= RUNS[1], RUNS[1]).otherwise(RUNS[2])


def number_in_props() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _place(prefix: str) -> list[Column]:
    """One file per community, run and day."""
    name = text(f"{prefix}_", day_of("ts"), "T00_00_00.json")
    return [
        F.col("event_type").alias("community"),
        run_of("ts").alias("ingest_date"),
        name.alias("file_name"),
        text("reddit/", F.col("event_type"), "/date=", run_of("ts"), "/", name).alias("source_file"),
        day_of("ts").alias("snapshot_at"),
        F.col("event_id").alias("position"),
    ]


def snapshot_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as posts read from snapshot files; a user's post recurs in later files."""
    return table(spark, sf_dir, "events").select(
        *_place("raw"),
        text("e", key("user_id")).alias("id"),
        F.col("event_type").alias("subreddit"),
        F.col("props").alias("title"),
        F.lit(None).cast("string").alias("selftext"),
        F.when(F.col("value") < 1, "[deleted]").otherwise(text("u", key("user_id"))).alias("author"),
        F.col("value").cast("bigint").alias("score"),
        F.lit(None).cast("double").alias("upvote_ratio"),
        number_in_props().alias("num_comments"),
        epoch("ts").alias("created_utc"),
        iso_utc(epoch("ts")).alias("created_date"),
        F.lit(None).cast("string").alias("permalink"),
        F.lit(None).cast("string").alias("url"),
        F.when(F.col("value") < 5, "").when(F.col("value") < 15, None)
        .otherwise(text("f", key("user_id"))).alias("flair"),
        F.lit(None).cast("boolean").alias("is_self"),
    )


def snapshot_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as comments read from snapshot files; ids recur per community, user and number."""
    return table(spark, sf_dir, "events").select(
        *_place("comments"),
        text("c", key("user_id"), "-", number_in_props().cast("string")).alias("id"),
        F.when(F.col("value") >= 2, text("e", key("user_id"))).alias("post_id"),
        F.lit(None).cast("string").alias("parent_id"),
        F.col("event_type").alias("subreddit"),
        F.when(number_in_props() > 0, text("u", number_in_props().cast("string"))).otherwise("").alias("author"),
        F.col("props").alias("body"),
        F.col("value").cast("bigint").alias("score"),
        (F.col("value") / 50).cast("bigint").alias("depth"),
        epoch("ts").alias("created_utc"),
        iso_utc(epoch("ts")).alias("created_date"),
    )


def snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files that the two frames above come from."""
    paths = snapshot_posts(spark, sf_dir).select("source_file").union(
        snapshot_comments(spark, sf_dir).select("source_file")
    )
    files = paths.distinct().withColumnRenamed("source_file", "path")
    return with_path_columns(files, F.col("path"))


_MADE: dict[tuple[str, str, str], object] = {}
_LOCK = threading.RLock()


def once(spark: SparkSession, sf_dir: str, what: str, make: Callable[[], object]) -> object:
    """Something written from the tables, made once per session."""
    known = (spark.sparkContext.applicationId, sf_dir, what)
    with _LOCK:
        if known not in _MADE:
            _MADE[known] = make()
        return _MADE[known]


def put_file(spark: SparkSession, path: str, content: str) -> None:
    """Write one small file below the shared folder, by Spark's file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    stream.write(bytearray(content.encode()))
    stream.close()


def snapshot_root(spark: SparkSession, sf_dir: str) -> str:
    """The events written as JSON snapshot files, one extraction per run."""
    return once(spark, sf_dir, "snapshots", lambda: write_runs(spark, sf_dir))


def write_runs(spark: SparkSession, sf_dir: str) -> str:
    """Posts: the last event per community and user. Comments: one per event."""
    root = new_folder(spark, "snapshots")
    posts = snapshot_posts(spark, sf_dir)
    comments = snapshot_comments(spark, sf_dir).withColumn("id", text("c", key("position")))
    dropped = ["community", "file_name", "source_file", "snapshot_at"]
    for date in RUNS:
        at = dt.datetime.fromisoformat(f"{date}T06:00:00")
        current = posts.where(F.col("ingest_date") == date)
        last = dedupe_ranked(current, ["community", "id"], [F.col("position").desc()])
        write_snapshots(
            last.drop("ingest_date", *dropped), root, date=date, snapshot_at=at, order=["position"]
        )
        said = comments.where(F.col("ingest_date") == date).drop("ingest_date", *dropped)
        write_snapshots(said, root, date=date, snapshot_at=at, payload="comments", order=["position"])
    return root


def documents_as_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        key("doc_id").alias("id"),
        F.col("lang").alias("subreddit"),
        F.col("source").alias("title"),
        F.col("text").alias("selftext"),
        text("a", F.col("source")).alias("author"),
        F.col("n_chars").alias("score"),
        F.lit(None).cast("bigint").alias("num_comments"),
        F.lit(None).cast("string").alias("created_date"),
        F.lit(None).cast("string").alias("flair"),
    )


def documents_with_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as posts whose whole text is followed by one to three aliases of tools, in any case.

    Which ones follows from the id; a third has no alias, and some have one inside a longer word.
    """
    names = F.array(*[F.lit(alias) for alias in TOOL_ALIASES])
    number = F.col("doc_id").cast("int")

    def alias(step: int) -> Column:
        return F.get(names, F.pmod(number * step, F.size(names)))

    said = (
        F.when(number % 3 == 0, text(" Nothing", alias(1), "ish here"))
        .when(number % 3 == 1, text(" Tried ", F.upper(alias(1)), ", then ", alias(3), "!"))
        .otherwise(text(" (", alias(1), ") or ", F.initcap(alias(5)), "; ", alias(1), "."))
    )
    posts = table(spark, sf_dir, "documents").withColumn("text", F.concat("text", said))
    return posts.select(
        key("doc_id").alias("id"), F.col("lang").alias("subreddit"), F.col("source").alias("title"),
        F.col("text").alias("selftext"), text("a", F.col("source")).alias("author"), F.col("n_chars").alias("score"),
        F.lit(None).cast("bigint").alias("num_comments"), F.lit(None).cast("string").alias("created_date"),
        F.lit(None).cast("string").alias("flair"),
    )


def lines_as_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document as a comment."""
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("n", "body")
    )
    return lines.select(
        text(key("doc_id"), "-", key("n")).alias("id"),
        F.col("lang").alias("subreddit"),
        "body",
        F.length("body").cast("bigint").alias("score"),
    )


def insight_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as insight rows; one community and item may occur several times a day."""
    kinds = F.create_map(*[F.lit(part) for pair in KINDS.items() for part in pair])
    return table(spark, sf_dir, "events").select(
        text("c", key("user_id")).alias("subreddit"),
        kinds[F.col("event_type")].alias("insight_type"),
        text("item", number_in_props().cast("string")).alias("item_name"),
        F.col("value").cast("int").alias("mentions"),
        F.col("props").alias("context"),
        moment("ts").alias("generated_at"),
        F.to_date(moment("ts")).alias("execution_date"),
        F.lit("m1").alias("model_version"),
        "event_id",
    )


def insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The insight table: the last event per community, kind, item and day."""
    keys = ["subreddit", "insight_type", "item_name", "execution_date"]
    last = dedupe_ranked(insight_events(spark, sf_dir), keys, [F.col("event_id").desc()])
    return last.drop("event_id")


def post_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a stored listing page with the post, a sparse copy of it, and an id-less entry."""
    posts = bronze_posts(spark, sf_dir)
    full = F.struct(
        "id", "subreddit", "title", "selftext", "author", "score", "upvote_ratio", "num_comments",
        "created_utc", "permalink", "url", F.col("flair").alias("link_flair_text"), "is_self",
    )
    fields = posts.select(full.alias("post")).schema["post"].dataType.fields[1:]
    nothing = [F.lit(None).cast(field.dataType).alias(field.name) for field in fields]
    sparse = F.struct("id", *nothing)
    nameless = F.struct(F.lit(None).cast("string").alias("id"), *nothing)
    children = F.array(
        *[F.struct(F.lit("t3").alias("kind"), post.alias("data")) for post in (full, sparse, nameless)]
    )
    listing = F.to_json(F.struct(F.struct(children.alias("children")).alias("data")))
    return posts.select(F.col("id").cast("bigint").alias("page"), listing.alias("listing"))


def deep_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as one chain of replies, a line answering the line before, as deep as it has lines."""
    head, tail = '{"data":{"children":[{"kind":"t1","data":', "}]}}"
    lines = table(spark, sf_dir, "documents").withColumn("lines", F.split("text", "\n"))

    def opened(line: Column, at: Column) -> Column:
        # The comment without its closing brace: its replies follow.
        data = F.to_json(F.struct(text(key("doc_id"), "-", at.cast("string")).alias("id"), line.alias("body")))
        return F.concat(F.lit(head), F.left(data, F.length(data) - 1), F.lit(',"replies":'))

    chain = F.concat(
        F.array_join(F.transform("lines", opened), ""), F.lit('""'), F.repeat(F.lit("}" + tail), F.size("lines"))
    )
    return lines.select(key("doc_id").alias("post_id"), chain.alias("listing"))


def comment_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a nested comment tree: threads of three lines, each answering the last.

    Each thread ends with an entry that is no comment, which a reader must skip.
    """
    lines = table(spark, sf_dir, "documents").withColumn("lines", F.split("text", "\n"))

    def comment(at: Column, replies: Column) -> Column:
        parent = F.when(at % 3 == 0, text("t3_", key("doc_id"))).otherwise(
            text("t1_", key("doc_id"), "-", (at - 1).cast("string"))
        )
        data = F.struct(
            text(key("doc_id"), "-", at.cast("string")).alias("id"),
            parent.alias("parent_id"),
            F.col("source").alias("author"),
            F.get(F.col("lines"), at).alias("body"),
            F.length(F.get(F.col("lines"), at)).alias("score"),
            F.col("n_chars").cast("double").alias("created_utc"),
            replies.alias("replies"),
        )
        return F.struct(F.lit("t1").alias("kind"), data.alias("data"))

    def listing(*children: Column) -> Column:
        return F.struct(F.struct(F.array(*children).alias("children")).alias("data"))

    def thread(first: Column) -> Column:
        last = comment(first + 2, F.lit(""))
        middle = F.when(first + 1 < F.size("lines"), listing(comment(first + 1, listing_if(first + 2, last))))
        return comment(first, middle)

    def listing_if(at: Column, child: Column) -> Column:
        return F.when(at < F.size("lines"), listing(child))

    threads = F.transform(F.sequence(F.lit(0), F.size("lines") - 1, F.lit(3)), thread)
    root = F.struct(F.struct(threads.alias("children")).alias("data"))
    more = F.regexp_replace(
        F.to_json(root), r"^\{\"data\":\{\"children\":\[", '{"data":{"children":[{"kind":"more","data":{"id":"m"}},'
    )
    return lines.select(key("doc_id").alias("post_id"), more.alias("listing"))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as model answers: good ones with one or two items, wrong ones, and broken ones."""
    item = [F.col("value").cast("int").alias("mentions"), F.col("props").alias("context")]
    named = F.struct(F.col("item").alias("name"), *item)
    topic = F.struct(F.col("item").alias("topic"), *item)
    bare = F.struct(F.col("item").alias("topic"), F.lit(None).cast("int").alias("mentions"), F.lit(None).cast("string").alias("context"))
    answer = (
        F.when(F.col("event_type") == "view", F.to_json(F.struct(F.array(named).alias("trending_tools"))))
        .when(F.col("event_type") == "click", F.to_json(F.struct(F.array(named).alias("trending_tools"), F.array(topic).alias("pain_points"))))
        .when(F.col("event_type") == "purchase", F.to_json(F.struct(F.array(bare).alias("solutions"))))
        .when(F.col("event_type") == "signup", F.to_json(F.struct(F.array(topic).alias("other"))))
        .otherwise(F.concat(F.lit('{"trending_tools": ['), F.col("props")))
    )
    events = table(spark, sf_dir, "events").withColumn("item", text("item", number_in_props().cast("string")))
    return events.select(
        "event_id", text("c", key("user_id")).alias("subreddit"), moment("ts").alias("answered_at"), answer.alias("answer")
    )
