from __future__ import annotations

import re

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plaza.functions import dates, text, values
from plaza.plans import context, fallback


def tools(spark, sentence, **aliases):
    got = spark.createDataFrame([(sentence,)], "t string").select(text.extract_tools(F.col("t"), **aliases))
    return got.first()[0]


@pytest.mark.parametrize(
    ("sentence", "found"),
    [
        ("I love using Apache Spark for ETL", ["Apache Spark"]),
        ("We use Airflow, dbt and Kafka in our stack", ["Apache Airflow", "Apache Kafka", "dbt"]),
        ("SPARK is great", ["Apache Spark"]),
        ("pyspark is just spark for python", ["Apache Spark", "Python"]),
        ("This post has no tech mentions", []),
        ("", []),
        (None, []),
        ("notsql sqlx sqlé _sql sql_ but power bi, delta lake!", ["Delta Lake", "Power BI"]),
        ("PostgreSQL/postgres (k8s)", ["Kubernetes", "PostgreSQL"]),
    ],
)
def test_tools(spark, sentence, found):
    assert tools(spark, sentence) == found


def test_of_two_aliases_that_fit_the_first_listed_wins(spark):
    assert tools(spark, "power bi", aliases={"power": "Power", "power bi": "Power BI"}) == ["Power"]
    assert tools(spark, "power bi", aliases={"power bi": "Power BI", "power": "Power"}) == ["Power BI"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="sqlparkydbt é_-.ßK8", max_size=25), min_size=1, max_size=12))
def test_tools_agree_with_python_regular_expressions(spark, sentences):
    words = "|".join(re.escape(alias) for alias in text.TOOL_ALIASES)
    pattern = re.compile(rf"\b({words})\b")
    expected = sorted(
        (sentence, sorted({text.TOOL_ALIASES[word] for word in pattern.findall(sentence.lower())}))
        for sentence in sentences
    )
    frame = spark.createDataFrame([(sentence,) for sentence in sentences], "t string")
    got = frame.select("t", text.extract_tools(F.col("t"))).collect()
    assert sorted((row[0], row[1]) for row in got) == expected


def test_prefixes(spark):
    names = spark.createDataFrame([("t1_abc",), ("t3_post_id",), ("",), ("plain",), (None,)], "n string")
    got = {row[0]: row[1] for row in names.select("n", text.strip_kind(F.col("n"))).collect()}
    assert got == {"t1_abc": "abc", "t3_post_id": "post_id", "": None, "plain": "plain", None: None}


def test_prompt_keeps_braces_of_the_content(spark):
    one = spark.createDataFrame([("tools", "say {subreddit} {x}")], "s string, c string")
    got = one.select(text.render_prompt(F.col("s"), F.col("c"))).first()[0]
    assert got.endswith("r/tools:\nsay {subreddit} {x}") and '"trending_tools"' in got


def test_fallback_filters_and_limits(spark):
    posts = spark.createDataFrame(
        [
            ("1", "s", "Good", "", "[deleted]", 1), ("2", "s", "Spark vs Flink", "also Kafka", "dev", 10),
            ("3", "s", "Gone", "", "[removed]", 1), ("4", "s", "No author", "", None, 1),
            ("5", "s", "", "text", "dev", 1), ("6", "t", "Long", "x" * 1000 + " spark", "dev", None),
            ("7", "t", "None body", None, "dev", 4),
        ],
        "id string, subreddit string, title string, selftext string, author string, score bigint",
    ).withColumns({name: F.lit(None).cast("string") for name in ("created_date", "flair")})
    silver = fallback.fallback_silver(posts.withColumn("num_comments", F.lit(None).cast("bigint")))
    got = {row["id"]: row for row in silver.collect()}
    assert set(got) == {"2", "6", "7"}
    assert got["2"]["tools_mentioned"] == ["Apache Flink", "Apache Kafka", "Apache Spark"]
    assert len(got["6"]["selftext_clean"]) == 500
    assert got["6"]["tools_mentioned"] == ["Apache Spark"]  # beyond the shown part
    assert got["7"]["selftext_clean"] == "" and got["7"]["num_comments"] == 0
    summary = fallback.fallback_summary(silver).first()
    assert tuple(summary) == (3, 3, 2, 4.7, 2)


def test_rankings(spark):
    silver = spark.createDataFrame(
        [("de", 100, ["Apache Spark", "dbt"]), ("de", 50, ["Apache Spark"]), ("py", 80, ["FastAPI"])],
        "subreddit string, score bigint, tools_mentioned array<string>",
    ).withColumn("tools_count", F.size("tools_mentioned"))
    first = fallback.tool_rankings(silver).collect()
    assert tuple(first[0]) == ("Apache Spark", 2, 150, 75.0)
    assert [row["tool"] for row in first] == ["Apache Spark", "FastAPI", "dbt"]
    assert [row["subreddit"] for row in fallback.subreddit_rankings(silver).collect()] == ["de", "py"]
    empty = silver.where("false")
    assert fallback.tool_rankings(empty).count() == 0 and fallback.subreddit_rankings(empty).count() == 0
    assert fallback.fallback_summary(empty).first()["total_posts"] == 0


def test_context_ranks_before_it_drops_empty_bodies(spark):
    posts = spark.createDataFrame(
        [("a", "p1", 5, "one", "body"), ("a", "p2", 9, "two", ""), ("a", "p3", 1, "three", None)],
        "subreddit string, id string, score bigint, title string, selftext string",
    )
    said = spark.createDataFrame(
        [("a", "c1", 3, ""), ("a", "c2", 2, "second"), ("a", "c3", 1, "third"), ("b", "c4", 1, "alone")],
        "subreddit string, id string, score bigint, body string",
    )
    size = context.ContextSize(posts=2, comments=2, max_chars=100, selftext=2, body=3)
    assert rows(context.build_context(posts, said, size)) == [("a", "two\none | bo\nsec")]


def test_numbers(spark):
    texts = spark.createDataFrame([("12",), ("12.9",), ("x",), (None,), ("9007199254740993",)], "t string")
    got = {row[0]: row[1] for row in texts.select("t", values.to_long(F.col("t"))).collect()}
    assert got == {"12": 12, "12.9": 12, "x": None, None: None, "9007199254740993": 9007199254740993}


def test_weeks_and_iso_dates(spark):
    sunday, monday = 1711929599.0, 1711929600.0  # 2024-03-31 23:59:59 and one second later
    times = spark.createDataFrame([(sunday,), (monday,), (0.0,), (None,), (1.5,)], "u double")
    got = {row[0]: (row[1], row[2]) for row in times.select(
        "u", dates.as_day(dates.week_of(F.col("u"))), dates.iso_utc(F.col("u"))).collect()}
    assert got[sunday] == ("2024-03-25", "2024-03-31T23:59:59+00:00")
    assert got[monday][0] == "2024-04-01"
    assert got[0.0][1] is None and got[None] == (None, None)
    assert got[1.5][1] == "1970-01-01T00:00:01.500000+00:00"
