"""Tool names in text, snippets, and prompt rendering."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alias -> canonical name of the tools that are counted.
TOOL_ALIASES = {
    "spark": "Apache Spark",
    "pyspark": "Apache Spark",
    "airflow": "Apache Airflow",
    "dagster": "Dagster",
    "prefect": "Prefect",
    "dbt": "dbt",
    "kafka": "Apache Kafka",
    "flink": "Apache Flink",
    "databricks": "Databricks",
    "snowflake": "Snowflake",
    "bigquery": "BigQuery",
    "redshift": "Redshift",
    "postgres": "PostgreSQL",
    "postgresql": "PostgreSQL",
    "python": "Python",
    "sql": "SQL",
    "docker": "Docker",
    "kubernetes": "Kubernetes",
    "k8s": "Kubernetes",
    "terraform": "Terraform",
    "aws": "AWS",
    "gcp": "GCP",
    "azure": "Azure",
    "delta lake": "Delta Lake",
    "iceberg": "Apache Iceberg",
    "polars": "Polars",
    "pandas": "Pandas",
    "duckdb": "DuckDB",
    "streamlit": "Streamlit",
    "fastapi": "FastAPI",
    "fivetran": "Fivetran",
    "airbyte": "Airbyte",
    "looker": "Looker",
    "power bi": "Power BI",
    "tableau": "Tableau",
    "superset": "Apache Superset",
    "mlflow": "MLflow",
    "redis": "Redis",
    "mongodb": "MongoDB",
    "clickhouse": "ClickHouse",
    "trino": "Trino",
}

PROMPT = """\
You are given posts and comments of the community r/{subreddit}. Answer with one JSON object only:
{"trending_tools":[{"name":"...","mentions":0,"context":"..."}],\
"pain_points":[{"topic":"...","mentions":0,"context":"..."}],\
"solutions":[{"topic":"...","mentions":0,"context":"..."}]}
At most three items per list, names of at most five words, one sentence of context each; \
leave a list empty when nothing fits.

r/{subreddit}:
{content}"""


def whole_words(words: Iterable[str]) -> str:
    """A pattern whose group 1 is one of the words, between Unicode word boundaries.

    The look-ahead turns away most positions by their first character alone, before the
    costly boundary test, and words are grouped by that character. Within a group they keep
    their order, so of several that fit, the first listed still wins.
    """
    rest: dict[str, list[str]] = {}
    for word in words:
        rest.setdefault(re.escape(word[0]), []).append(re.escape(word[1:]))
    branches = "|".join(f"{first}(?:{'|'.join(ends)})" for first, ends in rest.items())
    return rf"(?U)(?=[{''.join(rest)}])\b({branches})\b"


def extract_tools(text: Column, aliases: Mapping[str, str] = TOOL_ALIASES) -> Column:
    """Sorted distinct canonical names of the aliases that occur as whole words."""
    found = F.regexp_extract_all(F.lower(text), F.lit(whole_words(aliases)), F.lit(1))
    pairs = [F.lit(part) for pair in aliases.items() for part in pair]
    names = F.create_map(*pairs)
    canonical = F.transform(F.array_distinct(found), lambda word: names[word])
    return F.coalesce(F.array_sort(F.array_distinct(canonical)), F.array().cast("array<string>"))


def title_and_body(title: Column, body: Column) -> Column:
    """Both texts with a space between; a missing one counts as empty."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(body, F.lit("")))


def clip(text: Column, size: int) -> Column:
    """The first ``size`` characters, for display columns that are defined that way."""
    return F.substring(text, 1, size)


def ellipsis(text: Column, size: int) -> Column:
    """Display text: cut and marked when longer than ``size``; NULL becomes empty."""
    cut = F.when(F.length(text) > size, F.concat(clip(text, size), F.lit("…"))).otherwise(text)
    return F.coalesce(cut, F.lit(""))


def with_snippet(title: Column, body: Column, size: int) -> Column:
    """``title | start of body``, or the bare title when the body is missing or empty."""
    tail = F.when(F.length(body) > 0, F.concat(F.lit(" | "), clip(body, size))).otherwise("")
    return F.concat(F.coalesce(title, F.lit("")), tail)


def strip_kind(full_name: Column) -> Column:
    """``t1_abc`` -> ``abc``; text without an underscore stays, empty text is NULL."""
    cut = F.instr(full_name, "_")
    rest = F.when(cut > 0, full_name.substr(cut + 1, F.length(full_name))).otherwise(
        F.nullif(full_name, F.lit(""))
    )
    return rest


def render_prompt(subreddit: Column, content: Column, template: str = PROMPT) -> Column:
    """Fill ``{subreddit}`` and ``{content}``; the content is put in last, so it stays as it is."""
    named = F.replace(F.lit(template), F.lit("{subreddit}"), subreddit)
    return F.replace(named, F.lit("{content}"), content)


def is_community_name(name: Column) -> Column:
    return name.rlike(r"^[a-zA-Z0-9_]+$")
