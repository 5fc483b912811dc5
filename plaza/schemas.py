"""Column lists of the tables and of the JSON files, as Spark DDL."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Names and types that readers and writers of the files and tables agree on.
BRONZE_POSTS = """
    id STRING, subreddit STRING, title STRING, selftext STRING, author STRING,
    score BIGINT, upvote_ratio DOUBLE, num_comments BIGINT,
    created_utc DOUBLE, created_date STRING, permalink STRING, url STRING,
    flair STRING, is_self BOOLEAN
"""
BRONZE_COMMENTS = """
    id STRING, post_id STRING, parent_id STRING, subreddit STRING, author STRING,
    body STRING, score BIGINT, depth BIGINT, created_utc DOUBLE, created_date STRING
"""
LINEAGE = "_ingest_date STRING, _source_file STRING, _loaded_at TIMESTAMP"
SILVER_POSTS = BRONZE_POSTS + ", ingest_date STRING"
SILVER_COMMENTS = BRONZE_COMMENTS.replace("depth BIGINT", "depth INT") + ", ingest_date STRING"
GOLD_WEEK = """
    week_start STRING, subreddit STRING,
    post_count BIGINT, sum_score BIGINT, sum_num_comments BIGINT,
    avg_score DOUBLE, avg_comments_per_post DOUBLE,
    ingest_date STRING, computed_at TIMESTAMP,
    total_comments_extracted BIGINT, avg_comment_score DOUBLE, unique_commenters BIGINT
"""
GOLD_COMMENTERS = """
    subreddit STRING, author STRING, comment_count BIGINT, total_score BIGINT,
    avg_score DOUBLE, posts_commented BIGINT, ingest_date STRING, computed_at TIMESTAMP
"""
INSIGHTS = """
    subreddit STRING COMMENT 'community the insight is about',
    insight_type STRING COMMENT 'trending_tools, pain_points or solutions',
    item_name STRING COMMENT 'tool, topic or solution',
    mentions INT COMMENT 'how often the item was mentioned',
    context STRING COMMENT 'one sentence of context',
    generated_at TIMESTAMP COMMENT 'when the answer was produced',
    execution_date DATE COMMENT 'run date, the partition',
    model_version STRING COMMENT 'model that answered'
"""

# In the files numbers may come quoted, so they are read as text and cast afterwards.
_NUMBERS = {"BIGINT": "STRING", "DOUBLE": "STRING"}


def _as_text(ddl: str) -> str:
    for numeric, text in _NUMBERS.items():
        ddl = ddl.replace(numeric, text)
    return ddl


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(" ".join(ddl.split()))


def columns(ddl: str) -> list[str]:
    return struct(ddl).fieldNames()


_ENVELOPE = """
    subreddit STRING, execution_date STRING, snapshot_at STRING, saved_at STRING,
    extracted_at STRING, count BIGINT
"""
_STATS = """
    STRUCT<total_eligible BIGINT, skipped_cache BIGINT, fetched BIGINT,
           failed BIGINT, total_comments BIGINT>
"""
POST_SNAPSHOT = f"{_ENVELOPE}, posts ARRAY<STRUCT<{_as_text(BRONZE_POSTS)}>>"
COMMENT_SNAPSHOT = f"{_ENVELOPE}, stats {_STATS}, comments ARRAY<STRUCT<{_as_text(BRONZE_COMMENTS)}>>"
# The same files with each post kept as JSON text, to see which fields it really has.
RAW_POST_SNAPSHOT = f"{_ENVELOPE}, posts ARRAY<STRING>"
