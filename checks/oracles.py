"""SQL for each registered query, over the given tables."""

from __future__ import annotations

from checks.bindings import KINDS, RUNS, WORDS
from checks.queries import AS_OF, LATER, SPLIT
from plaza.functions.text import PROMPT, TOOL_ALIASES

ORACLES: dict[str, str] = {}


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in parts) + "\n"


def _case(column: str, pairs: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in pairs.items()) + " END"


BRONZE_POSTS = """
bronze_posts AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS subreddit,
    CASE WHEN o_totalprice < 490000 THEN 'order ' || o_orderkey END AS title,
    o_orderstatus AS selftext,
    CASE WHEN o_totalprice < 20000 THEN '[deleted]' WHEN o_totalprice < 30000 THEN '[removed]'
         WHEN o_totalprice < 35000 THEN NULL ELSE 'u' || o_custkey END AS author,
    CASE WHEN o_totalprice < 100000 OR o_totalprice >= 110000
         THEN CAST(trunc(o_totalprice) AS BIGINT) END AS score,
    CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 1000000 END AS upvote_ratio,
    CAST(trunc(o_totalprice / 10000) AS BIGINT) AS num_comments,
    epoch(o_orderdate) AS created_utc,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') AS created_date,
    '/r/' || o_orderpriority || '/' || o_orderkey AS permalink,
    CAST(NULL AS VARCHAR) AS url,
    CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS flair,
    CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus = 'O' END AS is_self,
    strftime(o_orderdate, '%Y-%m-%d') AS day,
    strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS week,
    o_custkey
  FROM orders)
"""
SILVER_POSTS = """
silver_posts AS (
  SELECT id, subreddit, title, selftext, author, coalesce(score, 0) AS score,
    coalesce(upvote_ratio, 0.0) AS upvote_ratio, coalesce(num_comments, 0) AS num_comments,
    created_utc, created_date, permalink, url, flair, coalesce(is_self, TRUE) AS is_self,
    day AS ingest_date, week, o_custkey
  FROM bronze_posts WHERE title IS NOT NULL AND author <> '[deleted]')
"""
BRONZE_COMMENTS = """
bronze_comments AS (
  SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_orderkey AS VARCHAR) AS post_id,
    CASE WHEN l_linenumber = 1 THEN CAST(l_orderkey AS VARCHAR)
         ELSE l_orderkey || '-' || (l_linenumber - 1) END AS parent_id,
    o_orderpriority AS subreddit,
    CASE WHEN l_tax = 0.08 THEN '[deleted]' ELSE 's' || l_suppkey END AS author,
    CASE WHEN l_quantity > 1 THEN l_returnflag || l_linestatus END AS body,
    CAST(trunc(l_quantity) AS BIGINT) AS score, l_linenumber - 1 AS depth,
    epoch(l_shipdate) AS created_utc,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S+00:00') AS created_date,
    strftime(l_shipdate, '%Y-%m-%d') AS day,
    strftime(date_trunc('week', l_shipdate), '%Y-%m-%d') AS week,
    l_partkey AS position
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""
SILVER_COMMENTS = """
silver_comments AS (
  SELECT id, post_id, parent_id, subreddit, author, body, score, CAST(depth AS INTEGER) AS depth,
    created_utc, created_date, day AS ingest_date, week
  FROM bronze_comments WHERE body IS NOT NULL AND author <> '[deleted]'
  QUALIFY row_number() OVER (PARTITION BY id
    ORDER BY day DESC, position DESC, author DESC, body DESC, score DESC) = 1)
"""
POST_WEEKS = """
post_weeks AS (
  SELECT week, subreddit, count(*) AS post_count, CAST(sum(score) AS BIGINT) AS sum_score,
    CAST(sum(num_comments) AS BIGINT) AS sum_num_comments, avg(score) AS avg_score,
    avg(num_comments) AS avg_comments_per_post
  FROM silver_posts GROUP BY ALL)
"""
COMMENT_WEEKS = """
comment_weeks AS (
  SELECT week, subreddit, count(*) AS total_comments_extracted, avg(score) AS avg_comment_score,
    count(DISTINCT author) AS unique_commenters
  FROM silver_comments GROUP BY ALL)
"""
WEEKS = """
weeks AS (
  SELECT week AS week_start, subreddit, post_count, sum_score, sum_num_comments, avg_score,
    avg_comments_per_post, total_comments_extracted, avg_comment_score, unique_commenters
  FROM post_weeks LEFT JOIN comment_weeks USING (week, subreddit))
"""
COMMENTERS = """
commenters AS (
  SELECT subreddit, author, count(*) AS comment_count, CAST(sum(score) AS BIGINT) AS total_score,
    avg(score) AS avg_score, count(DISTINCT post_id) AS posts_commented
  FROM silver_comments GROUP BY ALL)
"""
POSTS = [BRONZE_POSTS, SILVER_POSTS]
COMMENTS = [BRONZE_COMMENTS, SILVER_COMMENTS]
GOLD = [*POSTS, *COMMENTS, POST_WEEKS, COMMENT_WEEKS, WEEKS]

RUN = (
    f"CASE WHEN CAST(ts AS DATE) <= '{RUNS[0]}' THEN '{RUNS[0]}' "
    f"WHEN CAST(ts AS DATE) <= '{RUNS[1]}' THEN '{RUNS[1]}' ELSE '{RUNS[2]}' END"
)
SNAPSHOT_POSTS = f"""
snapshot_posts AS (
  SELECT event_type AS community, {RUN} AS ingest_date,
    'raw_' || strftime(ts, '%Y-%m-%d') || 'T00_00_00.json' AS file_name,
    strftime(ts, '%Y-%m-%d') AS snapshot_at, event_id AS position, 'e' || user_id AS id,
    event_type AS subreddit, props AS title,
    CASE WHEN value < 1 THEN '[deleted]' ELSE 'u' || user_id END AS author,
    CAST(trunc(value) AS BIGINT) AS score, CAST(json_extract(props, '$.k') AS BIGINT) AS num_comments,
    epoch(ts) AS created_utc, ts,
    CASE WHEN value < 5 THEN '' WHEN value < 15 THEN NULL ELSE 'f' || user_id END AS flair
  FROM events)
"""
SNAPSHOT_COMMENTS = f"""
snapshot_comments AS (
  SELECT event_type AS community, {RUN} AS ingest_date,
    'comments_' || strftime(ts, '%Y-%m-%d') || 'T00_00_00.json' AS file_name,
    strftime(ts, '%Y-%m-%d') AS snapshot_at, event_id AS position,
    'c' || user_id || '-' || CAST(json_extract(props, '$.k') AS BIGINT) AS id,
    CASE WHEN value >= 2 THEN 'e' || user_id END AS post_id,
    CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) > 0
         THEN 'u' || CAST(json_extract(props, '$.k') AS BIGINT) ELSE '' END AS author,
    props AS body, CAST(trunc(value) AS BIGINT) AS score,
    CAST(trunc(value / 50) AS BIGINT) AS depth, epoch(ts) AS created_utc
  FROM events)
"""
LATEST = """
latest AS (
  SELECT * FROM snapshot_posts QUALIFY row_number() OVER (
    PARTITION BY community, ingest_date, id ORDER BY file_name DESC, position DESC) = 1)
"""
LATEST_COMMENTS = """
latest_comments AS (
  SELECT * FROM snapshot_comments QUALIFY row_number() OVER (
    PARTITION BY community, ingest_date, id ORDER BY file_name DESC, position DESC) = 1)
"""
SNAPSHOTS = [SNAPSHOT_POSTS, LATEST]
COMMENT_SNAPSHOTS = [SNAPSHOT_COMMENTS, LATEST_COMMENTS]
FILES = """
files AS (
  SELECT community, ingest_date, count(DISTINCT file_name) AS snapshots
  FROM snapshot_posts GROUP BY ALL),
comment_files AS (
  SELECT community, ingest_date, count(DISTINCT file_name) AS comment_snapshots
  FROM snapshot_comments GROUP BY ALL)
"""
# Within one file of a run only the last event of a user is written.
WRITTEN = """
written AS (
  SELECT * FROM snapshot_posts QUALIFY row_number() OVER (
    PARTITION BY community, ingest_date, id ORDER BY position DESC) = 1)
"""
ISO = """CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00')
     ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END"""

INSIGHT_EVENTS = f"""
insight_events AS (
  SELECT 'c' || user_id AS subreddit, {_case("event_type", KINDS)} AS insight_type,
    'item' || CAST(json_extract(props, '$.k') AS BIGINT) AS item_name,
    CAST(trunc(value) AS INTEGER) AS mentions, props AS context, ts AS generated_at,
    CAST(ts AS DATE) AS execution_date, 'm1' AS model_version, event_id
  FROM events)
"""
INSIGHTS = """
insights AS (
  SELECT * FROM insight_events QUALIFY row_number() OVER (
    PARTITION BY subreddit, insight_type, item_name, execution_date ORDER BY event_id DESC) = 1)
"""
ALL_INSIGHTS = [INSIGHT_EVENTS, INSIGHTS]
LATEST_RUN = "latest_run AS (SELECT * FROM insights WHERE execution_date = (SELECT max(execution_date) FROM insights))"
STAMP = "'%Y-%m-%d %H:%M:%S'"

# --- sources and sinks ---

ORACLES["post_snapshots_read"] = _with(SNAPSHOT_POSTS, WRITTEN) + f"""
SELECT community, ingest_date, ingest_date AS file_day, ingest_date || 'T06:00:00' AS snapshot_at, id,
  subreddit, title, author, score, num_comments, created_utc, {ISO} AS created_date, flair
FROM written"""

ORACLES["comment_snapshots_read"] = _with(SNAPSHOT_COMMENTS) + """
SELECT community, ingest_date, 'c' || position AS id, post_id, community AS subreddit, author, body,
  score, depth, created_utc
FROM snapshot_comments"""

ORACLES["snapshot_lineage"] = _with(SNAPSHOT_POSTS, WRITTEN) + """
SELECT ingest_date AS _ingest_date, count(*) AS rows, count(*) AS from_post_files, count(*) AS loaded,
  CAST(1 AS BIGINT) AS load_times
FROM written GROUP BY ingest_date"""

ORACLES["snapshot_counts_with_corrupt_file"] = _with(*SNAPSHOTS) + f"""
SELECT community, ingest_date, 
  CAST(CASE WHEN community = 'click' AND ingest_date = '{RUNS[0]}' THEN 2 ELSE 1 END AS BIGINT) AS snapshots,
  count(*) AS posts
FROM latest GROUP BY ALL"""

_SPLIT = """
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY community, ingest_date ORDER BY position, id) - 1) // 20 AS part,
    count(*) OVER (PARTITION BY community, ingest_date) AS total
  FROM latest)
"""
ORACLES["split_snapshot_envelopes"] = _with(*SNAPSHOTS, _SPLIT) + """
SELECT community, ingest_date, CAST(part AS INT) AS part, CAST(ceil(any_value(total) / 20) AS INT) AS parts,
  any_value(total) AS count, count(*) AS items
FROM placed GROUP BY community, ingest_date, part"""

ORACLES["latest_files_of_split_snapshots"] = _with(*SNAPSHOTS) + """
SELECT community, ingest_date, id, score FROM latest
QUALIFY ingest_date = max(ingest_date) OVER (PARTITION BY community)"""

ORACLES["last_snapshot_times"] = _with(SNAPSHOT_POSTS) + """
SELECT DISTINCT community, ingest_date, ingest_date || 'T06:00:00' AS last_snapshot_at FROM snapshot_posts"""

ORACLES["daily_snapshot_overwrite"] = _with(*SNAPSHOTS) + f"""
SELECT community, ingest_date, id,
  CASE WHEN community = 'click' AND ingest_date = '{RUNS[1]}' THEN -1 ELSE score END AS score
FROM latest"""

ORACLES["object_key_checks"] = """
WITH keys AS (
  SELECT event_id, event_type, CASE event_type
    WHEN 'view' THEN 'reddit/view/date=' || strftime(ts, '%Y-%m-%d') || '/raw_' || event_id || '.json'
    WHEN 'click' THEN 'reddit/click/date=' || strftime(ts, '%Y-%m-%d') || '/comments_' || event_id || '.json'
    WHEN 'error' THEN 'reddit/error/' || strftime(ts, '%Y-%m-%d') || '/raw_' || event_id || '.json'
    ELSE 'reddit/a b/date=' || strftime(ts, '%Y-%m-%d') || '/raw_' || event_id || '.csv' END AS path
  FROM events)
SELECT event_id, path, event_type IN ('view', 'error') AS is_post, event_type = 'click' AS is_comment,
  event_type IN ('view', 'click') AS is_valid
FROM keys"""

ORACLES["path_columns"] = """
SELECT event_id, event_type AS community, strftime(ts, '%Y-%m-%d') AS ingest_date,
  'raw_' || user_id || '.json' AS file_name
FROM events WHERE event_type <> 'error'"""

ORACLES["latest_file_per_community"] = _with(SNAPSHOT_POSTS) + """
SELECT community, max('reddit/' || community || '/date=' || ingest_date || '/' || file_name) AS path
FROM snapshot_posts GROUP BY community"""

_EMPTY_POST = """CAST(NULL AS VARCHAR) AS subreddit, CAST(NULL AS VARCHAR) AS title, '' AS selftext,
  CAST(NULL AS VARCHAR) AS author, CAST(0 AS BIGINT) AS score, CAST(0 AS DOUBLE) AS upvote_ratio,
  CAST(0 AS BIGINT) AS num_comments, CAST(0 AS DOUBLE) AS created_utc,
  CAST(NULL AS VARCHAR) AS created_date, CAST(NULL AS VARCHAR) AS flair, TRUE AS is_self"""

ORACLES["post_listing_parsed"] = _with(BRONZE_POSTS) + f"""
SELECT CAST(id AS BIGINT) AS page, 0 AS position, id, subreddit, title, selftext, author,
  coalesce(score, 0) AS score, coalesce(upvote_ratio, 0) AS upvote_ratio, num_comments, created_utc,
  created_date, flair, coalesce(is_self, TRUE) AS is_self
FROM bronze_posts
UNION ALL SELECT CAST(id AS BIGINT), 1, id, {_EMPTY_POST} FROM bronze_posts
UNION ALL SELECT CAST(id AS BIGINT), 2, NULL, {_EMPTY_POST} FROM bronze_posts"""

ORACLES["post_listing_first_occurrence"] = _with(BRONZE_POSTS) + """
SELECT id, 0 AS position, title, coalesce(score, 0) AS score, flair FROM bronze_posts"""

ORACLES["comment_tree_flattened"] = """
WITH lines AS (
  SELECT doc_id, source, n_chars, unnest(string_split(text, chr(10))) AS body,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n
  FROM documents)
SELECT doc_id || '-' || n AS id, CAST(doc_id AS VARCHAR) AS post_id,
  CASE WHEN n % 3 = 0 THEN CAST(doc_id AS VARCHAR) ELSE doc_id || '-' || (n - 1) END AS parent_id,
  source AS author, body, CAST(length(body) AS BIGINT) AS score, n % 3 AS depth,
  CASE WHEN n_chars <> 0 THEN strftime(make_timestamp(n_chars * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') END
    AS created_date
FROM lines"""

ORACLES["deep_comment_tree_flattened"] = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS body,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n
  FROM documents)
SELECT doc_id || '-' || n AS id, CAST(doc_id AS VARCHAR) AS post_id, body, n AS depth, CAST(n + 1 AS INT) AS path_length
FROM lines"""

ORACLES["insight_table_check"] = _with(*ALL_INSIGHTS) + """
SELECT count(*) AS total_insights, count(DISTINCT subreddit) AS total_subreddits,
  count(DISTINCT insight_type) AS total_types, CAST(max(execution_date) AS VARCHAR) AS latest_execution
FROM insights"""

# --- Bronze, Silver, Gold ---

ORACLES["bronze_comments_deduplicated"] = _with(BRONZE_COMMENTS) + """
SELECT id, day AS _ingest_date, post_id, author, body, score, position FROM bronze_comments
QUALIFY row_number() OVER (PARTITION BY id, day
  ORDER BY position DESC, author DESC, body DESC NULLS LAST, score DESC) = 1"""

ORACLES["silver_posts"] = _with(*POSTS) + "SELECT * EXCLUDE (week, o_custkey) FROM silver_posts"

ORACLES["silver_posts_strict_authors"] = _with(*POSTS) + f"""
SELECT id, author, score, is_self, '{AS_OF}' AS ingest_date FROM silver_posts WHERE author <> '[removed]'"""

ORACLES["silver_comments"] = _with(*COMMENTS) + "SELECT * EXCLUDE (week) FROM silver_comments"

ORACLES["weekly_post_metrics"] = _with(*POSTS, POST_WEEKS) + "SELECT * FROM post_weeks"

ORACLES["weekly_comment_metrics"] = _with(*COMMENTS, COMMENT_WEEKS) + "SELECT * FROM comment_weeks"

ORACLES["gold_subreddit_week"] = _with(*GOLD) + "SELECT * FROM weeks"

ORACLES["gold_subreddit_week_zero_filled"] = _with(*GOLD) + """
SELECT week_start, subreddit, post_count, coalesce(total_comments_extracted, 0) AS total_comments_extracted,
  coalesce(avg_comment_score, 0.0) AS avg_comment_score, coalesce(unique_commenters, 0) AS unique_commenters
FROM weeks"""

ORACLES["gold_subreddit_week_posts_only"] = _with(*POSTS, POST_WEEKS) + """
SELECT * EXCLUDE (week), week AS week_start, CAST(0 AS BIGINT) AS total_comments_extracted,
  CAST(0 AS DOUBLE) AS avg_comment_score, CAST(0 AS BIGINT) AS unique_commenters
FROM post_weeks"""

ORACLES["gold_top_commenters"] = _with(*COMMENTS, COMMENTERS) + "SELECT * FROM commenters"

ORACLES["gold_summary"] = _with(*GOLD) + """
SELECT count(DISTINCT subreddit) AS unique_subreddits, CAST(sum(post_count) AS BIGINT) AS total_posts,
  round(avg(avg_score), 1) AS avg_score, CAST(sum(total_comments_extracted) AS BIGINT) AS total_comments,
  CAST(sum(unique_commenters) AS BIGINT) AS total_unique_commenters
FROM weeks"""

ORACLES["gold_exact_summary"] = _with(*POSTS, *COMMENTS) + """
SELECT p.subreddit, total_posts, avg_score, coalesce(total_comments, 0) AS total_comments,
  coalesce(total_unique_commenters, 0) AS total_unique_commenters
FROM (SELECT subreddit, count(*) AS total_posts, round(avg(score), 1) AS avg_score
      FROM silver_posts GROUP BY 1) p
LEFT JOIN (SELECT subreddit, count(*) AS total_comments, count(DISTINCT author) AS total_unique_commenters
      FROM silver_comments GROUP BY 1) c ON p.subreddit = c.subreddit"""

# --- deduplication over snapshots ---

ORACLES["latest_snapshot_version"] = _with(*SNAPSHOTS) + """
SELECT community, ingest_date, id, file_name, position, score, title FROM latest"""

ORACLES["latest_version_across_communities"] = _with(SNAPSHOT_POSTS) + """
SELECT id, community, ingest_date, position, score FROM snapshot_posts
QUALIFY row_number() OVER (PARTITION BY id
  ORDER BY community DESC, ingest_date DESC, file_name DESC, position DESC) = 1"""

ORACLES["latest_version_by_time"] = _with(SNAPSHOT_POSTS) + """
SELECT id, community, snapshot_at, position, score FROM snapshot_posts
QUALIFY row_number() OVER (PARTITION BY id
  ORDER BY snapshot_at DESC, community DESC, ingest_date DESC, file_name DESC, position DESC) = 1"""

# --- merge ---

HALVES = f"""
states AS (
  SELECT user_id, event_id, CAST(trunc(value) AS BIGINT) AS score, strftime(ts, '%Y-%m-%d') AS day,
    strftime(ts, {STAMP}) AS computed_at
  FROM events),
before AS (SELECT * FROM states WHERE day < '{SPLIT}'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
after AS (SELECT * FROM states WHERE day >= '{SPLIT}'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
"""

ORACLES["merge_insert_only"] = """
WITH days AS (
  SELECT user_id, event_id, CAST(trunc(value) AS BIGINT) AS score, strftime(ts, '%Y-%m-%d') AS day, event_type
  FROM events),
known AS (SELECT * FROM days WHERE event_type = 'view'
  QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY event_id) = 1)
SELECT * FROM known
UNION ALL
SELECT * FROM (SELECT * FROM days
  QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY event_id DESC) = 1) batch
WHERE NOT EXISTS (SELECT 1 FROM known WHERE known.user_id = batch.user_id AND known.day = batch.day)"""

_LATER_HALF = """
SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.event_id, b.event_id) AS event_id,
  coalesce(a.score, b.score) AS score, coalesce(a.day, b.day) AS day
FROM before b FULL OUTER JOIN after a ON a.user_id = b.user_id"""

ORACLES["merge_guarded_update"] = _with(HALVES) + _LATER_HALF

ORACLES["merge_file_order_guard"] = _with(HALVES) + _LATER_HALF

ORACLES["merge_newer_wins"] = _with(HALVES) + """
SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.event_id, b.event_id) AS event_id,
  coalesce(a.score, b.score) AS score, coalesce(a.day, b.day) AS day,
  coalesce(a.computed_at, CASE WHEN b.score >= 10 THEN b.computed_at END) AS computed_at
FROM before b FULL OUTER JOIN after a ON a.user_id = b.user_id"""

ORACLES["merge_insights"] = _with(INSIGHT_EVENTS) + f"""
, halved AS (
  SELECT * REPLACE (CASE WHEN execution_date < '{SPLIT}' THEN '2024-01-01' ELSE '2024-01-16' END AS execution_date),
    execution_date AS real_date
  FROM insight_events),
old AS (SELECT * FROM halved WHERE real_date < '2024-01-21' QUALIFY row_number() OVER (
  PARTITION BY subreddit, insight_type, item_name, execution_date ORDER BY event_id DESC) = 1),
new AS (SELECT * FROM halved WHERE real_date >= '{SPLIT}' QUALIFY row_number() OVER (
  PARTITION BY subreddit, insight_type, item_name, execution_date ORDER BY event_id DESC) = 1)
SELECT subreddit, insight_type, item_name, coalesce(n.mentions, o.mentions) AS mentions,
  coalesce(n.context, o.context) AS context,
  strftime(coalesce(n.generated_at, o.generated_at), {STAMP}) AS generated_at, execution_date,
  CASE WHEN n.event_id IS NULL THEN 'm1' ELSE 'm2' END AS model_version
FROM old o FULL OUTER JOIN new n USING (subreddit, insight_type, item_name, execution_date)"""

ORACLES["stored_insights"] = _with(INSIGHT_EVENTS) + f"""
, placed AS (
  SELECT *, row_number() OVER (PARTITION BY subreddit, insight_type, item_name, execution_date ORDER BY event_id) AS nth,
    row_number() OVER (PARTITION BY subreddit, insight_type, item_name, execution_date ORDER BY event_id DESC) AS back
  FROM insight_events)
SELECT subreddit, insight_type, item_name, mentions, strftime(generated_at, {STAMP}) AS generated_at,
  CAST(execution_date AS VARCHAR) AS execution_date, CASE WHEN execution_date < '{SPLIT}' THEN 'm1' ELSE 'm2' END AS model_version
FROM placed WHERE CASE WHEN execution_date < '{SPLIT}' THEN nth ELSE back END = 1"""

ORACLES["merge_into_partitioned_table"] = _with(HALVES) + """
SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.event_id, b.event_id) AS event_id,
  coalesce(a.score, b.score) AS score, coalesce(a.day, b.day) AS day, coalesce(b.day, a.day) AS stored_day
FROM before b FULL OUTER JOIN after a ON a.user_id = b.user_id"""

# --- state between runs ---

ORACLES["unseen_posts"] = f"""
WITH posts AS (
  SELECT event_type AS subreddit, user_id || '-' || CAST(json_extract(props, '$.k') AS BIGINT) AS id,
    strftime(ts, '%Y-%m-%d') AS day
  FROM events)
SELECT subreddit, id FROM posts WHERE day >= '{SPLIT}'
EXCEPT SELECT subreddit, id FROM posts WHERE day < '{SPLIT}'"""

_RUN_IDS = f"""
current_ids AS (SELECT DISTINCT subreddit, id FROM snapshot_posts WHERE ingest_date = '{RUNS[2]}'),
seen AS (SELECT DISTINCT subreddit, id FROM snapshot_posts
  WHERE CAST(substring(id, 2) AS BIGINT) % 5 <> 0 OR subreddit IN ('signup', 'error')),
news AS (SELECT DISTINCT subreddit FROM (SELECT * FROM current_ids EXCEPT SELECT * FROM seen))
"""

ORACLES["snapshots_worth_saving"] = _with(SNAPSHOT_POSTS, _RUN_IDS) + """
SELECT subreddit, id FROM current_ids WHERE subreddit IN (SELECT subreddit FROM news)"""

ORACLES["next_seen_ids"] = _with(SNAPSHOT_POSTS, _RUN_IDS) + """
SELECT subreddit, id FROM current_ids WHERE subreddit IN (SELECT subreddit FROM news)
UNION ALL SELECT subreddit, id FROM seen WHERE subreddit NOT IN (SELECT subreddit FROM news)"""

_CANDIDATES = f"""
current_posts AS (SELECT * FROM snapshot_posts QUALIFY row_number() OVER (
  PARTITION BY community, id ORDER BY file_name DESC, position DESC) = 1),
cache AS (SELECT id AS post_id, num_comments AS cached FROM snapshot_posts WHERE ingest_date = '{RUNS[0]}'
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY position DESC) = 1),
places AS (SELECT *, score + 2 * num_comments AS engagement,
    row_number() OVER (PARTITION BY subreddit ORDER BY score + 2 * num_comments DESC, id) AS place
  FROM current_posts WHERE num_comments >= 5),
candidates AS (SELECT places.*, cached, coalesce(cached, -1) <> num_comments AS changed
  FROM places LEFT JOIN cache ON id = post_id WHERE place <= 50)
"""

ORACLES["posts_needing_comments"] = _with(SNAPSHOT_POSTS, _CANDIDATES) + """
SELECT subreddit, id, engagement, CAST(place AS INTEGER) AS place, cached, changed FROM candidates"""

ORACLES["comment_fetch_stats"] = _with(SNAPSHOT_POSTS, _CANDIDATES) + """
SELECT subreddit, count(*) AS total_eligible, count(*) FILTER (NOT changed) AS skipped_cache,
  count(*) FILTER (changed) AS to_fetch
FROM candidates GROUP BY subreddit"""

ORACLES["next_comment_counts"] = _with(SNAPSHOT_POSTS, _CANDIDATES) + """
, fetched AS (SELECT id, num_comments FROM candidates WHERE changed AND subreddit = 'view')
SELECT coalesce(post_id, id) AS post_id, coalesce(num_comments, cached) AS num_comments
FROM cache FULL OUTER JOIN fetched ON post_id = id"""

_CUSTOMERS = """
sizes AS (SELECT 'c' || o_custkey AS subreddit, count(*) AS posts FROM bronze_posts GROUP BY 1 HAVING count(*) >= 3)
"""

ORACLES["communities_needing_insights"] = _with(BRONZE_POSTS, *ALL_INSIGHTS, _CUSTOMERS) + """
SELECT * FROM sizes WHERE subreddit NOT IN (SELECT subreddit FROM insights)"""

ORACLES["communities_quota"] = _with(BRONZE_POSTS, *ALL_INSIGHTS, _CUSTOMERS) + """
SELECT * FROM (SELECT * FROM sizes ORDER BY posts DESC, subreddit LIMIT 100)
WHERE subreddit NOT IN (SELECT subreddit FROM insights)"""

# --- quality ---

_QUALITY = """
checked AS (
  SELECT community, ingest_date, score,
    CASE WHEN score % 2 = 0 THEN subreddit ELSE subreddit || '2' END AS subreddit,
    NOT (community <> 'error' AND score < 50) AS invalid
  FROM snapshot_posts)
"""

ORACLES["quality_profile"] = _with(SNAPSHOT_POSTS, _QUALITY) + """
SELECT community, ingest_date, count(*) AS posts, count(*) FILTER (invalid) AS invalid,
  avg(score) AS avg_score, max(score) AS max_score, count(DISTINCT subreddit) AS communities
FROM checked GROUP BY community, ingest_date"""

ORACLES["quality_communities_found"] = _with(SNAPSHOT_POSTS, _QUALITY) + """
SELECT DISTINCT community, subreddit FROM checked"""

ORACLES["quality_strict_gate_failures"] = _with(SNAPSHOT_POSTS, _QUALITY) + """
SELECT community, ingest_date, count(*) AS posts, count(*) FILTER (invalid) AS invalid FROM checked
GROUP BY community, ingest_date HAVING count(*) FILTER (invalid) > count(*) * 0.5"""

ORACLES["quality_strict_gate_passed"] = _with(SNAPSHOT_POSTS, _QUALITY) + """
SELECT community, ingest_date, count(*) AS posts FROM checked WHERE NOT invalid GROUP BY ALL"""

ORACLES["quality_lenient_gate"] = _with(SNAPSHOT_POSTS, _QUALITY) + """
SELECT community, count(*) AS posts, count(*) FILTER (invalid) AS invalid FROM checked
GROUP BY community HAVING count(*) FILTER (invalid) <= count(*) * 0.5"""

# --- text ---


def _tools(aliases: dict[str, str]) -> str:
    """Whole words by splitting; a two-word alias is a word followed by the other."""
    pairs = ", ".join(f"('{alias}', '{name}')" for alias, name in aliases.items())
    return f"""
aliases(alias, tool) AS (VALUES {pairs}),
words AS (
  SELECT doc_id, w AS word, lead(w) OVER (PARTITION BY doc_id ORDER BY n) AS following FROM (
    SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS n FROM (
      SELECT doc_id, regexp_split_to_array(lower(source || ' ' || text), '[^\\p{{L}}\\p{{N}}\\p{{M}}\\p{{Pc}}]+') AS ws
      FROM documents))),
mentions AS (
  SELECT DISTINCT doc_id, tool FROM words
  JOIN aliases ON alias = word OR alias = word || ' ' || following),
listed AS (SELECT doc_id, string_agg(tool, '|' ORDER BY tool) AS tools, CAST(count(*) AS INTEGER) AS n
  FROM mentions GROUP BY doc_id)
"""


ORACLES["word_mentions"] = _with(_tools(WORDS)) + """
SELECT CAST(d.doc_id AS VARCHAR) AS id, coalesce(tools, '') AS tools, coalesce(n, 0) AS tools_count,
  substring(text, 1, 500) AS selftext_clean
FROM documents d LEFT JOIN listed USING (doc_id)"""

ORACLES["tool_mentions_in_documents"] = _with(_tools(TOOL_ALIASES)) + """
SELECT CAST(d.doc_id AS VARCHAR) AS id, coalesce(tools, '') AS tools, coalesce(n, 0) AS tools_count
FROM documents d LEFT JOIN listed USING (doc_id)"""

_ALIASED = f"""
said AS (
  SELECT doc_id, source, text || CASE doc_id % 3
    WHEN 0 THEN ' Nothing' || a[doc_id % {len(TOOL_ALIASES)} + 1] || 'ish here'
    WHEN 1 THEN ' Tried ' || upper(a[doc_id % {len(TOOL_ALIASES)} + 1]) || ', then ' || a[doc_id * 3 % {len(TOOL_ALIASES)} + 1] || '!'
    ELSE ' (' || a[doc_id % {len(TOOL_ALIASES)} + 1] || ') or ' || a[doc_id * 5 % {len(TOOL_ALIASES)} + 1] || '; '
      || a[doc_id % {len(TOOL_ALIASES)} + 1] || '.' END AS text
  FROM documents, (SELECT [{', '.join(f"'{alias}'" for alias in TOOL_ALIASES)}] AS a))
"""
ORACLES["tool_aliases_in_documents"] = _with(_ALIASED, _tools(TOOL_ALIASES).replace("FROM documents", "FROM said")) + """
SELECT CAST(d.doc_id AS VARCHAR) AS id, coalesce(tools, '') AS tools, coalesce(n, 0) AS tools_count
FROM documents d LEFT JOIN listed USING (doc_id)"""

ORACLES["tool_rankings"] = _with(_tools(WORDS)) + """
SELECT tool, count(*) AS mentions, CAST(sum(n_chars) AS BIGINT) AS total_score,
  round(avg(n_chars), 1) AS avg_score
FROM mentions JOIN documents USING (doc_id) GROUP BY tool ORDER BY mentions DESC, tool LIMIT 15"""

ORACLES["subreddit_rankings"] = """
SELECT lang AS subreddit, count(*) AS posts, CAST(sum(n_chars) AS BIGINT) AS total_score,
  round(avg(n_chars), 1) AS avg_score
FROM documents GROUP BY lang ORDER BY posts DESC, lang LIMIT 10"""

ORACLES["fallback_summary"] = _with(_tools(WORDS)) + """
SELECT count(*) AS total_posts, (SELECT count(DISTINCT tool) FROM mentions) AS unique_tools,
  count(DISTINCT lang) AS unique_subreddits, round(avg(n_chars), 1) AS avg_score,
  (SELECT count(DISTINCT doc_id) FROM mentions) AS posts_with_tools
FROM documents"""

ORACLES["fallback_report"] = _with(_tools(WORDS)) + """
, tools AS (
  SELECT 'tools' AS section, tool AS name, count(*) AS posts, CAST(sum(n_chars) AS BIGINT) AS total_score, round(avg(n_chars), 1) AS avg_score,
    row_number() OVER (ORDER BY count(*) DESC, tool) AS place
  FROM mentions JOIN documents USING (doc_id) GROUP BY tool),
communities AS (
  SELECT 'communities' AS section, lang AS name, count(*) AS posts, CAST(sum(n_chars) AS BIGINT) AS total_score, round(avg(n_chars), 1) AS avg_score,
    row_number() OVER (ORDER BY count(*) DESC, lang) AS place
  FROM documents GROUP BY lang)
SELECT section, CAST(place AS INTEGER) AS place, name, posts, total_score, avg_score, CAST(NULL AS BIGINT) AS posts_with_tools,
  CAST(NULL AS BIGINT) AS unique_tools, CAST(NULL AS BIGINT) AS unique_subreddits
FROM (SELECT * FROM tools WHERE place <= 15 UNION ALL SELECT * FROM communities WHERE place <= 10)
UNION ALL SELECT 'totals', 1, NULL, count(*), CAST(sum(n_chars) AS BIGINT), round(avg(n_chars), 1),
  (SELECT count(DISTINCT doc_id) FROM mentions), (SELECT count(DISTINCT tool) FROM mentions), count(DISTINCT lang)
FROM documents"""

ORACLES["fallback_silver_posts"] = _with(BRONZE_POSTS) + """
SELECT id, subreddit, title, selftext AS selftext_clean, author, coalesce(score, 0) AS score, num_comments,
  0 AS tools_count
FROM bronze_posts WHERE title IS NOT NULL AND author NOT IN ('[deleted]', '[removed]')"""

ORACLES["text_functions"] = """
SELECT doc_id, CASE WHEN length(text) > 280 THEN substring(text, 1, 280) || '…' ELSE text END AS shown,
  source || CASE WHEN length(text) > 0 THEN ' | ' || substring(text, 1, 150) ELSE '' END AS snippet,
  source || '_x' AS stripped, source AS unprefixed,
  CASE WHEN lang = 'en' THEN NULL ELSE '' END AS emptied,
  regexp_full_match(source, '[a-zA-Z0-9_]+') AS valid_name,
  regexp_full_match(text, '[a-zA-Z0-9_]+') AS valid_text,
  CASE WHEN lang = 'de' THEN 'none' ELSE source END AS defaulted,
  CASE WHEN lang = 'fr' THEN source ELSE '' END || ' ' || CASE WHEN lang <> 'es' THEN lang ELSE '' END AS joined
FROM documents"""

ORACLES["date_functions"] = f"""
SELECT event_id, strftime(date_trunc('week', ts), '%Y-%m-%d') AS week,
  CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') END AS iso,
  strftime(ts, '%Y-%m-%dT%H_%M_%S') AS stamp, strftime(ts, {STAMP}) AS parsed,
  DATE '{AS_OF}' - CAST(ts AS DATE) AS age
FROM events"""

ORACLES["number_functions"] = """
SELECT event_id, CASE WHEN event_type <> 'error' THEN event_id END AS whole,
  CASE WHEN event_type <> 'error' THEN event_id END AS cut,
  CASE WHEN event_type <> 'error' THEN event_id + 0.5::DOUBLE END AS double,
  (event_id + 19) // 20 AS pages
FROM events"""


def _context(posts: int, comments: int, chars: int, selftext: int, body: int) -> str:
    return f"""
picked AS (
  SELECT lang AS subreddit, 0 AS kind, row_number() OVER (PARTITION BY lang
      ORDER BY n_chars DESC, CAST(doc_id AS VARCHAR)) AS place,
    source || CASE WHEN length(text) > 0 THEN ' | ' || substring(text, 1, {selftext}) ELSE '' END AS line
  FROM documents QUALIFY place <= {posts}),
lines AS (
  SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS body,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n
  FROM documents),
said AS (
  SELECT lang AS subreddit, 1 AS kind, row_number() OVER (PARTITION BY lang
      ORDER BY length(body) DESC, doc_id || '-' || n) AS place, body
  FROM lines QUALIFY place <= {comments}),
contexts AS (
  SELECT subreddit, substring(string_agg(line, chr(10) ORDER BY kind, place), 1, {chars}) AS content
  FROM (SELECT * FROM picked
        UNION ALL SELECT subreddit, kind, place, substring(body, 1, {body}) FROM said WHERE body <> '')
  GROUP BY subreddit)
"""


ORACLES["community_context"] = _with(_context(15, 20, 6000, 150, 120)) + """
SELECT * FROM contexts WHERE length(content) >= 100"""

ORACLES["community_context_large"] = _with(_context(80, 120, 12000, 280, 200)) + "SELECT * FROM contexts"

ORACLES["community_default_prompts"] = _with(_context(15, 20, 6000, 150, 120)) + f"""
SELECT subreddit, content, CAST({len(PROMPT.replace('{subreddit}', '').replace('{content}', ''))}
    + {PROMPT.count('{subreddit}')} * length(subreddit) AS BIGINT) AS template_length,
  true AS holds_content, false AS unfilled
FROM contexts"""

ORACLES["community_prompts"] = _with(_context(15, 20, 6000, 150, 120)) + """
SELECT subreddit, 'r/' || subreddit || ' {x}' || chr(10) || content AS prompt FROM contexts"""

# --- insights ---

_ANSWER_ROWS = f"""
SELECT 'c' || user_id AS subreddit, kind AS insight_type,
  'item' || CAST(json_extract(props, '$.k') AS BIGINT) AS item_name,
  CASE WHEN kind = 'solutions' THEN 0 ELSE CAST(trunc(value) AS INTEGER) END AS mentions,
  CASE WHEN kind = 'solutions' THEN '' ELSE props END AS context,
  strftime(ts, {STAMP}) AS generated_at, CAST(CAST(ts AS DATE) AS VARCHAR) AS execution_date,
  'm1' AS model_version
FROM events JOIN (VALUES ('view', 'trending_tools'), ('click', 'trending_tools'), ('click', 'pain_points'),
  ('purchase', 'solutions')) kinds(event_type, kind) USING (event_type)"""

ORACLES["answers_to_insight_rows"] = _ANSWER_ROWS

ORACLES["answer_sizes"] = """
SELECT event_id, CAST(event_type IN ('view', 'click') AS BIGINT) AS trending_tools,
  CAST(event_type = 'click' AS BIGINT) AS pain_points, CAST(event_type = 'purchase' AS BIGINT) AS solutions
FROM events WHERE event_type IN ('view', 'click', 'purchase')"""

ORACLES["latest_insights_of_community"] = _with(*ALL_INSIGHTS, LATEST_RUN) + f"""
SELECT insight_type, item_name, mentions, context, strftime(generated_at, {STAMP}) AS generated_at
FROM latest_run WHERE subreddit = 'c8' ORDER BY insight_type, mentions DESC, item_name"""

ORACLES["latest_insights_of_community_own_run"] = _with(*ALL_INSIGHTS) + f"""
SELECT insight_type, item_name, mentions, context, strftime(generated_at, {STAMP}) AS generated_at
FROM insights WHERE subreddit = 'c8'
  AND execution_date = (SELECT max(execution_date) FROM insights WHERE subreddit = 'c8')
ORDER BY insight_type, mentions DESC, item_name"""

ORACLES["latest_insights_per_community"] = _with(*ALL_INSIGHTS) + """
SELECT subreddit, insight_type, item_name, mentions FROM insights
QUALIFY execution_date = max(execution_date) OVER (PARTITION BY subreddit)"""

ORACLES["top_insight_items"] = _with(*ALL_INSIGHTS, LATEST_RUN) + """
SELECT item_name AS tool, CAST(sum(mentions) AS BIGINT) AS total_mentions,
  count(DISTINCT subreddit) AS communities_count
FROM latest_run WHERE insight_type = 'trending_tools' GROUP BY item_name
ORDER BY total_mentions DESC, tool LIMIT 10"""

ORACLES["recent_pain_points"] = _with(*ALL_INSIGHTS) + f"""
SELECT subreddit, item_name AS pain_point, mentions, context, CAST(execution_date AS VARCHAR) AS execution_date
FROM insights WHERE insight_type = 'pain_points' AND execution_date >= DATE '{AS_OF}' - INTERVAL 7 DAY"""


def _trend(upper: str) -> str:
    return _with(*ALL_INSIGHTS) + f"""
, this_week AS (
  SELECT item_name, sum(mentions) AS n FROM insights
  WHERE insight_type = 'trending_tools' AND execution_date >= DATE '{AS_OF}' - INTERVAL 7 DAY
  GROUP BY item_name),
last_week AS (
  SELECT item_name, sum(mentions) AS n FROM insights
  WHERE insight_type = 'trending_tools' AND execution_date >= DATE '{AS_OF}' - INTERVAL 14 DAY
    AND execution_date {upper} DATE '{AS_OF}' - INTERVAL 7 DAY
  GROUP BY item_name)
SELECT coalesce(t.item_name, l.item_name) AS tool, CAST(coalesce(t.n, 0) AS BIGINT) AS current_week,
  CAST(coalesce(l.n, 0) AS BIGINT) AS previous_week,
  CAST(coalesce(t.n, 0) - coalesce(l.n, 0) AS BIGINT) AS trend
FROM this_week t FULL OUTER JOIN last_week l ON t.item_name = l.item_name
ORDER BY trend DESC, tool LIMIT 20"""


ORACLES["trend_between_weeks"] = _trend("<=")
ORACLES["trend_between_separate_weeks"] = _trend("<")

_CUT = """
cut AS (
  SELECT *, CAST((row_number() OVER (PARTITION BY subreddit ORDER BY insight_type, item_name) - 1) // 3 AS INT) AS part,
    count(*) OVER (PARTITION BY subreddit) AS total,
    CAST(ceil(count(*) OVER (PARTITION BY subreddit) / 3) AS INT) AS parts
  FROM latest_run)
"""
ORACLES["insights_nested"] = _with(*ALL_INSIGHTS, LATEST_RUN, _CUT) + """
SELECT subreddit, part, parts, any_value(total) AS total,
  string_agg(concat_ws(':', insight_type, item_name, mentions, context), '|' ORDER BY insight_type, item_name) AS insights
FROM cut GROUP BY subreddit, part, parts"""

ORACLES["insights_by_kind"] = _with(*ALL_INSIGHTS, LATEST_RUN, _CUT) + """
, kinds AS (
  SELECT subreddit, part, parts, insight_type, string_agg(item_name || ':' || mentions, '|' ORDER BY item_name) AS items
  FROM cut GROUP BY ALL)
SELECT subreddit, part, parts, max(items) FILTER (insight_type = 'trending_tools') AS trending_tools,
  max(items) FILTER (insight_type = 'pain_points') AS pain_points,
  max(items) FILTER (insight_type = 'solutions') AS solutions
FROM kinds GROUP BY subreddit, part, parts"""

ORACLES["insight_counts"] = _with(*ALL_INSIGHTS, LATEST_RUN) + f"""
SELECT subreddit, count(*) AS total_insights, count(*) FILTER (insight_type = 'trending_tools') AS tools_count,
  count(*) FILTER (insight_type = 'pain_points') AS pains_count,
  count(*) FILTER (insight_type = 'solutions') AS solutions_count,
  strftime(max(generated_at), {STAMP}) AS last_updated
FROM latest_run GROUP BY subreddit"""

ORACLES["stale_communities"] = _with(*POSTS, *ALL_INSIGHTS) + f"""
, ages AS (
  SELECT s.subreddit, max(i.execution_date) AS last_date
  FROM (SELECT DISTINCT 'c' || o_custkey AS subreddit FROM silver_posts) s
  LEFT JOIN insights i ON s.subreddit = i.subreddit GROUP BY s.subreddit)
SELECT subreddit, CAST(last_date AS VARCHAR) AS last_insight_date, DATE '{LATER}' - last_date AS days_since_update
FROM ages WHERE last_date IS NULL OR DATE '{LATER}' - last_date > 7"""

# --- served results ---

ORACLES["top_silver_posts"] = _with(*POSTS) + """
SELECT id, subreddit, title, selftext, author, score, upvote_ratio, num_comments, created_date, permalink,
  flair, is_self, ingest_date
FROM silver_posts ORDER BY score DESC, id LIMIT 30"""

ORACLES["top_silver_comments"] = _with(*COMMENTS) + """
SELECT id, post_id, subreddit, author, body, score, depth, created_date
FROM silver_comments ORDER BY score DESC, id LIMIT 50"""

ORACLES["top_gold_weeks"] = _with(*GOLD) + """
SELECT * FROM weeks ORDER BY post_count DESC, week_start, subreddit LIMIT 20"""

ORACLES["top_commenters_served"] = _with(*COMMENTS, COMMENTERS) + """
SELECT * FROM commenters ORDER BY comment_count DESC, subreddit, author LIMIT 20"""

ORACLES["top_commenters_ranked"] = _with(*COMMENTS, COMMENTERS) + """
SELECT CAST(row_number() OVER (ORDER BY total_score DESC, subreddit, author) AS INTEGER) AS rank,
  subreddit, author, total_score
FROM commenters QUALIFY rank <= 20"""

ORACLES["community_posts_by_bound_parameters"] = _with(*POSTS) + """
SELECT id, title, score FROM silver_posts WHERE subreddit = '1-URGENT' ORDER BY score DESC, id LIMIT 15"""

ORACLES["community_catalog"] = _with(*SNAPSHOTS, *COMMENT_SNAPSHOTS, FILES) + """
, days AS (
  SELECT f.community, f.ingest_date, f.snapshots, coalesce(comment_snapshots, 0) AS comment_snapshots,
    (SELECT count(*) FROM latest l WHERE l.community = f.community AND l.ingest_date = f.ingest_date) AS posts,
    (SELECT count(*) FROM latest_comments l WHERE l.community = f.community AND l.ingest_date = f.ingest_date)
      AS comments
  FROM files f LEFT JOIN comment_files USING (community, ingest_date))
SELECT community AS subreddit, string_agg(concat_ws(':', ingest_date, posts, snapshots, comments, comment_snapshots),
  '|' ORDER BY ingest_date) AS dates, CAST(sum(posts) AS BIGINT) AS total_posts
FROM days GROUP BY community"""

ORACLES["posts_page_by_score"] = _with(*SNAPSHOTS) + f"""
SELECT id, score, num_comments, title FROM latest WHERE community = 'click' AND ingest_date = '{RUNS[0]}'
ORDER BY score DESC, id LIMIT 20 OFFSET 20"""

ORACLES["posts_page_by_comments"] = _with(*SNAPSHOTS) + f"""
SELECT id, score, num_comments, title FROM latest WHERE community = 'view' AND ingest_date = '{RUNS[2]}'
ORDER BY num_comments DESC, id LIMIT 30"""

ORACLES["comments_page_by_date"] = _with(*COMMENT_SNAPSHOTS) + f"""
SELECT id, post_id, score, depth, created_utc FROM latest_comments
WHERE community = 'view' AND ingest_date = '{RUNS[1]}' ORDER BY created_utc DESC, id LIMIT 50 OFFSET 100"""

ORACLES["comments_page_of_post"] = _with(*COMMENT_SNAPSHOTS) + f"""
SELECT id, post_id, score, depth FROM latest_comments
WHERE community = 'view' AND ingest_date = '{RUNS[1]}' AND post_id = 'e7' ORDER BY score DESC, id LIMIT 100"""

ORACLES["posts_page_summary"] = _with(*SNAPSHOTS) + f"""
SELECT community, ingest_date, count(*) AS total, (count(*) + 19) // 20 AS pages,
  (SELECT count(DISTINCT file_name) FROM snapshot_posts
   WHERE community = 'click' AND ingest_date = '{RUNS[0]}') AS snapshots
FROM latest WHERE community = 'click' AND ingest_date = '{RUNS[0]}' GROUP BY ALL"""

ORACLES["post_stats"] = _with(*SNAPSHOTS) + """
, numbers AS (
  SELECT community, ingest_date, count(*) AS total, round(avg(score), 1) AS score_avg, max(score) AS score_max,
    min(score) AS score_min, round(avg(num_comments), 1) AS comments_avg,
    CAST(sum(num_comments) AS BIGINT) AS comments_total
  FROM latest GROUP BY ALL),
heads AS (
  SELECT community, ingest_date, count(DISTINCT file_name) AS snapshots, max(snapshot_at) AS last_snapshot_at
  FROM snapshot_posts GROUP BY ALL),
labels AS (
  SELECT * FROM (SELECT community, ingest_date, coalesce(nullif(flair, ''), 'Sem flair') AS label, count(*) AS n
    FROM latest GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY community, ingest_date ORDER BY n DESC, label) <= 10),
flairs AS (
  SELECT community, ingest_date, string_agg(label || ':' || n, '|' ORDER BY n DESC, label) AS flairs
  FROM labels GROUP BY ALL),
best AS (
  SELECT community, ingest_date, string_agg(concat_ws(':', title, score, num_comments, author), '|'
    ORDER BY score DESC, id) AS top_posts
  FROM (SELECT * FROM latest QUALIFY row_number() OVER (
    PARTITION BY community, ingest_date ORDER BY score DESC, id) <= 5) GROUP BY ALL)
SELECT * FROM numbers JOIN heads USING (community, ingest_date) JOIN flairs USING (community, ingest_date)
  JOIN best USING (community, ingest_date)"""

ORACLES["comment_stats"] = _with(*COMMENT_SNAPSHOTS) + """
, numbers AS (
  SELECT community, ingest_date, count(*) AS total,
    count(DISTINCT coalesce(post_id, '(none)')) AS unique_posts_with_comments,
    count(DISTINCT nullif(author, '')) AS unique_authors, round(avg(score), 1) AS score_avg,
    max(score) AS score_max, round(avg(depth), 1) AS avg_depth, max(depth) AS max_depth
  FROM latest_comments GROUP BY ALL),
heads AS (
  SELECT community, ingest_date, count(DISTINCT file_name) AS snapshots, max(snapshot_at) AS last_snapshot_at
  FROM snapshot_comments GROUP BY ALL),
best AS (
  SELECT community, ingest_date, string_agg(concat_ws(':', substring(body, 1, 200), score, author,
    coalesce(post_id, ''), depth), '|' ORDER BY score DESC, id) AS top_comments
  FROM (SELECT * FROM latest_comments QUALIFY row_number() OVER (
    PARTITION BY community, ingest_date ORDER BY score DESC, id) <= 5) GROUP BY ALL)
SELECT * FROM numbers JOIN heads USING (community, ingest_date) JOIN best USING (community, ingest_date)"""

ORACLES["all_posts"] = _with(SNAPSHOT_POSTS) + """
SELECT id, community, score FROM (SELECT * FROM snapshot_posts QUALIFY row_number() OVER (PARTITION BY id
  ORDER BY community DESC, ingest_date DESC, file_name DESC, position DESC) = 1)
ORDER BY score DESC, id LIMIT 500"""

ORACLES["layer_status"] = _with(*GOLD) + """
, best_bronze AS (SELECT * FROM bronze_posts ORDER BY coalesce(score, 0) DESC, id DESC LIMIT 1),
best_silver AS (SELECT * FROM silver_posts ORDER BY score DESC, id DESC LIMIT 1),
best_week AS (SELECT * FROM weeks ORDER BY post_count DESC, week_start DESC, subreddit DESC LIMIT 1)
SELECT 'Bronze' AS layer, count(*) AS records, count(DISTINCT subreddit) AS subreddits,
  (SELECT subreddit FROM best_bronze) AS sample_subreddit, (SELECT id FROM best_bronze) AS sample_key
FROM bronze_posts
UNION ALL SELECT 'Silver', count(*), count(DISTINCT subreddit), (SELECT subreddit FROM best_silver),
  (SELECT id FROM best_silver) FROM silver_posts
UNION ALL SELECT 'Gold', CAST(sum(post_count) AS BIGINT), count(DISTINCT subreddit),
  (SELECT subreddit FROM best_week), (SELECT week_start FROM best_week) FROM weeks"""

ORACLES["published_posts"] = _with(*POSTS) + """
SELECT id, score, CAST(0 AS BIGINT) AS tools_count, (SELECT count(*) FROM silver_posts) AS total_posts
FROM silver_posts ORDER BY score DESC, id LIMIT 50"""

ORACLES["published_rankings"] = _with(*POSTS, POST_WEEKS) + """
SELECT subreddit, post_count AS posts, sum_score AS total_score, round(avg_score, 1) AS avg_score
FROM post_weeks ORDER BY post_count DESC, week, subreddit LIMIT 30"""

ORACLES["published_insights"] = _with(*ALL_INSIGHTS, LATEST_RUN) + """
, kinds AS (
  SELECT subreddit, insight_type, string_agg(item_name || ':' || mentions, '|' ORDER BY item_name) AS items
  FROM latest_run GROUP BY ALL)
SELECT subreddit, max(items) FILTER (insight_type = 'trending_tools') AS trending_tools,
  max(items) FILTER (insight_type = 'pain_points') AS pain_points,
  max(items) FILTER (insight_type = 'solutions') AS solutions
FROM kinds GROUP BY subreddit"""

ORACLES["status_with_fallback"] = _with(BRONZE_POSTS) + """
, known AS (SELECT * FROM bronze_posts WHERE title IS NOT NULL AND author NOT IN ('[deleted]', '[removed]'))
SELECT 'Bronze' AS layer, 'active' AS mode, count(*) AS records, count(DISTINCT subreddit) AS subreddits FROM bronze_posts
UNION ALL SELECT 'Silver', 'fallback', count(*), count(DISTINCT subreddit) FROM known
UNION ALL SELECT 'Gold', 'fallback', count(*), count(DISTINCT subreddit) FROM known"""

ORACLES["published_layers"] = _with(*POSTS) + """
SELECT 'Bronze' AS name, 'active' AS status, count(*) AS records FROM silver_posts
UNION ALL SELECT 'Silver', 'active', count(*) FROM silver_posts
UNION ALL SELECT 'Gold', 'active', count(*) FROM silver_posts"""

# --- streams ---

_STREAMED = """
streamed AS (
  SELECT * FROM written WHERE author <> '[deleted]'
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingest_date DESC, community DESC) = 1),
said AS (
  SELECT strftime(date_trunc('week', to_timestamp(created_utc) AT TIME ZONE 'UTC'), '%Y-%m-%d') AS week_start,
    community AS subreddit, author, score
  FROM snapshot_comments WHERE author <> '[deleted]')
"""

ORACLES["medallion_of_one_batch"] = _with(*SNAPSHOTS) + """
SELECT ingest_date AS _ingest_date, count(DISTINCT id) AS posts FROM latest GROUP BY ALL"""

ORACLES["batch_scope_gold_weeks"] = _with(*SNAPSHOTS) + """
, clean AS (
  SELECT * FROM latest WHERE author <> '[deleted]' AND title IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY ingest_date, id ORDER BY community DESC, file_name DESC, position DESC) = 1),
weeks AS (
  SELECT strftime(date_trunc('week', to_timestamp(created_utc) AT TIME ZONE 'UTC'), '%Y-%m-%d') AS week_start, subreddit, count(*) AS post_count,
    CAST(sum(score) AS BIGINT) AS sum_score, CAST(sum(num_comments) AS BIGINT) AS sum_num_comments,
    avg(score) AS avg_score, avg(num_comments) AS avg_comments_per_post, ingest_date
  FROM clean GROUP BY ALL)
SELECT * FROM weeks QUALIFY row_number() OVER (PARTITION BY week_start, subreddit ORDER BY ingest_date DESC) = 1"""

ORACLES["streamed_silver_posts"] = _with(SNAPSHOT_POSTS, SNAPSHOT_COMMENTS, WRITTEN, _STREAMED) + """
SELECT id, subreddit, title, author, score, num_comments, created_utc, ingest_date FROM streamed"""

ORACLES["streamed_gold_weeks"] = _with(SNAPSHOT_POSTS, SNAPSHOT_COMMENTS, WRITTEN, _STREAMED) + """
SELECT * FROM (
  SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week_start, subreddit, count(*) AS post_count,
    CAST(sum(score) AS BIGINT) AS sum_score, CAST(sum(num_comments) AS BIGINT) AS sum_num_comments,
    avg(score) AS avg_score, avg(num_comments) AS avg_comments_per_post
  FROM streamed GROUP BY ALL)
LEFT JOIN (
  SELECT week_start, subreddit, count(*) AS total_comments_extracted, avg(score) AS avg_comment_score,
    count(DISTINCT author) AS unique_commenters
  FROM said GROUP BY ALL) USING (week_start, subreddit)"""

ORACLES["replayed_gold_commenters"] = _with(SNAPSHOT_COMMENTS) + f"""
SELECT community AS subreddit, author, count(*) AS comment_count, CAST(sum(score) AS BIGINT) AS total_score,
  avg(score) AS avg_score, count(DISTINCT post_id) AS posts_commented
FROM snapshot_comments WHERE ingest_date = '{RUNS[2]}' GROUP BY ALL"""

ORACLES["incremental_silver_posts"] = ORACLES["streamed_silver_posts"]

ORACLES["incremental_gold_weeks"] = ORACLES["streamed_gold_weeks"]

ORACLES["incremental_gold_commenters"] = _with(SNAPSHOT_COMMENTS) + """
SELECT community AS subreddit, author, count(*) AS comment_count, CAST(sum(score) AS BIGINT) AS total_score,
  avg(score) AS avg_score, count(DISTINCT post_id) AS posts_commented
FROM snapshot_comments WHERE author <> '[deleted]' GROUP BY ALL"""

ORACLES["new_ids_of_runs"] = _with(SNAPSHOT_POSTS) + f"""
, ids AS (SELECT DISTINCT subreddit, ingest_date AS run, id FROM snapshot_posts),
first AS (SELECT subreddit, id FROM ids WHERE run = '{RUNS[0]}'),
second AS (SELECT subreddit, id FROM ids WHERE run = '{RUNS[1]}'),
new_second AS (SELECT * FROM second EXCEPT SELECT * FROM first),
known AS (
  SELECT * FROM second WHERE subreddit IN (SELECT subreddit FROM new_second)
  UNION ALL SELECT * FROM first WHERE subreddit NOT IN (SELECT subreddit FROM new_second))
SELECT subreddit, '{RUNS[0]}' AS run, id FROM first
UNION ALL SELECT subreddit, '{RUNS[1]}' AS run, id FROM new_second
UNION ALL SELECT subreddit, '{RUNS[2]}' AS run, id FROM (
  SELECT subreddit, id FROM ids WHERE run = '{RUNS[2]}' EXCEPT SELECT * FROM known)"""

ORACLES["comment_counts_of_runs"] = _with(SNAPSHOT_POSTS) + f"""
, latest_of_run AS (SELECT * FROM snapshot_posts QUALIFY row_number() OVER (
  PARTITION BY community, ingest_date, id ORDER BY file_name DESC, position DESC) = 1),
candidates AS (SELECT ingest_date AS run, subreddit || '/' || id AS post_id, num_comments, CAST(substring(id, 2) AS BIGINT) % 4 <> 0 AS works
  FROM latest_of_run WHERE num_comments >= 5
  QUALIFY row_number() OVER (PARTITION BY ingest_date, subreddit ORDER BY score + 2 * num_comments DESC, id) <= 50),
first AS (SELECT *, CAST(NULL AS BIGINT) AS cached FROM candidates WHERE run = '{RUNS[0]}'),
cache_1 AS (SELECT post_id, num_comments FROM first WHERE works),
second AS (SELECT c.*, k.num_comments AS cached FROM candidates c LEFT JOIN cache_1 k USING (post_id) WHERE run = '{RUNS[1]}'),
fetched_2 AS (SELECT post_id, num_comments FROM second WHERE works AND cached IS DISTINCT FROM num_comments),
cache_2 AS (SELECT * FROM fetched_2 UNION ALL SELECT * FROM cache_1 WHERE post_id NOT IN (SELECT post_id FROM fetched_2)),
third AS (SELECT c.*, k.num_comments AS cached FROM candidates c LEFT JOIN cache_2 k USING (post_id) WHERE run = '{RUNS[2]}')
SELECT post_id, run, num_comments, cached, cached IS DISTINCT FROM num_comments AS changed
FROM (SELECT * FROM first UNION ALL SELECT * FROM second UNION ALL SELECT * FROM third)"""
