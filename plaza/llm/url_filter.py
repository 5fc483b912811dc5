"""URL filters: rules for hosts and paths, carried over to redirected and canonical aliases."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaza.llm.common import Scratch
from plaza.llm.components import connected_components

MOST_RULES = 500  # they become one expression; more are an error

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# Query parameters that do not change what a url shows, as they only tell where a visitor came from.
TRACKING = r"(^|&)(utm_[^=&]*|ref|fbclid|gclid)(=[^&]*)?(?=&|$)"
UNREAD = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script|\z)"  # parts of a page that declare nothing
DECIMAL, HEXADECIMAL = "^#([0-9]{1,7});", "^#[xX]([0-9a-fA-F]{1,6});"
CLIMB, SCHEME = r"^((?:\.\.?/)+)", "^[A-Za-z][A-Za-z0-9+.-]*:"


@dataclass(frozen=True)
class Rule:
    """What to do with urls of a host and its subdomains whose path begins with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits as a struct of name and verdict, NULL if none; of equals the longer host, then block."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    found = [F.lit(None).cast("struct<size:int,host:int,block:boolean,name:string,verdict:string>")] * 2
    for rule in rules:
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        size, block = F.lit(len(rule.name)).alias("size"), F.lit(rule.verdict == "block").alias("block")
        found.append(F.when(fits, F.struct(size, F.lit(len(rule.host)).alias("host"), block, F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))))
    return F.greatest(*found)


def alias_key(url: Column) -> Column:
    """Urls that differ in scheme, case of the host, fragment or tracking parameters have one key; NULL without ``://``."""
    query = F.regexp_replace(F.regexp_replace(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), TRACKING, ""), "^&+", "")
    return F.when(F.instr(url, "://") > 0, F.concat(host_of(url), path_of(url), F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def decoded(text: Column) -> Column:
    """The text with ``&amp;`` and numeric character references decoded once; others stay as they are."""
    def piece(part: Column, k: Column) -> Column:
        digits, letters = F.regexp_extract(part, DECIMAL, 1), F.regexp_extract(part, HEXADECIMAL, 1)
        code = F.when(digits != "", digits.cast("long")).when(letters != "", F.conv(letters, 16, 10).cast("long"))
        known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        letter = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return (
            F.when(k == 0, part).when(known, F.concat(letter, F.regexp_replace(part, "^[^;]*;", "")))
            .when(part.startswith("amp;"), F.concat(F.lit("&"), F.substring(part, 5, 1 << 30))).otherwise(F.concat(F.lit("&"), part))
        )

    return F.array_join(F.transform(F.split(text, "&"), piece), "")


def resolved(target: Column, url: Column) -> Column:
    """A target as an absolute url: from the page's scheme, root, folder or path; NULL if it is empty or a fragment."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(url))
    climbing = F.regexp_extract(target, CLIMB, 1)
    ups = F.length(F.replace(climbing, F.lit("../"), F.lit("..//"))) - F.length(climbing)
    folders = F.filter(F.split(F.regexp_replace(path_of(url), "[^/]*$", ""), "/"), lambda name: name != "")
    kept = F.slice(folders, F.lit(1), F.greatest(F.size(folders) - ups, F.lit(0)))
    below = F.concat(F.array_join(F.transform(kept, lambda name: F.concat(name, F.lit("/"))), ""), F.regexp_replace(target, CLIMB, ""))
    return (
        F.when((target == "") | target.startswith("#"), F.lit(None).cast("string"))
        .when(target.rlike(SCHEME), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(root, target))
        .when(target.startswith("?"), F.concat(root, path_of(url), target))
        .otherwise(F.concat(root, F.lit("/"), below))
    )


def declared_targets(url: Column, html: Column) -> Column:
    """The urls that a page's canonical link and refresh redirect name outside of comments and scripts, made absolute.

    Empty path parts go where a target climbs; a base element is not heeded.
    """
    tags = F.regexp_extract_all(F.regexp_replace(F.coalesce(html, F.lit("")), UNREAD, ""), F.lit(r"(?i)<(?:link|meta)\b[^>]*>"), 0)
    canonical = F.transform(
        F.filter(tags, lambda t: t.rlike(r"""(?i)\brel\s*=\s*["']?canonical\b""")),
        lambda t: F.regexp_extract(t, r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)""", 1),
    )
    refresh = F.transform(
        F.filter(tags, lambda t: t.rlike(r"""(?i)\bhttp-equiv\s*=\s*["']?refresh\b""")),
        lambda t: F.regexp_extract(t, r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)""", 1),
    )
    return F.filter(F.transform(F.concat(canonical, refresh), lambda t: resolved(decoded(t), url)), lambda t: F.instr(t, "://") > 0)


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule] = RULES, redirects: DataFrame | None = None, *, id_col: str = "page_id",
    url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page.

    A url's own rule decides. Otherwise a page is blocked if the urls that redirects (columns source
    and target) and canonical links connect it to, over any number of steps, hold a blocked one and
    none that a rule allows: an explicit allow takes precedence. All else is allowed. Pages without
    a url, or whose url has no ``://``, have no host, path or aliases. Links that are NULL, empty
    or name their own page connect nothing. Repeated rows are judged alike.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark)
    url = F.col(url_col)
    found = pages.select(alias_key(url).alias("a"), F.explode(declared_targets(url, F.col(html_col))).alias("target"))
    links = found.select("a", alias_key(F.col("target")).alias("b"))
    if redirects is not None:
        links = links.union(redirects.select(alias_key(F.col("source")), alias_key(F.col("target"))))
    links = scratch.write(links.filter("a <> b"), "aliases")
    classes = connected_components(links)
    own = fitting_rule(F.regexp_extract("node", r"(?s)^([^/?]*)", 1), F.regexp_extract("node", r"(?s)^[^/?]*([^?]*)", 1), rules)["verdict"]
    nodes = classes.withColumn("own", own)
    judged = nodes.groupBy("component").agg(
        F.coalesce(F.max(F.col("own") == "block"), F.lit(False)).alias("blocked"),
        F.coalesce(F.max(F.col("own") == "allow"), F.lit(False)).alias("allowed"),
    ).filter("blocked and not allowed").select("component")
    carried = nodes.join(judged, "component").select(F.col("node").alias("_node"), F.lit("block").alias("_carried"))
    given = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), alias_key(url).alias("_key"))
    ruled = given.withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules))
    return ruled.join(carried, F.col("_key") == F.col("_node"), "left").select(
        "page_id", "host", "path", F.col("_rule")["name"].alias("rule"),
        F.coalesce(F.col("_rule")["verdict"], F.col("_carried"), F.lit("allow")).alias("verdict"),
    )


def _key_sql(url: str) -> str:
    """The alias key in the oracle's SQL."""
    query = rf"regexp_replace(regexp_replace(regexp_extract({url}, '(?s)^[^?#]*\?([^#]*)', 1), '(^|&)(utm_[^=&]*|ref|fbclid|gclid)(=[^&]*)?(\b|$)', '', 'g'), '^&+', '')"
    host, path = (rf"regexp_extract({url}, '(?s)^.*?://([^/?#]*)([^?#]*)', {n})" for n in (1, 2))
    return f"CASE WHEN instr({url}, '://') > 0 THEN translate({host}, '{UPPER}', '{LOWER}') || {path} || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END END"


ORACLE = rf"""
WITH RECURSIVE rules(verdict, host, path) AS (VALUES {', '.join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)}),
p AS (
  SELECT row_number() OVER () AS r, page_id, {_key_sql('url')} AS k, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
    list_concat(
      list_transform(list_filter(regexp_extract_all(regexp_replace(coalesce(html, ''), '{UNREAD}', '', 'g'), '(?i)<(?:link|meta)\b[^>]*>'), lambda t: regexp_matches(t, '(?i)\brel\s*=\s*["'']?canonical\b')),
        lambda t: regexp_extract(t, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)),
      list_transform(list_filter(regexp_extract_all(regexp_replace(coalesce(html, ''), '{UNREAD}', '', 'g'), '(?i)<(?:link|meta)\b[^>]*>'), lambda t: regexp_matches(t, '(?i)\bhttp-equiv\s*=\s*["'']?refresh\b')),
        lambda t: regexp_extract(t, '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1))) AS targets, url
  FROM pages),
given AS (
  SELECT k AS a, regexp_extract(url, '(?s)^(.*?)://', 1) AS scheme, host, path, unnest(list_transform(targets, lambda t: array_to_string(list_transform(string_split(t, '&'), lambda x, i:
    CASE WHEN i = 1 THEN x
      WHEN regexp_matches(x, '{DECIMAL}') AND (regexp_extract(x, '{DECIMAL}', 1)::INT BETWEEN 1 AND 55295 OR regexp_extract(x, '{DECIMAL}', 1)::INT BETWEEN 57344 AND 1114111)
        THEN chr(regexp_extract(x, '{DECIMAL}', 1)::INT) || regexp_replace(x, '^[^;]*;', '')
      WHEN regexp_matches(x, '{HEXADECIMAL}') AND (('0x' || regexp_extract(x, '{HEXADECIMAL}', 1))::INT BETWEEN 1 AND 55295 OR ('0x' || regexp_extract(x, '{HEXADECIMAL}', 1))::INT BETWEEN 57344 AND 1114111)
        THEN chr(('0x' || regexp_extract(x, '{HEXADECIMAL}', 1))::INT) || regexp_replace(x, '^[^;]*;', '')
      WHEN starts_with(x, 'amp;') THEN '&' || substr(x, 5) ELSE '&' || x END), ''))) AS t FROM p),
climbed AS (
  SELECT *, list_filter(string_split(regexp_replace(path, '[^/]*$', ''), '/'), lambda x: x <> '') AS folders,
    length(replace(regexp_extract(t, '{CLIMB}', 1), '../', '..//')) - length(regexp_extract(t, '{CLIMB}', 1)) AS ups FROM given),
named AS (
  SELECT a, CASE WHEN t = '' OR starts_with(t, '#') THEN NULL WHEN regexp_matches(t, '{SCHEME}') THEN t
    WHEN starts_with(t, '//') THEN scheme || ':' || t WHEN starts_with(t, '/') THEN scheme || '://' || host || t
    WHEN starts_with(t, '?') THEN scheme || '://' || host || path || t
    ELSE scheme || '://' || host || '/' || array_to_string(list_transform(folders[1:greatest(len(folders) - ups, 0)], lambda x: x || '/'), '') || regexp_replace(t, '{CLIMB}', '') END AS target
  FROM climbed),
links AS (SELECT a, {_key_sql('target')} AS b FROM named),
edges AS (SELECT a, b FROM links WHERE a <> b UNION SELECT b, a FROM links WHERE a <> b),
reach AS (SELECT a, a AS b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
nodes AS (SELECT DISTINCT a AS k, regexp_extract(a, '(?s)^([^/?]*)', 1) AS host, regexp_extract(a, '(?s)^[^/?]*([^?]*)', 1) AS path FROM edges),
ruled AS (
  SELECT n.k, (SELECT arg_max(u.verdict, length(u.host || u.path)) FROM rules u WHERE (n.host = u.host OR ends_with(n.host, '.' || u.host)) AND starts_with(n.path, u.path)) AS verdict
  FROM nodes n),
carried AS (SELECT r.a AS k, bool_or(verdict = 'block') AND NOT coalesce(bool_or(verdict = 'allow'), false) AS blocked FROM reach r JOIN ruled ON r.b = ruled.k GROUP BY r.a),
own AS (
  SELECT p.r, arg_max(u.host || u.path, length(u.host || u.path)) AS rule, arg_max(u.verdict, length(u.host || u.path)) AS verdict
  FROM p JOIN rules u ON (p.host = u.host OR ends_with(p.host, '.' || u.host)) AND starts_with(p.path, u.path) GROUP BY p.r)
SELECT p.page_id, p.host, p.path, own.rule, coalesce(own.verdict, CASE WHEN c.blocked THEN 'block' END, 'allow') AS verdict
FROM p LEFT JOIN own USING (r) LEFT JOIN carried c ON p.k = c.k
"""
