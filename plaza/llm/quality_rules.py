"""Quality rules: a table of thresholds compiled into one projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaza.llm.common import let

# The characters that count as symbols, white space, and common short words of four languages.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
STOP_WORDS = (
    "the of and to in a is that it for on with as was be by are this from "
    "der die und das den von zu mit sich des auf für ist im nicht ein eine als auch "
    "le la les de des et en un une du que qui est pour dans par sur pas au avec "
    "el los las del y se por con no su para como una al lo "
).split()

WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A document is kept only where ``least <= top / bottom <= most``; a zero bottom passes.

    Documents of fewer than ``words`` words are not judged by the rule.
    """

    name: str
    top: str
    bottom: str
    least: float | None = None
    most: float | None = None
    words: int = 0


RULES = (
    Rule("mean word length", "word_chars", "n_words", least=2.0, most=15.0),
    Rule("symbols per word", "n_symbols", "n_words", most=0.2),
    Rule("repeated lines", "n_dup_lines", "n_lines", most=0.5),
    Rule("stop words", "n_stop_words", "n_words", least=0.01, words=50),
)


def _window(words: Column, i: Column) -> list[Column]:
    return [F.get(words, i + k) for k in range(WINDOW)]


def _repeated(words: Column) -> Column:
    """Words that lie in a window which occurs twice or more.

    Hashes of the windows tell most texts, which repeat none, at once; the rest compare the windows
    themselves: sorted, equal ones are neighbours, and each hit covers up to the next hit.
    """
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*_window(words, i)))

    def exactly(ordered: Column) -> Column:
        def same(i: Column, j: Column) -> Column:
            return F.coalesce(F.get(ordered, i)["text"] == F.get(ordered, j)["text"], F.lit(False))

        hits = F.transform(
            F.filter(
                F.transform(ordered, lambda x, i: F.struct(x["at"].alias("at"), (same(i, i - 1) | same(i, i + 1)).alias("hit"))),
                lambda x: x["hit"],
            ),
            lambda x: x["at"],
        )
        return let(
            F.sort_array(hits),
            lambda at: F.aggregate(
                F.transform(at, lambda x, i: F.least(F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))),
                F.lit(0), lambda total, x: total + x,
            ),
        )

    texts = F.transform(starts, lambda i: F.struct(F.concat_ws(" ", *_window(words, i)).alias("text"), i.alias("at")))
    slow = let(F.sort_array(texts), exactly)
    fast = let(hashes, lambda h: F.size(h) == F.size(F.array_distinct(h)))
    return F.when(F.size(words) < WINDOW, 0).when(fast, 0).otherwise(slow).cast("long")


def _count(text: Column, drop: str) -> Column:
    """Characters of ``text`` that are in ``drop``."""
    return (F.length(text) - F.length(F.translate(text, drop, ""))).cast("long")


def measured(text: Column) -> Column:
    """All counts of a text in one struct."""
    body = F.coalesce(text, F.lit(""))

    def of(words: Column, lines: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            (F.length(body) - _count(body, SPACES)).cast("long").alias("word_chars"),
            _count(body, SYMBOLS).alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size(F.filter(words, lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
            _repeated(words).alias("n_repeat_words"),
        )

    words = F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    return let(words, lambda w: let(lines, lambda x: of(w, x)))


def verdict(rules: Sequence[Rule]) -> Column:
    """The table of rules as one condition over the counts."""

    def holds(rule: Rule) -> Column:
        ratio = F.try_divide(F.col(rule.top), F.col(rule.bottom))
        sides = [ratio >= rule.least] if rule.least is not None else []
        sides += [ratio <= rule.most] if rule.most is not None else []
        return (F.col("n_words") < rule.words) | F.coalesce(reduce(lambda a, b: a & b, sides, F.lit(True)), F.lit(True))

    return reduce(lambda a, b: a & b, [holds(rule) for rule in rules], F.lit(True))


def judge_quality(docs: DataFrame, rules: Sequence[Rule] = RULES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and verdict of every document, by one projection without a shuffle.

    A NULL or empty text has no words, fails the base checks and is not kept. Repeated rows are
    judged alike, other columns are ignored, and an empty table gives an empty table. The whole
    text counts, however long.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), measured(F.col(text_col)).alias("m")).select("doc_id", "m.*")
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & verdict(rules))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g') <> '') AS lines FROM d),
windows AS (
  SELECT r, i, words[i:i + 4] AS t FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
hits AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS n FROM windows) WHERE n >= 2),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM hits, range(0, 5) g(k) GROUP BY r),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
    len(list_filter(words, lambda x: lower(rtrim(x, '.,;:!?')) IN ({', '.join(f"'{x}'" for x in dict.fromkeys(STOP_WORDS))})))::BIGINT AS n_stop_words,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered c USING (r)),
j AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND word_chars / n_words BETWEEN 2 AND 15 AND n_symbols / n_words <= 0.2
  AND coalesce(n_dup_lines / n_lines <= 0.5, true) AND (n_words < 50 OR n_stop_words / n_words >= 0.01) AS kept FROM j
"""
