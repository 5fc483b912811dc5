"""Mix sources to target weights by Poisson replication."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaza.llm.common import hash52, let, log_factorials, unit
from plaza.session import stage

# A mean above this is drawn as a sum of several draws with a mean up to it, so that the table of
# cumulative probabilities has a fixed length. Beyond MOST the probability is under 2**-60.
MEAN, MOST = 64.0, 190


def source_rates(
    docs: DataFrame, targets: Mapping[str | None, float] | None = None, *, alpha: float = 0.5,
    epochs: float = 1.0, source_col: str = "source",
) -> DataFrame:
    """Mean repetitions per document of each source: (source, n_docs, rate).

    The wanted share of a source is its entry in ``targets`` over their sum (sources that are not
    named get nothing), or without targets in proportion to ``n_docs ** alpha``. The rates make
    ``epochs`` times as many documents as there are, in expectation. Negative or non-finite
    weights are an error.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n_docs"))
    if targets is None:
        weighted = sizes.withColumn("weight", F.pow(F.col("n_docs").cast("double"), F.lit(float(alpha))))
    else:
        if any(not math.isfinite(w) or w < 0 for w in targets.values()):
            raise ValueError("target weights must be finite and not negative")
        weight = F.lit(0.0)
        for name, value in targets.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
        weighted = sizes.withColumn("weight", weight)
    # One row per source is written, then one row of sums is read: both are far smaller than the input.
    weighted = stage(weighted, "source-sizes")
    total = weighted.agg(F.sum("n_docs").alias("docs"), F.sum("weight").alias("weight")).first()
    wanted = float(epochs) * (total["docs"] or 0)
    rate = F.col("weight") / F.lit(total["weight"] or 1.0) * F.lit(wanted) / F.col("n_docs")
    return weighted.select("source", "n_docs", rate.alias("rate"))


def mix_sources(
    docs: DataFrame, targets: Mapping[str | None, float] | None = None, *, alpha: float = 0.5, epochs: float = 1.0,
    seed: int = 17, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", numbered: bool = True,
) -> DataFrame:
    """Repeat each document by a Poisson count with its source's rate, and shuffle all copies.

    Adds ``draw`` and ``copy`` (together they number a document's copies) and ``shuffle_key``; the
    rows are dealt by that key and sorted by it inside each partition. The count inverts the Poisson
    distribution at a hash of seed, id, draw and text (if there is such a column), so a task that
    runs again draws the same, rows without an id draw by their texts, and only rows with one id and
    text draw alike. NULL sources are a source of their own. An empty table gives an empty table.
    Columns of ``docs`` named draw, copy or shuffle_key are replaced, or with ``numbered=False`` kept
    while nothing is added; all other names are free.
    """
    if numbered:
        docs = docs.drop("draw", "copy", "shuffle_key")
    rates = source_rates(docs, targets, alpha=alpha, epochs=epochs, source_col=source_col)
    logs = F.array(*[F.lit(x) for x in log_factorials(MOST)])
    draws = F.ceil(F.col("rate") / MEAN).cast("int")
    mean = F.col("rate") / F.col("_draws")
    chance = F.transform(logs, lambda log, k: F.exp(k * F.log(F.col("_mean")) - F.col("_mean") - log))
    summed = let(
        chance,
        lambda each: F.transform(
            F.sequence(F.lit(1), F.lit(MOST + 1)),
            lambda n: F.aggregate(F.slice(each, 1, n), F.lit(0.0), lambda a, x: a + x),
        ),
    )
    # A table of one short row per source; AQE or the planner sends it to all tasks if it is small.
    table = stage(
        rates.filter("rate > 0").withColumn("_draws", draws).withColumn("_mean", mean)
        .select(F.col("source").alias("_source"), "_draws", summed.alias("_upto")),
        "source-rates",
    )
    text = F.md5(F.col(text_col).cast("string")) if text_col in docs.columns else F.lit(None).cast("string")
    # The given columns travel as one struct, so that none clashes with those of the draw.
    given = docs.select(F.struct(*docs.columns).alias("doc"), F.col(source_col).alias("source"), F.col(id_col).alias("id"), text.alias("text"))
    drawn = given.join(table, F.col("source").eqNullSafe(F.col("_source")), "inner").withColumn(
        "draw", F.explode(F.sequence(F.lit(0), F.col("_draws") - 1))
    )
    point = unit(hash52(str(seed), F.col("id"), F.col("draw"), F.col("text")))
    # The least k whose cumulative probability reaches the point.
    counted = drawn.withColumn("_point", point).withColumn(
        "_count", F.size(F.filter("_upto", lambda c: c < F.col("_point")))
    )
    copies = counted.filter("_count > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_count") - 1)))
    key = hash52(f"{seed}-order", F.col("id"), F.col("draw"), F.col("copy"), F.col("text"))
    dealt = copies.select("doc", "draw", "copy", key.alias("shuffle_key")).repartition("shuffle_key").sortWithinPartitions("shuffle_key")
    return dealt.select("doc.*", "draw", "copy", "shuffle_key") if numbered else dealt.select("doc.*")


# The rates are as in source_rates without targets, alpha 0.5, one epoch, seed 17.
ORACLE = """
WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
total AS (SELECT sum(n) AS docs, sum(sqrt(n)) AS weight FROM sizes),
rates AS (SELECT source, sqrt(n) / weight * docs / n AS rate FROM sizes, total),
split AS (SELECT source, ceil(rate / 64)::INT AS draws, rate / ceil(rate / 64) AS mean FROM rates WHERE rate > 0),
chances AS (SELECT source, draws, k, exp(k * ln(mean) - mean - lgamma(k + 1)) AS p FROM split, range(0, 191) t(k)),
upto AS (SELECT source, draws, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM chances),
tables AS (SELECT source, draws, list(c ORDER BY k) AS cs FROM upto GROUP BY source, draws),
drawn AS (
  SELECT d.*, t.cs, u.draw FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source,
  LATERAL (SELECT unnest(range(0, t.draws))::INT AS draw) u),
counted AS (
  SELECT *, len(list_filter(cs, lambda c: c < (('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null') || ':' || draw || ':' || coalesce(md5(text), 'null')), 1, 13))::BIGINT
    + 0.5::DOUBLE) / 4503599627370496)) AS n FROM drawn),
copies AS (SELECT *, unnest(range(0, n))::INT AS copy FROM counted)
SELECT doc_id, text, lang, source, n_chars, draw, copy,
  ('0x' || substr(md5('17-order:' || coalesce(doc_id::VARCHAR, 'null') || ':' || draw || ':' || copy || ':' || coalesce(md5(text), 'null')), 1, 13))::BIGINT AS shuffle_key
FROM copies
"""
