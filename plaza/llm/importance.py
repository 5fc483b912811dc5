"""Importance resampling towards a target text, by hashed n-gram counts of pre-tokenised words."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaza.llm.common import Scratch, pieces
from plaza.llm.scans import running_sums

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # runs of ASCII letters, digits and all that is not ASCII
BATCH_BYTES = 8 << 20


class Buckets:
    """Hash buckets of a text's n-grams; the splitter is a plain pattern and never trained."""

    def __init__(self, most: int, n_buckets: int):
        from tokenizers import Regex, pre_tokenizers

        self.split = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)
        self.most, self.n_buckets = most, n_buckets
        self.dtype = np.dtype("<u2" if n_buckets <= 1 << 16 else "<u4")

    def spans(self, text: str) -> tuple[bytes, list[tuple[int, int]]]:
        """The text with A-Z lower-cased in UTF-8, and where its words begin and end there."""
        data = text.encode().lower()  # of bytes, only ASCII letters change
        found = [span for _, span in self.split.pre_tokenize_str(data.decode())] if data else []
        if found and not text.isascii():
            begins = np.append(np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80), len(data))
            found = [tuple(span) for span in begins[np.array(found)].tolist()]
        return data, found

    def of(self, text: str | None) -> tuple[int, np.ndarray]:
        """How many words there are, and the bucket of every run of up to ``most`` words."""
        data, spans = self.spans(text or "")
        own = [data[a:b] for a, b in spans]
        crc = [zlib.crc32(word) for word in own]
        found = list(crc)
        for n in range(1, self.most):
            # A run of n + 1 words is the run before it, a space and one more word.
            crc = [zlib.crc32(word, zlib.crc32(b" ", run)) for run, word in zip(crc, own[n:])]  # noqa: B905
            found += crc
        return len(own), (np.array(found, np.uint32) % np.uint32(self.n_buckets)).astype(self.dtype)


def hashed_features(rows: DataFrame, id_col: str | None, text_col: str, most: int, n_buckets: int) -> DataFrame:
    """(doc_id, n_words, n_features, buckets) of every row; a bucket number takes two or four bytes."""
    name = F.col(id_col) if id_col else F.lit(None)
    given = rows.select(name.cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(most, n_buckets)
        for batch in pieces(batches, "text", BATCH_BYTES):
            found = [buckets.of(text.as_py()) for text in batch.column("text")]
            columns = [
                batch.column("doc_id"), pa.array([n for n, _ in found], pa.int64()),
                pa.array([len(own) for _, own in found], pa.int64()), pa.array([own.tobytes() for _, own in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "buckets"])

    return given.mapInArrow(hashed, "doc_id long, n_words long, n_features long, buckets binary")


def bucket_histogram(features: DataFrame, n_buckets: int) -> DataFrame:
    """(bucket, n) of all features; each task sends at most one row per bucket."""
    dtype = Buckets(1, n_buckets).dtype

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_buckets, np.int64)
        for batch in pieces(batches, "buckets", BATCH_BYTES):
            counts += np.bincount(np.frombuffer(b"".join(batch.column("buckets").to_pylist()), dtype), minlength=n_buckets)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[seen], pa.int64())], names=["bucket", "n"])

    return features.select("buckets").mapInArrow(tally, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, n_buckets: int) -> DataFrame:
    """(bucket, gain) for all buckets: a thousand times the log of how much likelier the target makes it, floored."""
    spark = raw.sparkSession
    counts = spark.range(n_buckets).select(F.col("id").alias("bucket"))
    counts = counts.join(raw.select("bucket", F.col("n").alias("s")), "bucket", "left").join(target.select("bucket", F.col("n").alias("t")), "bucket", "left")
    counts = counts.na.fill(0, ["s", "t"])
    sums = counts.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    s, t, all_s, all_t = (F.col(name).cast("double") for name in ("s", "t", "all_s", "all_t"))
    ratio = (t + 1) * (all_s + n_buckets) / ((s + 1) * (all_t + n_buckets))
    # One row of sums meets one row per bucket.
    return counts.join(F.broadcast(sums)).select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def resample(
    docs: DataFrame, target: DataFrame, *, most_words: int = 1, n_buckets: int = 10_000, percent: int = 10, least_words: int = 20,
    seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): draw documents that read like the target.

    Features are runs of 1 to ``most_words`` words, hashed into ``n_buckets``. A document's weight is
    the floored mean gain of its features. The score adds Gumbel noise from a hash of seed and id, so
    the ``percent`` highest scores of the documents with at least ``least_words`` words are a draw
    without replacement; ``rank`` numbers them from 1 and is NULL for the rest.

    Texts are split once; their bucket numbers are written to the shared folder, and histogram and
    weights read them there. The gains that all tasks get have one number per bucket. Ranks come from
    sorted ranges, so no task holds all scores.

    A NULL or empty text has no words and weight 0. A NULL id is hashed as "null" and follows the other
    ids of its score. Rows that repeat an id are documents of their own with one noise; rows alike in
    id and score are numbered in any order. An empty table, or an empty target, is no error. Columns
    beyond id and text are not looked at.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    raw = scratch.write(hashed_features(docs, id_col, text_col, most_words, n_buckets), "features")
    wanted = hashed_features(target, None, target_text, most_words, n_buckets)
    rows = bucket_gains(bucket_histogram(raw, n_buckets), bucket_histogram(wanted, n_buckets), n_buckets).collect()
    gains = np.zeros(n_buckets, np.int64)
    for row in rows:
        gains[row["bucket"]] = row["gain"]
    dtype = Buckets(1, n_buckets).dtype

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(own.as_buffer(), dtype) for own in batch.column("buckets")]
            weights = [int(gains[own].sum()) // len(own) if len(own) else 0 for own in found]
            columns = [*(batch.column(name) for name in ("doc_id", "n_words", "n_features")), pa.array(weights, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    weighed = raw.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / float(1 << 32))))
    scored = scratch.write(weighed.withColumn("score", F.col("weight") + noise).withColumn("_row", F.monotonically_increasing_id()), "scores")
    scratch.drop("features")
    enough = scored.filter(F.col("n_words") >= least_words)
    many = enough.count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    ranked = running_sums(enough, [], order, {"rank": F.lit(1).cast("long")}, scratch, "ranks")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= many, F.col("rank")))
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# DuckDB has no CRC-32, so the oracles compute it byte by byte from its table of 256 entries.
CRC_TABLE = "SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS entries"


def crc_sql(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes; a column ``entries`` must be there."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295)"


ORACLE = rf"""
WITH crc AS ({CRC_TABLE}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM documents),
raw AS (SELECT r, unnest(words) AS word FROM d),
wanted AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')) AS word FROM benchmark),
known AS (SELECT word, {crc_sql('word')} % 10000 AS bucket FROM (SELECT word FROM raw UNION SELECT word FROM wanted), crc),
s AS (SELECT bucket, count(*) AS n FROM raw JOIN known USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM wanted JOIN known USING (word) GROUP BY bucket),
sums AS (SELECT (SELECT count(*) FROM raw) AS s, (SELECT count(*) FROM wanted) AS t),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (sums.s + 10000)::DOUBLE / ((coalesce(s.n, 0) + 1)::DOUBLE * (sums.t + 10000)::DOUBLE)))::BIGINT AS gain
  FROM (SELECT DISTINCT bucket FROM known) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), sums),
summed AS (SELECT r, sum(gain) AS gain FROM raw JOIN known USING (word) JOIN gains USING (bucket) GROUP BY r),
weighed AS (SELECT r, doc_id, len(words) AS n_features, coalesce(floor(gain / len(words)), 0)::BIGINT AS weight FROM d LEFT JOIN summed USING (r)),
scored AS (
  SELECT *, weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM weighed),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM scored LEFT JOIN ranked USING (r)
"""
