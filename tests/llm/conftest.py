from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (id, text[, lang[, source]]) tuples, with a column whose name may clash."""

    def make(*rows, extra: str | None = None):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1]) if r[1] else 0) for r in rows]
        frame = spark.createDataFrame(full, DOCS)
        if extra:
            from pyspark.sql import functions as F

            frame = frame.withColumn(extra, F.lit("x"))
        return frame

    return make


def words(n: int, seed: int = 0) -> list[str]:
    """Different words: no two windows of five are alike."""
    return [f"w{seed}x{k}" for k in range(n)]
