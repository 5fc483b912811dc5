"""Defaults and number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_long(column: Column) -> Column:
    """BIGINT from a number or its text; ``"12"`` and ``"12.0"`` are 12, junk is NULL."""
    whole = column.try_cast("bigint")
    return F.coalesce(whole, column.try_cast("double").try_cast("bigint"))


def to_double(column: Column) -> Column:
    return column.try_cast("double")


def if_blank(column: Column, default: object) -> Column:
    """``default`` when the text is NULL or empty."""
    return F.coalesce(F.nullif(column, F.lit("")), F.lit(default))


def is_filled(column: Column) -> Column:
    return column.isNotNull() & (column != "")


def engagement(score: str = "score", num_comments: str = "num_comments") -> Column:
    """A comment weighs as much as two points of score."""
    return F.coalesce(F.col(score), F.lit(0)) + 2 * F.coalesce(F.col(num_comments), F.lit(0))


def pages(total: Column, per_page: int) -> Column:
    return F.ceil(total / F.lit(per_page)).cast("bigint")
