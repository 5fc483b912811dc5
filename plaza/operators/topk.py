"""Best rows overall and per group, ranks, and pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaza.functions.values import pages

SORTS = {"score": "score", "comments": "num_comments", "date": "created_utc"}


def top(df: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """Sort and limit; each task keeps only its own best rows."""
    return df.orderBy(*order).limit(limit)


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The best ``n`` rows of every group in one pass; groups are pruned before the shuffle."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, position).where(F.col(rank) <= n)


def ranked(df: DataFrame, order: Sequence[Column], limit: int, name: str = "rank") -> DataFrame:
    """The top ``limit`` rows with their 1-based place."""
    return top(df, order, limit).withColumn(name, F.row_number().over(Window.orderBy(*order)))


def sort_columns(sort_by: str, tie: str = "id") -> list[Column]:
    if sort_by not in SORTS:
        raise ValueError(f"sort_by must be one of {sorted(SORTS)}, not {sort_by!r}")
    return [F.coalesce(F.col(SORTS[sort_by]), F.lit(0)).desc(), F.col(tie).asc()]


def page(df: DataFrame, page: int = 1, per_page: int = 20, sort_by: str = "score", tie: str = "id") -> DataFrame:
    return df.orderBy(*sort_columns(sort_by, tie)).offset((page - 1) * per_page).limit(per_page)


def page_info(df: DataFrame, page: int = 1, per_page: int = 20) -> DataFrame:
    """One row about a paged result: total rows and number of pages."""
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total"),
        F.lit(page).alias("page"),
        F.lit(per_page).alias("per_page"),
        pages(total, per_page).alias("pages"),
    )
