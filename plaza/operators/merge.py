"""MERGE as joins: update matched rows, insert the others, and save only touched partitions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plaza.session import freeing, stage
from plaza.sources.tables import ROW_LEVEL_PROVIDERS, clear_partition, insert, open_table

# A guard gets a function for the new and one for the old value of a column.
Side = Callable[[str], Column]
Guard = Callable[[Side, Side], Column]


def always(new: Side, old: Side) -> Column:
    return F.lit(True)


def not_older(*columns: str) -> Guard:
    """New row at or after the old one by these columns, compared left to right."""

    def guard(new: Side, old: Side) -> Column:
        *leading, last = columns
        accept = new(last) >= old(last)
        for name in reversed(leading):
            accept = (new(name) > old(name)) | ((new(name) == old(name)) & accept)
        return accept

    return guard


def strictly_newer(column: str, missing: str = "1900-01-01") -> Guard:
    """New row strictly after the old one; an old row without the time always gives way."""

    def guard(new: Side, old: Side) -> Column:
        return new(column) > F.coalesce(old(column), F.lit(missing).cast("timestamp"))

    return guard


def _have_keys(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])


def matched_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is in the source; a NULL in the key never matches."""
    return target.join(source.select(*keys).where(_have_keys(keys)), list(keys), "left_semi")


def _common_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys that both sides have.

    Each side is made distinct first, so a key with many copies is one row before the
    shuffle. If the source's keys are few, Spark moves the semi join below the target's
    distinct and broadcasts them: the target is then filtered in place.
    """
    wanted = source.select(*keys).where(_have_keys(keys)).distinct()
    return target.select(*keys).distinct().join(wanted, list(keys), "left_semi")


def unmatched(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not in the target. The target is read for its keys only."""
    return source.join(_common_keys(target, source, keys), list(keys), "left_anti")


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus all source rows with an unknown key; matched rows stay untouched."""
    return target.unionByName(unmatched(source, target, keys).select(*target.columns))


def _updated(
    target: DataFrame, source: DataFrame, keys: Sequence[str], guard: Guard, update: Sequence[str]
) -> DataFrame:
    """The target with the source's values, by one join: the source is one row per key before it,
    and a key with several rows is an error where it meets a target row."""
    values = [name for name in source.columns if name not in keys and name in target.columns]
    incoming = source.where(_have_keys(keys)).groupBy(*[F.col(key).alias(f"_key_{key}") for key in keys]).agg(
        F.any_value(F.struct(*values, F.lit(True).alias("_any"))).alias("_new"), F.count(F.lit(1)).alias("_copies")
    )
    same_key = reduce(lambda a, b: a & b, [F.col(key) == F.col(f"_key_{key}") for key in keys])

    def new(name: str) -> Column:
        return F.col(name) if name in keys else F.col(f"_new.{name}")

    error = F.raise_error(F.lit("several source rows match one target row")).cast("boolean")
    take = F.col("_new").isNotNull() & F.coalesce(guard(new, F.col), F.lit(False))
    return (
        target.join(incoming, same_key, "left")
        # A filter, as a projection that nobody reads could be dropped.
        .where(F.when(F.col("_copies") > 1, error).otherwise(True))
        .withColumn("_take", take)
        .select(
            *[
                F.when(F.col("_take"), new(name)).otherwise(F.col(name)).alias(name)
                if name in update
                else F.col(name)
                for name in target.columns
            ]
        )
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    guard: Guard = always,
    update: Sequence[str] | None = None,
) -> DataFrame:
    """The target after MERGE: matched rows updated where ``guard`` holds, others inserted.

    ``update`` limits the columns that an update sets (default: all but the keys). Several
    source rows for one target row raise an error. The target streams through a left join,
    so a small source is broadcast and the target is not shuffled at all; with a large
    source both sides are shuffled and AQE splits hot target keys, which it could not do in
    a full outer join. Both sides are read more than once: give written tables, or ``stage`` them.
    """
    changed = [name for name in target.columns if name not in keys] if update is None else list(update)
    kept = _updated(target, source, keys, guard, changed)
    return kept.unionByName(unmatched(source, target, keys).select(*target.columns))


def _provider(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Provider'").head(1)
    return rows[0]["data_type"].lower() if rows else ""


def _values(rows: DataFrame, column: str) -> list[object]:
    """The distinct partition values of some rows: no more than the table has folders."""
    return [row[0] for row in rows.select(column).distinct().collect()]


def _in(column: str, values: Sequence[object]) -> Column:
    listed = F.col(column).isin([value for value in values if value is not None])
    return listed | F.col(column).isNull() if None in values else listed


def append_new(
    spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str], partition: str,
    staged: bool = False, varying: Sequence[str] = ("_loaded_at",), touched: Sequence[object] | None = None,
) -> None:
    """Insert-only MERGE into a table: nothing is rewritten, unknown rows are appended.

    ``partition`` must be one of the keys, so only the source's partitions are looked at.
    ``staged`` says that the source is a written table already. A row without a key is known if
    a stored one equals it in all columns but the ``varying`` ones, so a rerun adds nothing. The source
    is not searched for its partitions when the caller knows the ``touched`` ones.
    """
    with freeing(spark):
        rows = source if staged else stage(source, "append")
        target = open_table(spark, table)
        scope = target.where(_in(partition, _values(rows, partition) if touched is None else touched))
        keyed = rows.where(_have_keys(keys))
        fresh = unmatched(keyed, scope, keys).select(*target.columns)
        loose = rows.where(~_have_keys(keys)).select(*target.columns)
        if not loose.isEmpty():
            # Rows without a key match stored rows that agree in all but the load's own columns.
            compared = [name for name in target.columns if name not in varying]
            stored = scope.where(~_have_keys(keys)).select(*[F.col(name).alias(f"_old_{name}") for name in compared]).distinct()
            agree = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_old_{name}")) for name in compared])
            fresh = fresh.unionByName(loose.join(stored, agree, "left_anti"))
        insert(fresh, table, partition)


def merge_table(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    *,
    partition: str,
    guard: Guard = always,
    update: Sequence[str] | None = None,
    staged: bool = False,
    touched: Sequence[object] | None = None,
) -> None:
    """MERGE into a table.

    On a table format with row-level writes this is Spark's own ``mergeInto``. On parquet the
    partitions that hold a matched or a new row are rewritten; the files of all others are not
    read beyond their keys. A matched row stays in its partition whatever its new values, so
    none is ever left behind in an old folder. If ``partition`` is one of the keys, the
    source alone tells the partitions and the target is not searched for them; nor is it when
    the caller knows the ``touched`` ones.
    """
    if _provider(spark, table) in ROW_LEVEL_PROVIDERS:
        _native_merge(table, source, keys, guard, update)
        return
    with freeing(spark):
        target = open_table(spark, table)
        rows = source if staged else stage(source, "merge")
        if touched is None:
            touched = _values(rows, partition)
            if partition not in keys:
                touched = [*touched, *_values(matched_rows(target, rows, keys), partition)]
        changed = update or [name for name in target.columns if name not in keys]
        scope = target.where(_in(partition, touched))
        merged = upsert(scope, rows, keys, guard=guard, update=[c for c in changed if c != partition])
        insert(merged, table, partition, overwrite=True)


def _native_merge(
    table: str, source: DataFrame, keys: Sequence[str], guard: Guard, update: Sequence[str] | None
) -> None:
    def new(name: str) -> Column:
        return F.col(f"source.{name}")

    def old(name: str) -> Column:
        return F.col(f"{table}.{name}")

    same_key = reduce(lambda a, b: a & b, [old(key) == new(key) for key in keys])
    writer = source.alias("source").mergeInto(table, same_key)
    when = writer.whenMatched(guard(new, old))
    writer = when.update({name: new(name) for name in update}) if update else when.updateAll()
    writer.whenNotMatched().insertAll().merge()


def _native_replace(table: str, touched: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> None:
    gone = touched.select(*keys).distinct().alias("source")
    same_key = reduce(
        lambda a, b: a & b, [F.col(f"{table}.{key}").eqNullSafe(F.col(f"source.{key}")) for key in keys]
    )
    gone.mergeInto(table, same_key).whenMatched().delete().merge()
    insert(fresh, table)


def replace_rows(
    spark: SparkSession, table: str, touched: DataFrame, fresh: DataFrame, keys: Sequence[str], partition: str
) -> None:
    """Replace all rows that have one of the ``touched`` keys by the ``fresh`` ones.

    A touched key without a fresh row disappears. ``partition`` must follow from the keys and
    be a column of ``touched``; only its partitions are read and written.
    """
    if _provider(spark, table) in ROW_LEVEL_PROVIDERS:
        _native_replace(table, touched, stage(fresh, "replace"), keys)
        return
    with freeing(spark):
        there = _values(touched, partition)
        scope = open_table(spark, table).where(_in(partition, there))
        gone = touched.select(*[F.col(key).alias(f"_key_{key}") for key in keys]).distinct()
        same_key = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_key_{key}")) for key in keys])
        rows = stage(scope.join(gone, same_key, "left_anti").unionByName(fresh.select(*scope.columns)), "replace")
        insert(rows, table, partition, overwrite=True)
        for value in set(there) - set(_values(rows, partition)):
            clear_partition(spark, table, partition, value)
