"""Join rows to their group when one group may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_groups(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str, *, null_safe: bool = False
) -> DataFrame:
    """Join ``rows`` with ``groups``, which has one row per key; inner, left, left_semi or left_anti.

    In these joins AQE may split the partition of a hot key on the side of the rows and read the
    group for each piece, by the bytes it has measured, so no key is salted beforehand. Few
    groups are broadcast, which AQE decides from their real size as well.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a hot key can't be split in a {how} join")
    names = {key: f"_group_{key}" for key in keys}
    # Groups that come straight from an aggregation by the key would bring its partitioning along,
    # and a join that shares one is not split. Dealt anew, the few rows get a shuffle of their own.
    renamed = groups.withColumnsRenamed(names).hint("rebalance")

    def same(left: str, right: str) -> Column:
        return F.col(left).eqNullSafe(F.col(right)) if null_safe else F.col(left) == F.col(right)

    condition = reduce(lambda a, b: a & b, [same(key, name) for key, name in names.items()])
    return rows.join(renamed, condition, how).drop(*names.values())
