"""Left joins that hold when one key has a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join where NULL keys meet NULL keys, as they do in a GROUP BY.

    ``keys`` appear once in the result, taken from the left. The equality is
    null-safe, which Spark still plans as an equi-join (hash or sort-merge),
    and AQE may broadcast the right side or split a hot left key.
    """
    if not keys:
        raise ValueError("join_on_groups needs at least one key")
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    condition = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"__right_{k}" for k in keys])


def join_unique(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left-join columns from a side that an aggregate made unique on the key.

    Spark would take over the aggregate's partitioning and shuffle only the
    left side. AQE splits a hot key only where both sides were shuffled for
    the join itself, so the hash of the key is compared as well: it changes
    no result, but asks for such a shuffle. Spark still sees that the right
    side is unique, and drops the join where nobody reads its columns.
    """
    renamed = right.withColumnRenamed(key, "__right_key")
    condition = (F.col(key) == F.col("__right_key")) & (F.xxhash64(key) == F.xxhash64("__right_key"))
    return left.join(renamed, condition, "left").drop("__right_key")
