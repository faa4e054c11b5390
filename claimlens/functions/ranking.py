"""Ranks inside groups of any size.

``rank()`` over a window sends a whole group to one task, so a state that
holds a third of all providers becomes one very long task. The ranks here
only ever sort small pieces:

1. count the rows per (group, amount): ties collapse before the shuffle;
2. cut each group into blocks of 2**16 neighbouring amounts, and sum inside
   each block: a block has at most 65,536 distinct amounts;
3. sum over the blocks of a group. For whole, non-negative amounts that add
   up to T, k blocks need a total of about k*k/2 * 2**16, so a group has at
   most sqrt(T / 2**15) blocks: 175,000 for T = 10**15.

The rank is then one plus the rows in better blocks plus the better rows in
the own block. The blocks depend on the amount alone, so a task that is run
again after a lost executor puts every row into the same block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions.joins import join_on_groups

BLOCK_BITS = 16


def _standings(df: DataFrame, by: Sequence[str], amount: str, descending: bool) -> DataFrame:
    """Per (group, amount): ``ahead`` rows with a better amount and the group's ``size``."""
    def ordered(name: str):
        return F.desc_nulls_last(name) if descending else F.asc_nulls_last(name)

    tally = (
        df.groupBy(*by, amount)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .withColumn("__block", F.shiftright(F.col(amount).cast("bigint"), BLOCK_BITS))
    )
    in_block = Window.partitionBy(*by, "__block").orderBy(ordered(amount))
    over_blocks = Window.partitionBy(*by).orderBy(ordered("__block"))
    before = (Window.unboundedPreceding, -1)

    inside = tally.withColumn(
        "__inside", F.coalesce(F.sum("__rows").over(in_block.rowsBetween(*before)), F.lit(0))
    )
    blocks = (
        tally.groupBy(*by, "__block")
        .agg(F.sum("__rows").alias("__block_rows"))
        .select(
            *by,
            "__block",
            F.coalesce(F.sum("__block_rows").over(over_blocks.rowsBetween(*before)), F.lit(0)).alias("__outside"),
            F.sum("__block_rows").over(Window.partitionBy(*by)).alias("__size"),
        )
    )
    return join_on_groups(inside, blocks, [*by, "__block"], "inner").select(
        *by, amount, (F.col("__inside") + F.col("__outside")).alias("__ahead"), "__size"
    )


def with_rank(df: DataFrame, by: Sequence[str], amount: str, name: str, descending: bool = True) -> DataFrame:
    """Add ``rank()`` of a whole-number column inside each group; NULLs come last."""
    ranked = join_on_groups(df, _standings(df, by, amount, descending), [*by, amount], "inner")
    return ranked.withColumn(name, F.col("__ahead") + 1).drop("__ahead", "__size")


def with_percent_rank(df: DataFrame, by: Sequence[str], amount: str, name: str, descending: bool = False) -> DataFrame:
    """Add ``percent_rank()`` of a whole-number column inside each group; NULLs come last."""
    ranked = join_on_groups(df, _standings(df, by, amount, descending), [*by, amount], "inner")
    share = F.when(F.col("__size") > 1, F.col("__ahead") / (F.col("__size") - 1)).otherwise(0.0)
    return ranked.withColumn(name, share).drop("__ahead", "__size")


def first_n(
    df: DataFrame, by: Sequence[str], amount: str, ties: Sequence[str], n: int, name: str = "row_rank"
) -> DataFrame:
    """The ``n`` rows of each group with the greatest whole-number amount; ``ties`` decide among equals.

    One plan for every n: rows that have n better ones go first, and only rows
    of the same group and amount are sorted against each other.
    """
    ranked = join_on_groups(df, _standings(df, by, amount, True), [*by, amount], "inner").filter(F.col("__ahead") < n)
    among_equals = F.row_number().over(Window.partitionBy(*by, amount).orderBy(*ties))
    numbered = ranked.withColumn(name, (F.col("__ahead") + among_equals).cast("int"))
    return numbered.filter(F.col(name) <= n).drop("__ahead", "__size")
