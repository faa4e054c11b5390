"""Writers: one table each, with the row count taken while writing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

FORMAT_OPTIONS = {"parquet": {"compression": "snappy"}, "csv": {"header": "true"}}
MODES = ("overwrite", "append", "error")


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    fmt: str = "parquet",
    files: int | None = None,
    rebalance: bool = True,
    replace_partitions_only: bool = False,
    sort_by: Sequence[str] = (),
) -> int:
    """Write a table and return its row count, without reading it a second time.

    The rows are rebalanced on the partition columns first: AQE packs small
    folders into one file each and splits a folder that outgrows the advisory
    partition size, so a state with a third of all rows is written by many
    tasks. ``files`` asks for that many files instead; use it for tables of a
    known size. ``rebalance=False`` writes the partitions as they come, without
    a shuffle. ``replace_partitions_only`` leaves the folders that
    get no new rows as they are. ``sort_by`` (a leading minus: from high to low)
    deals the rows by ranges of the folders and these columns, and sorts each:
    the files of a folder, by name, are in one order, and so are their row
    groups, whose statistics then tell a reader which to pass by. ``fmt`` may be any format Spark has on its
    classpath ('delta' needs its jar).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    counted = Observation()
    if sort_by:
        order = [*map(F.asc_nulls_last, partition_by), *(F.desc_nulls_last(c[1:]) if c.startswith("-") else F.asc_nulls_last(c) for c in sort_by)]
        df = (df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)).sortWithinPartitions(*order)
    elif files:
        df = df.repartition(files)
    elif rebalance:
        df = df.hint("rebalance", *partition_by)
    # Counted after the shuffle: only a task whose output is committed adds
    # to the count, also when shuffle files are lost and made again.
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode)
    writer = writer.options(**FORMAT_OPTIONS.get(fmt, {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace_partitions_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    return counted.get["rows"]


def sample_rows(df: DataFrame, rows: int, key: Sequence[str] = (), salt: int = 0, by: Sequence[str] = ()) -> DataFrame:
    """A uniform sample without replacement: the ``rows`` rows of the smallest salted hash of their key, of each group of ``by``.

    Which rows are drawn depends on their keys and the salt alone, so it is
    the same for any partitioning and after lost tasks. Each task hands on
    its ``rows`` smallest (per group), and these are merged; no row is sorted
    with all others. The key is all columns by default; rows that share a key
    stand side by side in the order, and are told apart by the rest of the row.
    """
    hashes = [F.xxhash64(F.lit(salt), F.to_json(F.struct(*names), {"ignoreNullFields": "false"})) for names in (key or df.columns, df.columns)]
    drawn = df.withColumns({"__hash": hashes[0], "__rest": hashes[1]})
    if not by:
        return drawn.orderBy("__hash", "__rest").limit(rows).drop("__hash", "__rest")
    order = Window.partitionBy(*by).orderBy("__hash", "__rest")
    return drawn.withColumn("__place", F.row_number().over(order)).filter(F.col("__place") <= rows).drop("__hash", "__rest", "__place")


def export_sample(
    df: DataFrame, path: str, rows: int = 10_000, key: Sequence[str] = (), salt: int = 0, by: Sequence[str] = ()
) -> int:
    """Write a uniform sample of at most ``rows`` rows (of each group of ``by``) as one CSV file, for a look at the data."""
    return write_table(sample_rows(df, rows, key, salt, by), path, fmt="csv", files=1)
