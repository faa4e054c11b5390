"""Checks and statistics, each a DataFrame computed in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.config import DEFAULTS, STANDARD, Settings
from claimlens.functions.columns import percent, text_sql
from claimlens.operators.classify import flag_risk, risk_from_reference
from claimlens.operators.clean import KEPT, normalize_text, reject_reason, rename_columns


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """The required columns that are not there, in the order asked for."""
    return [c for c in required if c not in df.columns]


def has_columns(df: DataFrame, required: Sequence[str]) -> bool:
    return not missing_columns(df, required)


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: type, rows, NULLs and their share. One aggregate for all columns."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.expr(f"count_if(`{c}` IS NULL) AS `{c}`") for c in df.columns],
    )
    types = F.create_map(*[F.lit(v) for field in df.dtypes for v in field])
    long = counts.unpivot("__rows", [f"`{c}`" for c in df.columns], "column_name", "null_count")
    return long.select(
        "column_name",
        types[F.col("column_name")].alias("column_type"),
        F.col("__rows").alias("row_count"),
        "null_count",
        percent("null_count", "__rows").alias("null_pct"),
    )


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """A few rows, any."""
    return df.limit(rows)


def missing_values(df: DataFrame) -> DataFrame:
    """The columns that have NULLs, most first."""
    return (
        column_profile(df)
        .filter("null_count > 0")
        .select("column_name", "null_count", "null_pct")
        .orderBy(F.desc("null_count"), "column_name")
    )


def quality_score(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row: share of rows with all required fields, in percent; 0 without rows."""
    complete = " AND ".join(f"`{c}` IS NOT NULL" for c in required)
    return df.agg(
        F.expr("count(1) AS total_records"), F.expr(f"count_if({complete}) AS complete_records")
    ).withColumn("quality_score", F.coalesce(percent("complete_records", "total_records"), F.lit(0.0)))


def duplicates(df: DataFrame, keys: Sequence[str], ordered: bool = True) -> DataFrame:
    """Keys that occur more than once, most often first."""
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
    return found.orderBy(F.desc("row_count"), *keys) if ordered else found


def outliers(df: DataFrame, column: str, threshold: float = 3.0) -> DataFrame:
    """Add the absolute z-score (sample deviation) and a 0/1 outlier flag.

    Mean and deviation are one row, read as a scalar subquery, which computes
    ``df`` a second time: pass a written table if it is costly. A NULL value,
    or a deviation of zero, gives a NULL score and flag 0.
    """
    moments = df.agg(F.struct(F.avg(column).alias("mean"), F.stddev(column).alias("deviation"))).scalar()
    score = F.abs(F.try_divide(F.col(column) - moments["mean"], moments["deviation"]))
    return df.withColumn(f"{column}_zscore", score).withColumn(
        f"{column}_is_outlier", F.when(F.col(f"{column}_zscore") > threshold, 1).otherwise(0)
    )


def run_statistics(
    raw: DataFrame, settings: Settings = DEFAULTS, drug_reference: DataFrame | None = None
) -> DataFrame:
    """One row: records extracted, cleaned, high-risk, opioid, and state hotspots.

    The raw rows are read once and reduced to a count and a claim total per
    (state, category, kept or not); everything else follows from that table.
    A drug reference decides as it does in the clean layer.
    """
    classified = (
        raw.transform(rename_columns)
        .withColumn("__kept", reject_reason(settings) == KEPT)
        .transform(normalize_text)
        .transform(flag_risk, settings)
    )
    if drug_reference is not None:
        classified = risk_from_reference(classified, drug_reference, settings)
    return _statistics_of(_cells(classified), settings)


def layer_statistics(landed: DataFrame, clean: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The same row from what a run has written: the good landed lines and the clean layer."""
    kept = _cells(clean.withColumn("__kept", F.lit(True)))
    # The rows that cleaning dropped, as one cell that is not kept.
    dropped = landed.agg(F.count(F.lit(1))).scalar() - clean.agg(F.count(F.lit(1))).scalar()
    rest = landed.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("provider_state"), F.lit(STANDARD).alias("risk_category"),
        F.lit(False).alias("__kept"), dropped.alias("__rows"), F.lit(None).cast("bigint").alias("__claims"),
    )
    return _statistics_of(kept.unionByName(rest), settings)


def _cells(classified: DataFrame) -> DataFrame:
    return classified.groupBy("provider_state", "risk_category", "__kept").agg(
        F.expr("count(1) AS __rows"), F.expr("sum(total_claims) AS __claims")
    )


def _statistics_of(cells: DataFrame, settings: Settings) -> DataFrame:
    groups = Window.partitionBy("__kept", "risk_category").orderBy(F.asc_nulls_last("__claims"))

    def rows(condition: str, name: str):
        return F.expr(f"coalesce(sum(__rows) FILTER (WHERE {condition}), 0) AS {name}")

    return (
        cells.withColumn("__hotspot", F.percent_rank().over(groups) >= settings.hotspot_percentile)
        .agg(
            rows("true", "records_extracted"),
            rows("__kept", "records_cleaned"),
            rows(f"__kept AND risk_category <> {text_sql(STANDARD)}", "high_risk_count"),
            rows("__kept AND risk_category = 'OPIOID'", "opioid_count"),
            F.expr("count_if(__kept AND __hotspot) AS hotspot_count"),
        )
        .withColumns({
            "data_loss_pct": percent("records_extracted - records_cleaned", "records_extracted"),
            "high_risk_pct": percent("high_risk_count", "records_cleaned"),
            "opioid_pct": percent("opioid_count", "records_cleaned"),
        })
    )


def reconcile_all(
    own: DataFrame, supplied: DataFrame, keys: Sequence[str], measures: Sequence[str], tolerance: float = 0
) -> DataFrame:
    """Several measures compared, one row per key and ``measure``; the values are doubles."""
    def long(df: DataFrame) -> DataFrame:
        values = df.select(*keys, *[F.col(m).cast("double").alias(m) for m in measures])
        return values.unpivot(list(keys), list(measures), "measure", "value")

    return reconcile(long(own), long(supplied), [*keys, "measure"], "value", tolerance)


def reconcile(
    own: DataFrame, supplied: DataFrame, keys: Sequence[str], measure: str, tolerance: float = 0
) -> DataFrame:
    """Compare a measure of two aggregates key by key, keeping the keys of either side.

    Both carry ``keys`` and ``measure``, one row per key; NULL keys meet.
    """
    mine = own.select(*keys, F.col(measure).alias("own_value"), F.lit(True).alias("__mine"))
    theirs = supplied.select(
        *[F.col(k).alias(f"__their_{k}") for k in keys],
        F.col(measure).alias("supplied_value"),
        F.lit(True).alias("__theirs"),
    )
    same_key = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__their_{k}")) for k in keys])
    gap = F.col("own_value") - F.col("supplied_value")
    return mine.join(theirs, same_key, "full_outer").select(
        *[F.coalesce(k, f"__their_{k}").alias(k) for k in keys],
        "own_value",
        "supplied_value",
        gap.alias("difference"),
        F.when(F.col("__theirs").isNull(), "ONLY_OWN")
        .when(F.col("__mine").isNull(), "ONLY_SUPPLIED")
        .when(F.abs(gap) <= tolerance, "EQUAL")
        .otherwise("DIFFERENT")
        .alias("status"),
    )
