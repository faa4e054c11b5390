"""Cleaning: which claim rows are kept, how their text and metrics are derived."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.config import DEFAULTS, Settings
from claimlens.functions.columns import first_true, percent, ratio, ratio_sql
from claimlens.schemas import PROVIDER_DRUG_NAMES

KEPT = "KEPT"


def rename_columns(df: DataFrame, names: Mapping[str, str] = PROVIDER_DRUG_NAMES) -> DataFrame:
    """Rename the columns that are there; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(names))


def keep_rules(settings: Settings = DEFAULTS) -> dict[str, str]:
    """Reject reason -> SQL condition a row must meet, in the order they are tried.

    A condition that is NULL (a blank beneficiary count, a missing cost)
    rejects the row, as in a WHERE clause.
    """
    return {
        "MISSING_NPI": "npi IS NOT NULL",
        "MISSING_DRUG": "drug_name IS NOT NULL",
        "MISSING_CLAIMS": "total_claims IS NOT NULL",
        "LOW_CLAIMS": f"total_claims >= {settings.min_claims}",
        "LOW_BENEFICIARIES": f"beneficiary_count >= {settings.min_beneficiaries}",
        "HIGH_COST_PER_CLAIM": f"{ratio_sql('total_cost', 'total_claims')} <= {settings.max_cost_per_claim!r}D",
    }


def keep_valid(df: DataFrame, settings: Settings = DEFAULTS, only: Sequence[str] | None = None) -> DataFrame:
    """Drop the rows that break a rule (all rules, or those named in ``only``)."""
    rules = keep_rules(settings)
    return df.filter(" AND ".join(rules[r] for r in (only or rules)))


def reject_reason(settings: Settings = DEFAULTS) -> Column:
    """The first rule a row breaks, or ``KEPT``."""
    broken = {name: f"NOT coalesce({met}, false)" for name, met in keep_rules(settings).items()}
    return first_true(broken, otherwise=KEPT)


def rejected(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The dropped rows, each with its ``reject_reason``."""
    return df.withColumn("reject_reason", reject_reason(settings)).filter(F.col("reject_reason") != KEPT)


def reject_summary(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Rows per reject reason, in one pass."""
    return rejected(df, settings).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("row_count"))


def clean_counts(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row: rows before and after cleaning, and what was removed."""
    kept = " AND ".join(keep_rules(settings).values())
    counts = df.agg(F.expr("count(1) AS initial_count"), F.expr(f"count_if({kept}) AS clean_count"))
    return counts.withColumns({
        "removed_count": F.expr("initial_count - clean_count"),
        "removed_pct": percent("initial_count - clean_count", "initial_count"),
    })


def normalize_text(df: DataFrame) -> DataFrame:
    """Upper-case and trim names and state; only trim the specialty.

    A blank state is NULL, as it is when read back from a folder per state.
    """
    upper = {c: F.expr(f"upper(trim({c}))") for c in ("drug_name", "generic_name")}
    state = F.expr("nullif(upper(trim(provider_state)), '')")
    return df.withColumns({**upper, "provider_state": state, "specialty": F.expr("trim(specialty)")})


def derived_metrics(df: DataFrame) -> DataFrame:
    """Add the three ratios; a zero divisor gives NULL."""
    return df.withColumns({
        "cost_per_claim": ratio("total_cost", "total_claims"),
        "cost_per_day": ratio("total_cost", "total_day_supply"),
        "avg_day_supply": ratio("total_day_supply", "total_fills"),
    })


def clean(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Rename, keep valid rows, normalise text, derive metrics, mark as CLEAN."""
    return (
        df.transform(rename_columns)
        .transform(keep_valid, settings)
        .transform(normalize_text)
        .transform(derived_metrics)
        .withColumn("data_quality", F.lit("CLEAN"))
    )
