"""Provider, drug and specialty marts and the dashboard extract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.functions.columns import percent
from claimlens.operators.aggregate import CLAIMS, COST, PATIENTS, PROVIDERS, UNIT_COST, Grouping

PROVIDER = Grouping(
    keys=("npi", "provider_name", "provider_city", "provider_state", "provider_zip", "specialty"),
    measures={
        "provider_total_claims": CLAIMS,
        "provider_total_cost": COST,
        "provider_opioid_claims": "sum(total_claims) FILTER (WHERE is_opioid = 1)",
        "provider_highrisk_claims": "sum(total_claims) FILTER (WHERE is_high_risk = 1)",
        "unique_drugs_prescribed": "count(DISTINCT drug_name)",
        "total_beneficiaries": PATIENTS,
    },
)

DRUG = Grouping(
    keys=("drug_name", "generic_name", "risk_category"),
    measures={
        "drug_total_claims": CLAIMS,
        "drug_total_cost": COST,
        "prescriber_count": PROVIDERS,
        "avg_cost_per_claim": UNIT_COST,
        "total_patients": PATIENTS,
    },
)

SPECIALTY = Grouping(
    keys=("specialty", "risk_category"),
    measures={
        "specialty_claims": CLAIMS,
        "specialty_cost": COST,
        "specialty_provider_count": PROVIDERS,
    },
)

MAIN_DASHBOARD_COLUMNS = (
    *PROVIDER.keys,
    "provider_total_claims",
    "provider_total_cost",
    "provider_opioid_claims",
    "provider_highrisk_claims",
    "opioid_percentage",
    "unique_drugs_prescribed",
    "total_beneficiaries",
)


def provider_summary(df: DataFrame, zero_fill: bool = False) -> DataFrame:
    """Per provider: claims, cost, opioid and high-risk claims, drugs, patients.

    A provider without such drugs has NULL opioid or high-risk claims, and so
    no opioid percentage; ``zero_fill=True`` makes them 0.
    """
    return with_opioid_share(PROVIDER.of(df), zero_fill)


def with_opioid_share(summary: DataFrame, zero_fill: bool = False) -> DataFrame:
    """The provider aggregate with its opioid percentage."""
    if zero_fill:
        summary = summary.fillna(0, ["provider_opioid_claims", "provider_highrisk_claims"])
    return summary.withColumn("opioid_percentage", percent("provider_opioid_claims", "provider_total_claims"))


def drug_summary(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Per drug and category, by claims from high to low."""
    summary = DRUG.of(df)
    return summary.orderBy(F.desc("drug_total_claims"), *DRUG.keys) if ordered else summary


def specialty_risk(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Per specialty and category, by claims from high to low."""
    summary = SPECIALTY.of(df)
    return summary.orderBy(F.desc("specialty_claims"), *SPECIALTY.keys) if ordered else summary


def main_dashboard(providers: DataFrame) -> DataFrame:
    """The thirteen columns of the provider mart that the dashboard reads."""
    return providers.select(*MAIN_DASHBOARD_COLUMNS)
