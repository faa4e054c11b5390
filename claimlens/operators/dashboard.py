"""The queries behind the dashboard; they read the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions.columns import first_true, percent, ratio
from claimlens.functions.joins import join_on_groups
from claimlens.functions.ranking import first_n, with_rank

HIGH_RISK_PCT = 25
MODERATE_RISK_PCT = 10


def opioid_claims_by_state(providers: DataFrame) -> DataFrame:
    """Opioid claims per state, high to low; NULL where a state has none."""
    return (
        providers.groupBy("provider_state")
        .agg(F.sum("provider_opioid_claims").alias("opioid_claims"))
        .orderBy(F.desc_nulls_last("opioid_claims"), F.asc_nulls_last("provider_state"))
    )


def top_opioid_states(providers: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` states with most opioid claims."""
    return opioid_claims_by_state(providers).limit(n)


def high_risk_providers(providers: DataFrame, above: float = HIGH_RISK_PCT) -> DataFrame:
    """Providers whose opioid percentage exceeds the threshold."""
    return providers.filter(F.col("opioid_percentage") > above).select(
        "npi", "provider_name", "specialty", "opioid_percentage"
    )


def hotspots_only(flagged: DataFrame) -> DataFrame:
    return flagged.filter("is_hotspot = 1")


def states_with_high_opioid_share(
    providers: DataFrame, min_claims: int = 100, above_pct: float = 15
) -> DataFrame:
    """States whose larger providers have a mean opioid percentage above the bound."""
    return (
        providers.filter(F.col("provider_total_claims") > min_claims)
        .groupBy("provider_state")
        .agg(
            F.count_distinct("npi").alias("provider_count"),
            F.sum("provider_opioid_claims").alias("total_opioid_claims"),
            F.avg("opioid_percentage").alias("avg_opioid_pct"),
        )
        .filter(F.col("avg_opioid_pct") > above_pct)
        .orderBy(F.desc_nulls_last("total_opioid_claims"), F.asc_nulls_last("provider_state"))
    )


def calculated_fields(providers: DataFrame) -> DataFrame:
    """Add cost per claim, opioid claim ratio, claims per beneficiary and risk tier."""
    return providers.withColumns({
        "cost_per_claim": ratio("provider_total_cost", "provider_total_claims"),
        "opioid_claim_ratio": ratio("provider_opioid_claims", "provider_total_claims"),
        "claims_per_beneficiary": ratio("provider_total_claims", "total_beneficiaries"),
        "risk_tier": first_true(
            {
                "High Risk": f"opioid_percentage > {HIGH_RISK_PCT}",
                "Moderate Risk": f"opioid_percentage > {MODERATE_RISK_PCT}",
            },
            otherwise="Low Risk",
        ),
    })


def risk_tiers(providers: DataFrame) -> DataFrame:
    """Providers and claims per risk tier; no opioid percentage counts as Low."""
    return calculated_fields(providers).groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("provider_count"), F.sum("provider_total_claims").alias("total_claims")
    )


def top_providers(providers: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` providers with most claims; ties go by npi and the other keys."""
    return providers.orderBy(
        F.desc("provider_total_claims"), "npi", "provider_name", "provider_city",
        "provider_state", "provider_zip", "specialty",
    ).limit(n)


def top_drugs(drugs: DataFrame, n: int = 25) -> DataFrame:
    """The ``n`` drugs with most claims; ties go by the drug's keys."""
    return drugs.orderBy(F.desc("drug_total_claims"), "drug_name", "generic_name", "risk_category").limit(n)


def with_state_average(providers: DataFrame) -> DataFrame:
    """Each provider beside the mean opioid percentage of the state.

    Aggregated and joined back instead of a window, so that no task has to
    hold all providers of a large state.
    """
    means = providers.groupBy("provider_state").agg(F.avg("opioid_percentage").alias("state_avg_opioid_pct"))
    return join_on_groups(providers, means, ["provider_state"])


def rank_in_state(providers: DataFrame) -> DataFrame:
    """Rank of each provider in the state by opioid claims; none at all comes last."""
    return with_rank(providers, ["provider_state"], "provider_opioid_claims", "state_rank")


def opioid_trend_line(providers: DataFrame) -> DataFrame:
    """Least-squares line of opioid percentage over claims, all providers."""
    y, x = "opioid_percentage", "provider_total_claims"
    return providers.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("provider_count"),
    )


def drug_quadrants(drugs: DataFrame) -> DataFrame:
    """High or low volume and unit cost per drug, split at the means of all drugs.

    The means are one row, read as a scalar subquery, which computes ``drugs``
    a second time: pass a written mart rather than a lazy one.
    """
    means = drugs.agg(
        F.struct(F.avg("drug_total_claims").alias("claims"), F.avg("avg_cost_per_claim").alias("cost"))
    ).scalar()
    volume = F.when(F.col("drug_total_claims") >= means["claims"], "High volume").otherwise("Low volume")
    cost = F.when(F.col("avg_cost_per_claim") >= means["cost"], "high cost").otherwise("low cost")
    return drugs.withColumn("quadrant", F.concat_ws(", ", volume, cost))


def specialty_shares(specialties: DataFrame) -> DataFrame:
    """Each category's share of its specialty; a window group is one row per category."""
    total = F.sum("specialty_claims").over(Window.partitionBy("specialty"))
    return specialties.withColumn("specialty_total_claims", total).withColumn(
        "claim_share_pct", percent("specialty_claims", "specialty_total_claims")
    )


def top_providers_by_specialty(providers: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` providers with most claims in each specialty."""
    ties = ("npi", "provider_name", "provider_city", "provider_state", "provider_zip")
    return first_n(providers, ["specialty"], "provider_total_claims", ties, n, "specialty_rank")


def state_tooltip(providers: DataFrame) -> DataFrame:
    """Per state: opioid claims, providers with opioid claims, mean opioid percentage.

    Grouped by provider first, which makes the distinct count a plain count
    and spreads a large state over many tasks.
    """
    per_provider = providers.groupBy("provider_state", "npi").agg(
        F.sum("provider_opioid_claims").alias("opioid_claims"),
        F.sum("opioid_percentage").alias("pct_sum"),
        F.count("opioid_percentage").alias("pct_rows"),
    )
    return per_provider.groupBy("provider_state").agg(
        F.sum("opioid_claims").alias("total_opioid_claims"),
        F.count("npi").alias("provider_count"),
        F.count_if(F.col("npi").isNotNull() & (F.col("opioid_claims") > 0)).alias("opioid_provider_count"),
        ratio("sum(pct_sum)", "sum(pct_rows)").alias("avg_opioid_pct"),
    )


def filtered(
    df: DataFrame,
    states: Sequence[str] | None = None,
    years: Sequence[int] | None = None,
    categories: Sequence[str] | None = None,
    opioid_pct: tuple[float, float] | None = None,
) -> DataFrame:
    """The dashboard's selections; None leaves a field alone."""
    for column, chosen in (("provider_state", states), ("report_year", years), ("risk_category", categories)):
        if chosen is not None:
            df = df.filter(F.col(column).isin(list(chosen)))
    if opioid_pct is not None:
        df = df.filter(F.col("opioid_percentage").between(*opioid_pct))
    return df


def zip_drilldown(zips: DataFrame, state: str) -> DataFrame:
    """The ZIPs of one state."""
    return zips.filter(F.col("provider_state") == state)
