"""Every operator as a query over the star tables: name -> (spark, sf_dir) -> DataFrame.

Averages and other floating-point sums are shown to ten significant digits,
because their last digits depend on the order of the rows; exact ratios are not.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.functions import sketches
from claimlens.operators import classify, clean, dashboard, enrich, geo, marts, quality, temporal
from claimlens.plans import star_tables as star
from claimlens.plans.transformation import marts_of
from claimlens.schemas import PROVIDER_DRUG_NAMES
from claimlens.sources.readers import union_years

Query = Callable[[SparkSession, str], DataFrame]

CLAIM_KEY = ("npi", "drug_name", "generic_name", "report_date")
CLAIM_MEASURES = ("total_claims", "total_fills", "total_day_supply", "total_cost", "beneficiary_count")
ROUNDED = (
    "avg_cost_per_claim", "state_avg_cost_per_claim", "county_avg_cost_per_claim",
    "avg_opioid_pct", "state_avg_opioid_pct", "slope", "intercept", "r2",
)


def significant(column: str) -> Column:
    """Ten significant digits of numbers from 1e-9 up; smaller ones to 19 decimals."""
    value = F.col(column)
    out = F.round(value, 19)
    for power in range(-9, 12):
        out = F.when(F.abs(value) >= float(f"1e{power}"), F.round(value, 9 - power)).otherwise(out)
    return F.when(value.isNotNull(), out)


def _present(df: DataFrame) -> DataFrame:
    """Money as double, floating-point averages to ten significant digits."""
    rounded = {c: significant(c) for c in df.columns if c in ROUNDED}
    # A score is a difference from a mean, so its absolute digits are what engines agree in.
    rounded |= {c: F.round(c, 7) for c in df.columns if c.endswith("_zscore")}
    money = {c: F.col(c).cast("double") for c, kind in df.dtypes if kind.startswith("decimal")}
    return df.withColumns({**rounded, **money})


def _over_fact(step: Callable[[DataFrame], DataFrame]) -> Query:
    """A query over the raw fact."""
    return lambda spark, sf: _present(star.claims_fact(spark, sf).transform(step))


def _over_flagged(step: Callable[[DataFrame], DataFrame]) -> Query:
    """A query over the cleaned, classified and dated fact."""
    return lambda spark, sf: _present(star.flagged_fact(spark, sf).transform(step))


def _over_providers(step: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_flagged(lambda df: step(marts.provider_summary(df)))


def _over_states(step: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_flagged(lambda df: step(geo.geo_aggregate(df, "state")))


def _over_years(step: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_flagged(lambda df: step(temporal.trends(df, "year", ordered=False)))


def _rule(name: str, **blanked) -> Query:
    """One cleaning rule, after blanking a value so that NULLs occur."""
    def step(df: DataFrame) -> DataFrame:
        df = df.withColumns({c: F.nullif(F.col(c), F.lit(v)) for c, v in blanked.items()})
        rules = ("MISSING_NPI", "MISSING_DRUG", "MISSING_CLAIMS") if name == "MISSING" else (name,)
        kept = clean.keep_valid(df, star.STAR_SETTINGS, rules)
        return kept.select(*CLAIM_KEY, "total_claims", "total_cost", "beneficiary_count")
    return _over_fact(step)


def _flags(*columns: str) -> Query:
    return _over_flagged(lambda df: df.select(*CLAIM_KEY, *columns))


def scan_year_filter(spark: SparkSession, sf: str) -> DataFrame:
    """One year: the date bounds reach the scan of the orders."""
    return _present(star.claims_fact(
        spark, sf,
        "o_orderdate >= timestamp_ntz'1997-01-01' AND o_orderdate < timestamp_ntz'1998-01-01'",
    ))


def union_of_years(spark: SparkSession, sf: str) -> DataFrame:
    """Older years without beneficiary counts, stacked with the later ones."""
    older = star.claims_fact(spark, sf, "o_orderdate < timestamp_ntz'1998-01-01'")
    later = star.claims_fact(spark, sf, "o_orderdate >= timestamp_ntz'1998-01-01'")
    return _present(union_years([later, older.drop("beneficiary_count")]))


def rename_columns(spark: SparkSession, sf: str) -> DataFrame:
    raw = {new: old for old, new in PROVIDER_DRUG_NAMES.items()}
    providers = star.providers(spark, sf).drop("o_custkey")
    return providers.withColumnsRenamed(raw).transform(clean.rename_columns)


def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    parts = star.table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lit("  "), F.lower("p_name"), F.lit(" ")).alias("drug_name"),
        F.lower("p_type").alias("generic_name"),
        F.concat(F.lit(" "), F.lower("p_brand")).alias("provider_state"),
        F.concat(F.initcap("p_type"), F.lit("  ")).alias("specialty"),
    )
    return clean.normalize_text(parts)


def risk_from_reference(spark: SparkSession, sf: str) -> DataFrame:
    listed = classify.risk_from_reference(
        star.flagged_fact(spark, sf), star.drug_reference(spark, sf), star.STAR_SETTINGS
    )
    return listed.select(*CLAIM_KEY, *classify.RISK_FLAGS, "risk_category")


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.enrich(star.flagged_fact(spark, sf), star.registry(spark, sf))


def enrich_left_join(spark: SparkSession, sf: str) -> DataFrame:
    return _enriched(spark, sf).select(*CLAIM_KEY, "total_claims", "org_name", "npi_state")


def registry_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """The latest order of each customer, then the highest order key."""
    latest = enrich.keep_latest(star.table(spark, sf, "orders"), "o_custkey", ("o_orderdate", "o_orderkey"))
    return latest.withColumn("o_orderdate", F.to_date("o_orderdate"))


def enrich_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.unmatched_providers(star.flagged_fact(spark, sf), star.registry(spark, sf))


def profile_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return quality.missing_values(_enriched(spark, sf))


def geo_county(spark: SparkSession, sf: str) -> DataFrame:
    """Counties by the fourth digit of the ZIP, through a crosswalk of the providers' ZIPs."""
    crosswalk = star.providers(spark, sf).selectExpr(
        "provider_zip", "concat('COUNTY_', substr(provider_zip, 4, 1)) AS provider_county"
    )
    return _present(geo.geo_aggregate(geo.add_county(star.flagged_fact(spark, sf), crosswalk), "county"))


def _shared_zips(spark: SparkSession, sf: str) -> DataFrame:
    """Every ZIP in the county of its fourth digit and in that of its fifth, some in none; odd weights, pairs twice."""
    zips = star.providers(spark, sf).select("provider_zip").distinct().filter("substr(provider_zip, 5, 1) <> '9'")
    return zips.selectExpr(
        "provider_zip",
        "explode(array(named_struct('c', substr(provider_zip, 4, 1), 'w', 3L), named_struct('c', substr(provider_zip, 5, 1), 'w', 4L), "
        "named_struct('c', substr(provider_zip, 3, 1), 'w', 0L))) AS x",
    ).selectExpr("provider_zip", "concat('COUNTY_', x.c) AS provider_county", "x.w AS weight")


def geo_county_weighted(spark: SparkSession, sf: str) -> DataFrame:
    return geo.county_weighted(star.flagged_fact(spark, sf), _shared_zips(spark, sf))


def geo_time_sets(spark: SparkSession, sf: str) -> DataFrame:
    county = F.concat(F.lit("COUNTY_"), F.substring("provider_zip", 4, 1))
    return geo.geo_time_sets(star.flagged_fact(spark, sf).withColumn("provider_county", county))


def provider_sketch_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Providers per state from sketches by quarter, specialty and category, beside the exact count and the bound."""
    fact = star.flagged_fact(spark, sf)
    rolled = sketches.roll_up(sketches.PROVIDER_SKETCHES.of(fact), ["provider_state"])
    exact = fact.groupBy("provider_state").agg(F.countDistinct("npi").alias("exact_providers"))
    gap = F.abs(F.col("providers") - F.col("exact_providers"))
    return rolled.join(exact, "provider_state").select(
        "provider_state", "total_claims", "exact_providers", (gap <= F.col("exact_providers") * sketches.error_bound()).cast("int").alias("within_bound")
    )


def quality_score(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_score(_enriched(spark, sf), ["npi", "drug_name", "org_name"])


def geo_per_capita(spark: SparkSession, sf: str) -> DataFrame:
    states = geo.geo_aggregate(star.flagged_fact(spark, sf), "state")
    return _present(geo.per_capita(states, star.census(spark, sf), "provider_state", "state_total_claims"))


def reconcile_geo(spark: SparkSession, sf: str) -> DataFrame:
    """Claims and providers per state, from the fact without one state, against totals of other rows.

    The supplied side is of the orders alone: their number by the customers'
    nations, without another state. So keys are missing on either side.
    """
    own = (
        star.claims_fact(spark, sf)
        .filter("provider_state <> 'NATION_4'")
        .groupBy("provider_state")
        .agg(F.sum("total_claims").alias("claims"), F.countDistinct("npi").alias("providers"))
    )
    supplied = (
        star.table(spark, sf, "orders")
        .join(star.providers(spark, sf), "o_custkey")
        .filter("provider_state <> 'NATION_9'")
        .groupBy("provider_state")
        .agg((F.count(F.lit(1)) * 100).alias("claims"), F.countDistinct("npi").alias("providers"))
    )
    return quality.reconcile_all(own, supplied, ["provider_state"], ["claims", "providers"], tolerance=1000)


def _reference_with_odd_categories(spark: SparkSession, sf: str) -> DataFrame:
    """The reference table with categories in mixed case, and some that no setting knows."""
    spelled = """CASE length(drug_name) % 4 WHEN 0 THEN concat(' ', lower(risk_category)) WHEN 1 THEN risk_category
        WHEN 2 THEN concat(risk_category, ' OTHER') END"""
    return star.drug_reference(spark, sf).withColumn("risk_category", F.expr(spelled))


def reference_unknown(spark: SparkSession, sf: str) -> DataFrame:
    return classify.unknown_categories(_reference_with_odd_categories(spark, sf), star.STAR_SETTINGS)


def pipeline_stats_reference(spark: SparkSession, sf: str) -> DataFrame:
    reference = _reference_with_odd_categories(spark, sf)
    return quality.run_statistics(star.claims_fact(spark, sf), star.STAR_SETTINGS, reference)


def outliers_zscore(spark: SparkSession, sf: str) -> DataFrame:
    """Unit cost of the rows that pass all rules but the cost cap."""
    rules = [r for r in clean.keep_rules(star.STAR_SETTINGS) if r != "HIGH_COST_PER_CLAIM"]
    rows = star.claims_fact(spark, sf).transform(clean.keep_valid, star.STAR_SETTINGS, rules)
    scored = quality.outliers(clean.derived_metrics(rows), "cost_per_claim")
    return _present(scored.select(
        *CLAIM_KEY, "cost_per_claim", "cost_per_claim_zscore", "cost_per_claim_is_outlier"
    ))


def dashboard_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Two states, three years, two categories; providers with 20 to 80 percent opioids."""
    rows = dashboard.filtered(
        star.flagged_fact(spark, sf),
        states=["NATION_1", "NATION_7"], years=[1996, 1997, 1998], categories=["OPIOID", "STANDARD"],
    )
    return _present(dashboard.filtered(marts.provider_summary(rows), opioid_pct=(20, 80)))


def _hotspots(df: DataFrame, **options) -> DataFrame:
    return geo.hotspots(geo.geo_aggregate(df, "state"), **options)


QUERIES: dict[str, Query] = {
    "scan_year_filter": scan_year_filter,
    "union_years": union_of_years,
    "rename_columns": rename_columns,
    "filter_required": _rule("MISSING", npi="7", drug_name="RED BOLT", total_claims=20),
    "filter_privacy": _rule("LOW_CLAIMS", total_claims=20),
    "filter_beneficiaries": _rule("LOW_BENEFICIARIES", beneficiary_count=2),
    "filter_cost_cap": _rule("HIGH_COST_PER_CLAIM", total_claims=20),
    "normalize_text": normalize_text,
    "derived_metrics": _over_fact(lambda df: clean.derived_metrics(df).select(
        *CLAIM_KEY, "cost_per_claim", "cost_per_day", "avg_day_supply")),
    "clean_full": _over_fact(lambda df: clean.clean(df, star.STAR_SETTINGS)),
    "clean_counts": _over_fact(lambda df: clean.clean_counts(df, star.STAR_SETTINGS)),
    "reject_reasons": _over_fact(lambda df: clean.reject_summary(df, star.STAR_SETTINGS)),
    "flag_opioid": _flags("is_opioid"),
    "flag_benzo": _flags("is_benzodiazepine"),
    "flag_stimulant": _flags("is_stimulant"),
    "flag_high_risk": _flags("is_high_risk"),
    "risk_category": _flags(*classify.RISK_FLAGS, "risk_category"),
    "flag_whole_word": _over_fact(lambda df: classify.flag_risk(df, star.STAR_SETTINGS, whole_word=True).select(
        *CLAIM_KEY, *classify.RISK_FLAGS, "risk_category")),
    "risk_from_reference": risk_from_reference,
    "risk_counts": _over_flagged(classify.risk_counts),
    "enrich_left_join": enrich_left_join,
    "registry_dedupe": registry_dedupe,
    "enrich_unmatched": enrich_unmatched,
    "temporal_dims": _flags("report_year", "report_quarter", "report_month"),
    "trend_yearly": _over_flagged(lambda df: temporal.trends(df, "year")),
    "trend_quarterly": _over_flagged(lambda df: temporal.trends(df, "quarter")),
    "trend_monthly": _over_flagged(lambda df: temporal.trends(df, "month")),
    "trend_yoy": _over_years(temporal.year_over_year),
    "trend_reference_avg": _over_years(temporal.reference_average),
    "geo_state": _over_states(lambda states: states),
    "geo_zip_opioid": _over_flagged(geo.zip_opioid),
    "geo_level_region": _over_flagged(lambda df: geo.geo_aggregate(df, "county", "provider_region")),
    "geo_county": geo_county,
    "geo_rollup": _over_flagged(geo.geo_rollup),
    "geo_county_weighted": geo_county_weighted,
    "geo_time_sets": geo_time_sets,
    "provider_sketch_rollup": provider_sketch_rollup,
    "geo_per_capita": geo_per_capita,
    "hotspot_state": _over_flagged(_hotspots),
    "hotspot_state_literal": _over_flagged(lambda df: _hotspots(df, descending=True)),
    "hotspot_threshold_75": _over_flagged(lambda df: _hotspots(df, percentile=0.75)),
    "hotspot_zip": _over_flagged(lambda df: geo.zip_hotspots(geo.zip_opioid(df))),
    "hotspot_count": _over_flagged(lambda df: geo.hotspot_counts(_hotspots(df))),
    "top_states_opioid": _over_states(geo.top_states),
    "mart_provider": _over_providers(lambda providers: providers),
    "mart_provider_zero_fill": _over_flagged(lambda df: marts.provider_summary(df, zero_fill=True)),
    "mart_drug": _over_flagged(marts.drug_summary),
    "mart_specialty": _over_flagged(marts.specialty_risk),
    "mart_main_dashboard": _over_providers(marts.main_dashboard),
    "q_state_opioid": _over_providers(dashboard.opioid_claims_by_state),
    "q_highrisk_providers": _over_providers(dashboard.high_risk_providers),
    "q_hotspots_only": _over_flagged(lambda df: dashboard.hotspots_only(_hotspots(df))),
    "q_state_having": _over_providers(dashboard.states_with_high_opioid_share),
    "q_calc_fields": _over_providers(dashboard.calculated_fields),
    "q_risk_tier": _over_providers(dashboard.risk_tiers),
    "q_top10_states": _over_providers(dashboard.top_opioid_states),
    "q_top100_providers": _over_providers(dashboard.top_providers),
    "q_top25_drugs": _over_flagged(lambda df: dashboard.top_drugs(marts.drug_summary(df, ordered=False))),
    "q_lod_state_avg": _over_providers(lambda p: dashboard.with_state_average(p).select(
        "npi", "provider_state", "opioid_percentage", "state_avg_opioid_pct")),
    "q_rank_in_state": _over_providers(lambda p: dashboard.rank_in_state(p).select(
        "npi", "provider_state", "provider_opioid_claims", "state_rank")),
    "q_trend_line": _over_providers(dashboard.opioid_trend_line),
    "q_drug_quadrants": _over_flagged(lambda df: dashboard.drug_quadrants(marts.drug_summary(df, ordered=False))),
    "q_specialty_share": _over_flagged(lambda df: dashboard.specialty_shares(
        marts.specialty_risk(df, ordered=False))),
    "q_topn_by_specialty": _over_providers(dashboard.top_providers_by_specialty),
    "q_topn_large": _over_providers(lambda p: dashboard.top_providers_by_specialty(p, 2000)),
    "q_state_tooltip": _over_providers(dashboard.state_tooltip),
    "q_dashboard_filter": dashboard_filter,
    "q_zip_drilldown": _over_flagged(lambda df: dashboard.zip_drilldown(geo.zip_opioid(df), "NATION_5")),
    "profile_nulls": profile_nulls,
    "profile_columns": lambda spark, sf: quality.column_profile(_enriched(spark, sf)),
    "quality_score": quality_score,
    "duplicates": _over_flagged(lambda df: quality.duplicates(df, ["npi", "drug_name"])),
    "outliers_zscore": outliers_zscore,
    "pipeline_stats": _over_fact(lambda df: quality.run_statistics(df, star.STAR_SETTINGS)),
    "pipeline_stats_reference": pipeline_stats_reference,
    "reference_unknown": reference_unknown,
    "reconcile_geo": reconcile_geo,
}


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """State hotspots as the whole transformation gives them."""
    fact = enrich.enrich(star.flagged_fact(spark, sf), star.registry(spark, sf))
    return _present(marts_of(fact, star.STAR_SETTINGS)["state_hotspots"])
