"""Aggregates per state, ZIP and other geographies, and their hotspots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.config import DEFAULTS, GEO_LEVELS
from claimlens.functions.columns import ratio
from claimlens.functions.joins import join_unique
from claimlens.functions.ranking import with_percent_rank
from claimlens.functions.sketches import sketch_sql
from claimlens.operators.aggregate import CENTS, CLAIMS, COST, PATIENTS, PROVIDERS, UNIT_COST, Grouping
from claimlens.operators.temporal import TIME_KEYS

# A level's own key below the state's.
BELOW_STATE = {"zip": ("provider_zip",), "county": ("provider_county",), "state": ()}
GEO_COLUMNS = dict(zip(GEO_LEVELS, ("provider_state", "provider_zip", "provider_county")))

# An opioid row always has risk_category OPIOID; naming both lets a reader of
# the clean layer skip the folders of the other categories.
OPIOID_ROWS = "is_opioid = 1 AND risk_category = 'OPIOID'"


def geo_grouping(level: str = "state", column: str | None = None) -> Grouping:
    return Grouping(
        keys=(column or GEO_COLUMNS[level], "risk_category"),
        measures={
            f"{level}_total_claims": CLAIMS,
            f"{level}_total_cost": COST,
            f"{level}_provider_count": PROVIDERS,
            f"{level}_beneficiary_count": PATIENTS,
            f"{level}_avg_cost_per_claim": UNIT_COST,
        },
    )


ZIP_OPIOID = Grouping(
    keys=("provider_zip", "provider_state"),
    measures={
        "zip_opioid_claims": CLAIMS,
        "zip_opioid_cost": COST,
        "zip_opioid_providers": PROVIDERS,
        "zip_opioid_beneficiaries": PATIENTS,
    },
    where=OPIOID_ROWS,
)


def geo_aggregate(df: DataFrame, level: str = "state", column: str | None = None) -> DataFrame:
    """Measures per geography and risk category.

    ``level`` names the measures; ``column`` the geography column where it
    differs from the usual one. Counties need :func:`add_county` first.
    """
    return geo_grouping(level, column).of(df)


def add_county(df: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Add ``provider_county`` from a (provider_zip, provider_county) crosswalk.

    A ZIP that lies in several counties goes to the first by name, so that no
    claim is counted twice; :func:`county_weighted` parts its claims instead.
    """
    one_each = crosswalk.groupBy("provider_zip").agg(F.min("provider_county").alias("provider_county"))
    return join_unique(df, one_each, "provider_zip")


def _largest_remainder(amount: str, by: Window) -> Column:
    """A whole amount parted by ``__weight`` of ``__weights``: each part rounded down, the rest to the largest remainders.

    Equal remainders go by county. The products have up to 38 digits, so the parts always add up to the amount.
    """
    product = f"cast(abs({amount}) AS decimal(20)) * __weight"
    floor, remainder = F.expr(f"({product}) div __weights"), F.expr(f"({product}) % __weights")
    left = F.expr(f"abs({amount})") - F.sum(floor).over(by)
    order = F.row_number().over(by.orderBy(remainder.desc(), F.asc_nulls_last("provider_county")))
    return F.signum(F.col(amount)).cast("bigint") * (floor + F.when(order <= left, 1).otherwise(0))


def county_weighted(df: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Claims, cost and patients per state, county and risk category, where a ZIP may lie in several counties.

    ``crosswalk`` holds (provider_zip, provider_county, weight), the weight
    being a whole number such as addresses; rows of one pair add up, weights
    that aren't positive don't count. The claims, cents and patients of each
    ZIP are parted among its counties by weight, by largest remainder, so
    county sums equal state sums exactly. A ZIP that the crosswalk doesn't
    hold keeps its claims under county NULL. The windows run over the counties
    of one ZIP.
    """
    keys = ("provider_state", "provider_zip", "risk_category")
    measured = {"__claims": CLAIMS, "__cents": CENTS, "__patients": PATIENTS}
    zips = Grouping(keys, measured).of(df)
    pairs = crosswalk.filter("weight > 0").groupBy("provider_zip", "provider_county").agg(F.expr("sum(cast(weight AS decimal(18)))").alias("__weight"))
    pairs = pairs.withColumn("__weights", F.sum("__weight").over(Window.partitionBy("provider_zip")))
    pairs = pairs.select(F.col("provider_zip").alias("__zip"), "provider_county", F.expr("cast(__weight AS decimal(18))").alias("__weight"), F.expr("cast(__weights AS decimal(18))").alias("__weights"))
    met = zips.join(pairs, F.col("provider_zip") == F.col("__zip"), "left").fillna({"__weight": 1, "__weights": 1})
    by = Window.partitionBy(*keys)
    parted = met.withColumns({m: _largest_remainder(m, by) for m in measured})
    return parted.groupBy("provider_state", "provider_county", "risk_category").agg(
        F.sum("__claims").alias("county_total_claims"),
        F.expr("cast(sum(__cents) AS double) / 100 AS county_total_cost"),
        F.sum("__patients").alias("county_beneficiary_count"),
    )


def geo_time_sets(df: DataFrame, providers: str | None = "exact") -> DataFrame:
    """Claims, cost and providers by ZIP, county and state, each by month, quarter and year, in one pass.

    ``geo_level`` and ``time_level`` tell which of the nine a row belongs to;
    the keys of the finer levels are NULL in it. Counties are left out where
    ``df`` has none (:func:`add_county`). The claims are first summed by
    provider and month, so that what is multiplied by the sets is small.
    ``providers`` is ``exact``, ``sketch`` (an estimate within
    ``sketches.error_bound``, without a row per provider), or None.
    """
    if providers not in ("exact", "sketch", None):
        raise ValueError(f"providers must be 'exact', 'sketch' or None, not {providers!r}")
    levels = [g for g in BELOW_STATE if GEO_COLUMNS[g] in df.columns]
    times = {t: TIME_KEYS[t] for t in ("month", "quarter", "year")}
    columns = ["provider_state", *(c for g in levels for c in BELOW_STATE[g]), "report_year", "report_quarter", "report_month"]
    sets = [["provider_state", *BELOW_STATE[g], *times[t]] for g in levels for t in times]
    sums = {"total_claims": CLAIMS, "__cents": CENTS}
    if providers == "sketch":
        sums["__sketch"] = sketch_sql("npi")
    finest = Grouping((*columns, "npi") if providers == "exact" else tuple(columns), sums).of(df)

    def level(names: dict[str, tuple[str, ...]], last: str) -> Column:
        """The first of the levels, from the finest on, whose own key is grouped by."""
        out = F.lit(last)
        for name, own in reversed(names.items()):
            if name != last:
                out = F.when(F.grouping(own[-1]) == 0, name).otherwise(out)
        return out

    measures = [F.sum("total_claims").alias("total_claims"), F.expr("cast(sum(__cents) AS double) / 100 AS total_cost")]
    if providers == "exact":
        measures.append(F.countDistinct("npi").alias("provider_count"))
    elif providers == "sketch":
        measures.append(F.hll_sketch_estimate(F.hll_union_agg("__sketch")).alias("provider_count"))
    return finest.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        level({g: BELOW_STATE[g] for g in levels}, "state").alias("geo_level"),
        level(times, "year").alias("time_level"),
        *measures,
    )


def zip_opioid(df: DataFrame) -> DataFrame:
    """Opioid measures per ZIP and state."""
    return ZIP_OPIOID.of(df)


def geo_rollup(df: DataFrame) -> DataFrame:
    """Claims and cost per (state, ZIP), per state and in total.

    ``geo_level`` tells a subtotal from a group whose key is NULL.
    """
    level = F.when(F.grouping_id() == 0, "zip").when(F.grouping_id() == 1, "state").otherwise("all")
    return df.rollup("provider_state", "provider_zip").agg(
        level.alias("geo_level"), F.expr(CLAIMS).alias("total_claims"), F.expr(COST).alias("total_cost")
    )


def per_capita(geo: DataFrame, census: DataFrame, key: str, claims: str, level: str = "state") -> DataFrame:
    """Add population and claims per 100,000 inhabitants (NULL where unknown)."""
    people = (
        census.filter(F.col("geo_level") == level)
        .groupBy(F.col("geo_key").alias(key))
        .agg(F.max("population").alias("population"))
    )
    return join_unique(geo, people, key).withColumn(
        "claims_per_100k", ratio(claims, "population") * 100000
    )


def _hotspot_flag(rank: str, percentile: float) -> Column:
    return F.when(F.col(rank) >= percentile, 1).otherwise(0)


def hotspots(
    geo: DataFrame,
    claims: str = "state_total_claims",
    beneficiaries: str = "state_beneficiary_count",
    percentile: float = DEFAULTS.hotspot_percentile,
    descending: bool = False,
    rank: str = "state_opioid_rank",
) -> DataFrame:
    """Percent rank by claims inside each risk category; flag ranks >= percentile.

    Ascending order flags the highest volumes; ``descending=True`` the lowest.
    Takes the state aggregate: a window group holds one row per state.
    """
    by_claims = F.desc_nulls_last(claims) if descending else F.asc_nulls_last(claims)
    w = Window.partitionBy("risk_category").orderBy(by_claims)
    return geo.withColumns({
        "claims_per_beneficiary": ratio(claims, beneficiaries),
        rank: F.percent_rank().over(w),
    }).withColumn("is_hotspot", _hotspot_flag(rank, percentile))


def zip_hotspots(
    zips: DataFrame, percentile: float = DEFAULTS.hotspot_percentile, descending: bool = False
) -> DataFrame:
    """The same over all ZIPs of the country, without one task sorting them all."""
    ranked = with_percent_rank(zips, (), "zip_opioid_claims", "zip_opioid_rank", descending)
    return ranked.withColumns({
        "claims_per_beneficiary": ratio("zip_opioid_claims", "zip_opioid_beneficiaries"),
        "is_hotspot": _hotspot_flag("zip_opioid_rank", percentile),
    })


def hotspot_counts(flagged: DataFrame) -> DataFrame:
    """Flagged geographies per risk category."""
    return flagged.filter("is_hotspot = 1").groupBy("risk_category").agg(F.count(F.lit(1)).alias("hotspot_count"))


def top_states(geo: DataFrame, n: int = 10, category: str = "OPIOID") -> DataFrame:
    """The ``n`` states with most claims of a category; ties go by name."""
    return (
        geo.filter(F.col("risk_category") == category)
        .orderBy(F.desc_nulls_last("state_total_claims"), F.asc_nulls_last("provider_state"))
        .limit(n)
    )
