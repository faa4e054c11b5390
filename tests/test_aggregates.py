from datetime import date

import pytest
from conftest import make_claims
from pyspark.sql import functions as F

from claimlens.operators import dashboard, enrich, geo, marts, temporal
from claimlens.operators.classify import flag_risk
from claimlens.operators.clean import clean
from claimlens.schemas import CENSUS


@pytest.fixture
def fact(spark):
    """Six claims of three providers; P3 has no opioid, P1 two rows of one drug."""
    rows = [
        {"npi": "P1", "drug_name": "NORCO", "total_claims": 40, "total_cost": 100, "provider_zip": "02101"},
        {"npi": "P1", "drug_name": "NORCO", "total_claims": 20, "total_cost": 50, "provider_zip": "02101"},
        {"npi": "P1", "drug_name": "XANAX", "total_claims": 40, "total_cost": 300, "provider_zip": "02101"},
        {"npi": "P2", "drug_name": "NORCO", "total_claims": 90, "total_cost": 900, "provider_state": "CA"},
        {"npi": "P2", "drug_name": "PLAIN", "total_claims": 10, "total_cost": 10, "provider_state": "CA"},
        {"npi": "P3", "drug_name": "PLAIN", "total_claims": 30, "total_cost": "0.03", "provider_state": None},
    ]
    return flag_risk(clean_all(make_claims(spark, rows)))


def clean_all(df):
    from dataclasses import replace

    from claimlens.config import DEFAULTS

    return clean(df, replace(DEFAULTS, min_claims=1))


def by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_left_join_keeps_every_claim_once(spark, fact):
    registry = spark.createDataFrame(
        [("P1", "Org B", "NY"), ("P1", "Org A", "CA"), ("P2", "Org C", None)],
        "npi string, org_name string, npi_state string",
    )
    joined = enrich.enrich(fact, registry)
    assert joined.count() == fact.count()
    got = {r.npi: (r.org_name, r.npi_state) for r in joined.collect()}
    assert got == {"P1": ("Org B", "NY"), "P2": ("Org C", None), "P3": (None, None)}
    assert [tuple(r) for r in enrich.unmatched_providers(fact, registry).collect()] == [("P3", 1)]


def test_keep_latest_does_not_depend_on_row_order(spark):
    rows = [(1, date(2020, 1, 1), 5, "old"), (1, date(2021, 1, 1), 4, "tie"), (1, date(2021, 1, 1), 6, "win"),
            (2, None, 1, "only")]
    schema = "k int, d date, o int, v string"
    expected = {(1, date(2021, 1, 1), 6, "win"), (2, None, 1, "only")}
    for ordering in (rows, rows[::-1]):
        got = enrich.keep_latest(spark.createDataFrame(ordering, schema), "k", ["d", "o"])
        assert got.columns == ["k", "d", "o", "v"]
        assert set(map(tuple, got.collect())) == expected


def test_state_aggregate(fact):
    got = by(geo.geo_aggregate(fact), "provider_state", "risk_category")
    ny = got["NY", "OPIOID"]
    assert (ny.state_total_claims, ny.state_total_cost, ny.state_provider_count) == (60, 150.0, 1)
    assert ny.state_beneficiary_count == 10 and ny.state_avg_cost_per_claim == 2.5
    assert got[None, "STANDARD"].state_total_cost == 0.03
    assert len(got) == 5


def test_state_and_provider_marts_have_the_same_totals(fact):
    states = geo.geo_aggregate(fact).agg(F.sum("state_total_claims"), F.round(F.sum("state_total_cost"), 2)).first()
    providers = marts.provider_summary(fact).agg(
        F.sum("provider_total_claims"), F.round(F.sum("provider_total_cost"), 2)).first()
    assert tuple(states) == tuple(providers) == (230, 1360.03)


def test_zip_counts_opioids_only_and_keeps_zeros(fact):
    got = by(geo.zip_opioid(fact), "provider_zip", "provider_state")
    assert set(got) == {("02101", "NY"), ("10001", "CA")}
    assert got["02101", "NY"].zip_opioid_claims == 60


def test_county_through_a_crosswalk(spark, fact):
    crosswalk = spark.createDataFrame(
        [("02101", "SUFFOLK"), ("02101", "ESSEX"), ("10001", "NEW YORK")],
        "provider_zip string, provider_county string")
    counties = geo.geo_aggregate(geo.add_county(fact, crosswalk), "county")
    got = by(counties, "provider_county", "risk_category")
    assert got["ESSEX", "OPIOID"].county_total_claims == 60
    assert counties.agg(F.sum("county_total_claims")).first()[0] == 230


def test_rollup_tells_subtotals_from_null_keys(fact):
    got = {(r.geo_level, r.provider_state, r.provider_zip): r.total_claims for r in geo.geo_rollup(fact).collect()}
    assert got["all", None, None] == 230
    assert got["state", None, None] == 30 and got["zip", None, "10001"] == 30
    assert got["state", "NY", None] == 100


def test_per_capita_is_null_without_population(spark, fact):
    census = spark.createDataFrame([("state", "NY", 1000), ("zip", "CA", 5)], CENSUS)
    got = by(geo.per_capita(geo.geo_aggregate(fact), census, "provider_state", "state_total_claims"),
             "provider_state", "risk_category")
    assert got["NY", "OPIOID"].claims_per_100k == 6000.0
    assert got["CA", "OPIOID"].claims_per_100k is None


def ranked_states(spark):
    rows = [(f"S{i:02d}", "OPIOID", i * 100, 0 if i == 1 else i) for i in range(1, 21)]
    return spark.createDataFrame(
        rows, "provider_state string, risk_category string, state_total_claims bigint, state_beneficiary_count bigint")


@pytest.mark.parametrize("descending, flagged", [(False, "S20"), (True, "S01")])
def test_hotspot_is_the_top_or_by_choice_the_bottom(spark, descending, flagged):
    got = geo.hotspots(ranked_states(spark), descending=descending)
    assert [r.provider_state for r in dashboard.hotspots_only(got).collect()] == [flagged]
    assert tuple(geo.hotspot_counts(got).first()) == ("OPIOID", 1)


def test_hotspot_threshold_and_zero_beneficiaries(spark):
    got = by(geo.hotspots(ranked_states(spark), percentile=0.75), "provider_state")
    assert sum(r.is_hotspot for r in got.values()) == 5
    assert got["S01",].claims_per_beneficiary is None and got["S02",].claims_per_beneficiary == 100.0


def test_top_states_break_ties_by_name(spark):
    rows = [("B", "OPIOID", 5), ("A", "OPIOID", 5), ("C", "OPIOID", 9), ("D", "STANDARD", 99)]
    df = spark.createDataFrame(rows, "provider_state string, risk_category string, state_total_claims bigint")
    assert [r.provider_state for r in geo.top_states(df, 2).collect()] == ["C", "A"]


def test_provider_without_opioids_is_null_or_zero(fact):
    got = by(marts.provider_summary(fact), "npi")
    p1, p3 = got["P1",], got["P3",]
    assert (p1.provider_total_claims, p1.provider_opioid_claims, p1.provider_highrisk_claims) == (100, 60, 100)
    assert (p1.opioid_percentage, p1.unique_drugs_prescribed) == (60.0, 2)
    assert p3.provider_opioid_claims is None and p3.opioid_percentage is None
    filled = by(marts.provider_summary(fact, zero_fill=True), "npi")["P3",]
    assert (filled.provider_opioid_claims, filled.provider_highrisk_claims, filled.opioid_percentage) == (0, 0, 0.0)
    assert len(marts.main_dashboard(marts.provider_summary(fact)).columns) == 13


def test_drug_and_specialty_marts_are_sorted(fact):
    drugs = [r.drug_name for r in marts.drug_summary(fact).collect()]
    assert drugs[0] == "NORCO"
    claims = [r.specialty_claims for r in marts.specialty_risk(fact).collect()]
    assert claims == sorted(claims, reverse=True) == [150, 40, 40]


def dated(spark):
    rows = [
        {"npi": "P1", "total_claims": 20, "total_cost": 20}, {"npi": "P2", "total_claims": 30, "total_cost": 60},
        {"npi": "P1", "total_claims": 100, "total_cost": 100}, {"npi": "P1", "total_claims": 50, "total_cost": 50},
    ]
    days = [date(2019, 1, 5), date(2019, 4, 1), date(2020, 1, 1), date(2022, 12, 31)]
    df = flag_risk(clean_all(make_claims(spark, rows)))
    when = F.element_at(F.array(*[F.lit(d) for d in days]), F.when(F.col("total_claims") == 20, 1).when(
        F.col("total_claims") == 30, 2).when(F.col("total_claims") == 100, 3).otherwise(4))
    return temporal.add_calendar(df.withColumn("day", when), "day")


def test_trends_per_level(spark):
    df = dated(spark)
    assert [(r.report_year, r.yearly_claims, r.yearly_providers, r.avg_cost_per_claim)
            for r in temporal.trends(df).collect()] == [(2019, 50, 2, 1.5), (2020, 100, 1, 1.0), (2022, 50, 1, 1.0)]
    assert [(r.report_quarter, r.quarterly_claims) for r in temporal.trends(df, "quarter").collect()] == [
        ("Q1", 20), ("Q2", 30), ("Q1", 100), ("Q4", 50)]
    assert [r.report_month for r in temporal.trends(df, "month").collect()] == [1, 4, 1, 12]


def test_year_over_year_names_the_previous_year(spark):
    yearly = temporal.trends(dated(spark))
    got = [(r.report_year, r.prev_year, r.claims_change, r.claims_change_pct)
           for r in temporal.year_over_year(yearly).orderBy("report_year").collect()]
    assert got == [(2019, None, None, None), (2020, 2019, 50, 100.0), (2022, 2020, -50, -50.0)]
    means = {r.avg_yearly_claims for r in temporal.reference_average(yearly).collect()}
    assert means == {200 / 3}
