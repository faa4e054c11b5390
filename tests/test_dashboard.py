import pytest

from claimlens.operators import dashboard

PROVIDERS = (
    "npi string, provider_name string, provider_city string, provider_state string, provider_zip string, "
    "specialty string, provider_total_claims bigint, provider_total_cost double, provider_opioid_claims bigint, "
    "opioid_percentage double, total_beneficiaries bigint"
)


@pytest.fixture
def providers(spark):
    rows = [
        ("1", "NY", "Pain", 200, 400.0, 100, 50.0, 10),
        ("2", "NY", "Pain", 100, 100.0, 20, 20.0, 0),
        ("3", "NY", "Eye", 300, 30.0, None, None, 30),
        ("4", "CA", "Eye", 500, 50.0, 25, 5.0, 50),
        ("5", "TX", "Eye", 120, 12.0, None, None, 12),
        ("6", None, "Pain", 150, 15.0, 100, 66.0, 15),
    ]
    full = [(n, "N" + n, "C", s, "Z", sp, c, cost, o, pct, b) for n, s, sp, c, cost, o, pct, b in rows]
    return spark.createDataFrame(full, PROVIDERS)


def test_opioid_claims_by_state(providers):
    assert [tuple(r) for r in dashboard.opioid_claims_by_state(providers).collect()] == [
        ("NY", 120), (None, 100), ("CA", 25), ("TX", None)]
    assert [r.provider_state for r in dashboard.top_opioid_states(providers, 2).collect()] == ["NY", None]


def test_thresholds_are_exclusive_and_nulls_are_low(providers):
    assert {r.npi for r in dashboard.high_risk_providers(providers).collect()} == {"1", "6"}
    tiers = {r.npi: r.risk_tier for r in dashboard.calculated_fields(providers).collect()}
    assert tiers == {"1": "High Risk", "2": "Moderate Risk", "3": "Low Risk", "4": "Low Risk", "5": "Low Risk",
                     "6": "High Risk"}
    assert {tuple(r) for r in dashboard.risk_tiers(providers).collect()} == {
        ("High Risk", 2, 350), ("Moderate Risk", 1, 100), ("Low Risk", 3, 920)}
    fields = {r.npi: r for r in dashboard.calculated_fields(providers).collect()}
    assert fields["1"].cost_per_claim == 2.0 and fields["1"].opioid_claim_ratio == 0.5
    assert fields["2"].claims_per_beneficiary is None and fields["3"].opioid_claim_ratio is None


def test_states_with_high_share_need_larger_providers(providers):
    got = [tuple(r) for r in dashboard.states_with_high_opioid_share(providers).collect()]
    assert got == [("NY", 2, 100, 50.0), (None, 1, 100, 66.0)]


def test_top_lists(spark, providers):
    assert [r.npi for r in dashboard.top_providers(providers, 3).collect()] == ["4", "3", "1"]
    top = dashboard.top_providers_by_specialty(providers, 1).collect()
    assert {(r.specialty, r.npi, r.specialty_rank) for r in top} == {("Eye", "4", 1), ("Pain", "1", 1)}


def test_state_average_and_rank(providers):
    means = {r.npi: r.state_avg_opioid_pct for r in dashboard.with_state_average(providers).collect()}
    assert means == {"1": 35.0, "2": 35.0, "3": 35.0, "4": 5.0, "5": None, "6": 66.0}
    ranks = {r.npi: r.state_rank for r in dashboard.rank_in_state(providers).collect()}
    assert ranks == {"1": 1, "2": 2, "3": 3, "4": 1, "5": 1, "6": 1}


def test_tooltip_counts_providers_with_opioids(providers):
    got = {r.provider_state: tuple(r)[1:] for r in dashboard.state_tooltip(providers).collect()}
    assert got == {"NY": (120, 3, 2, 35.0), "CA": (25, 1, 1, 5.0), "TX": (None, 1, 0, None), None: (100, 1, 1, 66.0)}


def test_trend_line_skips_providers_without_percentage(spark):
    df = spark.createDataFrame(
        [(10, 3.0), (20, 5.0), (30, 7.0), (99, None)], "provider_total_claims bigint, opioid_percentage double")
    line = dashboard.opioid_trend_line(df).first()
    assert line.provider_count == 3
    assert (round(line.slope, 9), round(line.intercept, 9), round(line.r2, 9)) == (0.2, 1.0, 1.0)


def test_quadrants_and_shares(spark):
    drugs = spark.createDataFrame(
        [("A", 10, 1.0), ("B", 30, 9.0), ("C", 20, 5.0)],
        "drug_name string, drug_total_claims bigint, avg_cost_per_claim double")
    assert {r.drug_name: r.quadrant for r in dashboard.drug_quadrants(drugs).collect()} == {
        "A": "Low volume, low cost", "B": "High volume, high cost", "C": "High volume, high cost"}
    specialties = spark.createDataFrame(
        [("Eye", "OPIOID", 25), ("Eye", "STANDARD", 75), (None, "STANDARD", 5)],
        "specialty string, risk_category string, specialty_claims bigint")
    shares = {(r.specialty, r.risk_category): r.claim_share_pct
              for r in dashboard.specialty_shares(specialties).collect()}
    assert shares == {("Eye", "OPIOID"): 25.0, ("Eye", "STANDARD"): 75.0, (None, "STANDARD"): 100.0}


def test_filters(providers):
    got = dashboard.filtered(providers, states=["NY", "CA"], opioid_pct=(5, 20))
    assert {r.npi for r in got.collect()} == {"2", "4"}
    assert dashboard.filtered(providers).count() == 6
    assert dashboard.filtered(providers, states=[]).count() == 0
    assert dashboard.zip_drilldown(providers, "NY").count() == 3
