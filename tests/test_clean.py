from datetime import date

import pytest
from conftest import make_claims

from claimlens.config import DEFAULTS
from claimlens.operators import clean, temporal


def values(df, column):
    return [r[column] for r in df.collect()]


def test_rename_ignores_absent_columns(spark):
    df = spark.createDataFrame([("1", 12, "x")], "npi string, total_claim_count int, other string")
    assert clean.rename_columns(df).columns == ["npi", "total_claims", "other"]


def test_claims_below_eleven_are_dropped(spark, claims):
    low = make_claims(spark, [{"npi": "99999", "total_claims": 5}])
    kept = clean.keep_valid(claims.union(low), only=["LOW_CLAIMS"])
    assert kept.count() == 5
    assert "99999" not in values(kept, "npi")


@pytest.mark.parametrize("row, reason", [
    ({"npi": None}, "MISSING_NPI"),
    ({"npi": ""}, "KEPT"),
    ({"drug_name": None}, "MISSING_DRUG"),
    ({"total_claims": None}, "MISSING_CLAIMS"),
    ({"total_claims": 10}, "LOW_CLAIMS"),
    ({"total_claims": 11}, "KEPT"),
    ({"total_claims": 10, "beneficiary_count": None}, "LOW_CLAIMS"),
    ({"beneficiary_count": None}, "LOW_BENEFICIARIES"),
    ({"beneficiary_count": 0}, "LOW_BENEFICIARIES"),
    ({"beneficiary_count": 1}, "KEPT"),
    ({"total_cost": None}, "HIGH_COST_PER_CLAIM"),
    ({"total_claims": 20, "total_cost": "1000000.00"}, "KEPT"),
    ({"total_claims": 20, "total_cost": "1000000.01"}, "HIGH_COST_PER_CLAIM"),
    ({"total_day_supply": 0, "total_fills": 0.0}, "KEPT"),
])
def test_each_rule_and_its_edge(spark, row, reason):
    df = make_claims(spark, [row])
    assert df.select(clean.reject_reason().alias("r")).first().r == reason
    assert clean.keep_valid(df).count() == (1 if reason == "KEPT" else 0)
    assert clean.rejected(df).count() == (0 if reason == "KEPT" else 1)


def test_reject_summary_and_counts_agree(spark):
    df = make_claims(spark, [{}, {"npi": None}, {"total_claims": 3}, {"total_claims": 4}])
    assert {r.reject_reason: r.row_count for r in clean.reject_summary(df).collect()} == {
        "MISSING_NPI": 1, "LOW_CLAIMS": 2,
    }
    counts = clean.clean_counts(df).first()
    assert (counts.initial_count, counts.clean_count, counts.removed_count, counts.removed_pct) == (4, 1, 3, 75.0)
    assert clean.clean_counts(df.limit(0)).first().removed_pct is None


def test_text_is_normalised(spark):
    row = {"drug_name": " oxy codone ", "generic_name": None, "provider_state": " ny", "specialty": " Pain Mgmt "}
    got = clean.normalize_text(make_claims(spark, [row])).first()
    assert (got.drug_name, got.generic_name, got.provider_state, got.specialty) == (
        "OXY CODONE", None, "NY", "Pain Mgmt",
    )


def test_ratios(claims):
    first = clean.derived_metrics(claims).filter("drug_name = 'TAPENTADOL ER'").first()
    assert first.cost_per_claim == 25.0
    assert first.cost_per_day == 2.0
    assert first.avg_day_supply == 25.0


def test_zero_divisors_give_null(spark):
    got = clean.clean(make_claims(spark, [{"total_day_supply": 0, "total_fills": 0.0}])).first()
    assert got.cost_per_day is None and got.avg_day_supply is None
    assert got.cost_per_claim == 5.0 and got.data_quality == "CLEAN"


def test_clean_twice_is_clean_once(claims):
    once = clean.clean(claims)
    assert sorted(once.collect()) == sorted(clean.clean(once).collect())


def test_texts_that_are_no_dates(spark):
    df = spark.createDataFrame([("2023-03-04",), ("2023-13-45",), ("soon",), ("soon",), (None,)], "filed string")
    got = {(r.filed, r.report_year, r.report_quarter) for r in temporal.add_calendar(df, "filed").collect()}
    assert got == {("2023-03-04", 2023, "Q1"), ("2023-13-45", None, None), ("soon", None, None), (None, None, None)}
    bad = {(r.date_text, r.row_count) for r in temporal.bad_dates(df, "filed").collect()}
    assert bad == {("2023-13-45", 1), ("soon", 2)}


def test_blank_state_is_null(spark):
    got = clean.clean(make_claims(spark, [{"provider_state": "  "}, {"provider_state": " or "}]))
    assert {r.provider_state for r in got.collect()} == {None, "OR"}


def test_calendar_from_date(spark):
    df = spark.createDataFrame([(date(2021, 5, 17),), (None,)], "filed date")
    got = temporal.add_calendar(df, "filed").collect()
    assert tuple(got[0])[1:] == (date(2021, 5, 17), 2021, "Q2", 5)
    assert tuple(got[1])[1:] == (None, None, None, None)


def test_calendar_from_year(spark):
    df = spark.createDataFrame([(1,)], "x int")
    got = temporal.add_calendar(df, year=2022, quarter="Q4").first()
    assert (got.report_date, got.report_year, got.report_quarter, got.report_month) == (None, 2022, "Q4", None)
    with pytest.raises(ValueError):
        temporal.add_calendar(df)


def test_defaults_are_the_published_rules():
    assert (DEFAULTS.min_claims, DEFAULTS.max_cost_per_claim, DEFAULTS.min_beneficiaries) == (11, 50000, 1)
    assert [len(words) for _, _, words in DEFAULTS.risk_lists] == [15, 9, 8]
