"""Weighted counties, geography by time, and sketches."""

from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from claimlens.functions import sketches
from claimlens.operators import geo, marts
from claimlens.plans import star_tables as star

COLUMNS = ("provider_state string, provider_zip string, risk_category string, total_claims long, total_cost double, "
           "beneficiary_count long")


def parted(amount, weights):
    """Largest remainder with fractions: weights by county."""
    whole = sum(weights.values())
    exact = {c: Fraction(amount * w, whole) for c, w in weights.items()}
    out = {c: int(x) for c, x in exact.items()}
    for c in sorted(exact, key=lambda c: (out[c] - exact[c], c))[: amount - sum(out.values())]:
        out[c] += 1
    return out


def test_shared_zips_are_parted_by_weight(spark):
    rows = [("A", "1", "X", 10, 1.01, 7), ("A", "1", "X", 1, 0.0, 1), ("A", "2", "X", 5, 3.0, None), ("B", "1", "X", 2, 0.03, 2),
            ("A", None, "X", 4, 1.0, 1), ("A", "9", "Y", 6, 2.0, 3)]
    claims = spark.createDataFrame(rows, COLUMNS)
    crosswalk = spark.createDataFrame(
        [("1", "K", 1), ("1", "K", 1), ("1", "L", 2), ("1", "M", 3), ("1", "N", 0), ("2", "K", 10**12), ("2", "M", 10**12 + 1)],
        "provider_zip string, provider_county string, weight long")
    got = {(r.provider_state, r.provider_county, r.risk_category): r for r in geo.county_weighted(claims, crosswalk).collect()}
    one, two, b = parted(11, {"K": 2, "L": 2, "M": 3}), parted(5, {"K": 10**12, "M": 10**12 + 1}), parted(2, {"K": 2, "L": 2, "M": 3})
    assert {k: r.county_total_claims for k, r in got.items()} == {
        ("A", "K", "X"): one["K"] + two["K"], ("A", "L", "X"): one["L"], ("A", "M", "X"): one["M"] + two["M"],
        ("B", "K", "X"): b["K"], ("B", "L", "X"): b["L"], ("B", "M", "X"): b["M"],
        ("A", None, "X"): 4, ("A", None, "Y"): 6,
    }
    cents = parted(101, {"K": 2, "L": 2, "M": 3})
    assert got["A", "L", "X"].county_total_cost == cents["L"] / 100
    assert sum(r.county_beneficiary_count for k, r in got.items() if k[::2] == ("A", "X")) == 9


def test_county_sums_are_state_sums(spark, small_dir):
    fact = star.flagged_fact(spark, small_dir)
    zips = fact.select("provider_zip").distinct()
    crosswalk = zips.selectExpr("provider_zip", "explode(array('P', 'Q', 'R')) AS provider_county").withColumn(
        "weight", F.expr("1 + abs(xxhash64(provider_zip, provider_county)) % 1000"))
    counties = geo.county_weighted(fact, crosswalk).groupBy("provider_state", "risk_category").agg(
        F.sum("county_total_claims").alias("c"), F.expr("round(sum(county_total_cost) * 100)").alias("m"), F.sum("county_beneficiary_count").alias("p"))
    states = fact.groupBy("provider_state", "risk_category").agg(
        F.sum("total_claims").alias("c"), F.expr("round(sum(cast(total_cost AS decimal(18, 2))) * 100)").cast("double").alias("m"), F.sum("beneficiary_count").alias("p"))
    assert sorted(map(tuple, counties.collect())) == sorted(map(tuple, states.collect()))


def test_levels_of_geography_and_time(spark):
    rows = [("A", "1", "p", 2020, "Q1", 1, 5, 1.0), ("A", "1", "q", 2020, "Q1", 2, 6, 2.5), ("A", None, "q", 2020, "Q2", 4, 7, 0.1), (None, "1", "p", None, None, None, 8, 1.0)]
    claims = spark.createDataFrame(rows, "provider_state string, provider_zip string, npi string, report_year int, report_quarter string, report_month int, total_claims long, total_cost double")
    got = geo.geo_time_sets(claims)
    assert "provider_county" not in got.columns
    found = {(r.geo_level, r.time_level, r.provider_state, r.provider_zip, r.report_year, r.report_quarter, r.report_month): (r.total_claims, r.total_cost, r.provider_count) for r in got.collect()}
    assert len(found) == got.count() == 4 + 3 + 3 + 4 + 3 + 2
    assert found["zip", "month", "A", "1", 2020, None, 1] == (5, 1.0, 1)
    assert found["zip", "year", "A", None, 2020, None, None] == (7, 0.1, 1)
    assert found["state", "quarter", "A", None, 2020, "Q1", None] == (11, 3.5, 2)
    assert found["state", "year", "A", None, 2020, None, None] == (18, 3.6, 2)
    assert found["state", "year", None, None, None, None, None] == (8, 1.0, 1)
    sketched = {tuple(r) for r in geo.geo_time_sets(claims, "sketch").collect()}
    assert sketched == {tuple(r) for r in got.collect()}
    assert "provider_count" not in geo.geo_time_sets(claims, None).columns
    with pytest.raises(ValueError):
        geo.geo_time_sets(claims, "some")


def test_one_pass_over_the_claims(spark, small_dir):
    fact = star.flagged_fact(spark, small_dir)
    plan = geo.geo_time_sets(fact)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1
    one = fact.groupBy("provider_state").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == one.count("Scan parquet")
    sketch = geo.geo_time_sets(fact, "sketch")._jdf.queryExecution().executedPlan().toString()
    assert "hll_union_agg" in sketch and "count(distinct npi" not in sketch


def test_sketches_stay_within_their_bound(spark):
    """Distinct values in the hundred thousands, met in several parts each."""
    fact = spark.range(400_000).selectExpr(
        "cast(pmod(xxhash64(id), 150000) AS string) AS npi", "2020 + id % 3 AS report_year", "concat('Q', id % 4) AS report_quarter",
        "if(id % 3 = 0, 'A', 'B') AS provider_state", "'s' AS specialty", "concat('c', id % 2) AS risk_category", "1L AS total_claims")
    parts = sketches.PROVIDER_SKETCHES.of(fact)
    for keys in ([], ["provider_state"], ["report_year", "provider_state"]):
        exact = {tuple(r[k] for k in keys): r.n for r in fact.groupBy(*keys).agg(F.countDistinct("npi").alias("n")).collect()}
        rolled = {tuple(r[k] for k in keys): r for r in sketches.roll_up(parts, keys).collect()}
        assert exact.keys() == rolled.keys() and sum(r.total_claims for r in rolled.values()) == 400_000
        for k, n in exact.items():
            assert abs(rolled[k].providers - n) <= sketches.error_bound() * n
    whole, by_part = sketches.PROVIDER_SKETCHES, fact.withColumn("part", F.expr("total_claims"))
    merged = whole.merged(whole.partial(by_part, ["part"]))
    assert sketches.roll_up(merged, ["provider_state"]).count() == 2


def test_exact_counts_stay_the_default(spark, small_dir):
    plan = marts.drug_summary(star.flagged_fact(spark, small_dir))._jdf.queryExecution().executedPlan().toString()
    assert "hll" not in plan
