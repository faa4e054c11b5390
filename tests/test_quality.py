import pytest
from conftest import make_claims

from claimlens.operators import geo, quality
from claimlens.operators.classify import flag_risk, risk_counts
from claimlens.operators.clean import clean


@pytest.fixture
def sample(spark):
    rows = [(11, None, 7, 0.5), (12, "pear", 90, 31.0), (13, "fig", 8, 2.25), (14, "plum", 41, 12.0), (15, None, 6, 1.0)]
    return spark.createDataFrame(rows, "id bigint, name string, claims bigint, cost double")


def test_required_columns(sample):
    assert quality.has_columns(sample, ["id", "name"])
    assert quality.missing_columns(sample, ["x", "id", "y"]) == ["x", "y"]


def test_profile_and_missing_values(sample):
    profile = {r.column_name: tuple(r)[1:] for r in quality.column_profile(sample).collect()}
    assert profile["name"] == ("string", 5, 2, 40.0)
    assert profile["id"] == ("bigint", 5, 0, 0.0)
    assert [tuple(r) for r in quality.missing_values(sample).collect()] == [("name", 2, 40.0)]
    assert quality.missing_values(sample.limit(0)).count() == 0


def test_odd_column_names(spark):
    df = spark.createDataFrame([(None, 1)], "`a b.c` int, `Legal (Name)` int")
    assert [tuple(r) for r in quality.missing_values(df).collect()] == [("a b.c", 1, 100.0)]
    assert quality.quality_score(df, ["a b.c"]).first().quality_score == 0.0


def test_quality_score(sample):
    assert tuple(quality.quality_score(sample, ["id", "name", "claims"]).first()) == (5, 3, 60.0)
    assert quality.quality_score(sample.limit(0), ["id"]).first().quality_score == 0.0


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None), (2, None), (2, None)], "k int, v string")
    assert [tuple(r) for r in quality.duplicates(df, ["k", "v"]).collect()] == [(2, None, 3), (1, "a", 2)]


def test_outliers(spark):
    df = spark.createDataFrame([(float(i % 2),) for i in range(40)] + [(100.0,), (None,)], "x double")
    got = quality.outliers(df, "x")
    assert [r.x for r in got.filter("x_is_outlier = 1").collect()] == [100.0]
    blank = got.filter("x IS NULL").first()
    assert blank.x_zscore is None and blank.x_is_outlier == 0
    flat = quality.outliers(spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x").first()
    assert flat.x_zscore is None and flat.x_is_outlier == 0


def test_run_statistics_equal_the_separate_counts(spark):
    rows = [{"npi": str(i), "provider_state": f" s{i % 25}", "total_claims": 5 + i,
             "drug_name": ["norco ", "XANAX", "PLAIN"][i % 3]} for i in range(100)]
    raw = make_claims(spark, rows)
    stats = quality.run_statistics(raw).first()
    fact = flag_risk(clean(raw))
    counts = risk_counts(fact).first()
    hot = geo.hotspots(geo.geo_aggregate(fact)).filter("is_hotspot = 1").count()
    assert (stats.records_extracted, stats.records_cleaned) == (100, fact.count())
    assert (stats.high_risk_count, stats.opioid_count) == (counts.high_risk_count, counts.opioid_count)
    assert stats.hotspot_count == hot > 0
    assert stats.high_risk_pct == counts.high_risk_pct
    empty = quality.run_statistics(raw.limit(0)).first()
    assert empty.records_extracted == 0 and empty.opioid_pct is None


def test_reconcile(spark):
    schema = "k string, m bigint"
    own = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("d", None)], schema)
    supplied = spark.createDataFrame([("a", 1), ("b", 5), (None, 3), ("c", 4), ("d", 1)], schema)
    got = {r.k: (r.own_value, r.supplied_value, r.difference, r.status)
           for r in quality.reconcile(own, supplied, ["k"], "m").collect()}
    assert got == {
        "a": (1, 1, 0, "EQUAL"), "b": (2, 5, -3, "DIFFERENT"), None: (3, 3, 0, "EQUAL"),
        "c": (None, 4, None, "ONLY_SUPPLIED"), "d": (None, 1, None, "DIFFERENT"),
    }
    close = quality.reconcile(own, supplied, ["k"], "m", tolerance=3).filter("k = 'b'").first()
    assert close.status == "EQUAL"
