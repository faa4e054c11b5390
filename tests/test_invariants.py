"""Properties that hold for any claims, tried on random ones."""

import random

from conftest import make_claims
from pyspark.sql import functions as F

from claimlens.operators import clean, geo, marts, quality, temporal
from claimlens.operators.classify import flag_risk, risk_counts


def random_claims(spark, seed=11, n=400):
    rng = random.Random(seed)
    drugs = ["NORCO", "XANAX", "RITALIN", " plain ", "APOMORPHINE", None]
    return make_claims(spark, [{
        "npi": rng.choice(["1", "2", "3", "4", None]),
        "provider_state": rng.choice(["NY", " ny", "CA", None]),
        "provider_zip": rng.choice(["00501", "10001", None]),
        "drug_name": rng.choice(drugs),
        "generic_name": rng.choice(drugs),
        "total_claims": rng.choice([None, 5, 11, 12, 400]),
        "total_day_supply": rng.choice([0, 30, None]),
        "total_cost": rng.choice([None, "0.10", "0.20", "1234.56", "99999999.99"]),
        "beneficiary_count": rng.choice([None, 0, 1, 30]),
    } for _ in range(n)])


def fact(df):
    return temporal.add_calendar(flag_risk(clean.clean(df)), year=2020)


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_every_row_is_kept_or_rejected_once(spark):
    df = random_claims(spark)
    counts = clean.clean_counts(df).first()
    assert counts.clean_count == clean.clean(df).count() > 0
    assert counts.removed_count == clean.rejected(df).count() == total(clean.reject_summary(df), "row_count")


def test_parts_add_up_to_the_whole(spark):
    df = fact(random_claims(spark))
    claims = total(df, "total_claims")
    assert df.groupBy("risk_category").count().agg(F.sum("count")).first()[0] == risk_counts(df).first().total_records
    assert total(geo.geo_aggregate(df), "state_total_claims") == claims
    assert total(marts.provider_summary(df), "provider_total_claims") == claims
    assert total(marts.drug_summary(df), "drug_total_claims") == claims
    assert total(marts.specialty_risk(df), "specialty_claims") == claims
    assert total(temporal.trends(df), "yearly_claims") == claims
    opioid = total(df.filter("is_opioid = 1"), "total_claims")
    assert total(geo.zip_opioid(df), "zip_opioid_claims") == opioid
    assert total(marts.provider_summary(df), "provider_opioid_claims") == opioid


def test_row_order_and_partitions_do_not_matter(spark):
    df = random_claims(spark)
    shuffled = df.orderBy(F.md5(F.concat_ws("|", *df.columns))).repartition(7)
    for step in (marts.provider_summary, geo.zip_opioid, marts.specialty_risk):
        assert sorted(step(fact(df)).collect(), key=repr) == sorted(step(fact(shuffled)).collect(), key=repr)
    assert quality.run_statistics(df).first() == quality.run_statistics(shuffled).first()


def test_tightening_a_threshold_only_removes_rows(spark):
    from dataclasses import replace

    from claimlens.config import DEFAULTS

    df = random_claims(spark)
    loose, tight = (clean.keep_valid(df, replace(DEFAULTS, min_claims=n)) for n in (11, 12))
    assert tight.count() < loose.count()
    assert tight.exceptAll(loose).count() == 0
