"""Aggregates in two steps equal those in one; means to twelve digits, as one of doubles depends on the order of rows."""

import pytest
from pyspark.sql import functions as F

from claimlens.operators.aggregate import Grouping
from claimlens.plans import star_tables as star
from claimlens.plans.transformation import GROUPINGS


def plain(df):
    return sorted(str([f"{v:.12g}" if isinstance(v, float) else v for v in r]) for r in df.collect())


@pytest.fixture(scope="module")
def fact(spark, small_dir):
    fact = star.flagged_fact(spark, small_dir)
    # Parts that share providers and drugs, NULL keys and NULL measures.
    return fact.withColumns({
        "part": F.expr("total_day_supply % 3"),
        "provider_zip": F.expr("nullif(provider_zip, '00007')"),
        "beneficiary_count": F.expr("nullif(beneficiary_count, 2)"),
    }).cache()


@pytest.mark.parametrize("name", sorted(GROUPINGS))
def test_parts_add_up(fact, name):
    grouping = GROUPINGS[name]
    whole = grouping.of(fact)
    merged = grouping.merged(grouping.partial(fact, ["part"]))
    assert merged.dtypes == whole.dtypes
    assert plain(merged) == plain(whole)


@pytest.mark.parametrize("name", sorted(GROUPINGS))
def test_order_of_rows_does_not_matter(fact, name):
    grouping = GROUPINGS[name]
    one, two = (grouping.merged(grouping.partial(fact.repartition(n, order), ["part"])) for n, order in ((1, "npi"), (7, "drug_name")))
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_other_measures_are_refused(fact):
    with pytest.raises(ValueError, match="two steps"):
        Grouping(("npi",), {"m": "median(total_claims)"}).partial(fact)
