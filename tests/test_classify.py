from dataclasses import replace

import pytest
from conftest import make_claims

from claimlens.config import DEFAULTS
from claimlens.operators.classify import flag_risk, risk_counts, risk_from_reference, unknown_categories


def flags(spark, whole_word=False, settings=DEFAULTS, **row):
    r = flag_risk(make_claims(spark, [row]), settings, whole_word).first()
    return r.is_opioid, r.is_benzodiazepine, r.is_stimulant, r.is_high_risk, r.risk_category


@pytest.mark.parametrize("drug, generic, expected", [
    ("OXYCODONE HCL", "OXYCODONE", (1, 0, 0, 1, "OPIOID")),
    ("BRAND", "HYDROCODONE", (1, 0, 0, 1, "OPIOID")),
    ("XANAX", None, (0, 1, 0, 1, "BENZODIAZEPINE")),
    ("RITALIN LA", "METHYLPHENIDATE", (0, 0, 1, 1, "STIMULANT")),
    ("LISINOPRIL", None, (0, 0, 0, 0, "STANDARD")),
    ("VALIUM", "ADDERALL", (0, 1, 1, 1, "BENZODIAZEPINE")),
    ("VALIUM", "NORCO", (1, 1, 0, 1, "OPIOID")),
    (None, None, (0, 0, 0, 0, "STANDARD")),
])
def test_flags_and_first_category_wins(spark, drug, generic, expected):
    assert flags(spark, drug_name=drug, generic_name=generic) == expected


@pytest.mark.parametrize("drug", ["APOMORPHINE", "MORPHINE-SR", "MORPHINE"])
def test_words_match_inside_words_unless_whole(spark, drug):
    assert flags(spark, drug_name=drug, generic_name=None)[0] == 1
    whole = flags(spark, whole_word=True, drug_name=drug, generic_name=None)[0]
    assert whole == (0 if drug == "APOMORPHINE" else 1)


def test_words_are_plain_text_not_patterns(spark):
    odd = replace(DEFAULTS, opioid_words=("A.B", "C'D\\E"))
    assert flags(spark, settings=odd, drug_name="AXB")[0] == 0
    assert flags(spark, settings=odd, drug_name="xA.By")[0] == 1
    assert flags(spark, settings=odd, drug_name="C'D\\E")[0] == 1
    assert flags(spark, True, odd, drug_name="AXB", generic_name="C'D\\E")[0] == 1
    assert flags(spark, settings=replace(DEFAULTS, opioid_words=()), drug_name="NORCO")[0] == 0


def test_shares_of_risky_claims(claims):
    flagged = flag_risk(claims)
    assert [r.npi for r in flagged.filter("is_opioid = 1").collect()] == ["7100000001"]
    counts = risk_counts(flagged).first()
    assert (counts.total_records, counts.high_risk_count, counts.opioid_count) == (5, 2, 1)
    assert (counts.high_risk_pct, counts.opioid_pct) == (40.0, 20.0)
    assert risk_counts(flagged.limit(0)).first().opioid_pct is None


def test_reference_table_overrides_the_words(spark):
    claims = flag_risk(make_claims(spark, [
        {"npi": "1", "drug_name": "NORCO"}, {"npi": "2", "drug_name": "PLAIN"},
        {"npi": "3", "drug_name": "TWICE"}, {"npi": "4", "drug_name": "VALIUM"},
    ]))
    reference = spark.createDataFrame(
        [("norco ", "STANDARD"), ("TWICE", "STIMULANT"), ("TWICE", "OPIOID"), ("PLAIN", None), ("PLAIN", "OTHER")],
        "drug_name string, risk_category string",
    )
    got = {r.npi: (r.is_opioid, r.is_high_risk, r.risk_category)
           for r in risk_from_reference(claims, reference).collect()}
    assert got == {
        "1": (0, 0, "STANDARD"), "2": (0, 0, "STANDARD"), "3": (1, 1, "OPIOID"), "4": (0, 1, "BENZODIAZEPINE"),
    }


def test_categories_in_any_spelling(spark):
    claims = flag_risk(make_claims(spark, [{"npi": str(k), "drug_name": f"PLAIN {k}"} for k in range(5)]))
    listed = [("plain 0", " opioid"), ("PLAIN 1", "Stimulant "), ("PLAIN 2", "Narcotic"), ("PLAIN 3", None), ("plain 2 ", "NARCOTIC")]
    reference = spark.createDataFrame(listed, "drug_name string, risk_category string")
    got = {r.npi: r.risk_category for r in risk_from_reference(claims, reference).collect()}
    assert got == {"0": "OPIOID", "1": "STIMULANT", "2": "STANDARD", "3": "STANDARD", "4": "STANDARD"}
    odd = {r.risk_category: (r.row_count, r.drug_count) for r in unknown_categories(reference).collect()}
    assert odd == {"NARCOTIC": (2, 1), None: (1, 1)}
