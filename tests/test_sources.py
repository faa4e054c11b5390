import pytest

from claimlens.schemas import PROVIDER_DRUG_NAMES, REGISTRY_NAMES
from claimlens.sources import readers

# Not in the order of the schema; one column the schema does not know.
HEADER = [
    "npi", "nppes_provider_last_org_name", "nppes_provider_first_name", "nppes_provider_city",
    "nppes_provider_state", "specialty_description", "description_flag", "drug_name", "generic_name",
    "bene_count", "total_claim_count", "total_30_day_fill_count", "total_day_supply", "total_drug_cost",
    "nppes_provider_zip5",
]
GOOD = [
    "0012345678,SMITHSON,ANN,BOSTON,MA,Pain,S,OXYCODONE,OXYCODONE,,20,20.5,600,1234.50,2101",
    '0012345679,"LAST, JR",BOB,RENO,NV,Eye,S,PLAIN,PLAIN,15,30,30,900,0.10,89501',
]
SHORT = "0012345670,SHORT,ANN"
LONG = GOOD[0] + ",EXTRA"
TEXT = GOOD[0].replace(",20,20.5", ",many,20.5")


@pytest.fixture
def raw(tmp_path):
    for year, lines in {2021: [GOOD[0]], 2022: [*GOOD, SHORT, LONG, TEXT]}.items():
        folder = tmp_path / "partd" / "provider_drug" / str(year)
        folder.mkdir(parents=True)
        (folder / "part.csv").write_text("\n".join([",".join(HEADER), *lines]) + "\n")
    registry = tmp_path / "npi"
    registry.mkdir()
    names = ["Entity Type Code", *REGISTRY_NAMES, "Last Update Date"]
    rows = ["1,0012345678,Org One,208VP,MA,02101,x", "1,0012345679,,152W,NV,89501,x"]
    (registry / "npi.csv").write_text("\n".join([",".join(names), *rows]) + "\n")
    census = tmp_path / "census"
    census.mkdir()
    (census / "c.csv").write_text("geo_key,geo_level,population\nMA,state,7000000\n")
    reference = tmp_path / "drug_reference"
    reference.mkdir()
    (reference / "d.csv").write_text("drug_name,risk_category,other\nPLAIN,STIMULANT,1\n")
    for name in ("provider", "geography_drug"):
        folder = tmp_path / "partd" / name / "2022"
        folder.mkdir(parents=True)
        (folder / "t.csv").write_text("geo,total_claim_count,total_drug_cost\nMA,20,1234.50\n")
    return tmp_path


def test_claims_have_declared_types_by_header_name(spark, raw):
    df = readers.read_claims(spark, str(raw / "partd/provider_drug"), 2022)
    types = dict(df.dtypes)
    assert types["npi"] == types["nppes_provider_zip5"] == types["description_flag"] == "string"
    assert types["total_drug_cost"] == "decimal(18,2)" and types["bene_count"] == "bigint"
    assert set(PROVIDER_DRUG_NAMES) <= set(df.columns)
    first = readers.good_lines(df).filter("npi = '0012345678'").first()
    assert first.nppes_provider_zip5 == "02101" and first.bene_count is None
    assert (first.total_claim_count, first.total_30_day_fill_count, str(first.total_drug_cost)) == (20, 20.5, "1234.50")


def test_every_query_sees_the_same_bad_lines(spark, raw):
    df = readers.read_claims(spark, str(raw / "partd/provider_drug"), 2022)
    assert df.count() == 5
    assert readers.good_lines(df).count() == 2
    assert readers.good_lines(df).select("npi").count() == len(readers.good_lines(df).collect()) == 2
    assert {r[0] for r in readers.bad_lines(df).collect()} == {SHORT, LONG, TEXT}


def test_years_stack(spark, raw):
    both = readers.good_lines(readers.read_claim_years(spark, str(raw / "partd/provider_drug"), [2021, 2022]))
    assert {(r.year, r["count"]) for r in both.groupBy("year").count().collect()} == {(2021, 1), (2022, 2)}


def test_union_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2,)], "k int")
    assert sorted(map(tuple, readers.union_years([a, b]).collect())) == [(1, "x"), (2, None)]


def test_registry_reads_five_columns(spark, raw):
    df = readers.read_registry(spark, str(raw / "npi"))
    assert df.columns == ["npi", "org_name", "taxonomy_code", "npi_state", "npi_zip"]
    assert {r.npi: (r.org_name, r.npi_zip) for r in df.collect()} == {
        "0012345678": ("Org One", "02101"), "0012345679": (None, "89501")}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Last Update Date" not in plan.split("ReadSchema")[1]


def test_read_all_takes_what_has_a_path(spark, raw):
    every = readers.read_all(spark, readers.RawPaths.under(str(raw)), 2022)
    assert set(every) == {
        "provider_drug", "npi_registry", "census", "drug_reference", "provider_summary", "geography_drug"}
    assert [tuple(r) for r in every["census"].collect()] == [("state", "MA", 7000000)]
    assert [tuple(r) for r in every["drug_reference"].collect()] == [("PLAIN", "STIMULANT")]
    assert every["geography_drug"].first().total_claim_count == 20
    few = readers.RawPaths(str(raw / "partd/provider_drug"), str(raw / "npi"))
    assert set(readers.read_all(spark, few, 2022)) == {"provider_drug", "npi_registry"}


def test_session_and_rows(spark):
    assert readers.session() is not None
    df = readers.from_rows(spark, [("1", None, None, "NY", "00501", None, "A", "B", 1, 1.0, 1, None, 1)])
    assert df.first().provider_zip == "00501"


def test_zips_are_padded_and_never_cut(spark):
    given = ["2101", "02101", "501", "21011234", "5011234", "123456789", "02101-1234", " 97035 ", "ABC12", "123456", "1234567890", "", None]
    want = ["02101", "02101", "00501", "02101", "00501", "12345", "02101", "97035", "ABC12", "123456", "1234567890", "", None]
    df = spark.createDataFrame(list(enumerate(given)), "k int, z string")
    assert [r.z for r in df.select("k", readers.five_digits("z").alias("z")).orderBy("k").collect()] == want


def test_files_with_another_header(spark, tmp_path):
    """Claims are matched by name; where a folder is read as one scan, another header fails it, never by position."""
    (tmp_path / "a.csv").write_text("npi,total_claim_count\n1,20\n")
    (tmp_path / "b.csv").write_text("total_claim_count,npi\n30,2\n")
    claims = readers.read_claims(spark, str(tmp_path))
    assert sorted((r.npi, r.total_claim_count) for r in claims.collect()) == [("1", 20), ("2", 30)]
    with pytest.raises(Exception):  # noqa: B017
        readers.read_csv(spark, str(tmp_path)).collect()
