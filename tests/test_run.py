import os
from glob import glob

import pytest
from pyspark.sql import functions as F
from test_sources import raw  # noqa: F401 - fixture

from claimlens.plans import transformation
from claimlens.schemas import REGISTRY_NAMES
from claimlens.sinks.marts import MARTS, read_clean
from claimlens.sinks.versions import read_table
from claimlens.sinks.writers import export_sample, write_table
from claimlens.sources.readers import RawPaths, landed_lines, read_claims, read_registry


def data_files(path, ending="parquet"):
    return glob(f"{path}/**/*.{ending}", recursive=True)


def test_write_returns_the_count_and_round_trips(spark, tmp_path):
    df = spark.range(100).withColumn("part", F.expr("if(id % 3 = 0, 'a', cast(id AS string))"))
    assert write_table(df, f"{tmp_path}/t", ["part"]) == 100
    assert spark.read.parquet(f"{tmp_path}/t").count() == 100
    assert len(data_files(f"{tmp_path}/t/part=a")) == 1
    assert "snappy" in data_files(f"{tmp_path}/t/part=a")[0]


def test_modes_and_formats(spark, tmp_path):
    df = spark.range(10)
    path = f"{tmp_path}/t"
    assert write_table(df, path, mode="error", rebalance=False) == 10
    assert write_table(df, path, mode="append") == 10
    assert spark.read.parquet(path).count() == 20
    with pytest.raises(Exception, match="(?i)exist"):
        write_table(df, path, mode="error")
    assert write_table(df, path) == 10
    assert spark.read.parquet(path).count() == 10
    with pytest.raises(ValueError):
        write_table(df, path, mode="sometimes")
    assert write_table(df, f"{tmp_path}/c", fmt="csv", files=3) == 10
    assert len(data_files(f"{tmp_path}/c", "csv")) == 3
    assert spark.read.option("header", True).csv(f"{tmp_path}/c").columns == ["id"]


def test_other_partitions_can_stay(spark, tmp_path):
    path = f"{tmp_path}/t"
    for year, value in ((2021, 1), (2022, 2), (2022, 3)):
        df = spark.createDataFrame([(year, value)], "y int, v int")
        write_table(df, path, ["y"], replace_partitions_only=True)
    assert sorted((r.y, r.v) for r in spark.read.parquet(path).collect()) == [(2021, 1), (2022, 3)]


def test_sample_export(spark, tmp_path):
    assert export_sample(spark.range(1000), f"{tmp_path}/s", 20) == 20
    assert export_sample(spark.range(10), f"{tmp_path}/s", 20) == 10
    assert len(data_files(f"{tmp_path}/s", "csv")) == 1


def test_full_run_writes_all_layers(spark, raw, tmp_path):  # noqa: F811
    out = f"{tmp_path}/out"
    result = transformation.run(spark, RawPaths.under(str(raw)), out, 2022, quarter="Q4", csv_files={"Provider Summary": 2})
    rows = {r.name: (r.row_count, r.format) for r in result.catalog.collect()}
    assert rows == {
        "Provider Summary": (1, "parquet/csv"), "Drug Summary": (1, "parquet"),
        "State Hotspots": (1, "parquet/csv"), "ZIP Opioid Hotspots": (0, "parquet"),
        "Temporal Trends": (1, "parquet"), "Specialty Risk": (1, "parquet"), "Main Dashboard": (1, "csv"),
        "Quarterly Trends": (1, "parquet"), "Year over Year": (1, "parquet"), "ZIP Hotspot Flags": (0, "parquet"),
        "State Claims per Capita": (1, "parquet"),
    }
    for r in result.catalog.collect():
        assert os.path.isdir(r.path), r.name
        assert "supplied_table" in r["keys"] or set(r["keys"]) <= set(r.columns), r.name
    assert read_table(spark, f"{out}/rejected_lines").count() == 3
    assert tuple(result.extraction.first()) == (2, 3)
    stats = result.statistics.first()
    assert (stats.records_extracted, stats.records_cleaned) == (2, 1)
    clean = read_clean(spark, out).collect()
    assert [(r.npi, r.org_name, r.report_year, r.report_quarter, r.provider_state) for r in clean] == [
        ("0012345679", None, 2022, "Q4", "NV")]
    assert read_table(spark, f"{out}/catalog").count() == len(rows)


def test_phases_build_on_each_other(spark, raw, tmp_path):  # noqa: F811
    out, paths = f"{tmp_path}/out", RawPaths.under(str(raw))
    assert transformation.run(spark, paths, out, 2022, mode="extract").extraction.first().records_extracted == 2
    stats = transformation.run(spark, paths, out, 2022, mode="transform", use_drug_reference=True).statistics.first()
    assert (stats.high_risk_count, stats.opioid_count) == (1, 0)
    nowhere = RawPaths("/nowhere", "/nowhere")
    catalog = transformation.run(spark, nowhere, out, 2022, mode="load").catalog
    assert "State Claims per Capita" not in {r.name for r in catalog.collect()}
    drugs = read_table(spark, f"{out}/tableau_ready/drug_summary").first()
    assert (drugs.drug_name, drugs.risk_category) == ("PLAIN", "STIMULANT")
    with pytest.raises(ValueError):
        transformation.run(spark, paths, out, 2022, mode="all")


def claim_files(base, years):
    """Claim files of several years; header order, case and columns differ between them."""
    names = ["npi", "nppes_provider_last_org_name", "nppes_provider_city", "nppes_provider_state", "nppes_provider_zip5", "specialty_description", "drug_name", "generic_name",
             "total_claim_count", "total_30_day_fill_count", "total_day_supply", "total_drug_cost", "bene_count", "filed"]
    for year, rows in years.items():
        folder = base / "partd/provider_drug" / str(year)
        folder.mkdir(parents=True)
        order = names if year % 2 else names[::-1]
        order = [n for n in order if n != "filed" or year % 2]  # a column that some years lack
        head = [n.upper() if year % 2 == 0 else n for n in order]
        lines = [",".join(str(row.get(n, "")) for n in order) for row in rows]
        (folder / "f.csv").write_text("\n".join([",".join(head), *lines]) + "\n")
    (base / "npi").mkdir()
    (base / "npi/n.csv").write_text(",".join(REGISTRY_NAMES) + "\n")


def row(npi, claims=20, state="OR", code="2101", drug="NORCO", filed="2021-02-03", supply="600"):
    return {"npi": npi, "nppes_provider_state": state, "nppes_provider_zip5": code, "specialty_description": "Eye", "drug_name": drug,
            "generic_name": drug, "total_claim_count": claims, "total_30_day_fill_count": 20, "total_day_supply": supply,
            "total_drug_cost": "100.00", "bene_count": 9, "filed": filed}


YEARS = {
    2021: [row("1"), row("2", state=""), row("3", supply="bad"), row("4", drug="PLAIN", claims=30)],
    2022: [row("1", claims=50), row("5", code="21011234", state="VT"), row("6", claims=3)],
}


def test_years_stay_and_agree_with_the_direct_path(spark, tmp_path):
    claim_files(tmp_path, YEARS)
    paths, out = RawPaths.under(str(tmp_path)), f"{tmp_path}/out"
    transformation.run(spark, paths, out, 2021, mode="extract")
    transformation.run(spark, paths, out, 2022)  # 2021 was landed before and isn't restamped
    assert {r.report_year for r in read_clean(spark, out).collect()} == {2022}
    transformation.run(spark, paths, out, 2021)
    both = f"{tmp_path}/both"
    every = transformation.run(spark, paths, both)
    assert every.statistics.first().records_extracted == 6 and every.statistics.first().records_cleaned == 5
    for path in ("clean", *(m.path for m in MARTS if not m.optional)):
        one, two = (read_table(spark, f"{o}/{path}") for o in (out, both))
        assert sorted(map(str, one.collect())) == sorted(map(str, two.select(one.columns).collect())), path
    rows = {(r.npi, r.report_year): (r.provider_zip, r.provider_state) for r in read_clean(spark, both).collect()}
    assert rows == {("1", 2021): ("02101", "OR"), ("2", 2021): ("02101", None), ("4", 2021): ("02101", "OR"),
                    ("1", 2022): ("02101", "OR"), ("5", 2022): ("02101", "VT")}
    for entry in every.catalog.collect():
        if "csv" != entry.format:
            assert read_table(spark, entry.path).count() == entry.row_count, entry.name
    change = {(r.provider_state, r.report_year): r.claims_change for r in read_table(spark, f"{both}/temporal/year_over_year").collect() if r.risk_category == "OPIOID"}
    assert change["OR", 2022] == 30
    # The same marts from the raw folder of one year, without any layer between.
    direct = transformation.transform_all(
        {"provider_drug": read_claims(spark, paths.provider_drug, 2021), "npi_registry": read_registry(spark, paths.npi_registry)}, year=2021)
    alone = f"{tmp_path}/alone"
    transformation.run(spark, paths, alone, 2021)
    for mart in MARTS:
        if not mart.optional:
            written = read_table(spark, f"{alone}/{mart.path}").select(direct[mart.source].columns)
            assert sorted(map(str, direct[mart.source].collect())) == sorted(map(str, written.collect())), mart.title


def test_dates_decide_the_year(spark, tmp_path):
    rows = {2021: [row("1", filed="2020-11-30"), row("2", filed="2021-05-01"), row("3", filed="2021-05-99")]}
    claim_files(tmp_path, rows)
    out = f"{tmp_path}/out"
    transformation.run(spark, RawPaths.under(str(tmp_path)), out, 2021, date_column="filed")
    got = {(r.npi, r.report_year, r.report_quarter, r.report_month) for r in read_clean(spark, out).collect()}
    assert got == {("1", 2020, "Q4", 11), ("2", 2021, "Q2", 5), ("3", None, None, None)}
    assert [tuple(r) for r in read_table(spark, f"{out}/quality/bad_dates").collect()] == [("2021-05-99", 1)]
    quarters = read_table(spark, f"{out}/temporal/quarterly_trends").filter("report_quarter = 'Q4'").first()
    assert (quarters.report_year, quarters.quarterly_claims) == (2020, 20)


def test_other_inputs_reach_the_marts(spark, tmp_path):
    claim_files(tmp_path, YEARS)
    for folder, text in {
        "census": "geo_key,geo_level,population\nOR,state,1000\n",
        "drug_reference": "drug_name,risk_category\nplain,stimulant\nNORCO,weird\n",
        "partd/provider/2021": "npi,total_claim_count,total_drug_cost\n1,20,100.00\n2,99,100.00\n8,5,1.00\n",
        "partd/geography_drug/2021": "nppes_provider_state,drug_name,total_claim_count\nor,norco,20\n",
    }.items():
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "x.csv").write_text(text)
    out = f"{tmp_path}/out"
    result = transformation.run(spark, RawPaths.under(str(tmp_path)), out, 2021, use_drug_reference=True)
    people = {r.provider_state: r.claims_per_100k for r in read_table(spark, f"{out}/hotspots/state_per_capita").collect() if r.risk_category == "OPIOID"}
    assert people == {"OR": 2000.0, None: None}
    got = {(r.supplied_table, r.key, r.measure): r.status for r in read_table(spark, f"{out}/quality/reconciliation").collect()}
    key = '{"npi":"%s"}'
    assert got["provider_summary", key % 1, "total_claims"] == got["provider_summary", key % 1, "total_cost"] == "EQUAL"
    assert got["provider_summary", key % 2, "total_claims"] == "DIFFERENT"
    assert got["provider_summary", key % 4, "total_claims"] == "ONLY_OWN" and got["provider_summary", key % 8, "total_claims"] == "ONLY_SUPPLIED"
    assert got["geography_drug", '{"provider_state":"OR","drug_name":"NORCO"}', "total_claims"] == "EQUAL"
    assert [tuple(r) for r in read_table(spark, f"{out}/quality/unknown_categories").collect()] == [("WEIRD", 1, 1)]
    clean = read_clean(spark, out)
    stats = result.statistics.first()
    assert stats.high_risk_count == clean.filter("is_high_risk = 1").count() == 3
    assert stats.opioid_count == clean.filter("is_opioid = 1").count() == 2
    assert stats.hotspot_count == read_table(spark, f"{out}/hotspots/state_level").filter("is_hotspot = 1").count()


def test_landed_scan_reads_no_number_it_does_not_need(spark, tmp_path):
    claim_files(tmp_path, YEARS)
    out = f"{tmp_path}/out"
    transformation.run(spark, RawPaths.under(str(tmp_path)), out, 2021, mode="extract")
    plan = landed_lines(read_table(spark, f"{out}/landed")).groupBy("nppes_provider_state").count()
    schema = plan._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert "total_claim_count" not in schema and "total_drug_cost" not in schema


def test_transform_all_gives_every_table(spark, claims):
    registry = spark.createDataFrame(
        [("7100000001", "Org", "T", "OR", "97035")],
        "npi string, org_name string, taxonomy_code string, npi_state string, npi_zip string")
    tables = transformation.transform_all({"provider_drug": claims, "npi_registry": registry}, year=2023)
    assert set(tables) >= {"cleaned_data", *(m.source for m in MARTS if not m.optional)}
    assert tables["cleaned_data"].count() == 5
    assert tables["provider_summary"].count() == 4
    assert tables["state_hotspots"].filter("is_hotspot = 1").count() >= 1
    assert tables["temporal_trends"].first().report_year == 2023
