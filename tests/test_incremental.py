"""A run reads the parts that changed, and nothing of other runs is lost."""

import pytest
from test_run import YEARS, claim_files, row

from claimlens.operators.aggregate import Grouping
from claimlens.plans import incremental, transformation
from claimlens.plans.transformation import GROUPINGS, run
from claimlens.sinks.marts import MARTS, Change, MartFile, _write_mart, read_clean, write_clean
from claimlens.sinks.versions import current, read_table, read_version
from claimlens.sources.readers import RawPaths


def lines(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def clean_files_of(df):
    return [f for f in df.inputFiles() if "/clean/" in f]


@pytest.fixture
def two_runs(spark, tmp_path):
    claim_files(tmp_path, YEARS)
    paths, out = RawPaths.under(str(tmp_path)), f"{tmp_path}/out"
    run(spark, paths, out, 2021)
    first = {m.path: current(spark, f"{out}/{m.path}") for m in MARTS if not m.optional}
    result = run(spark, paths, out, 2022)
    return paths, out, first, result


def test_second_year_equals_a_full_rebuild(spark, two_runs, tmp_path):
    paths, out, _, result = two_runs
    run(spark, paths, f"{tmp_path}/both")
    for path in ("clean", *(m.path for m in MARTS if not m.optional)):
        assert lines(read_table(spark, f"{out}/{path}")) == lines(read_table(spark, f"{tmp_path}/both/{path}")), path
    for entry in result.catalog.collect():
        assert entry.version == current(spark, entry.path).number, entry.name
        if entry.format != "csv":
            assert read_table(spark, entry.path).count() == entry.row_count
            assert sum(spark.read.parquet(f).count() for f in entry.folders if "_csv/" not in f) == entry.row_count


def test_second_year_reads_one_year_of_the_clean_layer(spark, two_runs, monkeypatch):
    paths, out, _, _ = two_runs
    read = []
    partial = Grouping.partial

    def watched(grouping, df, parts=()):
        read.extend(clean_files_of(df))
        return partial(grouping, df, parts)

    monkeypatch.setattr(Grouping, "partial", watched)
    run(spark, paths, out, 2022)
    assert read and all("landed_from=2022" in f for f in read)
    read.clear()
    run(spark, paths, out, mode="load")  # nothing changed
    assert read == []


def test_folders_of_an_unchanged_input_are_taken_over(spark, two_runs):
    _, out, first, _ = two_runs
    yearly = current(spark, f"{out}/temporal/yearly_trends")
    assert yearly.parts["report_year=2021"] == first["temporal/yearly_trends"].parts["report_year=2021"]
    assert yearly.parts["report_year=2022"] != yearly.parts["report_year=2021"]
    # 2022 has no blank state: the folder of 2021 stays.
    providers, before = current(spark, f"{out}/tableau_ready/provider_summary"), first["tableau_ready/provider_summary"]
    blank = "provider_state=__HIVE_DEFAULT_PARTITION__"
    assert providers.parts[blank] == before.parts[blank] and providers.parts["provider_state=OR"] != before.parts["provider_state=OR"]


def test_a_year_that_shrinks_takes_its_rows_out_of_the_marts(spark, two_runs, tmp_path):
    paths, out, _, _ = two_runs
    (tmp_path / "partd/provider_drug/2022/f.csv").unlink()
    head = "NPI,NPPES_PROVIDER_STATE,NPPES_PROVIDER_ZIP5,DRUG_NAME,GENERIC_NAME,TOTAL_CLAIM_COUNT,TOTAL_30_DAY_FILL_COUNT,TOTAL_DAY_SUPPLY,TOTAL_DRUG_COST,BENE_COUNT,SPECIALTY_DESCRIPTION,NPPES_PROVIDER_LAST_ORG_NAME,NPPES_PROVIDER_CITY"
    (tmp_path / "partd/provider_drug/2022/g.csv").write_text(f"{head}\n1,OR,2101,NORCO,NORCO,50,20,600,100.00,9,Eye,,\n")
    run(spark, paths, out, 2022)
    run(spark, paths, f"{tmp_path}/fresh")
    for path in ("clean", *(m.path for m in MARTS if not m.optional)):
        assert lines(read_table(spark, f"{out}/{path}")) == lines(read_table(spark, f"{tmp_path}/fresh/{path}")), path
    assert "provider_state=VT" not in current(spark, f"{out}/tableau_ready/provider_summary").parts


def test_a_flat_run_keeps_the_years_of_earlier_runs(spark, tmp_path):
    claim_files(tmp_path, {2021: [row("1"), row("2")]})
    out = f"{tmp_path}/out"
    run(spark, RawPaths.under(str(tmp_path)), out, 2021)
    for name, filed in (("flat", "2021-06-01"), ("other", "2020-06-01")):
        folder = tmp_path / name
        claim_files(folder, {2021: [row(f"9{name}", filed=filed)]})
        flat = RawPaths(f"{folder}/partd/provider_drug/2021", f"{folder}/npi")
        run(spark, flat, out, date_column="filed")
        run(spark, flat, out, date_column="filed")  # again: replaces what it brought
    assert {(r.npi, r.report_year) for r in read_clean(spark, out).collect()} == {("1", 2021), ("2", 2021), ("9flat", 2021), ("9other", 2020)}
    assert transformation.read_landed(spark, out).count() == 4
    years = {(r.report_year, r.yearly_providers) for r in read_table(spark, f"{out}/temporal/yearly_trends").collect()}
    assert years == {(2021, 3), (2020, 1)}


def test_a_failed_write_keeps_every_table(spark, two_runs, monkeypatch):
    paths, out, _, result = two_runs
    held = {m.path: lines(read_table(spark, f"{out}/{m.path}")) for m in MARTS if not m.optional}
    clean = lines(read_clean(spark, out))
    cleaned = transformation.cleaned_claims

    def broken(*args, **options):
        return cleaned(*args, **options).selectExpr("*", "if(npi = '5', raise_error('lost'), 1) AS x").filter("x = 1").drop("x")

    monkeypatch.setattr(transformation, "cleaned_claims", broken)
    with pytest.raises(Exception, match="lost"):
        run(spark, paths, out, 2022)
    assert lines(read_clean(spark, out)) == clean
    assert {p: lines(read_table(spark, f"{out}/{p}")) for p in held} == held
    assert read_table(spark, f"{out}/catalog").count() == result.catalog.count()


def test_a_mart_that_missed_a_refresh_is_written_whole(spark, tmp_path):
    mart = MartFile("m", "m", "M", ("k",), "", ("k",))
    path, rows = f"{tmp_path}/m", spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    assert _write_mart(rows, path, mart, Change("1", None, None))[0].number == 1
    assert _write_mart(rows, path, mart, Change("1", None, None)) == (current(spark, path), False)
    more = spark.createDataFrame([("a", 9), ("b", 9), (None, 9)], "k string, n int")
    _write_mart(more, path, mart, Change("2", "1", ("a", None)))
    assert sorted(map(str, map(tuple, read_version(spark, path).collect()))) == ["('a', 9)", "('b', 2)", "(None, 9)"]
    _write_mart(more, path, mart, Change("4", "3", ("a",)))
    assert sorted(r.n for r in read_version(spark, path).collect()) == [9, 9, 9]


def test_another_definition_rebuilds_the_sums(spark, two_runs):
    _, out, _, _ = two_runs
    assert incremental.refresh(spark, out, "state", GROUPINGS["state"]).stale == []
    changed = Grouping(GROUPINGS["state"].keys, {"n": "sum(total_claims)"})
    found = incremental.refresh(spark, out, "state", changed)
    assert found.before is None and found.after.by_value().keys() == {"2021", "2022"}


def test_clean_layer_without_landed_folders(spark, claims, tmp_path):
    from claimlens.plans.transformation import cleaned_claims

    write_clean(cleaned_claims(claims, year=2020), str(tmp_path))
    write_clean(cleaned_claims(claims, year=2021), str(tmp_path))
    assert {r.report_year for r in read_clean(spark, str(tmp_path)).collect()} == {2021}
