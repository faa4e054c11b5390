"""Folders whose files have several headers."""

import gzip

from test_run import row
from test_sources import raw  # noqa: F401 - fixture

from claimlens.plans.transformation import run
from claimlens.schemas import REGISTRY_NAMES
from claimlens.sinks.marts import read_clean
from claimlens.sinks.versions import read_table
from claimlens.sources.headers import header_index, header_report
from claimlens.sources.readers import CORRUPT, RawPaths, bad_lines, good_lines, read_claims

NAMES = ["npi", "nppes_provider_last_org_name", "nppes_provider_city", "nppes_provider_state", "nppes_provider_zip5", "specialty_description", "drug_name", "generic_name",
         "total_claim_count", "total_30_day_fill_count", "total_day_supply", "total_drug_cost", "bene_count"]


def write(folder, name, header, rows, opener=open):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [",".join(header), *(",".join(str(r.get(h.strip('"').lower(), "new")) for h in header) for r in rows)]
    with opener(folder / name, "wt") as f:
        f.write("\n".join(lines) + "\n")


def three_headers(folder):
    write(folder, "a.csv", NAMES, [row("1"), row("2", claims="bad")])
    write(folder, "b.csv", NAMES, [row("3")])
    swapped = [*NAMES[:8], "total_day_supply", "total_30_day_fill_count", "total_claim_count", *NAMES[11:]]
    write(folder, "c.csv", [n.upper() for n in swapped], [row("4", claims=77)])
    write(folder, "d.csv.gz", ['"npi"', *(n for n in NAMES[1:] if n != "specialty_description"), "brand_new"], [row("5"), row("6", code="2101")], gzip.open)
    (folder / "empty.csv").write_text("")
    (folder / "_done").write_text("not,a,header")


def test_no_line_is_lost_and_none_misplaced(spark, tmp_path):
    three_headers(tmp_path / "2021")
    claims = read_claims(spark, str(tmp_path), 2021).cache()
    got = {r.npi: r for r in good_lines(claims).collect()}
    assert sorted(got) == ["1", "3", "4", "5", "6"] and bad_lines(claims).count() == 1
    assert (got["4"].total_claim_count, got["4"].total_day_supply, got["4"].total_30_day_fill_count) == (77, 600, 20)
    assert got["5"].specialty_description is None and got["5"].brand_new == "new" and got["1"].brand_new is None
    assert got["6"].nppes_provider_zip5 == "02101"
    assert claims.columns.count(CORRUPT) == 1
    assert claims.count() == 6


def test_index_and_report(spark, tmp_path):
    three_headers(tmp_path / "f")
    index = header_index(spark, str(tmp_path / "f"))
    assert [len(files) for files in index.values()] == [2, 1, 1]
    found = {r.file_count: r for r in header_report(spark, str(tmp_path / "f"), NAMES).filter("size(extra) > 0 OR file_count > 1").collect()}
    assert (found[2].missing, found[2].extra) == ([], [])
    assert (found[1].missing, found[1].extra) == (["specialty_description"], ["brand_new"])


def test_one_scan_for_each_header(spark, tmp_path):
    three_headers(tmp_path / "f")
    plan = read_claims(spark, str(tmp_path / "f"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 3
    write(tmp_path / "g", "a.csv", NAMES, [row("1")])
    write(tmp_path / "g", "b.csv", NAMES, [row("2")])
    assert read_claims(spark, str(tmp_path / "g"))._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1


def test_a_run_reports_the_headers(spark, tmp_path):
    three_headers(tmp_path / "partd/provider_drug/2021")
    (tmp_path / "npi").mkdir()
    (tmp_path / "npi/n.csv").write_text(",".join(REGISTRY_NAMES) + "\n")
    out = f"{tmp_path}/out"
    run(spark, RawPaths.under(str(tmp_path)), out, 2021)
    assert {r.npi for r in read_clean(spark, out).collect()} == {"1", "3", "4", "5", "6"}
    assert read_table(spark, f"{out}/quality/headers").count() == 3
