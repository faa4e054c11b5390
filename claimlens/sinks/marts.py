"""Where each mart goes, in which format and layout, and the catalog of all."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.operators.marts import main_dashboard
from claimlens.sinks.versions import Manifest, current, read_version, write_version


@dataclass(frozen=True)
class MartFile:
    """One written mart: its keys, measures, layout, and the number of files of its CSV copy."""

    source: str
    path: str
    title: str
    keys: tuple[str, ...]
    measures: str
    partition_by: tuple[str, ...] = ()
    csv_path: str | None = None
    csv_files: int = 1
    optional: bool = False
    sort_by: tuple[str, ...] = ()


# Folders, file counts and titles that readers of the output know.
CLEAN_PATH = "clean"
LANDED_FROM = "landed_from"
CLEAN_PARTITIONS = ("provider_state", "risk_category")
YEAR = "report_year"
CATALOG_PATH = "catalog"
DASHBOARD_PATH = "tableau_ready/main_dashboard"
DASHBOARD_TITLE = "Main Dashboard"
DASHBOARD_FILES = 5

MARTS = (
    MartFile(
        "provider_summary", "tableau_ready/provider_summary", "Provider Summary",
        ("npi", "provider_state", "specialty"), "claims, cost, distinct drugs, opioid and high-risk claims, opioid share",
        ("provider_state",), "tableau_ready/provider_summary_csv", 10,
    ),
    MartFile(
        "drug_summary", "tableau_ready/drug_summary", "Drug Summary",
        ("drug_name", "generic_name", "risk_category"), "claims, cost, distinct prescribers, mean unit cost",
        ("risk_category",), sort_by=("-drug_total_claims", "drug_name", "generic_name"),
    ),
    MartFile(
        "state_hotspots", "hotspots/state_level", "State Hotspots",
        ("provider_state", "risk_category"), "claims, cost, claims per beneficiary, percent rank, hotspot flag",
        (), "hotspots/state_level_csv", 1,
    ),
    MartFile(
        "zip_hotspots", "hotspots/zip_opioid", "ZIP Opioid Hotspots",
        ("provider_zip", "provider_state"), "opioid claims, providers and beneficiaries",
        ("provider_state",),
    ),
    MartFile(
        "temporal_trends", "temporal/yearly_trends", "Temporal Trends",
        ("report_year", "provider_state", "risk_category"), "yearly claims, cost and providers",
        ("report_year",), sort_by=("provider_state", "risk_category"),
    ),
    MartFile(
        "specialty_risk", "tableau_ready/specialty_risk", "Specialty Risk",
        ("specialty", "risk_category"), "claims and providers",
        sort_by=("-specialty_claims", "specialty", "risk_category"),
    ),
    MartFile(
        "quarterly_trends", "temporal/quarterly_trends", "Quarterly Trends",
        ("report_year", "report_quarter", "provider_state", "risk_category"), "quarterly claims, cost and providers",
        ("report_year",),
    ),
    MartFile(
        "year_over_year", "temporal/year_over_year", "Year over Year",
        ("provider_state", "risk_category", "report_year"), "yearly claims, those of the year before, change",
    ),
    MartFile(
        "zip_hotspot_flags", "hotspots/zip_flags", "ZIP Hotspot Flags",
        ("provider_zip", "provider_state"), "opioid claims, percent rank over all ZIPs, hotspot flag",
        ("provider_state",),
    ),
    MartFile(
        "state_per_capita", "hotspots/state_per_capita", "State Claims per Capita",
        ("provider_state", "risk_category"), "claims, population, claims per 100,000 inhabitants",
        optional=True,
    ),
    MartFile(
        "reconciliation", "quality/reconciliation", "Reconciliation with Supplied Totals",
        ("supplied_table", "key", "measure"), "own and supplied value, difference, status",
        optional=True,
    ),
)

CATALOG_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("format", T.StringType()),
    T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("row_count", T.LongType()),
    T.StructField("keys", T.ArrayType(T.StringType())),
    T.StructField("measures", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("folders", T.ArrayType(T.StringType())),
])


def write_clean(claims: DataFrame, base: str, landed: Sequence[str] | None = None) -> Manifest:
    """The clean layer: a part per landed folder, in it folders per report year, state and risk category.

    With ``landed`` only the rows that came from these landed folders are
    replaced, those of each as a whole; without, all are.
    """
    if LANDED_FROM not in claims.columns:
        claims = claims.withColumn(LANDED_FROM, F.lit("all"))
    path = f"{base.rstrip('/')}/{CLEAN_PATH}"
    return write_version(claims, path, (LANDED_FROM, YEAR, *CLEAN_PARTITIONS), landed, in_parts=True)


def read_clean(spark: SparkSession, base: str, landed: Iterable[str] | None = None) -> DataFrame:
    """The written clean layer, or what came from some landed folders; only their files are opened."""
    return read_version(spark, f"{base.rstrip('/')}/{CLEAN_PATH}", parts=landed)


@dataclass(frozen=True)
class Change:
    """What a mart's input is now, and which folders differ from what it was; None: any may."""

    source: str
    before: str | None
    folders: tuple | None


def _write_mart(table: DataFrame, path: str, mart: MartFile, change: Change | None) -> tuple[Manifest, bool]:
    """The mart's version, and whether it is a new one. Folders whose input stayed the same are taken over."""
    spark, in_parts = table.sparkSession, bool(mart.partition_by)
    options = {"partition_by": mart.partition_by, "in_parts": in_parts, "sort_by": mart.sort_by}
    if change is None:
        return write_version(table, path, **options), True
    held, notes = current(spark, path), {"source": change.source}
    reached = held.notes.get("source") if held else None
    if held and reached == change.source:
        return held, False
    if not in_parts or change.folders is None or reached != change.before or held.part_column != mart.partition_by[0]:
        return write_version(table, path, notes=notes, **options), True
    folder = F.col(mart.partition_by[0])
    known = [v for v in change.folders if v is not None]
    some = folder.isin(known) | (folder.isNull() if len(known) < len(change.folders) else F.lit(False))
    return write_version(table.filter(some), path, parts=change.folders, notes=notes, **options), True


def write_marts(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    base: str,
    csv_files: Mapping[str, int] | None = None,
    changes: Mapping[str, Change] | None = None,
) -> DataFrame:
    """Write every mart, its CSV copy and the dashboard extract; return the catalog.

    Each is a table in versions (``sinks/versions.py``); the catalog, written
    last, names the version of each and the folders it is made of. The CSV
    copies read the Parquet mart just written, so no aggregate runs twice.
    ``csv_files`` sets the number of files of a copy by the mart's title; the
    same number holds for any number of rows. Optional marts are left out
    where ``tables`` lacks them. With ``changes`` (by source), only folders
    whose input changed are written, and nothing for a mart without any.
    """
    base = base.rstrip("/")
    files = {m.title: m.csv_files for m in MARTS} | {DASHBOARD_TITLE: DASHBOARD_FILES} | dict(csv_files or {})
    entries = []

    def copy(df: DataFrame, path: str, title: str, new: bool) -> Manifest:
        held = None if new else current(spark, path)
        number = files[title]
        return held if held and held.notes.get("files") == number else write_version(df, path, fmt="csv", files=number, notes={"files": number})

    for mart in MARTS:
        if mart.optional and mart.source not in tables:
            continue
        table = tables[mart.source]
        path = f"{base}/{mart.path}"
        done, new = _write_mart(table, path, mart, (changes or {}).get(mart.source))
        written = read_version(spark, path, done).select(table.columns)
        rows = written.count() if done.rows is None else done.rows
        formats, folders = "parquet", done.folders(path)
        if mart.csv_path:
            csv = f"{base}/{mart.csv_path}"
            folders += copy(written, csv, mart.title, new).folders(csv)
            formats = "parquet/csv"
        entries.append((mart.title, path, formats, table.columns, rows, list(mart.keys), mart.measures, done.number, folders))
        if mart.source == "provider_summary":
            extract = main_dashboard(written)
            target = f"{base}/{DASHBOARD_PATH}"
            out = copy(extract, target, DASHBOARD_TITLE, new)
            entries.append((DASHBOARD_TITLE, target, "csv", extract.columns, rows, list(mart.keys), mart.measures, out.number, out.folders(target)))
    catalog = spark.createDataFrame(entries, CATALOG_SCHEMA)
    write_version(catalog, f"{base}/{CATALOG_PATH}", files=1)
    return catalog
