"""The whole job: raw claims to clean layer to marts."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.config import DEFAULTS, Settings
from claimlens.operators.classify import flag_risk, risk_from_reference, unknown_categories
from claimlens.operators.clean import clean, rename_columns
from claimlens.operators.enrich import enrich
from claimlens.operators.geo import ZIP_OPIOID, geo_aggregate, geo_grouping, hotspots, per_capita, zip_hotspots
from claimlens.operators.marts import DRUG, PROVIDER, SPECIALTY, with_opioid_share
from claimlens.operators.quality import layer_statistics, reconcile_all
from claimlens.operators.temporal import add_calendar, bad_dates, trend_grouping, year_over_year
from claimlens.plans import incremental
from claimlens.sinks.marts import (
    CATALOG_PATH,
    CLEAN_PATH,
    DASHBOARD_PATH,
    LANDED_FROM,
    MARTS,
    YEAR,
    read_clean,
    write_clean,
    write_marts,
)
from claimlens.schemas import PROVIDER_DRUG_NAMES
from claimlens.sinks.versions import drop_old_versions, read_version, write_version
from claimlens.sources.headers import header_report
from claimlens.sources.readers import (
    CORRUPT,
    RawPaths,
    good_lines,
    landed_bad_lines,
    landed_lines,
    read_census,
    read_claims,
    read_drug_reference,
    read_geography_totals,
    read_provider_totals,
    read_registry,
    union_years,
    year_folders,
    year_path,
)

MODES = ("full", "extract", "transform", "load")
LANDED_PATH = "landed"
REJECTED_LINES_PATH = "rejected_lines"
HEADERS_PATH = "quality/headers"
EXTRACTION_PATH = "extraction"
STATISTICS_PATH = "statistics"
UNKNOWN_CATEGORIES_PATH = "quality/unknown_categories"
BAD_DATES_PATH = "quality/bad_dates"
# Marts that are one grouping and nothing else: only their changed folders are written.
ONE_GROUPING = {
    "provider_summary": "provider",
    "drug_summary": "drug",
    "zip_hotspots": "zip",
    "temporal_trends": "yearly",
    "quarterly_trends": "quarterly",
    "specialty_risk": "specialty",
}
# The measures that supplied totals may hold.
SUPPLIED_MEASURES = ("total_claims", "total_fills", "total_day_supply", "total_cost")


def cleaned_claims(
    claims: DataFrame,
    registry: DataFrame | None = None,
    drug_reference: DataFrame | None = None,
    date_column: str | None = None,
    year: int | None = None,
    quarter: str | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Clean, classify, enrich and date the claims: the fact all marts read.

    Lines that did not parse are left out. Rows that already carry a
    ``report_year`` keep it where neither a date column nor a year is given.
    """
    if CORRUPT in claims.columns:
        claims = good_lines(claims)
    fact = claims.transform(clean, settings).transform(flag_risk, settings)
    if drug_reference is not None:
        fact = risk_from_reference(fact, drug_reference, settings)
    if registry is not None:
        fact = enrich(fact, registry)
    if date_column is None and year is None and YEAR in fact.columns:
        own = fact.withColumnRenamed(YEAR, "__year")
        return add_calendar(own, year=0, quarter=quarter).withColumn(YEAR, F.col("__year")).drop("__year")
    return add_calendar(fact, date_column, year, quarter)


# The aggregates that all marts are made of.
GROUPINGS = {
    "state": geo_grouping("state"),
    "zip": ZIP_OPIOID,
    "provider": PROVIDER,
    "drug": DRUG,
    "specialty": SPECIALTY,
    "yearly": trend_grouping("year"),
    "quarterly": trend_grouping("quarter"),
}


def marts_from(aggregates: Mapping[str, DataFrame], settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """Every mart, by name, from the aggregates of GROUPINGS. All lazy.

    The tables are not sorted: a partitioned write would not keep the order.
    """
    states = aggregates["state"].transform(hotspots, percentile=settings.hotspot_percentile)
    zips, yearly = aggregates["zip"], aggregates["yearly"]
    return {
        "temporal_trends": yearly,
        "quarterly_trends": aggregates["quarterly"],
        "year_over_year": year_over_year(yearly),
        "zip_hotspot_flags": zip_hotspots(zips, settings.hotspot_percentile),
        "provider_summary": with_opioid_share(aggregates["provider"]),
        "drug_summary": aggregates["drug"],
        "state_hotspots": states,
        "zip_hotspots": zips,
        "specialty_risk": aggregates["specialty"],
        "state_aggregates": states,
        "zip_opioid_aggregates": zips,
    }


def marts_of(fact: DataFrame, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """Every mart of a cleaned fact, by name. All lazy."""
    return marts_from({name: grouping.of(fact) for name, grouping in GROUPINGS.items()}, settings)


def checks_of(
    fact: DataFrame,
    census: DataFrame | None = None,
    provider_totals: DataFrame | None = None,
    geography_totals: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """What the other inputs allow: claims per capita, and the supplied totals beside the own ones.

    Supplied tables are compared in the keys and measures that they hold,
    renamed as the claims are: providers by npi, geographies by state, drug or
    both. A table with no such key can't be compared and is left out.
    """
    tables = {}
    if census is not None:
        states = geo_aggregate(fact, "state")
        tables["state_per_capita"] = per_capita(states, census, "provider_state", "state_total_claims")
    compared = []
    for name, supplied, keys in (
        ("provider_summary", provider_totals, ["npi"]),
        ("geography_drug", geography_totals, ["provider_state", "drug_name"]),
    ):
        if supplied is not None:
            theirs = rename_columns(supplied)
            keys = [k for k in keys if k in theirs.columns]
            if not keys:
                continue
            measures = [m for m in SUPPLIED_MEASURES if m in theirs.columns]
            upper = {k: F.upper(F.trim(k)) for k in keys if k != "npi"}

            def totals(df: DataFrame, keys=keys, measures=measures, upper=upper) -> DataFrame:
                return df.withColumns(upper).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])

            rows = reconcile_all(totals(fact), totals(theirs), keys, measures)
            key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("key")
            compared.append(rows.select(
                F.lit(name).alias("supplied_table"), key, "measure", "own_value", "supplied_value", "difference", "status"
            ))
    if compared:
        tables["reconciliation"] = reduce(DataFrame.unionByName, compared)
    return tables


def transform_all(datasets: dict[str, DataFrame], **options) -> dict[str, DataFrame]:
    """The tables of a full transformation: the cleaned fact, its marts, and what further inputs allow.

    ``datasets`` are those of ``read_all``: ``provider_drug`` and, where
    present, the others. The options are those of :func:`cleaned_claims`; the
    drug reference is used only where ``datasets`` holds it.
    """
    fact = cleaned_claims(
        datasets["provider_drug"], datasets.get("npi_registry"), datasets.get("drug_reference"), **options
    )
    more = checks_of(fact, datasets.get("census"), datasets.get("provider_summary"), datasets.get("geography_drug"))
    return {"cleaned_data": fact, **marts_of(fact, options.get("settings", DEFAULTS)), **more}


class RunResult(NamedTuple):
    """What a run gives back: the tables of the phases that ran, None for the others."""

    extraction: DataFrame | None = None
    statistics: DataFrame | None = None
    catalog: DataFrame | None = None


def landing_names(raw: RawPaths, years: Sequence[int] | None) -> list[str]:
    """What the landed folders of a run are called: by year, or, of a folder without years, by its path.

    So a run replaces what an earlier one landed from the same folder, and nothing else.
    """
    if years:
        return [str(y) for y in years]
    return [f"base-{hashlib.sha256(raw.provider_drug.rstrip('/').encode()).hexdigest()[:12]}"]


def read_landed(spark: SparkSession, output: str, landed: Sequence[str] | None = None) -> DataFrame:
    """All landed lines, or those of some landed folders; a column that one of them lacks is NULL there."""
    return read_version(spark, f"{output}/{LANDED_PATH}", parts=landed)


def _written(df: DataFrame, path: str) -> DataFrame:
    """A small table, written in one file and read again."""
    return read_version(df.sparkSession, path, write_version(df, path, files=1))


def extract_phase(spark: SparkSession, raw: RawPaths, output: str, years: Sequence[int] | None) -> DataFrame:
    """Parse the claim files once into Parquet, a part per raw folder; set bad lines aside; count both."""
    for year, name in zip(years or (None,), landing_names(raw, years)):
        lines = read_claims(spark, raw.provider_drug, year)
        lines = lines.toDF(*[c.lower() for c in lines.columns]).withColumn(LANDED_FROM, F.lit(name))
        write_version(lines, f"{output}/{LANDED_PATH}", (LANDED_FROM,), [name], in_parts=True, rebalance=False)
        headers = header_report(spark, year_path(raw.provider_drug, year), [*PROVIDER_DRUG_NAMES]).withColumn(LANDED_FROM, F.lit(name))
        write_version(headers, f"{output}/{HEADERS_PATH}", (LANDED_FROM,), [name], in_parts=True)
    lines = read_landed(spark, output)
    write_version(landed_bad_lines(lines), f"{output}/{REJECTED_LINES_PATH}")
    counts = lines.agg(
        F.expr(f"count_if({CORRUPT} IS NULL) AS records_extracted"), F.expr(f"count_if({CORRUPT} IS NOT NULL) AS lines_rejected")
    )
    return _written(counts, f"{output}/{EXTRACTION_PATH}")


def transform_phase(
    spark: SparkSession, raw: RawPaths, output: str, years: Sequence[int] | None, settings: Settings,
    quarter: str | None, use_drug_reference: bool, date_column: str | None,
) -> DataFrame:
    """Read the landed claims and the dimensions; write the clean layer, what the reference didn't settle, statistics."""
    landed = landing_names(raw, years)
    claims = landed_lines(read_landed(spark, output, landed))
    if not date_column:
        claims = claims.withColumn(YEAR, F.col(LANDED_FROM).cast("int"))
    reference = read_drug_reference(spark, raw.drug_reference) if use_drug_reference else None
    registry = read_registry(spark, raw.npi_registry)
    fact = cleaned_claims(claims, registry, reference, date_column, quarter=quarter, settings=settings)
    write_clean(fact, output, landed)
    if reference is not None:
        _written(unknown_categories(reference, settings), f"{output}/{UNKNOWN_CATEGORIES_PATH}")
    if date_column:
        _written(bad_dates(rename_columns(claims), date_column), f"{output}/{BAD_DATES_PATH}")
    return _written(layer_statistics(claims, read_clean(spark, output, landed), settings), f"{output}/{STATISTICS_PATH}")


def load_phase(
    spark: SparkSession, raw: RawPaths, output: str, settings: Settings, years: Sequence[int] | None,
    csv_files: Mapping[str, int] | None,
) -> DataFrame:
    """Bring the marts up to the clean layer, of which only changed parts are read; write the catalog and return it."""
    made, changes = incremental.aggregates(spark, output, GROUPINGS, ONE_GROUPING)
    tables = marts_from(made, settings)

    def totals(read, path: str | None) -> DataFrame | None:
        if path is None:
            return None
        return union_years([read(spark, path, year) for year in years]) if years else read(spark, path)

    if raw.census:
        census = read_census(spark, raw.census)
        tables["state_per_capita"] = per_capita(made["state"], census, "provider_state", "state_total_claims")
    of_run = read_clean(spark, output, landing_names(raw, years) if years else None)
    compared = checks_of(
        of_run, None, totals(read_provider_totals, raw.provider_summary), totals(read_geography_totals, raw.geography_drug)
    )
    return write_marts(spark, {**tables, **compared}, output, csv_files, changes)


def table_paths(output: str) -> list[str]:
    """Where the tables of a run are."""
    marts = [p for m in MARTS for p in (m.path, m.csv_path) if p]
    sums = [f"{incremental.PARTIALS_PATH}/{name}" for name in GROUPINGS]
    others = (LANDED_PATH, HEADERS_PATH, REJECTED_LINES_PATH, EXTRACTION_PATH, CLEAN_PATH, STATISTICS_PATH, UNKNOWN_CATEGORIES_PATH, BAD_DATES_PATH)
    return [f"{output}/{p}" for p in (*others, *sums, *marts, DASHBOARD_PATH, CATALOG_PATH)]


def existing(spark: SparkSession, raw: RawPaths) -> RawPaths:
    """raw without the optional inputs whose folders are not there."""
    def there(path: str | None) -> bool:
        if path is None:
            return False
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)

    optional = ("census", "provider_summary", "geography_drug")
    return replace(raw, **{name: None for name in optional if not there(getattr(raw, name))})


def run(
    spark: SparkSession,
    raw: RawPaths,
    output: str,
    year: int | Sequence[int] | None = None,
    mode: str = "full",
    quarter: str | None = None,
    settings: Settings = DEFAULTS,
    use_drug_reference: bool = False,
    date_column: str | None = None,
    csv_files: Mapping[str, int] | None = None,
    keep_versions: int | None = 2,
) -> RunResult:
    """Run one phase or, with ``full``, all; each reads what the one before wrote.

    ``year`` is one year, several, or None for all year folders (without any,
    the base folder is read, and ``date_column`` must tell the years). Landed
    and clean layer keep what earlier runs brought from other raw folders; the
    marts cover all of the clean layer, the reconciliation the years of this
    run. ``csv_files`` sets the number of CSV files by title. A written table
    between the phases cuts the lineage where it outlives any executor, and
    lets each mart scan only its own columns.

    All tables are in versions: one that fails to be written stays as it was.
    The last ``keep_versions`` of each are kept, None keeps all.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    output = output.rstrip("/")
    if year is not None:
        years = [year] if isinstance(year, int) else [int(y) for y in year]
    elif mode == "load":
        years = None
    else:
        years = year_folders(spark, raw.provider_drug) or None
        if years is None and date_column is None:
            raise ValueError("without year folders, a run needs a date column")
    result = RunResult()
    if mode in ("full", "extract"):
        result = result._replace(extraction=extract_phase(spark, raw, output, years))
    if mode in ("full", "transform"):
        statistics = transform_phase(spark, raw, output, years, settings, quarter, use_drug_reference, date_column)
        result = result._replace(statistics=statistics)
    if mode in ("full", "load"):
        result = result._replace(catalog=load_phase(spark, existing(spark, raw), output, settings, years, csv_files))
    if keep_versions is not None:
        for path in table_paths(output):
            drop_old_versions(spark, path, keep_versions)
    return result
