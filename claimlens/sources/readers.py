"""Readers for the raw files.

Columns are found by their header name, in any case and order, and get a
declared type; nothing is inferred from the data. The files of a folder of
claims may have different headers, as folders of different years may: each
distinct header is one scan, and they are stacked by name. In the other
folders a file with another header fails the read; it is never matched by
position. Opening a folder reads header lines; everything else is lazy.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens import schemas
from claimlens.operators.enrich import select_registry
from claimlens.sources.headers import header_index

CORRUPT = "_corrupt_record"


def session(app_name: str = "claimlens", options: Mapping[str, str] | None = None) -> SparkSession:
    """The running session, or a new one with the given options.

    Memory, cores, file systems and shuffle partitions belong to the
    deployment; adaptive execution is on by default in Spark.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in (options or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def from_rows(spark: SparkSession, rows: Iterable, schema: T.StructType = schemas.CLAIMS) -> DataFrame:
    """A small DataFrame from rows in memory, under a declared schema."""
    return spark.createDataFrame(list(rows), schema)


def year_path(base: str, year: int | str | None = None) -> str:
    """The folder of one year, or the base folder."""
    return base if year is None else f"{base.rstrip('/')}/{year}"


def read_csv(
    spark: SparkSession, path: str | Sequence[str], types: Mapping[str, T.DataType] | None = None, keep_corrupt: bool = False,
    header: Sequence[str] | None = None,
) -> DataFrame:
    """CSV with a header; columns not in ``types`` are strings.

    ``keep_corrupt`` adds ``_corrupt_record``: the text of every line with
    too few or too many fields or with an unreadable number; every line is
    then split into all its fields. Without it Spark parses only the columns
    in use. ``path`` may be some files; where their ``header`` is known, none
    is read for it.
    """
    wanted = {name.lower(): dtype for name, dtype in (types or {}).items()}
    if header is None:
        header = spark.read.option("header", True).csv(path).columns
    fields = [T.StructField(name, wanted.get(name.lower(), T.StringType())) for name in header]
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
    if keep_corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType()))
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
    return reader.schema(T.StructType(fields)).csv(path if isinstance(path, str) else list(path))


def _lines_where(df: DataFrame, condition: str) -> DataFrame:
    """Rows by a condition on the corrupt record.

    Spark converts only the columns a query reads, so a query without the
    claim count would miss an unreadable claim count. The second condition
    always holds, but reads every typed column: all queries then see the same
    lines, and also a count has a column to read beside the corrupt record.
    """
    columns = [c for c, kind in df.dtypes if kind != "string"] or [c for c in df.columns if c != CORRUPT][:1]
    read_all_typed = f"xxhash64({', '.join(f'`{c}`' for c in columns)}) % 2 < 2"
    return df.filter(f"{CORRUPT} {condition} AND {read_all_typed}")


def good_lines(df: DataFrame) -> DataFrame:
    """The lines that parsed, without the corrupt-record column."""
    return _lines_where(df, "IS NULL").drop(CORRUPT)


def bad_lines(df: DataFrame) -> DataFrame:
    """The text of the lines that did not parse."""
    return _lines_where(df, "IS NOT NULL").select(CORRUPT)


def landed_lines(df: DataFrame) -> DataFrame:
    """The good lines of a table that was parsed and written before: a plain condition, which reads no other column."""
    return df.filter(f"{CORRUPT} IS NULL").drop(CORRUPT)


def landed_bad_lines(df: DataFrame) -> DataFrame:
    """The text of the bad lines of such a table."""
    return df.filter(f"{CORRUPT} IS NOT NULL").select(CORRUPT)


def five_digits(zip_code: str) -> Column:
    """A ZIP's five digits: lost leading zeros restored, the four digits of a ZIP+4 left off, anything else as it is."""
    code = F.trim(zip_code)
    return (
        F.when(code.rlike("^[0-9]{1,5}$"), F.lpad(code, 5, "0"))
        .when(code.rlike("^[0-9]{5}-[0-9]{4}$"), F.left(code, F.lit(5)))
        .when(code.rlike("^[0-9]{7,9}$"), F.left(F.lpad(code, 9, "0"), F.lit(5)))
        .otherwise(code)
    )


def read_claims(spark: SparkSession, path: str, year: int | str | None = None) -> DataFrame:
    """Provider-by-drug claims with ``_corrupt_record``; ZIPs get their five digits.

    A column that some of the folder's files lack is NULL in their lines.
    """
    folder = year_path(path, year)
    headers = header_index(spark, folder)
    if len(headers) > 1:
        raw = union_years([read_csv(spark, files, schemas.CLAIM_NUMBERS, True, header) for header, files in headers.items()])
    else:
        raw = read_csv(spark, folder, schemas.CLAIM_NUMBERS, keep_corrupt=True)
    zips = [c for c in raw.columns if schemas.PROVIDER_DRUG_NAMES.get(c.lower()) == "provider_zip"]
    return raw.withColumns({c: five_digits(c) for c in zips})


def year_folders(spark: SparkSession, path: str) -> list[int]:
    """The years that have a folder below ``path``."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(path)
    found = base.getFileSystem(conf).listStatus(base)
    names = [status.getPath().getName() for status in found if status.isDirectory()]
    return sorted(int(n) for n in names if n.isdigit() and len(n) == 4)


def read_claim_years(spark: SparkSession, path: str, years: Sequence[int]) -> DataFrame:
    """Several yearly folders as one, each row with its ``year``."""
    return union_years([
        read_claims(spark, path, year).withColumn("year", F.lit(int(year))) for year in years
    ])


def union_years(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column that a year lacks is NULL there."""
    first, *others = frames
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The provider registry: five of its several hundred columns."""
    return select_registry(read_csv(spark, path))


def read_census(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, {f.name: f.dataType for f in schemas.CENSUS}).select(schemas.CENSUS.names)


def read_drug_reference(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path).select(schemas.DRUG_REFERENCE.names)


def read_provider_totals(spark: SparkSession, path: str, year: int | str | None = None) -> DataFrame:
    """Supplied per-provider totals, to reconcile the own aggregates with."""
    return read_csv(spark, year_path(path, year), schemas.CLAIM_NUMBERS)


def read_geography_totals(spark: SparkSession, path: str, year: int | str | None = None) -> DataFrame:
    """Supplied per-geography drug totals, to reconcile the own aggregates with."""
    return read_csv(spark, year_path(path, year), schemas.CLAIM_NUMBERS)


@dataclass(frozen=True)
class RawPaths:
    """Where the raw folders are, on any file system Spark can read; None where absent."""

    provider_drug: str
    npi_registry: str
    census: str | None = None
    drug_reference: str | None = None
    provider_summary: str | None = None
    geography_drug: str | None = None

    @classmethod
    def under(cls, base: str) -> RawPaths:
        """The usual layout below one folder."""
        base = base.rstrip("/")
        return cls(
            provider_drug=f"{base}/partd/provider_drug",
            npi_registry=f"{base}/npi",
            census=f"{base}/census",
            drug_reference=f"{base}/drug_reference",
            provider_summary=f"{base}/partd/provider",
            geography_drug=f"{base}/partd/geography_drug",
        )


def read_all(spark: SparkSession, paths: RawPaths, year: int | str | None = None) -> dict[str, DataFrame]:
    """All raw inputs that have a path, by name."""
    readers = {
        "provider_drug": lambda p: read_claims(spark, p, year),
        "npi_registry": lambda p: read_registry(spark, p),
        "census": lambda p: read_census(spark, p),
        "drug_reference": lambda p: read_drug_reference(spark, p),
        "provider_summary": lambda p: read_provider_totals(spark, p, year),
        "geography_drug": lambda p: read_geography_totals(spark, p, year),
    }
    return {name: read(path) for name, read in readers.items() if (path := getattr(paths, name))}
