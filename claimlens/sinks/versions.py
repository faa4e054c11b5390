"""Tables in versions: a write goes to a folder of its own, and one small manifest makes it the table.

    table/__version=<id>/...            rows as Spark writes them, never changed afterwards
    table/_manifests/00000003.json      which folders version 3 is made of, its schema, and notes of the writer

A write that fails leaves no manifest, so readers go on with the version before. A table may be in parts, one for each
value of its first folder column: a write then replaces some parts, and the manifest takes the others over from the
version before. Readers open the folders of one manifest only. Spark passes by folders whose names begin with an
underscore and hold no equals sign, as that of the manifests.

The manifest is written beside its place and renamed. One writer a table is assumed; where a manifest of the same number
is there already, the write is refused and the table stays as it is. Folders that no kept version uses are deleted by
:func:`drop_old_versions` alone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.sinks.writers import write_table

VERSION = "__version"
MANIFESTS = "_manifests"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
WHOLE = ""


@dataclass(frozen=True)
class Manifest:
    """One version: the version folder that holds each part, the schema, the rows where known, and the writer's notes."""

    number: int
    schema: T.StructType
    parts: Mapping[str, str]
    part_column: str | None = None
    fmt: str = "parquet"
    rows: int | None = None
    notes: Mapping[str, object] = field(default_factory=dict)

    def by_value(self) -> dict[str | None, str]:
        """The version folder of each part, by the part's value as text."""
        return {_value(part): version for part, version in self.parts.items()}

    def folders(self, path: str, values: Iterable | None = None) -> list[str]:
        """Where the parts lie, or those of some values."""
        wanted = None if values is None else {_text(v) for v in values}
        return [
            f"{path}/{VERSION}={version}" + (f"/{part}" if part else "")
            for part, version in sorted(self.parts.items())
            if wanted is None or _value(part) in wanted
        ]

    def to_json(self) -> str:
        return json.dumps({**self.__dict__, "schema": json.loads(self.schema.json())}, sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        held = json.loads(text)
        return cls(**{**held, "schema": T.StructType.fromJson(held["schema"])})


def _value(part: str) -> str | None:
    """The value that a part's folder stands for, as text."""
    text = unquote(part.partition("=")[2])
    return None if text == NO_VALUE else text


def _text(value: object) -> str | None:
    return None if value is None else str(value)


class _Folder:
    """A folder on any file system that Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.files = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        place = self._at(name)
        return sorted(s.getPath().getName() for s in self.files.listStatus(place)) if self.files.exists(place) else []

    def read(self, name: str) -> str:
        stream = self.files.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a small file that is there as a whole or not at all; an existing one stays."""
        draft = f"{name}.{uuid.uuid4().hex}.draft"
        stream = self.files.create(self._at(draft), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.files.exists(self._at(name)) or not self.files.rename(self._at(draft), self._at(name)):
            self.files.delete(self._at(draft), False)
            raise FileExistsError(f"{self.path}/{name}: another run wrote this version")

    def delete(self, name: str) -> None:
        self.files.delete(self._at(name), True)


def _numbers(folder: _Folder) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in folder.names(MANIFESTS) if n.endswith(".json"))


def _manifest_name(number: int) -> str:
    return f"{MANIFESTS}/{number:08d}.json"


def current(spark: SparkSession, path: str, number: int | None = None) -> Manifest | None:
    """The last version of a table, or the given one; None where there is none yet."""
    folder = _Folder(spark, path)
    if number is None:
        found = _numbers(folder)
        if not found:
            return None
        number = found[-1]
    return Manifest.from_json(folder.read(_manifest_name(number)))


def write_version(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    parts: Iterable | None = None,
    in_parts: bool = False,
    fmt: str = "parquet",
    files: int | None = None,
    rebalance: bool = True,
    notes: Mapping[str, object] | None = None,
    sort_by: Sequence[str] = (),
) -> Manifest:
    """Write df as the next version of the table at ``path``, and commit it.

    With ``in_parts`` the table has a part for each value of the first of
    ``partition_by``. ``parts`` then names the values that this write
    replaces: their old rows go, also where no new row has the value; all
    other parts stay. A row of another value is refused before the commit.
    Without ``parts`` the new rows are the whole table.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if parts is not None and not (in_parts and partition_by):
        raise ValueError("only a table in parts can have some replaced")
    before, version = current(spark, path), uuid.uuid4().hex
    rows = write_table(df, f"{path}/{VERSION}={version}", partition_by, "error", fmt, files, rebalance, sort_by=sort_by)
    column = partition_by[0] if in_parts else None
    if not in_parts:
        kept, new = {}, {WHOLE: version}
    else:
        new = {n: version for n in _Folder(spark, path).names(f"{VERSION}={version}") if n.startswith(f"{column}=")}
        kept = {}
        if parts is not None:
            replaced = {_text(v) for v in parts}
            if strange := {_value(p) for p in new} - replaced:
                raise ValueError(f"rows of parts that this write doesn't replace: {sorted(map(str, strange))}")
            if before and before.part_column != column:
                raise ValueError(f"the table is in parts by {before.part_column}, not by {column}")
            kept = {p: v for p, v in (before.parts if before else {}).items() if _value(p) not in replaced}
    schema = _widened(before.schema, df.schema) if kept else df.schema
    manifest = Manifest((before.number if before else 0) + 1, schema, {**kept, **new}, column, fmt, None if kept else rows, {**({"sort_by": [*sort_by]} if sort_by else {}), **(notes or {})})
    commit(spark, path, manifest)
    return manifest


def commit(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Make a manifest the table's next version."""
    _Folder(spark, path).create(_manifest_name(manifest.number), manifest.to_json())


def _widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """The columns of both; one that both have must have one type."""
    kinds = {f.name: f.dataType for f in old}
    for f in new:
        if kinds.setdefault(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name} is {kinds[f.name].simpleString()} in the parts that stay, {f.dataType.simpleString()} in the new ones")
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def read_version(spark: SparkSession, path: str, manifest: Manifest | None = None, parts: Iterable | None = None) -> DataFrame:
    """The rows of a version (the last one), or of some of its parts; other folders aren't even listed."""
    path = path.rstrip("/")
    manifest = manifest or current(spark, path)
    if manifest is None:
        raise FileNotFoundError(f"no table at {path}")
    folders = manifest.folders(path, parts)
    if not folders:
        return spark.createDataFrame([], manifest.schema)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in manifest.schema] + [T.StructField(VERSION, T.StringType())])
    reader = spark.read.schema(schema).option("basePath", path).format(manifest.fmt)
    if manifest.fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(folders).select([F.col(f"`{f.name}`") for f in manifest.schema])


def read_top(spark: SparkSession, path: str, n: int, part: object = WHOLE) -> DataFrame:
    """The first ``n`` rows of a table written with ``sort_by``, or of one of its parts: opens the first files, as many as hold n rows."""
    path = path.rstrip("/")
    manifest = current(spark, path)
    order = (manifest.notes if manifest else {}).get("sort_by")
    if not order:
        raise ValueError(f"the table at {path} isn't sorted")
    folders = manifest.folders(path, None if part == WHOLE else [part])
    if manifest.part_column and len(folders) > 1:
        raise ValueError("each part has an order of its own: name one")
    by = [F.desc_nulls_last(c[1:]) if c.startswith("-") else F.asc_nulls_last(c) for c in order]
    rows = read_version(spark, path, manifest, None if part == WHOLE else [part])
    files = sorted(rows.inputFiles(), key=lambda f: f.rpartition("/")[2])
    schema, held, chosen = T.StructType([f for f in rows.schema if f.name != manifest.part_column]), 0, []
    for file in files:
        chosen.append(file)
        held += spark.read.schema(schema).parquet(file).count()  # from its footer
        if held >= n:
            break
    if not chosen:
        return rows.limit(0)
    first = spark.read.schema(schema).parquet(*chosen)
    if manifest.part_column:
        first = first.withColumn(manifest.part_column, F.lit(_text(part)).cast(rows.schema[manifest.part_column].dataType))
    return first.select(rows.columns).orderBy(*by).limit(n)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table in versions, or else plain Parquet."""
    return read_version(spark, path) if current(spark, path) else spark.read.parquet(path)


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete the manifests before the last ``keep`` and the version folders that no kept one uses; those of failed writes too.

    Not to be called while another run writes the table.
    """
    if keep < 1:
        raise ValueError("the current version stays")
    folder = _Folder(spark, path)
    numbers = _numbers(folder)
    used = {v for n in numbers[-keep:] for v in current(spark, path, n).parts.values()}
    for n in numbers[:-keep]:
        folder.delete(_manifest_name(n))
    gone = [n for n in folder.names() if n.startswith(f"{VERSION}=") and n.partition("=")[2] not in used] if numbers else []
    for name in gone:
        folder.delete(name)
    return gone
