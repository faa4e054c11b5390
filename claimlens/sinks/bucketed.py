"""Tables in buckets of a key, so that joins and aggregates on the key need no shuffle.

Rows are dealt to a fixed number of buckets by a hash of the key, once, when the table is written; two tables with the same
number of buckets are joined bucket by bucket where they lie. Spark knows a table's buckets from its catalog only, so a
reader registers the folder under a name made of its path; nothing but that name is kept in the session.

A key with a large part of all rows stays in one bucket, and a join without a shuffle can't be split by AQE: for such data
read the folder as plain Parquet and use ``enrich``, which shuffles and splits. ``heaviest_share`` tells which it is.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.operators.enrich import keep_latest
from claimlens.sinks.versions import Manifest, commit, current

BUCKETS = 200


def _name(path: str) -> str:
    return "bucketed_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> Manifest:
    """Write df as the next version of a table in ``buckets`` buckets of ``key``, each sorted by it: one file a bucket."""
    spark, path, version = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    before = current(spark, path)
    folder = f"{path}/__version={version}"
    # Dealt as the buckets are, so each bucket is written by one task.
    dealt = df.repartition(buckets, key)
    writer = dealt.write.format("parquet").mode("error").bucketBy(buckets, key).sortBy(key).option("path", folder)
    writer.saveAsTable(_name(folder))
    notes = {"bucketed_by": key, "buckets": buckets}
    manifest = Manifest((before.number if before else 0) + 1, df.schema, {"": version}, notes=notes)
    commit(spark, path, manifest)
    return manifest


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The last version of such a table, with its buckets known to Spark."""
    path = path.rstrip("/")
    manifest = current(spark, path)
    if manifest is None or "bucketed_by" not in manifest.notes:
        raise FileNotFoundError(f"no bucketed table at {path}")
    folder = manifest.folders(path)[0]
    name = _name(folder)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in manifest.schema)
        key, buckets = manifest.notes["bucketed_by"], manifest.notes["buckets"]
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{folder}'")
    return spark.table(name)


def enrich_colocated(claims: DataFrame, registry: DataFrame, key: str = "npi") -> DataFrame:
    """``enrich`` where both sides are in buckets of the key: no row is shuffled."""
    latest = registry.transform(keep_latest, key).withColumnRenamed(key, "__right_key")
    return claims.join(latest, F.col(key) == F.col("__right_key"), "left").drop("__right_key")


def heaviest_share(df: DataFrame, key: str) -> float:
    """The share of all rows that the most frequent key has: the part of a join without a shuffle that one task does."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    return (counted["most"] or 0) / (counted["all"] or 1)
