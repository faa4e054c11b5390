"""Helpers that several operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of at most so many bytes, measured before, is broadcast.
BROADCAST_BYTES = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; where unset, on one machine as in tests, an own one.

    On a cluster an own folder would be another one on each machine, so there the setting has to be made.
    """
    sc = spark.sparkContext
    place = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not place:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        place = tempfile.mkdtemp(prefix="claimlens-")
        atexit.register(shutil.rmtree, place, ignore_errors=True)
        sc.setCheckpointDir(place)
    return place.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends here, and its true size is known.

    The file system deletes the table when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """df, to be broadcast if its measured size allows; else Spark joins it as any other."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
