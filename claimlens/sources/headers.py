"""Folders whose files have several headers: which file has which, and one scan for each.

The first line of every file is read through the file system, by some threads side by side and nothing else of the file;
what comes back is a line a file. Files with the same line are one scan, and the scans are stacked by column name, so a
column stands under its name whatever its place in a file, and is NULL where a file lacks it.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

THREADS = 16
MARK = "﻿"
REPORT_SCHEMA = T.StructType([
    T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("file_count", T.LongType()),
    T.StructField("missing", T.ArrayType(T.StringType())),
    T.StructField("extra", T.ArrayType(T.StringType())),
])


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files that Spark would read in a folder (not those below it), or the file itself; empty ones are left out."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    files = [(s.getPath().getName(), s) for s in found if s.isFile() and s.getLen() > 0]
    return sorted(s.getPath().toString() for name, s in files if not name.startswith(("_", ".")))


def _first_line(spark: SparkSession, path: str) -> str:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        raw = codec.createInputStream(stream) if codec else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(raw, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


def header_index(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of each distinct header, the most frequent header first."""
    files = data_files(spark, path)
    with ThreadPoolExecutor(THREADS) as pool:
        lines = list(pool.map(lambda f: _first_line(spark, f), files))
    found: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines):
        columns = next(csv.reader([line.removeprefix(MARK)]), [])
        found.setdefault(tuple(columns), []).append(file)
    return dict(sorted(found.items(), key=lambda x: (-len(x[1]), x[0])))


def header_report(spark: SparkSession, path: str, expected: Sequence[str]) -> DataFrame:
    """Per distinct header its files, the expected columns it lacks, and those it has beyond them; names in any case."""
    wanted = [e.lower() for e in expected]
    rows = []
    for columns, files in header_index(spark, path).items():
        names = [c.lower() for c in columns]
        rows.append((list(columns), len(files), [w for w in wanted if w not in names], [c for c in columns if c.lower() not in wanted]))
    return spark.createDataFrame(rows, REPORT_SCHEMA)
