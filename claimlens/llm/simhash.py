"""SimHash near-duplicates by pivot distance tables.

A fingerprint's 64 bits are cut into blocks. For each block there are reference patterns; a fingerprint's Hamming
distances to them, counted in the block, are its pivot table. By the triangle inequality two fingerprints differ in a
block by at least the greatest difference of their distances to its references, so the sum of these over the blocks
bounds their distance from below. Fingerprints that differ in at most ``MAX_BITS`` bits differ in at most that many
blocks, so all other blocks have *equal* distances: these are the join keys. Pairs that share a key are discarded where
the bound exceeds ``MAX_BITS``, and the rest is verified on the bits.

Only distinct fingerprints are compared. A key held by more than ``CROWD`` of them is not paired off: its members are
linked through the fingerprints between them, at most one differing bit each, which takes one row per bit and links
the same components.

Null and empty texts have fingerprint zero and are linked like any other. Repeated rows each give a row. A null id
gives a row; it names no component.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from random import Random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from claimlens.llm.common import stored, table
from claimlens.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
WIDTHS = (11, 11, 11, 11, 10, 10)
REFERENCES = 8
CROWD = 64
#: Shingles hashed at a time.
SLICE = 1 << 15


def fingerprint_bits(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text: a bit is set if it is in over half of the shingles' hashes."""
    found = text.lower().split()
    if not found:
        return 0
    shifted = [found[k:] for k in range(min(words, len(found)))]
    counts, n = np.zeros(64, np.int64), len(shifted[-1])
    join, digest = b" ".join, xxhash.xxh64_intdigest
    for at in range(0, n, SLICE):
        shingles = zip(*(x[at : at + SLICE] for x in shifted))
        hashes = np.fromiter((digest(join(x), SEED) for x in shingles), np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


@F.arrow_udf(LongType())
def _fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        bits = np.array([fingerprint_bits(x.as_py() or b"") for x in batch], np.uint64)
        yield pa.array(bits.view(np.int64), pa.int64())


def fingerprints(docs: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """docs with the SimHash of each text, its 64 bits as a long."""
    return docs.withColumn(into, _fingerprint.asNondeterministic()(docs[text].cast("string").cast("binary")))


def blocks() -> list[tuple[int, int]]:
    """Shift and width of each block of bits."""
    return [(sum(WIDTHS[:k]), w) for k, w in enumerate(WIDTHS)]


def references() -> list[list[int]]:
    """The reference patterns of each block, the same in every run."""
    rng = Random(SEED)
    return [rng.sample(range(1 << width), REFERENCES) for _, width in blocks()]


def _pivot_columns(bits: Column) -> list[Column]:
    """Per block, its distances to the references, four bits each, in one long."""
    out = []
    for (shift, width), patterns in zip(blocks(), references()):
        part = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        distances = [F.shiftleft(F.bit_count(part.bitwiseXOR(F.lit(p).cast("long"))).cast("long"), 4 * k) for k, p in enumerate(patterns)]
        out.append(reduce(Column.bitwiseOR, distances))
    return out


def _bound(left: str, right: str) -> Column:
    """Sum over the blocks of the greatest difference of a pivot distance."""

    def nibble(table: str, block: int, k: int) -> Column:
        return F.shiftrightunsigned(F.col(f"{table}.d{block}"), 4 * k).bitwiseAND(F.lit(15).cast("long"))

    greatest = [F.greatest(*(F.abs(nibble(left, b, k) - nibble(right, b, k)) for k in range(REFERENCES))) for b in range(len(WIDTHS))]
    return reduce(Column.__add__, greatest)


def links(distinct: DataFrame, bits: str = "fingerprint") -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct fingerprints within MAX_BITS bits."""
    pivots = distinct.select(F.col(bits).alias("f"), *(d.alias(f"d{k}") for k, d in enumerate(_pivot_columns(F.col(bits)))))
    kept = len(WIDTHS) - MAX_BITS
    choices = [F.struct(F.lit(n).alias("choice"), F.xxhash64(*(f"d{k}" for k in c)).alias("key")) for n, c in enumerate(combinations(range(len(WIDTHS)), kept))]
    keyed = pivots.withColumn("k", F.explode(F.array(*choices))).select("k.choice", "k.key", "f", *(f"d{k}" for k in range(len(WIDTHS))))
    crowds = keyed.groupBy("choice", "key").count().where("count > 1")
    keyed = stored(keyed.join(crowds, ["choice", "key"]), "simhash-keys")
    few, many = keyed.where(F.col("count") <= CROWD), keyed.where(F.col("count") > CROWD)
    pairs = (
        few.alias("x")
        .join(few.alias("y"), (F.col("x.choice") == F.col("y.choice")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.f") < F.col("y.f")))
        .where(_bound("x", "y") <= MAX_BITS)
        .where(F.bit_count(F.col("x.f").bitwiseXOR(F.col("y.f"))) <= MAX_BITS)
        .select(F.col("x.f").alias("a"), F.col("y.f").alias("b"))
    )
    between = F.array(F.col("f"), *(F.col("f").bitwiseXOR(F.lit(1 << k if k < 63 else -(1 << 63)).cast("long")) for k in range(64)))
    hubs = many.select("f").distinct().withColumn("hub", F.explode(between))
    first = hubs.groupBy("hub").agg(F.min("f").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    return pairs.union(hubs.join(first, "hub").where("f > b").select(F.col("b").alias("a"), F.col("f").alias("b"))).distinct()


def _classes(marked: DataFrame) -> DataFrame:
    """Each distinct fingerprint with the id and fingerprint that stand for its component: the smallest id's."""
    distinct = marked.groupBy("fingerprint").agg(F.min("id").alias("least"))
    classes = components(links(distinct.select("fingerprint")))
    roots = stored(
        distinct.join(classes, distinct.fingerprint == classes.node, "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")),
        "simhash-roots",
    )
    least = F.min(F.struct(F.col("least").isNull(), F.col("least").alias("id"), "fingerprint"))
    named = stored(roots.groupBy("root").agg(least.alias("least")).select("root", "least.id", F.col("least.fingerprint").alias("of")), "simhash-named")
    return stored(roots.join(named, "root").select("fingerprint", "id", "of"), "simhash-classes")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: id, fingerprint (long), and component_id, the smallest id reachable over links."""
    marked = stored(fingerprints(docs.select(docs[id].alias("id"), docs[text].alias("t")), "t").drop("t"), "simhash")
    classes = _classes(marked).select("fingerprint", F.col("id").alias("component_id"))
    return marked.join(classes, "fingerprint").select(F.col("id").alias(id), "fingerprint", "component_id")


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each component of fingerprints, that of the smallest id.

    Of rows that share this id and its fingerprint, the one of the least text stays, and of equal texts one. Rows without
    an id stay only where none of their component has one.
    """
    marked = fingerprints(docs.select(docs[id].alias("id"), docs[text].alias("t")), "t").drop("t")
    classes = _classes(stored(marked, "simhash-ids")).withColumnsRenamed({"fingerprint": "__bits", "id": "__id", "of": "__of"})
    named = classes.where(F.col("__bits") == F.col("__of")).select("__id", "__of")
    met = fingerprints(docs.select(F.struct(*docs.columns).alias("row"), docs[text].alias("t"), docs[id].alias("id")), "t", "bits")
    met = met.join(named, (F.col("bits") == F.col("__of")) & F.col("id").eqNullSafe(F.col("__id")))
    order = F.struct(F.col("t").isNull(), "t", F.xxhash64("row"))
    return met.groupBy("bits").agg(F.min_by("row", order).alias("row")).select("row.*")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: fingerprint in 16 hexadecimal digits, and the smallest doc_id reachable over links."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
