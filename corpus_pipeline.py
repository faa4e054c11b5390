"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read as the next one's
docs. All but the last keep the columns of ``documents``. Rows with null or empty texts pass all filters that don't
judge them otherwise: nothing in them is a copy of a passage or of a benchmark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimlens.llm import bpe, decontaminate, quality_fm, simhash, suffix_dedup
from claimlens.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled ones among them, doesn't reject."""
    return quality_fm.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links (three-word shingles, two bits at most), the one of the smallest id."""
    return simhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of over fifty words that stand in them or others more than once."""
    return suffix_dedup.without_repeated_words(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten words of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document as packed 32-bit integers, their number, and whether decoding gives the text back."""
    coded = bpe.decode(bpe.encode(docs.select("doc_id", "text")))
    whole = coded["decoded"].eqNullSafe(coded["text"]) | coded["text"].isNull()
    return coded.select("doc_id", bpe.n_tokens(coded["ids"]).alias("n_tokens"), "ids", whole.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: A trained classifier, hashes and merges of a vocabulary are beyond SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
