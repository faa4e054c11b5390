"""Token counts without token ids: pieces are counted once per distinct pre-token and joined to frequencies.

1. Every task counts its pre-tokens; the counts are summed, which gives each distinct pre-token once.
2. The pieces of each are counted, once.
3. Every document's pre-token frequencies meet these counts. Pre-tokens with a share of at least ``HOT_SHARE`` of the
   corpus, of which there cannot be more than ``1 / HOT_SHARE``, are looked up where the text is read, so no hot key is
   ever shuffled; all others are joined on the pre-token, and the products are summed by document.

Null texts count as empty: zero bytes, zero tokens. Every row gives one row, repeated ones and null ids too.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm.bpe import ByteBPE, loaded, vocabulary
from claimlens.llm.common import stored, table
from claimlens.llm.cutting import cut, slices

HOT_SHARE = 2.0**-20
TOKEN_LIMIT = 512


def _is_added(bpe: ByteBPE, words: pa.Array) -> np.ndarray:
    """Which pre-tokens are added tokens, one token each wherever they stand."""
    return pc.is_in(words, value_set=pa.array([*bpe.added], pa.binary())).to_numpy(zero_copy_only=False)


def frequencies(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """Each distinct pre-token of the corpus and how often it occurs."""
    content = vocabulary(docs.sparkSession, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(content.value)
        for batch in batches:
            for part in slices(batch.column(0)):
                cuts = cut(part, bpe.added_at)
                n = np.bincount(cuts.index, minlength=len(cuts.words))
                own = ~_is_added(bpe, cuts.words)
                yield pa.RecordBatch.from_pydict({"pre_token": cuts.words.filter(pa.array(own)).cast(pa.string()), "n": pa.array(n[own], pa.int64())})

    counted = docs.select(docs[text].cast("string").alias("text")).mapInArrow(run, "pre_token string, n long")
    return counted.groupBy("pre_token").agg(F.sum("n").alias("n"))


def with_pieces(words: DataFrame, path: str | None = None) -> DataFrame:
    """words with the number of pieces of each pre-token."""
    content = vocabulary(words.sparkSession, path)

    @F.arrow_udf("int")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = loaded(content.value)
        for batch in batches:
            yield pa.array(np.diff(bpe.words(batch.cast(pa.binary()))[1]), pa.int32())

    return words.withColumn("pieces", run.asNondeterministic()("pre_token"))


def count_tokens(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Per row of docs: its id, n_bytes and n_tokens."""
    spark = docs.sparkSession
    words = stored(with_pieces(frequencies(docs, text, path), path), "pre-tokens")
    total = words.agg(F.sum("n")).first()[0] or 0
    hot_rows = words.where(F.col("n") >= max(1, total * HOT_SHARE)).select(F.col("pre_token").cast("binary"), "pieces").toArrow()
    hot = spark.sparkContext.broadcast(tuple(pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type) for c in hot_rows.columns))
    content = vocabulary(spark, path)
    kinds = {"rid": pa.int64(), "id": pa.null(), "n_bytes": pa.int64(), "pre_token": pa.string(), "n": pa.int64()}

    def counted(bpe: ByteBPE, part: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """Per text the pieces of its hot pre-tokens; and the others of each text: whose, which, how often."""
        cuts = cut(part, bpe.added_at)
        place = pc.index_in(cuts.words, value_set=hot.value[0]).fill_null(-1).to_numpy(zero_copy_only=False)
        pieces = np.zeros(len(cuts.words), np.int64)
        pieces[place >= 0] = hot.value[1].to_numpy()[place[place >= 0]]
        added = _is_added(bpe, cuts.words)
        pieces[added] = 1
        sums = np.append(0, np.cumsum(pieces[cuts.index]))
        rare = ((place < 0) & ~added)[cuts.index]
        whose = np.repeat(np.arange(len(part)), np.diff(cuts.first))[rare]
        pair, times = np.unique(whose * len(cuts.words) + cuts.index[rare], return_counts=True)
        whose, which = np.divmod(pair, max(1, len(cuts.words)))
        return np.diff(sums[cuts.first]), whose, cuts.words.take(pa.array(which)).cast(pa.string()), times

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(content.value)
        for batch in batches:
            done, own = 0, kinds | {"id": batch.schema.field("id").type}
            for part in slices(batch.column(2)):
                rows = batch.slice(done, len(part))
                done += len(part)
                base, whose, which, times = counted(bpe, part)
                rid, no = rows.column(0).to_numpy(), len(whose)
                # No pre-token is as this key, so each row keeps its count in the join.
                keys = pa.array([f"\0\0{r}" for r in rid.tolist()], pa.string())
                columns = [
                    pa.array(np.concatenate([rid, rid[whose]])),
                    pa.concat_arrays([rows.column(1), pa.nulls(no, own["id"])]),
                    pa.concat_arrays([rows.column(3), pa.nulls(no, pa.int64())]),
                    pa.concat_arrays([keys, which]),
                    pa.array(np.concatenate([base, times])),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([*own.items()]))

    value = docs[text].cast("string")
    read = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        docs[id].alias("id"),
        value.alias("text"),
        F.coalesce(F.octet_length(value), F.lit(0)).cast("long").alias("n_bytes"),
    )
    kind = docs.schema[id].dataType.simpleString()
    parts = read.mapInArrow(run, f"rid long, id {kind}, n_bytes long, pre_token string, n long")
    met = parts.join(words.select("pre_token", "pieces"), "pre_token", "left")
    pieces = F.when(F.col("n_bytes").isNotNull(), F.col("n")).otherwise(F.col("n") * F.col("pieces"))
    return met.groupBy("rid").agg(
        F.first("id", ignorenulls=True).alias(id),
        F.max("n_bytes").alias("n_bytes"),
        F.sum(pieces).alias("n_tokens"),
    ).drop("rid")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: bytes, tokens, and whether the tokens exceed the limit."""
    counts = count_tokens(table(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
