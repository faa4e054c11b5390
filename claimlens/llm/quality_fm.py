"""Quality scores from a factorisation machine.

A text's features are its hashed words (log counts, scaled to length one), statistics of its structure, and metadata
(its stated length). The machine adds to a linear score the products of all pairs of features, weighted by the inner
products of their factors; by the sum-of-squares identity that takes time linear in the features present.

The model is fitted on at most ``SAMPLE`` labelled rows, those with the smallest hash of their id. Scoring reads every
whole text. Null texts count as empty; empty texts get the score of their statistics. A null id gives a row that is
neither held out nor learnt from. Without any labelled row all scores are 0.5.
"""

from __future__ import annotations

import math
import operator
import warnings
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, IntegerType, StructField, StructType

from claimlens.llm.common import table

SAMPLE = 6000
WORD_BITS = 14
FACTORS = 8
EPOCHS = 12
FOLDS, HELD_OUT = 3, 1
SYMBOLS = "!?.,;:|%$#*&@/\\<>(){}[]_-+=~^\"'"
FEATURES = StructType([StructField("index", ArrayType(IntegerType())), StructField("value", ArrayType(FloatType()))])

#: Of each byte: 0 other, 1 lower, 2 upper, 3 digit, 4 blank, 5 line end, 6 sentence mark, 7 other symbol, 8 beyond ASCII.
KIND = np.zeros(256, np.uint8)
for kind, members in ((1, range(97, 123)), (2, range(65, 91)), (3, range(48, 58)), (4, b" \t"), (5, b"\n\r"), (6, b".,;:?'\"-()"), (7, b"!|%$#*&@/\\<>{}[]_+=~^`"), (8, range(128, 256))):
    KIND[[*members]] = kind


def structure(text: str, words: list[str], counts: Counter, stated: int | None) -> list[float]:
    """Statistics of a text, and its stated length."""
    raw = text.encode()
    size, n = max(1, len(raw)), max(1, len(words))
    kinds = np.bincount(KIND[np.frombuffer(raw, np.uint8)], minlength=9) / size if raw else np.zeros(9)
    lines = text.split("\n")
    return [
        *kinds[1:].tolist(),
        kinds[2] / max(1e-9, kinds[1] + kinds[2]),
        *(min(1.0, text.count(c) / n) for c in SYMBOLS),
        math.log1p(len(raw)),
        math.log1p(len(words)),
        len(text) / n,
        len(counts) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        counts.most_common(1)[0][1] / n if counts else 0.0,
        sum(map(str.isupper, counts)) / max(1, len(counts)),
        sum(map(str.isalpha, counts)) / max(1, len(counts)),
        math.log1p(len(lines)),
        len({*lines}) / len(lines),
        math.log1p(len(text) / len(lines)),
        max(map(len, counts), default=0) ** 0.5,
        float(stated is None),
        math.log1p(max(0, stated or 0)),
    ]


STATISTICS = len(structure("", [], Counter(), None))
WIDTH = STATISTICS + (1 << WORD_BITS)


def features(text: str, stated: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values; the statistics come first."""
    words = text.split()
    counts = Counter(words)
    slots = np.fromiter((zlib.crc32(w.encode()) for w in counts), np.int64, len(counts)) & ((1 << WORD_BITS) - 1)
    sums = np.bincount(slots, np.fromiter(counts.values(), np.float64, len(counts)), 1 << WORD_BITS)
    at = np.flatnonzero(sums)
    weights = 1 + np.log(sums[at])
    weights /= max(1e-9, float(np.sqrt(weights @ weights)))
    return np.concatenate([np.arange(STATISTICS), at + STATISTICS]), np.concatenate([structure(text, words, counts, stated), weights])


@dataclass
class Model:
    """A fitted machine: bias, weights, factors, and the statistics' means and deviations."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    deviation: np.ndarray

    def scaled(self, value: np.ndarray) -> np.ndarray:
        out = value.copy()
        out[:STATISTICS] = np.clip((value[:STATISTICS] - self.mean) / self.deviation, -5, 5) / 5
        return out

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        x = self.scaled(value)
        of = self.factors[index] * x[:, None]
        pairs = 0.5 * float((of.sum(0) ** 2).sum() - (of * of).sum())
        raw = self.bias + float(self.weights[index] @ x) + pairs
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, raw))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> Model | None:
    """Fit by AdaGrad on small batches of (index, value, label)."""
    if not rows:
        return None
    rng = np.random.default_rng(seed)
    top = np.array([v[:STATISTICS] for _, v, _ in rows])
    share = (sum(y for *_, y in rows) + 1) / (len(rows) + 2)
    model = Model(math.log(share / (1 - share)), np.zeros(WIDTH), rng.normal(0, 0.05, (WIDTH, FACTORS)), top.mean(0), top.std(0) + 1e-6)
    data = [(i, model.scaled(v), y) for i, v, y in rows]
    seen_bias, seen_w, seen_v = 1e-6, np.full(WIDTH, 1e-6), np.full((WIDTH, FACTORS), 1e-6)
    rate, shrink = 0.1, 1e-5
    for _ in range(EPOCHS):
        order = rng.permutation(len(data))
        for start in range(0, len(order), 64):
            batch = [data[k] for k in order[start : start + 64]]
            n = len(batch)
            row = np.repeat(np.arange(n), [len(i) for i, *_ in batch])
            at, x = np.concatenate([i for i, *_ in batch]), np.concatenate([v for _, v, _ in batch])
            y = np.array([y for *_, y in batch], float)
            used, slot = np.unique(at, return_inverse=True)
            v = model.factors[at] * x[:, None]
            sums = np.array([np.bincount(row, v[:, f], n) for f in range(FACTORS)]).T
            squares = np.bincount(row, (v * v).sum(1), n)
            raw = model.bias + np.bincount(row, model.weights[at] * x, n) + 0.5 * ((sums**2).sum(1) - squares)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y) / n
            weighted = error[row] * x
            grad_w = np.bincount(slot, weighted, len(used)) + shrink * model.weights[used]
            inner = weighted[:, None] * (sums[row] - v)
            grad_v = np.array([np.bincount(slot, inner[:, f], len(used)) for f in range(FACTORS)]).T + shrink * model.factors[used]
            grad_b = float(error.sum())
            seen_bias += grad_b**2
            seen_w[used] += grad_w**2
            seen_v[used] += grad_v**2
            model.bias -= rate * grad_b / math.sqrt(seen_bias)
            model.weights[used] -= rate * grad_w / np.sqrt(seen_w[used])
            model.factors[used] -= rate * grad_v / np.sqrt(seen_v[used])
    return model


def held_out(id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", length: str = "n_chars", label: str = "quality", sample: int = SAMPLE) -> Model | None:
    """A model from at most ``sample`` labelled rows outside the held-out fold; the labels' rows, then the texts', in order of a hash.

    Labels of documents that aren't there are passed over before any is drawn. None where no label is left.
    """
    there = docs.select(F.col(id).alias("__there"))
    labels = labels.select(id, label).join(there, F.col(id) == F.col("__there"), "left_semi")
    known = labels.where(F.col(id).isNotNull() & F.col(label).isin(0, 1) & ~held_out(id)).groupBy(id).agg(F.max(label).alias("__y"))
    chosen = known.orderBy(F.xxhash64(id), id).limit(sample).toArrow()
    few = docs.sparkSession.createDataFrame(chosen).withColumnRenamed(id, "__id")

    @F.arrow_udf(FEATURES)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lengths in batches:
            found = [features(t.as_py() or "", n.as_py()) for t, n in zip(texts, lengths)]
            yield pa.StructArray.from_arrays([pa.array([i for i, _ in found], pa.list_(pa.int32())), pa.array([v for _, v in found], pa.list_(pa.float32()))], ["index", "value"])

    met = docs.select(F.col(id).alias("__id"), F.col(text).cast("string").alias("t"), F.col(length).cast("long").alias("n")).join(F.broadcast(few), "__id")
    drawn = met.select("__id", F.col("__y"), run.asNondeterministic()("t", "n").alias("x")).orderBy(F.xxhash64("__id"), "__id", F.xxhash64("x.index")).limit(sample).toArrow()
    x = drawn.column("x").combine_chunks()
    x = x if isinstance(x, pa.StructArray) else pa.concat_arrays(x.chunks)
    pairs = zip(x.field("index"), x.field("value"), drawn.column("__y").to_pylist())
    return fit([(i.values.to_numpy().astype(np.int64), v.values.to_numpy().astype(np.float64), int(y)) for i, v, y in pairs])


def scored(docs: DataFrame, model: Model | None, text: str = "text", length: str = "n_chars", into: str = "score") -> DataFrame:
    """docs with a score from 0 to 1 of each whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        own = sent.value
        for texts, lengths in batches:
            yield pa.array([own.score(*features(t.as_py() or "", n.as_py())) if own else 0.5 for t, n in zip(texts, lengths)], pa.float64())

    return docs.withColumn(into, run.asNondeterministic()(F.col(text).cast("string"), F.col(length).cast("long")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those scored below one half; a warning, and all of docs, where no labelled document tells what is good."""
    model = train(docs, labels)
    if model is None:
        warnings.warn("no document is labelled: none is rejected", stacklevel=2)
    return scored(docs, model, into="__score").where("__score >= 0.5").drop("__score")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: fold, score, and the class it means."""
    docs = table(spark, sf_dir, "documents")
    out = scored(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
