"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Documents' n-gram frequencies are counted over all learnable texts; the regression is fitted by
follow-the-regularised-leader with elastic-net penalties on at most ``SAMPLE`` of them, those with the smallest hash of
their id, a fifth of which is kept aside to set the temperature of the probabilities.

Whole texts are read, lower-cased. A null text or one without letters is ``und`` with score 0; so is any text if there
is nothing to learn from. Every row gives a row; a null id is neither held out nor learnt from.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, IntegerType, StructField, StructType

from claimlens.llm.common import table

SAMPLE = 4000
SIZES = (1, 2, 3)
BITS = 15
FOLDS, HELD_OUT = 4, 2
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.05
#: Characters hashed at a time.
SLICE = 1 << 18
UNKNOWN = "und"
COUNTS = StructType([StructField("index", ArrayType(IntegerType())), StructField("count", ArrayType(FloatType()))])


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of a text, and how often each occurs."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    counts = np.zeros(1 << BITS, np.int64)
    for n in SIZES:
        for at in range(0, max(0, len(codes) - n + 1), SLICE):
            part = codes[at : at + SLICE + n - 1]
            mixed = np.full(len(part) - n + 1, n, np.uint32)
            for k in range(n):
                mixed = (mixed ^ part[k : len(part) - n + 1 + k]) * np.uint32(0x9E3779B1)
                mixed ^= mixed >> np.uint32(15)
            counts += np.bincount(mixed >> np.uint32(32 - BITS), minlength=1 << BITS)
    index = np.flatnonzero(counts)
    return index, counts[index]


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many texts each hashed n-gram occurs, and the number of texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for value in batch.column(0):
                found[grams(value.as_py() or "")[0]] += 1
                n += 1
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"gram": pa.array([*at, -1], pa.int32()), "n": pa.array([*found[at], n], pa.int64())})

    summed = docs.select(F.col(text).cast("string")).mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    out, total = np.zeros(1 << BITS, np.int64), 0
    for gram, n in zip(summed["gram"], summed["n"]):
        if gram < 0:
            total = n
        else:
            out[gram] = n
    return out, total


@dataclass
class Model:
    """Languages, inverse document frequencies, weights (language x gram), biases, temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def values(self, index: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[index]
        return x / max(1e-9, math.sqrt(float(x @ x)))

    def logits(self, index: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.weights[:, index] @ self.values(index, counts) + self.bias

    def predict(self, text: str) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        p = softmax(self.logits(*grams(text)) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def fit(rows: list[tuple[np.ndarray, np.ndarray, str]], idf: np.ndarray, seed: int = 7) -> Model:
    """FTRL-proximal over the rows (index, counts, language), then the temperature that best suits the rows kept aside."""
    languages = sorted({y for *_, y in rows})
    width, kinds = 1 << BITS, len(languages)
    model = Model(languages, idf, np.zeros((kinds, width)), np.zeros(kinds))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    aside, learnt = order[: len(order) // 5], order[len(order) // 5 :]
    z, n = np.zeros((kinds, width)), np.zeros((kinds, width))
    bias_seen = np.full(kinds, 1e-6)
    for _ in range(EPOCHS):
        for k in rng.permutation(learnt):
            index, counts, language = rows[k]
            x = model.values(index, counts)
            zi, ni = z[:, index], n[:, index]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + root) / ALPHA + L2))
            error = softmax(w @ x + model.bias)
            error[languages.index(language)] -= 1
            g = error[:, None] * x
            z[:, index] = zi + g - (np.sqrt(ni + g * g) - root) / ALPHA * w
            n[:, index] = ni + g * g
            bias_seen += error**2
            model.bias -= 0.1 * error / np.sqrt(bias_seen)
    model.weights = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    if len(aside):
        logits = [(model.logits(*rows[k][:2]), languages.index(rows[k][2])) for k in aside]

        def loss(t: float) -> float:
            return -sum(math.log(max(1e-12, softmax(x / t)[y])) for x, y in logits)

        model.temperature = min(np.geomspace(0.05, 5, 41).tolist(), key=loss)
    return model


def held_out(id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def train(docs: DataFrame, id: str = "doc_id", text: str = "text", language: str = "lang", sample: int = SAMPLE) -> Model:
    """A model from the documents outside the held-out fold that have a text and a language."""
    usable = docs.where(F.col(id).isNotNull() & F.col(text).isNotNull() & F.col(language).isNotNull() & ~held_out(id))
    found, total = document_frequencies(usable, text)
    idf = np.log((1 + total) / (1 + found)) + 1
    keys = usable.select(F.col(id).alias("__id"), F.col(language).cast("string").alias("__lang")).distinct()
    chosen = docs.sparkSession.createDataFrame(keys.orderBy(F.xxhash64("__id"), "__id", "__lang").limit(sample).toArrow(), keys.schema)

    @F.arrow_udf(COUNTS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            got = [grams(x.as_py()) for x in batch]
            yield pa.StructArray.from_arrays([pa.array([i for i, _ in got], pa.list_(pa.int32())), pa.array([c for _, c in got], pa.list_(pa.float32()))], ["index", "count"])

    met = usable.select(F.col(id).alias("i"), F.col(language).cast("string").alias("l"), F.col(text).cast("string").alias("t")).join(F.broadcast(chosen), F.expr("i = __id AND l = __lang"))
    drawn = met.select("i", "l", run.asNondeterministic()("t").alias("x")).orderBy(F.xxhash64("i"), "i", "l", F.xxhash64("x")).limit(sample).toArrow()
    rows = []
    for batch in drawn.to_batches():
        for i, c, y in zip(batch.column("x").field("index"), batch.column("x").field("count"), batch.column("l").to_pylist()):
            if len(i):
                rows.append((i.values.to_numpy().astype(np.int64), c.values.to_numpy().astype(np.float64), y))
    return fit(rows, idf)


def predicted(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """docs with a struct of each whole text's language (lang) and its probability (score)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = sent.value
        for batch in batches:
            got = [own.predict(x.as_py() or "") for x in batch]
            yield pa.StructArray.from_arrays([pa.array([a for a, _ in got], pa.string()), pa.array([b for _, b in got], pa.float64())], ["lang", "score"])

    return docs.withColumn(into, run.asNondeterministic()(F.col(text).cast("string")))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: fold, language and probability."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = predicted(docs, train(docs))
    return out.select("doc_id", held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))
