"""Phrase collocations per language by Toivonen's mining.

A phrase is frequent if it occurs ``MIN_COUNT`` times or more in its language. All words are counted in a first pass, and
of a sample of pieces all longer phrases. The frequent words and the phrases that the sample proposes (``PROPOSED``
occurrences in it) are written into a bitmap by their hash, of ``FILTER_BITS`` bits whatever the corpus. The full pass
counts all phrases whose first words and whose last words, one less each, are in the bitmap: the proposed ones and their
negative border. A frequent phrase that isn't in the bitmap is a border failure: it goes into the bitmap, and an expansion
pass counts what this adds to the border. It takes all that it adds as if it were frequent, so that extensions of
extensions are counted with them and the next look finds the border closed.

What is shuffled for a phrase is its hash of 64 bits, made from the hashes of all its words but the last and of the last
word, and a tag with ``TAG_BITS`` bits of the latter. That can be undone: the last word is a frequent one with these bits,
and its hash and the phrase's give that of the other words. So the texts of frequent phrases are put together when all is
counted. Hashes are of language and words. Should two words share theirs, or two phrases in the bitmap, or a frequent phrase
come apart in two ways, all is counted anew under another seed; only phrases that share hash and tag, 92 bits, would be taken
for one. Sample and bitmap settle which phrases are counted, never how often.

A null language is ``und``; null and empty texts have no words; repeated rows count as often as they stand there. Tasks
hold a slice of text at a time, and their counts are combined before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

from claimlens.llm.common import stored, table
from claimlens.llm.cutting import binaries, buffer_of, slices

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
SCALE = 1000
#: A candidate goes if a longer one that holds it has this share of its occurrences, in percent.
SHARE = 100
#: One piece in so many is in the sample; a phrase that occurs so often in it is proposed.
SAMPLE_EVERY = 16
PROPOSED = 2
FILTER_BITS = 26
NO_LANGUAGE = "und"
BREAKS = b".,;:!?\n\v\f\r"
BLANKS = b" \t"
MIXER = np.uint64(0x9E3779B97F4A7C15)
UNMIXER = np.uint64(pow(int(MIXER), -1, 1 << 64))
#: Bits of the last word's hash in a phrase's tag, above two bits for the number of words and one for being in the bitmap.
TAG_BITS = 28
#: Bytes of text handled at a time.
SLICE_BYTES = 1 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIXER
    return (x ^ (x >> np.uint64(29))) * MIXER


def _longer(hashes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The hash of a phrase from those of all its words but the last and of the last."""
    return _mixed(hashes * MIXER + last)


def _all_but_last(hashes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The hash of all words of a phrase but the last, from those of the phrase and of the last: _longer undone."""
    x = hashes * UNMIXER
    x = (x ^ (x >> np.uint64(29)) ^ (x >> np.uint64(58))) * UNMIXER
    return ((x ^ (x >> np.uint64(32))) - last) * UNMIXER


class _Words:
    """The words of some texts in lower case: the distinct ones, each occurrence's place among them, and its piece."""

    kinds = np.full(256, 2, np.uint8)
    kinds[list(BLANKS)], kinds[list(BREAKS)] = 0, 1
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32

    def __init__(self, texts: pa.Array, lang: str, seed: int = 0):
        data, at = buffer_of(texts)
        edge = np.zeros(len(data) + 1, bool)
        edge[at[:-1]] = True
        kind = self.kinds[data]
        inside = kind == 2
        start = inside.copy()
        start[1:] &= ~inside[:-1] | edge[1:-1]
        begins = np.flatnonzero(start)
        self.piece = np.cumsum((kind == 1) | edge[:-1], dtype=np.int32)[begins]
        letters = self.lower[data[inside]]
        found = binaries(letters, np.append(np.cumsum(inside)[begins] - 1, len(letters))).dictionary_encode()
        self.words, self.index, self.lang = found.dictionary, found.indices.to_numpy().astype(np.int64), lang
        own = np.uint64(xxhash.xxh64_intdigest(lang, 2 * seed + 1))  # another seed than the words', which may be a language's name
        self.hash = _mixed(np.fromiter((xxhash.xxh64_intdigest(w, 2 * seed) for w in self.words.to_pylist()), np.uint64, len(self.words)) ^ own)
        self.n_bytes = len(data)

    def within(self, k: int) -> np.ndarray:
        """Whether k words from each word on lie in one piece."""
        return self.piece[: max(0, len(self.piece) - k + 1)] == self.piece[k - 1 :]


def _by_language(batches: Iterable[pa.RecordBatch], limit: int, seed: int) -> Iterator[_Words]:
    for batch in batches:
        coded = batch.column(0).dictionary_encode()
        for place, lang in enumerate(coded.dictionary.to_pylist()):
            for part in slices(batch.column(1).filter(pc.equal(coded.indices, place)), limit):
                words = _Words(part, lang, seed)
                if len(words.index):
                    yield words


def _words_and_sample(batches: Iterable[pa.RecordBatch], every: int = SAMPLE_EVERY, limit: int = SLICE_BYTES, seed: int = 0) -> Iterator[pa.RecordBatch]:
    """All words with their counts, and of longer phrases in the sample's pieces the hashes with theirs."""
    for words in _by_language(batches, limit, seed):
        n = np.bincount(words.index, minlength=len(words.words))
        yield _batch(lang=pa.repeat(pa.scalar(words.lang, pa.string()), len(n)), phrase=words.words.cast(pa.string()), h=_signed(words.hash), n=n)
        drawn = _mixed(words.piece.astype(np.uint64) + np.uint64(words.n_bytes)) % np.uint64(every) == 0
        hashes = words.hash[words.index]
        for k in range(2, LONGEST + 1):
            if len(hashes) < 2:
                break
            hashes = _longer(hashes[:-1], words.hash[words.index[k - 1 :]])
            taken, n = np.unique(hashes[words.within(k) & drawn[: len(hashes)]], return_counts=True)
            yield _batch(lang=pa.nulls(len(n), pa.string()), phrase=pa.nulls(len(n), pa.string()), h=_signed(taken), n=n)


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({name: c if isinstance(c, pa.Array) else pa.array(c) for name, c in columns.items()})


def _held(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set in a bitmap."""
    slots = (hashes >> np.uint64(60 - len(bits).bit_length())).astype(np.int64)
    return (bits[slots >> 5] >> (slots & 31).astype(np.uint32) & np.uint32(1)).astype(bool)


def _border(words: _Words, bits: np.ndarray, before: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases whose both parts are in the bitmap, given by the hash ``p`` of all words but the last and ``w`` of the last.

    A part counts as being there only if its own parts are: what is in the bitmap by chance is passed over mostly. With the
    bitmap of the pass ``before``, phrases counted then are left out, and what is counted now is taken for being there.
    """
    own = words.hash[words.index]
    hashes, now = own, _held(words.hash, bits)[words.index]
    then = None if before is None else _held(words.hash, before)[words.index]
    for k in range(2, LONGEST + 1):
        if len(hashes) < 2:
            return
        within, above, last = words.within(k), hashes[:-1], own[k - 1 :]
        both = new = now[:-1] & now[1:] & within
        if then is not None:
            then = then[:-1] & then[1:] & within
            new = both & ~then
        hashes = _longer(above, last)
        places = np.flatnonzero(new)
        p, w = above[places], last[places]
        order = np.lexsort((w, p))
        p, w = p[order], w[order]
        first = np.flatnonzero(np.append(True, (p[1:] != p[:-1]) | (w[1:] != w[:-1]))) if len(p) else places
        n = np.diff(np.append(first, len(p)))
        p, w = p[first], w[first]
        known = _held(_longer(p, w), bits) if before is None else np.ones(len(n), bool)
        if len(n):
            yield _batch(k=np.full(len(n), k, np.int32), p=_signed(p), w=_signed(w), known=known, n=n)
        now = both.copy()
        now[both] = _held(hashes[both], bits)
        if then is not None:
            now |= new
            held = then.copy()
            held[then] = _held(hashes[then], before)
            then = held


def _tagged(border: pa.RecordBatch) -> pa.RecordBatch:
    """What _border counts, given by hash and tag."""
    p, w = (border.column(c).to_numpy().view(np.uint64) for c in "pw")
    k, known = border.column("k").to_numpy(), border.column("known").to_numpy(zero_copy_only=False)
    tag = (w & np.uint64((1 << TAG_BITS) - 1)).astype(np.int32) << 3 | (k - 2) << 1 | known
    return _batch(h=_signed(_longer(p, w)), tag=tag.astype(np.int32), n=border.column("n"))


@F.arrow_udf(LongType())
def _first_of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for h, w in batches:
        yield _signed(_all_but_last(h.to_numpy().view(np.uint64), w.to_numpy().view(np.uint64)))


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """The bitmap in which the bits of the column h are set; the driver gets its words of 32 bits, as many as it has at most."""
    found = hashes.selectExpr(f"shiftrightunsigned(h, {64 - FILTER_BITS}) AS slot").groupBy(F.expr("cast(slot DIV 32 AS int)").alias("w"))
    found = found.agg(F.expr("bit_or(shiftleft(1L, cast(slot % 32 AS int)))").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    out[found.column("w").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    return out


def _read(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(docs[lang].cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))


def _summed(read: DataFrame, run, schema: str) -> DataFrame:
    """What a pass counts, summed over all tasks."""
    counted = read.mapInArrow(run, f"{schema}, n long")
    return counted.groupBy(*(c for c in counted.columns if c != "n")).agg(F.sum("n").alias("n"))


def _pass(read: DataFrame, seed: int, bits: np.ndarray, before: np.ndarray | None) -> DataFrame:
    """A pass over all words with a bitmap, and that of the pass before."""
    sent, limit = read.sparkSession.sparkContext.broadcast((bits, before)), SLICE_BYTES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _by_language(batches, limit, seed):
            yield from map(_tagged, _border(words, *sent.value))

    return _summed(read, run, "h long, tag int").withColumns({"k": F.expr("shiftright(tag, 1) & 3") + 2, "known": F.expr("tag & 1 = 1")})


def _shared(hashes: DataFrame) -> bool:
    """Whether two rows share their hash."""
    return not hashes.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def frequent(docs: DataFrame, text: str = "text", lang: str = "lang", minimum: int = MIN_COUNT, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """All frequent phrases of 1 to LONGEST words (lang, k, phrase, f), and the number of words by language (lang, n)."""
    read = _read(docs, text, lang)
    drawn = _summed(read, partial(_words_and_sample, every=SAMPLE_EVERY, limit=SLICE_BYTES, seed=seed), "lang string, phrase string, h long")
    drawn = stored(drawn.where(F.col("phrase").isNotNull() | (F.col("n") >= PROPOSED)), "phrases-words")
    every = drawn.where("phrase IS NOT NULL")
    totals = stored(every.groupBy("lang").agg(F.sum("n").alias("n")), "phrases-totals")
    words = every.where(F.col("n") >= minimum)
    bits, before = _bitmap(words.select("h").union(drawn.where("phrase IS NULL").select("h"))), None
    counted = None
    while True:
        some = _pass(read, seed, bits, before).where((F.col("n") >= minimum) | F.col("known"))
        some = stored(some, "phrases-counted")
        counted = some if counted is None else counted.union(some)
        failed = some.where(~F.col("known")).where(F.col("k") < LONGEST)
        if failed.isEmpty():
            break
        before, bits = bits, bits | _bitmap(failed.select("h"))
    if not _shared(every.select("h")):
        texts = _texts(words.select("lang", "phrase", "h", F.col("n").alias("f")), counted.where(F.col("n") >= minimum))
        if not _shared(texts.select("h").union(counted.where(F.col("n") < minimum).select("h"))):
            return words.select("lang", F.lit(1).alias("k"), "phrase", F.col("n").alias("f")).union(texts.drop("h")), totals
    return frequent(docs, text, lang, minimum, seed + 1)


def _texts(words: DataFrame, counted: DataFrame) -> DataFrame:
    """Frequent phrases of two words and more by their text: that of their first words, frequent too, and of their last."""
    shorter, found = words, None
    last = words.select(F.col("phrase").alias("last"), F.col("h").alias("w_h"), F.expr(f"cast(h & {(1 << TAG_BITS) - 1} AS int)").alias("w_tag"))
    for k in range(2, LONGEST + 1):
        first = shorter.select("lang", F.col("phrase").alias("first"), F.col("h").alias("p_h"))
        met = counted.where(F.col("k") == k).select("h", F.expr("shiftright(tag, 3)").alias("tag"), F.col("n").alias("f")).join(last, F.col("tag") == F.col("w_tag"))
        met = met.withColumn("p", _first_of.asNondeterministic()("h", "w_h")).join(first, F.col("p") == F.col("p_h"))
        shorter = stored(met.select("lang", F.concat_ws(" ", "first", "last").alias("phrase"), "h", "f"), "phrases-texts")
        longer = shorter.select("lang", F.lit(k).alias("k"), "phrase", "f", "h")
        found = longer if found is None else found.union(longer)
    return found


def scored(found: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases of two words and more with the counts l and r of their weakest cut, and its score, rounded down.

    Products are decimals of 38 digits, which hold them exactly up to 10^34 / SCALE word occurrences squared.
    """
    candidates = found.where("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"))
    cut = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).withColumn("left", F.expr("substring_index(phrase, ' ', cut)"))
    cut = cut.withColumn("right", F.expr("substring(phrase, length(left) + 2)"))
    parts = found.select(F.col("lang").alias("p_lang"), F.col("phrase").alias("p"), F.col("f"))
    met = cut.join(parts, (F.col("lang") == F.col("p_lang")) & (F.col("left") == F.col("p"))).withColumnRenamed("f", "l").drop("p_lang", "p")
    met = met.join(parts, (F.col("lang") == F.col("p_lang")) & (F.col("right") == F.col("p"))).withColumnRenamed("f", "r").drop("p_lang", "p")
    met = met.join(totals.select(F.col("lang").alias("t_lang"), "n"), F.col("lang") == F.col("t_lang"))
    score = F.expr(f"(cast(a as decimal(19)) * n * {SCALE}) div (cast(l as decimal(19)) * r)")
    weakest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("w")
    return met.groupBy("lang", "k", "phrase", "a", "n").agg(weakest).select("lang", "k", "phrase", "a", "w.l", "w.r", "n", "w.score")


def _held_by_longer(candidates: DataFrame) -> DataFrame:
    """Phrases that a longer candidate holds, with the highest count of such a one: (lang, phrase, most)."""
    longer = candidates.where("k > 2").select("lang", "k", "a", F.split("phrase", " ").alias("w"))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("k") - m + 1), lambda s: F.array_join(F.slice("w", s, m), " "))))
    return longer.select("lang", "a", F.explode(spans).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("most"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", minimum: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases by score: lang, rank, phrase, a, l, r, n, score."""
    found, totals = frequent(docs, text, lang, minimum)
    candidates = stored(scored(found, totals), "phrases-scored")
    held = _held_by_longer(candidates).withColumnsRenamed({"lang": "h_lang", "phrase": "h_phrase"})
    left = candidates.join(held, (F.col("lang") == F.col("h_lang")) & (F.col("phrase") == F.col("h_phrase")), "left")
    left = left.where(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * SHARE))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language the phrases whose words stand together most beyond chance."""
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
    SELECT lang, k, unnest([array_to_string(w[i : i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
    FROM worded, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k),
counted AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counted WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM counted WHERE k > 1 AND f >= 100),
cuts AS (
    SELECT lang, k, phrase, a, unnest(range(1, k)) AS cut, w FROM candidates),
met AS (
    SELECT c.lang, c.k, c.phrase, c.a, cut, x.f AS l, y.f AS r, n, (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
    FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : cut], ' ')
    JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1 : c.k], ' ') JOIN totals t ON t.lang = c.lang),
weakest AS (SELECT * FROM met QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
spans AS (
    SELECT lang, a, k, w, unnest(range(2, k)) AS m FROM candidates WHERE k > 2),
held AS (
    SELECT lang, phrase, max(a) AS most
    FROM (SELECT lang, a, unnest([array_to_string(w[s : s + m - 1], ' ') FOR s IN range(1, k - m + 2)]) AS phrase FROM spans) GROUP BY ALL),
ranked AS (
    SELECT x.lang, row_number() OVER (PARTITION BY x.lang ORDER BY score DESC, a DESC, encode(x.phrase)) AS rank, x.phrase, a, l, r, n, score
    FROM weakest x LEFT JOIN held h ON h.lang = x.lang AND h.phrase = x.phrase WHERE h.phrase IS NULL OR 100 * most < 100 * a)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""
