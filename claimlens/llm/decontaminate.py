"""Benchmark passages in documents: a prefix-filtered join of word windows, in DataFrame operations alone.

A window is WINDOW consecutive words of an item (all of them if it has fewer). A document holds a window only if it
holds all its words, so it is enough to look for the first word in the order of rarity, the window's prefix: the
rarest in the corpus, by counts over all documents. A match of that word at a position fixes where the window would
start; the length bound (enough words from there) and the positional bound (no start before the first word) leave few
candidates, and these are verified word by word on the document.

Only distinct windows are looked for. Words are counted and looked up against a table whose size depends on the
benchmark alone; it is broadcast after its size has been measured and found small, and joined with a shuffle otherwise.

Null and wordless texts have no words and no hits; an item with a null id or no words takes no part. Repeated
documents each give a row with the same results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimlens.llm.common import small, stored, table

WINDOW = 10
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """The text's words; none for a null text."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lowered, SPLIT), "")


def windows(items: DataFrame, id: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Each distinct window with the ids of its items: (window, words, items)."""
    words = items.where(F.col(id).isNotNull()).select(F.col(id).cast("string").alias("item"), words_of(F.col(text)).alias("w")).where("size(w) > 0")
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0))))
    cut = words.select("item", "w", starts.alias("at")).select("item", F.slice("w", F.col("at") + 1, F.lit(size)).alias("words"))
    return cut.groupBy("words").agg(F.collect_set("item").alias("items")).select(F.sha2(F.array_join("words", " "), 256).alias("window"), "words", "items")


def prefixes(found: DataFrame, docs_words: DataFrame) -> DataFrame:
    """Each window's rarest word in the documents and its place: (word, window, words, at). Windows with a word that no document has are left out."""
    each = found.select("window", F.posexplode("words").alias("at", "word"))
    vocabulary = stored(each.select("word").distinct(), "benchmark-words")
    counts = docs_words.join(small(vocabulary), "word").groupBy("word").agg(F.count("*").alias("n"))
    ranked = each.join(stored(counts, "word-counts"), "word", "left").fillna(0, ["n"])
    rarest = ranked.groupBy("window").agg(F.min(F.struct("n", "word", "at")).alias("r")).where("r.n > 0")
    return found.join(rarest.select("window", "r.word", "r.at"), "window").select("word", "window", "words", "items", "at")


def matches(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """Per distinct document with a hit: (id, text_hash, spans, items), spans being (start, words) of each window found."""
    words = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("text_hash"), words_of(F.col(text)).alias("w"))
    found = stored(windows(items, item_id, item_text, size), "windows")
    exploded = words.select("id", "text_hash", F.size("w").alias("length"), F.posexplode("w").alias("at", "word"))
    firsts = stored(prefixes(found, exploded.select("word")), "prefixes")
    near = exploded.join(small(firsts.select("word").distinct()), "word").select("id", "text_hash", "length", F.col("at").alias("place"), F.col("word").alias("rare"))
    met = near.join(small(firsts.drop("items")), near.rare == F.col("word"))
    # Positional and length bounds: the window starts at or after the first word and ends at or before the last.
    bounded = met.withColumn("start", F.col("place") - F.col("at")).where((F.col("start") >= 0) & (F.col("start") + F.size("words") <= F.col("length")))
    candidate = F.struct("start", "window", "words")
    per_doc = bounded.groupBy("id", "text_hash").agg(F.collect_set(candidate).alias("c"))
    own = stored(per_doc.withColumnsRenamed({"id": "own", "text_hash": "own_hash"}), "candidates")
    texts = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    wanted = texts.join(own, F.col("id").eqNullSafe(F.col("own")) & (F.col("text_hash") == F.col("own_hash")))
    # Verify: the words that stand in the document at a candidate's place are the window's.
    split = wanted.select("id", "text_hash", "c", words_of(F.col("text")).alias("w"))
    held = split.select("id", "text_hash", F.explode(F.expr("filter(c, x -> slice(w, x.start + 1, size(x.words)) = x.words)")).alias("c"))
    verified = held.select("id", "text_hash", "c.start", "c.window", F.size("c.words").alias("n"))
    return verified.join(small(found.select("window", "items")), "window").groupBy("id", "text_hash").agg(
        F.collect_set(F.struct("start", "n")).alias("spans"),
        F.flatten(F.collect_set("items")).alias("items"),
    )


def _covered(spans: str) -> Column:
    """How many words the spans cover."""
    return F.expr(
        f"aggregate(array_sort({spans}), named_struct('upto', 0, 'n', 0), (a, x) -> named_struct("
        "'upto', greatest(a.upto, x.start + x.n), 'n', a.n + greatest(0, x.start + x.n - greatest(a.upto, x.start))), a -> a.n)"
    )


def contamination(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """Per row of docs: id, n_words, n_hit, items (sorted ids of the items with windows in it) and spans of hit windows."""
    hits = matches(docs, items, id, text, item_id, item_text, size).select(F.col("id").alias("own"), F.col("text_hash").alias("own_hash"), "spans", F.array_sort(F.array_distinct("items")).alias("items"))
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("text_hash"), F.size(words_of(F.col(text))).cast("long").alias("n_words"))
    met = rows.join(hits, F.col("id").eqNullSafe(F.col("own")) & (F.col("text_hash") == F.col("own_hash")), "left")
    return met.select(F.col("id").alias(id), "n_words", F.coalesce(_covered("spans").cast("long"), F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans")


def clean(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """docs without the rows that hold a window of an item."""
    hits = matches(docs, items, id, text, item_id, item_text, size).select(F.col("id").alias("__own"), F.col("text_hash").alias("__hash"))
    return docs.join(hits, F.col(id).eqNullSafe(F.col("__own")) & (F.xxhash64(text) == F.col("__hash")), "left_anti")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words in benchmark windows, and the items that these come from."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP6_SQL = """
WITH w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
i AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
g AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, a, a + least(10, len(w)) - 1) AS g
  FROM i, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS a) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM g),
d AS (SELECT doc_id, n, a, list_slice(w, a, a + n - 1) AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS a FROM w, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, a, d.n FROM d JOIN g USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + n)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit ON w.doc_id = hit.doc_id LEFT JOIN it ON w.doc_id = it.doc_id
"""
