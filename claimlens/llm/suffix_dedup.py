"""Removal of long repeated strings: every byte that a string of LENGTH bytes covers which also starts elsewhere.

1. Windows of LENGTH bytes are gathered under anchors (``anchors.py``). An anchor's context, the bytes of all its
   windows, mostly settles it: if a context occurs twice, all its windows are repeated; if its gram occurs in no other
   context, none is.
2. What is left are contexts that share a gram. Their windows are parted into ``BINS`` by distance from the anchor; the
   bytes that all windows of a bin have in common are its core, and cores of one context alone are dropped.
3. One fragment for each context and shared core is fetched, and all suffixes of a core's fragments are sorted block by
   block with a difference cover (``suffixes.py``); equal windows lie side by side. A core with more than ``CROWD``
   fragments is not gathered: its windows are parted into finer bins by longer cores, again those of one context alone
   are dropped, and the digests of the rest are counted, which splits them over all tasks.
4. Spans of repeated windows go back to all occurrences, and each document is cut once.

Everything is judged on the input. Texts are bytes of UTF-8; a null text is empty, and texts shorter than LENGTH are
kept. Texts are told apart by 128 bits of hash; equal texts share their results, whatever their ids, and every row
gives a row.

``without_repeated_words`` does the same with windows of WORDS words, whatever their bytes: each word is coded as
WORD_BYTES bytes of its hash, and repeated windows of the coded text that start at a word are windows of words. Coded
windows that start within a word add none: they hold WORDS - 1 whole words and parts of two.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from claimlens.llm import anchors
from claimlens.llm.common import small, stored, table
from claimlens.llm.suffixes import repeated_windows

LENGTH = 400
#: Words in a repeated passage of over fifty, and bytes that stand for each: windows of WORDS * WORD_BYTES bytes are as long
#: as ``suffixes.py`` takes them.
WORDS = 51
WORD_BYTES = 8
WORD = re.compile(rb"\S+")
#: Scripts written without spaces between words: each of their letters is a word. A fixed list of Unicode's scripts.
UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Bopomofo}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}\p{Tai_Tham}\p{Javanese}\p{Balinese}"
IN_RUN = regex.compile(f"[{UNSPACED}]|[^{UNSPACED}]+")
BINS = 4
CROWD = 256
#: Windows in one of the finer bins of a crowded core.
FINE = 23
#: Bytes of fragments sorted together.
BLOCK = 1 << 18
#: Texts that a worker gives back at a time, so that of a batch of 10,000 it holds what came in but not all that goes out.
GIVEN = 256
#: n neighbouring anchors of the same gram and context are one row: place, first, last and cores are those of the first
#: of them, upto is the last window of the last.
OCCURRENCES = "k1 long, k2 long, gram long, context long, n int, place int, first int, last int, upto int, cores array<long>"


def text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("text"), text).alias("k2")]


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64), pa.int64())


def bins(length: int) -> list[tuple[int, int]]:
    """Least and greatest distance from window start to anchor in each bin."""
    top = length - anchors.GRAM + 1
    edges = [top * k // BINS for k in range(BINS + 1)]
    return [(a, b - 1) for a, b in zip(edges, edges[1:])]


def core_hashes(text: bytes, length: int, places: list[int], firsts: list[int], lasts: list[int]) -> list[list[int | None]]:
    """Per anchor and bin, a hash of the bytes common to all windows of the bin; none where the anchor has no such window."""
    digest, view, ranges = xxhash.xxh3_64_intdigest, memoryview(text), bins(length)
    out = []
    for p, first, last in zip(places, firsts, lasts):
        row: list[int | None] = []
        for k, (low, high) in enumerate(ranges):
            held = p - last <= high and p - first >= low
            value = digest(view[p - low : p - high + length], k) if held else None
            row.append(value - (1 << 64) if value is not None and value >> 63 else value)
        out.append(row)
    return out


def occurrences(texts: DataFrame, length: int = LENGTH, words: bool = False) -> DataFrame:
    """Every anchor of every text (k1, k2, text as bytes), or with words of every coded text, which is coded in the same task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k1, k2, value in zip(*batch.columns):
                text = coded(value.as_py()) if words else value.as_py()
                places, firsts, lasts = anchors.anchored(text, length)
                for at in range(0, len(places), 50_000):
                    p, a, b = (x[at : at + 50_000] for x in (places, firsts, lasts))
                    grams, contexts = (np.array(x, np.uint64) for x in anchors.names(text, length, p, a, b))
                    # In a text that repeats a few bytes over and over, each repetition has the same anchor.
                    new = np.flatnonzero(np.append(True, (grams[1:] != grams[:-1]) | (contexts[1:] != contexts[:-1])))
                    n, upto = np.diff(new, append=len(p)), b[np.append(new[1:], len(p)) - 1]
                    p, a, b, grams, contexts = (x[new] for x in (p, a, b, grams, contexts))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(pa.array(np.full(len(p), k.as_py(), np.int64)) for k in (k1, k2)), _signed(grams), _signed(contexts),
                            *(pa.array(x, pa.int32()) for x in (n, p, a, b, upto)),
                            pa.array(core_hashes(text, length, p.tolist(), a.tolist(), b.tolist()), pa.list_(pa.int64())),
                        ],
                        names=[x.split()[0] for x in OCCURRENCES.split(", ")],
                    )

    return texts.mapInArrow(_merged(run), OCCURRENCES)


def _merged(run, rows: int = 10_000):
    """run with its small output batches put together."""

    def merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in run(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return merged


def _requests(found: DataFrame, length: int) -> DataFrame:
    """Fragments to compare: (k1, k2, core, sharing, context, first, from, to) for each context and core that others share."""
    grams = found.groupBy("gram").agg(F.min("context").alias("a"), F.max("context").alias("b")).where("a <> b").select("gram")
    near = found.join(small(stored(grams, "shared-grams")), "gram", "left_semi")
    # All firsts of a group come from the same row, whichever that is.
    one = stored(near.groupBy("context").agg(*(F.first(c).alias(c) for c in ("k1", "k2", "place", "first", "last", "cores"))), "contexts")
    each = one.select("context", "k1", "k2", "place", "first", "last", F.posexplode("cores").alias("bin", "core")).where("core IS NOT NULL")
    shared = stored(each.groupBy("core").agg(F.count("*").alias("sharing")).where("sharing > 1"), "shared-cores")
    low = F.element_at(F.array(*(F.lit(a) for a, _ in bins(length))), F.col("bin") + 1)
    high = F.element_at(F.array(*(F.lit(b) for _, b in bins(length))), F.col("bin") + 1)
    return each.join(small(shared), "core").select(
        "k1", "k2", "core", "sharing", "context", "first", "place",
        F.greatest("first", F.col("place") - high).alias("from"),
        F.least("last", F.col("place") - low).alias("to"),
    )


def _fragments(texts: DataFrame, requests: DataFrame, length: int, words: bool = False) -> DataFrame:
    """The requests' bytes: (core, sharing, context, shift, distance, bytes): its place in the context, and how far the anchor is."""
    asked = requests.groupBy("k1", "k2").agg(F.collect_list(F.struct("core", "sharing", "context", "first", "place", "from", "to")).alias("r"))
    asked = stored(asked, "requests").withColumnsRenamed({"k1": "a1", "k2": "a2"})
    once = texts.dropDuplicates(["k1", "k2"])
    met = once.join(asked, (F.col("k1") == F.col("a1")) & (F.col("k2") == F.col("a2")))
    met = (met.withColumn("text", _coded.asNondeterministic()("text")) if words else met).select("text", F.explode("r").alias("r"))
    return met.select(
        "r.core", "r.sharing", "r.context", (F.col("r.from") - F.col("r.first")).alias("shift"), (F.col("r.place") - F.col("r.from")).alias("distance"),
        F.substring("text", F.col("r.from") + 1, F.col("r.to") - F.col("r.from") + length).alias("bytes"),
    )


RUNS = "context long, a int, b int"


def _sorted_runs(fragments: DataFrame, length: int) -> DataFrame:
    """Runs of repeated windows in fragments of the same core, by suffix sorting: (context, a, b) from the context's first."""

    def flush(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        runs = repeated_windows([f for *_, f in held], length)
        rows = [(c, shift + a, shift + b) for (c, shift, _), own in zip(held, runs) for a, b in own]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int32()))], names=["context", "a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for core, context, shift, value in zip(*(c.to_pylist() for c in batch.columns)):
                if core != last and size >= BLOCK:
                    yield flush(held)
                    held, size = [], 0
                held.append((context, shift, value))
                size += len(value)
                last = core
        yield flush(held)

    dealt = fragments.select("core", "context", "shift", "bytes").repartition("core").sortWithinPartitions("core")
    return dealt.mapInArrow(run, RUNS)


def finer(value: bytes, distance: int, length: int) -> Iterator[tuple[int, int, int]]:
    """The finer bins of a fragment: the digest of what all windows of a bin have in common, first and last window."""
    view, last = memoryview(value), len(value) - length
    for number in range(max(0, distance - last) // FINE, distance // FINE + 1):
        low, high = number * FINE, number * FINE + FINE - 1
        core = xxhash.xxh3_64_intdigest(view[distance - low : distance - high + length], number)
        yield core, max(0, distance - high), min(last, distance - low)


def _counted_runs(fragments: DataFrame, length: int) -> DataFrame:
    """The same for crowded cores, by counting the digests of the windows whose finer core other contexts share."""

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (core, context, shift + a, value[a : b + length])
                for context, shift, distance, value in zip(*(c.to_pylist() for c in batch.columns))
                for core, a, b in finer(value, distance, length)
            ]
            yield pa.RecordBatch.from_arrays(
                [_signed([r[0] for r in rows]), *(pa.array([r[k] for r in rows], t) for k, t in ((1, pa.int64()), (2, pa.int32()), (3, pa.binary())))],
                names=["fine", "context", "shift", "bytes"],
            )

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_intdigest
        for batch in batches:
            for context, shift, value in zip(*(c.to_pylist() for c in batch.columns)):
                view = memoryview(value)
                names = [digest(view[k : k + length]) for k in range(len(value) - length + 1)]
                yield pa.RecordBatch.from_arrays(
                    [_signed([x >> 64 for x in names]), _signed([x & (1 << 64) - 1 for x in names]), pa.array([context] * len(names), pa.int64()), pa.array(range(shift, shift + len(names)), pa.int32())],
                    names=["w1", "w2", "context", "at"],
                )

    fine = stored(fragments.select("context", "shift", "distance", "bytes").mapInArrow(parts, "fine long, context long, shift int, bytes binary"), "finer")
    shared = stored(fine.groupBy("fine").agg(F.min("context").alias("a"), F.max("context").alias("b")).where("a <> b").select("fine"), "shared-finer")
    rest = fine.join(small(shared), "fine", "left_semi")
    windows = stored(rest.select("context", "shift", "bytes").mapInArrow(_merged(digests), "w1 long, w2 long, context long, at int"), "windows")
    twice = stored(windows.groupBy("w1", "w2").count().where("count > 1").select("w1", "w2"), "repeated-windows")
    return windows.join(small(twice), ["w1", "w2"]).select("context", F.col("at").alias("a"), F.col("at").alias("b"))


def repeated_spans(texts: DataFrame, length: int = LENGTH, words: bool = False) -> DataFrame:
    """Per distinct text (k1, k2, text as bytes) with repeated windows: (k1, k2, spans), spans being (first, last) windows.

    With words, windows are those of the coded text.
    """
    texts = texts.where(F.octet_length("text") >= (length // WORD_BYTES if words else length))
    found = stored(occurrences(texts, length, words), "anchors")
    fragments = stored(_fragments(texts, _requests(found, length), length, words), "fragments")
    few, many = fragments.where(F.col("sharing") <= CROWD), fragments.where(F.col("sharing") > CROWD)
    runs = stored(_sorted_runs(few, length).union(_counted_runs(many, length)), "runs")
    per_context = runs.groupBy("context").agg(F.collect_set(F.struct("a", "b")).alias("runs"))
    twice = found.groupBy("context").agg(F.sum("n").alias("n")).where("n > 1").select("context", F.lit(None).cast("array<struct<a:int,b:int>>").alias("runs"))
    alone = per_context.join(twice.select("context"), "context", "left_anti")
    known = stored(twice.union(alone), "known-contexts")
    met = found.select("context", "k1", "k2", "first", "upto").join(small(known), "context")
    whole = F.array(F.struct(F.lit(0).alias("a"), (F.col("upto") - F.col("first")).alias("b")))
    each = met.select("k1", "k2", "first", F.explode(F.coalesce("runs", whole)).alias("r"))
    spans = each.select("k1", "k2", (F.col("first") + F.col("r.a")).alias("a"), (F.col("first") + F.col("r.b")).alias("b")).distinct()
    return spans.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("spans"))


def covered(spans: list[dict], length: int) -> list[list[int]]:
    """Maximal runs [start, end) of bytes that the windows of sorted spans cover."""
    out: list[list[int]] = []
    for s in spans:
        start, end = s["a"], s["b"] + length
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def cut(text: bytes, spans: list[list[int]]) -> bytes:
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return b"".join([*kept, text[at:]])


def whole_letters(text: bytes, spans: list[list[int]]) -> list[list[int]]:
    """spans without the bytes of letters that they hold only in part."""
    out = []
    for start, end in spans:
        while start < end and text[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            out.append([start, end])
    return out


def word_bounds(text: bytes) -> list[tuple[int, int]]:
    """Start and end of each word: a run without white space, however long; in scripts that have no spaces, each letter."""
    if not text or max(text) < 0xE0:  # no such script has letters of fewer than three bytes
        return [m.span() for m in WORD.finditer(text)]
    out = []
    for m in WORD.finditer(text):
        at = m.start()
        for part in IN_RUN.findall(m[0].decode()):
            out.append((at, at := at + len(part.encode())))
    return out


def coded(text: bytes) -> bytes:
    """WORD_BYTES bytes for each word of the text."""
    digest = xxhash.xxh3_64_digest
    return b"".join([digest(text[a:b]) for a, b in word_bounds(text)])


def word_runs(text: bytes, spans: list[dict], words: int) -> list[list[int]]:
    """Runs [start, end) of bytes that the windows of sorted spans of the coded text cover, each with the space behind it."""
    bounds = word_bounds(text)
    whole = [{"a": -(-s["a"] // WORD_BYTES), "b": s["b"] // WORD_BYTES} for s in spans]
    starts = [*(a for a, _ in bounds), len(text)]
    return [[starts[a], starts[b]] for a, b in covered([s for s in whole if s["a"] <= s["b"]], words)]


@F.arrow_udf(BinaryType())
def _coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for at in range(0, len(batch), GIVEN):
            yield pa.array([coded(x.as_py()) if x.is_valid else None for x in batch[at : at + GIVEN]], pa.binary())


def with_spans(docs: DataFrame, text: str = "text", length: int = LENGTH, into: str = "removed", words: bool = False) -> DataFrame:
    """docs with the sorted runs of windows to remove from each text: null, or (a, b) structs of first and last window.

    With words, windows are those of the coded text.
    """
    value = F.col(text).cast("string").cast("binary")
    texts = docs.select(*text_key(value), value.alias("text"))
    spans = stored(repeated_spans(texts, length, words), "spans").withColumnsRenamed({"k1": "__k1", "k2": "__k2", "spans": into})
    k1, k2 = text_key(value)
    return docs.join(spans, (k1 == F.col("__k1")) & (k2 == F.col("__k2")), "left").drop("__k1", "__k2")


def _without(marked: DataFrame, columns: list[str], text: str, size: str | None, runs: Callable[[bytes, list[dict]], list[list[int]]]) -> DataFrame:
    """marked with the runs that ``runs`` makes of a text and its spans taken out; documents of which nothing is left go.

    Texts without spans stay as they are and aren't sent to a worker.
    """

    @F.arrow_udf("string")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            for at in range(0, len(texts), GIVEN):
                out = []
                for t, s in zip(texts[at : at + GIVEN], spans[at : at + GIVEN]):
                    raw = t.as_py()
                    out.append(None if raw is None else cut(raw, runs(raw, s.as_py())).decode())
                yield pa.array(out, pa.string())

    held, value = F.col("__removed").isNotNull(), F.col(text).cast("string")
    less = run.asNondeterministic()(F.when(held, value.cast("binary")), F.col("__removed"))
    done = marked.withColumn(text, F.when(held, less).otherwise(value))
    left = done.where(F.col("__removed").isNull() | (F.octet_length(text) > 0))
    if size in columns:
        left = left.withColumn(size, F.when(F.col("__removed").isNull(), F.col(size)).otherwise(F.char_length(text).cast(marked.schema[size].dataType)))
    return left.select(columns)


def without_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, size: str | None = "n_chars") -> DataFrame:
    """docs with repeated strings taken out of their texts, in whole letters; documents of which nothing is left go."""
    return _without(with_spans(docs, text, length, "__removed"), docs.columns, text, size, lambda raw, spans: whole_letters(raw, covered(spans, length)))


def without_repeated_words(docs: DataFrame, text: str = "text", words: int = WORDS, size: str | None = "n_chars") -> DataFrame:
    """docs with repeated passages of ``words`` words taken out of their texts; documents of which no word is left go."""

    def runs(raw: bytes, spans: list[dict]) -> list[list[int]]:
        found = word_runs(raw, spans, words)
        return found if cut(raw, found).split() else [[0, len(raw)]]

    return _without(with_spans(docs, text, words * WORD_BYTES, "__removed", True), docs.columns, text, size, runs)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: bytes, removed bytes and runs, the digest of what is kept, its size, and what is kept in whole letters."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kinds = {"removed": pa.int64(), "spans": pa.int64(), "sha": pa.string(), "kept": pa.binary()}

    @F.arrow_udf("struct<removed: bigint, spans: bigint, sha: string, kept: binary>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            rows = []
            for t, s in zip(texts, spans):
                raw = t.as_py() or b""
                runs = covered(s.as_py() or [], LENGTH)
                kept = cut(raw, whole_letters(raw, runs)) if runs else None  # texts that stay as they are needn't come back
                rows.append((sum(b - a for a, b in runs), len(runs), hashlib.sha256(cut(raw, runs)).hexdigest(), kept))
            yield pa.StructArray.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds.values())], [*kinds])

    raw = F.col("text").cast("binary")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    out = with_spans(docs).select("doc_id", "text", size.alias("n_bytes"), run.asNondeterministic()(raw, F.col("removed")).alias("r"))
    return out.select(
        "doc_id", "n_bytes",
        F.col("r.removed").alias("n_removed"), F.col("r.spans").alias("n_spans"), F.col("r.sha").alias("kept_sha256"),
        (F.col("n_bytes") - F.col("r.removed")).alias("n_kept"),
        F.coalesce(F.col("r.kept").cast("string"), F.col("text"), F.lit("")).alias("text"),
    )
