"""How two tokenizers cut the same texts, counted over the corpus by way of exact-text deduplication.

1. Texts are shuffled by their whole text, which leaves each distinct one once, with its number of copies.
2. Each distinct text is encoded by A and by B and aligned: where tokens of both end at one byte, a group of tokens ends,
   and the two tokens are linked. Words are encoded once in a slice of texts (``cutting.py`` for A; for B, a piece model
   none of whose pieces crosses the start of a word, the runs from one space to the next).
3. The links of each pair of ids are counted, a text's links as often as it has copies.
4. Pairs with a share of ``HOT_SHARE`` of all links, of which there are ``1 / HOT_SHARE`` at most, are looked up where the
   links are read, so no hot pair is shuffled; the others are joined on the pair. The measures are summed by text.
5. Documents get the measures of their text, joined on its SHA-256. A text of very many documents is split by AQE there.

A encodes a space and the text, B the text, before which it puts a space itself; strings of special tokens are plain text.
Texts that are null or empty, or whose tokens' bytes aren't those of space and text, have no tokens: all measures are
zero, and their groups are ''. Every row gives one row, repeated ones and null ids too.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm import bpe
from claimlens.llm.common import stored, table
from claimlens.llm.cutting import binaries, buffer_of, cut, joined, slices

FIRST = "byte_bpe_50k.json"
SECOND = "piece_bpe_32k.model"
HOT_SHARE = 2.0**-20
#: Bytes of text, and links, handled at a time.
SLICE_BYTES = 1 << 20
SLICE_LINKS = 1 << 19
MARK = "▁"
MEASURES = ("n_a", "n_b", "n_groups", "n_links")


class PieceModel:
    """A sentencepiece model that puts a space before a text and knows the byte 0x20 as its mark."""

    def __init__(self, content: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(self.size)]
        if any(MARK in p.lstrip(MARK) for p in pieces) or self.model.encode("a", out_type=str) != [MARK + "a"]:
            raise ValueError("pieces across words, or no space put before a text: not a model that this can encode by word")
        single = [bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.bytes_of = pa.array(single, pa.binary())
        self.space = self.model.piece_to_id(MARK)

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that each begin with a space, and where those of each start; a space alone is the mark."""
        found = self.model.encode([w[1:].decode() for w in words.to_pylist()], num_threads=1)
        found = [ids or [self.space] for ids in found]
        return np.array([i for ids in found for i in ids], np.int32), np.append(0, np.cumsum([len(ids) for ids in found])).astype(np.int64)


@dataclass
class Tokens:
    """Tokens of some texts: ids, the byte of the whole buffer after which each ends, and each text's first token."""

    ids: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def _tokens(index: np.ndarray, first: np.ndarray, ids: np.ndarray, start: np.ndarray, lengths: np.ndarray) -> Tokens:
    data, at = joined(binaries(ids.view(np.uint8), start * 4), index)
    own = data.view(np.int32)
    return Tokens(own, np.cumsum(lengths[own]), at[first] // 4)


def _by_first(texts: pa.Array, model: bpe.ByteBPE) -> Tokens:
    cuts = cut(texts)
    return _tokens(cuts.index, cuts.first, *model.words(cuts.words), np.diff(buffer_of(model.bytes_of)[1]))


def _by_second(texts: pa.Array, model: PieceModel) -> tuple[Tokens, np.ndarray]:
    """The tokens, and for each text whether its bytes are theirs."""
    data, at = buffer_of(texts)
    start = data == 32
    start[1:] &= data[:-1] != 32
    start[at[:-1]] = True
    begins = np.flatnonzero(start)
    found = binaries(data, np.append(begins, len(data))).dictionary_encode()
    ids, begin = model.words(found.dictionary)
    own, ends = joined(model.bytes_of, ids)
    same = pc.equal(binaries(own, ends[begin]), found.dictionary).to_numpy(zero_copy_only=False)
    index, first = found.indices.to_numpy(), np.searchsorted(begins, at)
    wrong = np.append(0, np.cumsum(~same[index]))
    return _tokens(index, first, ids, begin, np.diff(buffer_of(model.bytes_of)[1])), np.diff(wrong[first]) == 0


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each id's decimal digits in a row, to the right, with a place for a separator; and which of these are its own."""
    width = len(str(size))
    numbers = np.arange(size)[:, None] // 10 ** np.arange(width - 1, -1, -1)
    own = (numbers > 0) | (np.arange(width) == width - 1)
    pad = np.ones((size, 1), bool)
    return np.hstack([(48 + numbers % 10).astype(np.uint8), pad.astype(np.uint8)]), np.hstack([own, pad])


@lru_cache(maxsize=2)
def loaded(first: bytes, second: bytes) -> Aligner:
    return Aligner(first, second)


class Aligner:
    """Encodes texts by both vocabularies and links tokens that end together."""

    def __init__(self, first: bytes, second: bytes):
        self.a, self.b = bpe.loaded(first, False), PieceModel(second)
        self.size_a, self.size_b = len(self.a.bytes_of), self.b.size
        if self.size_a * self.size_b >= 1 << 31:
            raise ValueError("a pair of ids has to fit 31 bits")
        self.digits, self.own = _digits(max(self.size_a, self.size_b))

    def align(self, texts: pa.Array) -> pa.RecordBatch:
        """Per text its measures, its groups as ``a1,a2|b1;a3|b2`` and its links, each as the pair's number."""
        spaced = pc.binary_join_element_wise(pa.scalar(b"", pa.binary()), texts.cast(pa.binary()).fill_null(b""), pa.scalar(b" ", pa.binary()))
        filled = np.diff(buffer_of(spaced)[1]) > 1
        rows = np.flatnonzero(filled)
        if len(rows):
            b, good = _by_second(some := spaced.take(pa.array(rows)), self.b)
            if not good.all():
                rows, some = rows[good], some.filter(pa.array(good))
                b, _ = _by_second(some, self.b)
        n = len(texts)
        measures, groups, links, sizes = {m: np.zeros(n, np.int64) for m in MEASURES}, pa.array([], pa.binary()), np.zeros(0, np.int32), np.zeros(n, np.int64)
        if len(rows):
            a = _by_first(some, self.a)
            met = np.zeros(len(buffer_of(some)[0]) + 1, np.uint8)
            met[a.ends] += 1
            met[b.ends] += 1
            last_a, last_b = met[a.ends] == 2, met[b.ends] == 2
            links = a.ids[last_a] * np.int32(self.size_b) + b.ids[last_b]
            ended = np.append(0, np.cumsum(last_a))
            sizes[rows] = np.diff(ended[a.first])
            for name, value in zip(MEASURES, (np.diff(a.first), np.diff(b.first), sizes[rows], sizes[rows])):
                measures[name][rows] = value
            groups = self._groups(a, b, last_a, last_b)
        place = np.full(n, -1, np.int64)
        place[rows] = np.arange(len(rows))
        groups = groups.take(pa.array(place, mask=place < 0)).fill_null(b"").cast(pa.string())
        listed = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(links, pa.int32()))
        return pa.RecordBatch.from_pydict({m: pa.array(v) for m, v in measures.items()} | {"groups": groups, "links": listed})

    def _groups(self, a: Tokens, b: Tokens, last_a: np.ndarray, last_b: np.ndarray) -> pa.Array:
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        first_b = np.append(0, np.flatnonzero(last_b) + 1)
        end_a = np.flatnonzero(last_a) + 1
        at_a, at_b = np.arange(len(a.ids)) + first_b[group_a], np.arange(len(b.ids)) + end_a[group_b]
        ids, marks = np.empty(len(a.ids) + len(b.ids), np.int32), np.empty(len(a.ids) + len(b.ids), np.uint8)
        ids[at_a], ids[at_b] = a.ids, b.ids
        marks[at_a], marks[at_b] = np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))
        first = a.first + b.first
        letters, own = self.digits[ids], self.own[ids]
        letters[:, -1] = marks
        own[first[1:] - 1, -1] = False  # nothing follows a text's last group
        return binaries(letters[own], np.append(0, np.cumsum(own.sum(1)))[first])


def _content(path: str | None, default: str) -> bytes:
    with open(path or public_tokenizers.path(default), "rb") as f:
        return f.read()


def text_key(text):
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


def aligned(docs: DataFrame, text: str = "text", first: str | None = None, second: str | None = None) -> DataFrame:
    """Each distinct text of docs once: key, copies, n_a, n_b, n_groups, n_links, groups and links."""
    files = docs.sparkSession.sparkContext.broadcast((_content(first, FIRST), _content(second, SECOND)))
    limit = SLICE_BYTES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = loaded(*files.value)
        for batch in batches:
            done = 0
            for part in slices(batch.column(0), limit):
                out, rows = aligner.align(part), batch.slice(done, len(part))
                done += len(part)
                yield pa.RecordBatch.from_arrays([rows.column(1), rows.column(2), *out.columns], names=["key", "copies", *out.schema.names])

    once = docs.select(F.coalesce(docs[text].cast("string"), F.lit("")).alias("text")).groupBy("text").agg(F.count("*").alias("copies"))
    measures = ", ".join(f"{m} long" for m in MEASURES)
    return once.select("text", text_key(F.col("text")).alias("key"), "copies").mapInArrow(run, f"key binary, copies long, {measures}, groups string, links array<int>")


def pair_counts(texts: DataFrame, size_b: int) -> DataFrame:
    """For each pair of linked ids, how many links of the corpus it has, and whether no pair of its B id has more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in slices(batch.column(0), SLICE_LINKS):
                copies = batch.column(1).slice(done, len(part)).to_numpy()
                done += len(part)
                at = part.offsets.to_numpy()
                pairs, own = np.unique(part.values.to_numpy()[at[0] : at[-1]], return_inverse=True)
                n = np.zeros(len(pairs), np.int64)
                np.add.at(n, own, np.repeat(copies, np.diff(at)))
                yield pa.RecordBatch.from_pydict({"pair": pa.array(pairs, pa.int64()), "n": pa.array(n)})

    counted = stored(texts.select("links", "copies").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "alignment-pairs")
    highest = counted.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("most"))
    return counted.join(highest, F.col("pair") % size_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def measured(texts: DataFrame, counts: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of texts, of which ``key`` is one, with n_best and count_sum of each one's links."""
    spark = texts.sparkSession
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = counts.where(F.col("n") >= max(1, total * HOT_SHARE)).orderBy("pair").toArrow()
    hot = spark.sparkContext.broadcast(tuple(often.column(c).to_numpy() for c in ("pair", "n", "best")))
    own = texts.select(*keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = hot.value
        for batch in batches:
            done = 0
            for part in slices(batch.column(1), SLICE_LINKS):
                rows = batch.slice(done, len(part))
                done += len(part)
                at = part.offsets.to_numpy().astype(np.int64)
                links = part.values.to_numpy()[at[0] : at[-1]].astype(np.int64)
                place = np.minimum(np.searchsorted(pairs, links), max(0, len(pairs) - 1))
                hit = pairs[place] == links if len(pairs) else np.zeros(len(links), bool)
                sums = np.append(0, np.cumsum(np.where(hit, n[place] if len(pairs) else 0, 0)))[at - at[0]]
                bests = np.append(0, np.cumsum(hit & best[place] if len(pairs) else hit))[at - at[0]]
                whose = np.repeat(np.arange(len(part)), np.diff(at))[~hit]
                order = np.lexsort((links[~hit], whose))
                whose, rare = whose[order], links[~hit][order]
                new = np.flatnonzero(np.append(True, (whose[1:] != whose[:-1]) | (rare[1:] != rare[:-1]))) if len(rare) else np.zeros(0, np.int64)
                times = np.diff(np.append(new, len(rare)))
                rid = rows.column(0).to_numpy()
                # No pair has a negative number, so each text's own row meets nothing in the join, nor another text's.
                columns = [np.append(rid, rid[whose[new]]), np.append(-1 - rid, rare[new]), np.append(np.diff(sums), times), np.append(np.diff(bests), times)]
                kept = [pa.concat_arrays([c, pa.nulls(len(new), c.type)]) for c in rows.columns[2:]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *kept], names=["rid", "pair", "sums", "bests", *rows.schema.names[2:]])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema)
    read = texts.select(F.monotonically_increasing_id().alias("rid"), "links", *keep)
    parts = read.mapInArrow(run, f"rid long, pair long, sums long, bests long, {kinds}")
    met = parts.join(counts, "pair", "left")
    rare = F.col("pair") >= 0
    return met.groupBy("rid").agg(
        *(F.first(c, ignorenulls=True).alias(c) for c in keep),
        F.sum(F.when(rare, F.when(F.col("best"), F.col("bests")).otherwise(0)).otherwise(F.col("bests"))).alias("n_best"),
        F.sum(F.when(rare, F.col("sums") * F.col("n")).otherwise(F.col("sums"))).alias("count_sum"),
    ).drop("rid")


def align(docs: DataFrame, id: str = "doc_id", text: str = "text", first: str | None = None, second: str | None = None, digest: bool = False) -> DataFrame:
    """Per row of docs: its id, the measures of its text, and its groups, or their SHA-256 ('' without tokens)."""
    texts = aligned(docs, text, first, second)
    if digest:
        hashed = F.when(F.col("groups") != "", F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
        texts = texts.withColumn("groups", hashed)
    texts = stored(texts, "alignment-texts")
    counts = stored(pair_counts(texts, PieceModel(_content(second, SECOND)).size), "alignment-counts")
    found = measured(texts, counts, ["key", *MEASURES, "groups"])
    rows = docs.select(docs[id].alias("__id"), text_key(docs[text]).alias("__key"))
    met = rows.join(found, (F.col("__key") == F.col("key")) & (F.xxhash64("__key") == F.xxhash64("key")))
    return met.select(F.col("__id").alias(id), *MEASURES, "n_best", "count_sum", "groups")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: tokens of both vocabularies, groups, links and how usual the links are in the corpus."""
    found = align(table(spark, sf_dir, "documents"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")
