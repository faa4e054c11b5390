"""Byte-level BPE: encoding with a contiguous rank array per word, and decoding.

The texts of a slice are cut into pre-tokens (``cutting.py``), at the vocabulary's added tokens too, and each distinct
pre-token is encoded once. Those of equal length lie in one array, a row each: the parts between a word's boundaries, and
the ranks of adjacent parts. Each step scans every row for its least rank, deletes that boundary, and looks up the two
ranks beside it; rows in which nothing can be merged leave the array. Pre-tokens of over ``SHORT`` bytes, for which such
scans take quadratic time, go through a heap one by one.

Null texts count as empty. Empty texts give no ids. Every row gives one row, repeated ones too; other columns are
kept as they are.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm.cutting import binaries, buffer_of, cut, joined, slices
from claimlens.llm.pair_table import FREE, PairTable

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
SHORT = 128


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: itself if printable, else one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteBPE:
    """Encodes and decodes with a byte-level BPE vocabulary in the tokenizers library's JSON format.

    Without ``special``, the strings of added tokens in a text are text like any other.
    """

    def __init__(self, content: bytes, special: bool = True):
        spec = json.loads(content)
        model, letters = spec["model"], byte_letters()
        odd = [k for k in ("unk_token", "dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        if model.get("type") != "BPE" or odd or spec.get("normalizer") or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError(f"not a plain byte-level BPE vocabulary: {odd}")
        vocab: dict[str, int] = model["vocab"]
        self.byte_ids = np.zeros(256, np.int32)
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocab[letter]
        merges = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        left, right = (np.array([vocab[x[k]] for x in merges], np.int64) for k in (0, 1))
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.pairs = PairTable(left, right, np.arange(len(merges)))
        every = np.arange(1 << 16)
        self.byte_pairs = self.pairs.get(self.byte_ids[every >> 8], self.byte_ids[every & 255])
        added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in spec["added_tokens"]):
            raise ValueError("added tokens that change their surroundings aren't supported")
        self.added = {token.encode(): i for token, i in added.items()} if special else {}
        self.added_at = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        of_id = [b""] * (1 + max([*vocab.values(), *added.values()]))
        for token, i in vocab.items():
            if all(c in letters for c in token):
                of_id[i] = bytes(letters[c] for c in token)
        for token, i in added.items():
            of_id[i] = token.encode()
        self.bytes_of = pa.array(of_id, pa.binary())

    def _pieces_of_short(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of bytes, all of one length: the places of rows that end up with the same number of ids, and these ids."""
        places, parts = np.arange(len(words)), self.byte_ids[words]
        ranks = self.byte_pairs[words[:, :-1].astype(np.intp) << 8 | words[:, 1:]]
        while parts.shape[1] > 1:
            at = ranks.argmin(1)
            low = ranks[np.arange(len(at)), at]
            done = low == FREE
            if done.any():
                yield places[done], parts[done]
                places, parts, ranks, at, low = (x[~done] for x in (places, parts, ranks, at, low))
            if not len(places):
                return
            column, row = np.arange(parts.shape[1] - 1), np.arange(len(at))
            parts = np.take_along_axis(parts, column + (column > at[:, None]), 1)
            parts[row, at] = self.made[low]
            ranks = np.take_along_axis(ranks, column[:-1] + (column[:-1] >= at[:, None]), 1)
            for beside in (at - 1, at):
                r = np.flatnonzero((beside >= 0) & (beside < ranks.shape[1]))
                c = beside[r]
                ranks[r, c] = self.pairs.get(parts[r, c], parts[r, c + 1])
        yield places, parts

    def _pieces_of_long(self, word: np.ndarray) -> np.ndarray:
        """The ids of one word of any length, by a heap of ranks."""
        ids, n = self.byte_ids[word].tolist(), len(word)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        first = self.byte_pairs[word[:-1].astype(np.intp) << 8 | word[1:]].tolist()
        heap = [(r, i) for i, r in enumerate(first) if r != FREE]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}

        def rank(a: int, b: int) -> int:
            if (a, b) not in known:
                known[a, b] = int(self.pairs.get(np.array([a]), np.array([b]))[0])
            return known[a, b]

        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or rank(ids[i], ids[j]) != r:
                continue
            ids[i], ids[j], after[i] = int(self.made[r]), -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (new := rank(ids[a], ids[b])) != FREE:
                    heapq.heappush(heap, (new, a))
        return np.array([x for x in ids if x >= 0], np.int32)

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pre-tokens that aren't empty, one after another, and where those of each start."""
        data, at = buffer_of(words)
        lengths = np.diff(at)
        # Where the cuts leave an added token whole, it is one.
        special = pc.index_in(words, value_set=pa.array([*self.added], pa.binary())).fill_null(-1).to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(special >= 0)
        counts, found = np.ones(len(words), np.int64), [(rows, np.array([*self.added.values()], np.int32)[special[rows]][:, None])]
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero((lengths == length) & (special < 0))
            if length <= SHORT:
                some = self._pieces_of_short(data[at[rows][:, None] + np.arange(length)])
                found += [(rows[places], ids) for places, ids in some]
            else:
                found += [(rows[k : k + 1], self._pieces_of_long(data[at[r] : at[r + 1]])[None]) for k, r in enumerate(rows.tolist())]
        for rows, ids in found:
            counts[rows] = ids.shape[1]
        start = np.append(0, np.cumsum(counts))
        out = np.empty(start[-1], np.int32)
        for rows, ids in found:
            out[start[rows][:, None] + np.arange(ids.shape[1])] = ids
        return out, start

    def encode(self, texts: pa.Array) -> pa.Array:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        cuts = cut(texts, self.added_at)
        ids, start = self.words(cuts.words)
        data, at = joined(binaries(ids.astype("<u4").view(np.uint8), start * 4), cuts.index)
        return binaries(data, at[cuts.first])

    def decode(self, ids: pa.Array) -> pa.Array:
        """The texts of packed ids; bytes that are no UTF-8 become replacement characters."""
        data, at = buffer_of(ids)
        places = np.frombuffer(data.tobytes(), "<u4")
        data, ends = joined(self.bytes_of, places)
        found = binaries(data, ends[at // 4])
        try:
            return found.cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([x.decode("utf-8", "replace") for x in found.to_pylist()], pa.large_string())


@lru_cache(maxsize=4)
def loaded(content: bytes, special: bool = True) -> ByteBPE:
    return ByteBPE(content, special)


def vocabulary(spark: SparkSession, path: str | None = None):
    """The vocabulary file, read by the driver and sent to the workers: a file of fixed size, whatever the corpus."""
    with open(path or public_tokenizers.path(DEFAULT_VOCABULARY), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, text: str = "text", into: str = "ids", path: str | None = None) -> DataFrame:
    """docs with the ids of each text, packed as little-endian unsigned 32-bit integers in a binary column."""
    content = vocabulary(docs.sparkSession, path)

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = loaded(content.value)
        for batch in batches:
            parts = [bpe.encode(part).cast(pa.binary()) for part in slices(batch)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

    return docs.withColumn(into, run.asNondeterministic()(docs[text].cast("string")))


def decode(tokens: DataFrame, ids: str = "ids", into: str = "decoded", path: str | None = None) -> DataFrame:
    """tokens with the text of its packed ids; null ids count as none."""
    content = vocabulary(tokens.sparkSession, path)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = loaded(content.value)
        for batch in batches:
            parts = [bpe.decode(part).cast(pa.string()) for part in slices(batch)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return tokens.withColumn(into, run.asNondeterministic()(tokens[ids]))


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: token count and digests of the packed ids and of the decoded text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = decode(encode(docs))
    return coded.select(
        "doc_id",
        n_tokens(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
