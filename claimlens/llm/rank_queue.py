"""Byte-level BPE with a hierarchical-bitmap rank queue.

The distinct pre-tokens of a slice of texts lie one after another as linked lists of parts, all in one pair of arrays;
no list runs from one pre-token into the next. For every merge rank there is a bucket of list positions whose part can
be merged with the next one at that rank. Which buckets hold something is written in a bitmap of bitmaps: find-first-set
on each level gives the lowest rank. Its positions are merged at once, from the left; entries gone stale, because a part
was merged otherwise since, are skipped. New neighbours put positions into other buckets. A merge costs the same however
long the pre-token is, so a pre-token of megabytes takes no more time per byte than a word does.

Merging all positions of a rank at once gives what merging one at a time gives, unless a merge of that rank can make a
pair of a lower rank, which the vocabulary shows beforehand: at such ranks each pre-token merges its leftmost position
only, and lower ranks go first again.

Null texts count as empty and give no ids, as empty texts do. Every row gives one row, repeated ones and null ids too;
other columns are kept as they are, those named like the new ones are replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm.common import table
from claimlens.llm.cutting import binaries, buffer_of, cut, joined, slices
from claimlens.llm.pair_table import FREE, PairTable

DEFAULT_VOCABULARY = "byte_bpe_multi_50k.tiktoken"
BITS = 6
WORD = (1 << BITS) - 1


class RankQueue:
    """Buckets of positions by rank; the least rank of a bucket that isn't empty is found by three find-first-sets."""

    def __init__(self, ranks: int):
        self.leaves = [0] * ((ranks >> BITS) + 1)
        self.inner = [0] * ((ranks >> 2 * BITS) + 1)
        self.root = 0
        self.buckets: dict[int, list[np.ndarray]] = {}

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Put each of some ascending positions into the bucket of its rank; those at FREE go nowhere."""
        held = ranks != FREE
        ranks, positions = ranks[held], positions[held]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        at = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1]))
        for r, b, e in zip(ranks[at].tolist(), at.tolist(), [*at[1:].tolist(), len(ranks)]):
            bucket = self.buckets.get(r)
            if bucket is None:
                self.buckets[r] = [positions[b:e]]
                self.leaves[r >> BITS] |= 1 << (r & WORD)
                self.inner[r >> 2 * BITS] |= 1 << (r >> BITS & WORD)
                self.root |= 1 << (r >> 2 * BITS)
            else:
                bucket.append(positions[b:e])

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The least rank and its positions in order, each once; None when all buckets are empty."""
        if not self.root:
            return None
        top = _first_set(self.root)
        middle = top << BITS | _first_set(self.inner[top])
        r = middle << BITS | _first_set(self.leaves[middle])
        self.leaves[middle] &= self.leaves[middle] - 1
        if not self.leaves[middle]:
            self.inner[top] &= self.inner[top] - 1
            if not self.inner[top]:
                self.root &= self.root - 1
        bucket = self.buckets.pop(r)
        return r, bucket[0] if len(bucket) == 1 else np.unique(np.concatenate(bucket))


def _first_set(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


class RankBPE:
    """Encodes and decodes with a vocabulary of tokens by rank, in tiktoken's format; a rank is the token's id."""

    def __init__(self, content: bytes):
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in content.splitlines() if line)}
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary has a token for each byte")
        self.size = max(ranks.values()) + 1
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        ordered = sorted(ranks.items(), key=lambda x: x[1])
        self.tokens, self.token_ids = pa.array([t for t, _ in ordered], pa.binary()), np.array([r for _, r in ordered], np.int32)
        of_id = [b""] * self.size
        for token, r in ordered:
            of_id[r] = token
        self.bytes_of = pa.array(of_id, pa.binary())
        pairs = [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ordered for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        left, right, made = np.array(pairs, np.int64).reshape(-1, 3).T
        self.pairs = PairTable(left, right, made)
        every = np.arange(1 << 16)
        self.byte_pairs = self.pairs.get(self.byte_ids[every >> 8], self.byte_ids[every & 255])
        #: Ranks whose merge can make a pair that goes before them.
        self.careful = np.zeros(self.size, bool)
        self.careful[left[made < left]] = True
        self.careful[right[made < right]] = True

    def merged(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of byte strings that lie one after another, and where those of each string start."""
        n = len(data)
        own = np.repeat(np.arange(len(at) - 1), np.diff(at))
        token = np.append(self.byte_ids[data], -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        rank = np.full(n + 1, FREE, np.int32)
        if n > 1:
            rank[: n - 1] = self.byte_pairs[data[:-1].astype(np.intp) << 8 | data[1:]]
            rank[at[1:-1][(at[1:-1] > 0) & (at[1:-1] < n)] - 1] = FREE
        alive = np.ones(n, bool)
        queue = RankQueue(self.size)
        queue.push(rank[:n], np.arange(n))
        while (popped := queue.pop()) is not None:
            r, p = popped
            p = p[rank[p] == r]  # the others are stale
            if not len(p):
                continue
            if self.careful[r]:
                first = np.append(True, own[p[1:]] != own[p[:-1]])
                queue.push(np.full(len(p), r, np.int32)[~first], p[~first])
                p = p[first]
            elif len(p) > 1:
                p = p[_from_the_left(after[p[:-1]] == p[1:])]
            gone = after[p]
            token[p] = r
            alive[gone] = False
            rank[gone] = FREE
            after[p] = after[gone]
            before[after[p]] = p
            changed = np.unique(np.concatenate([p, (b := before[p])[b >= 0]]))
            follow = after[changed]
            joined = (follow < n) & (own[np.minimum(follow, n - 1)] == own[changed])
            rank[changed] = np.where(joined, self.pairs.get(token[changed], token[follow]), FREE)
            queue.push(rank[changed], changed)
        return token[:n][alive], np.searchsorted(np.flatnonzero(alive), at)

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct pre-tokens, and where those of each start; a pre-token that is a token is left whole."""
        known = pc.index_in(words, value_set=self.tokens).fill_null(-1).to_numpy(zero_copy_only=False)
        whole = known >= 0
        rest = np.flatnonzero(~whole)
        ids, begin = self.merged(*joined(words, rest))
        counts = np.ones(len(words), np.int64)
        counts[rest] = np.diff(begin)
        start = np.append(0, np.cumsum(counts))
        out = np.empty(start[-1], np.int32)
        out[start[:-1][whole]] = self.token_ids[known[whole]]
        out[np.repeat(~whole, counts)] = ids
        return out, start

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """The ids of each text."""
        cuts = cut(texts)
        ids, start = self.words(cuts.words)
        data, at = joined(binaries(ids.view(np.uint8), start * 4), cuts.index)
        return pa.ListArray.from_arrays(pa.array(at[cuts.first] // 4, pa.int32()), pa.array(data.view(np.int32)))

    def decode(self, ids: pa.Array) -> pa.Array:
        """The bytes of each list of ids."""
        ids = ids.fill_null([]) if ids.null_count else ids
        at = ids.offsets.to_numpy().astype(np.int64)
        data, ends = joined(self.bytes_of, ids.values.to_numpy()[at[0] : at[-1]])
        return binaries(data, ends[at - at[0]])


def _from_the_left(overlaps: np.ndarray) -> np.ndarray:
    """Which of some positions are merged where each may overlap the one before: in a row of overlapping ones every other."""
    at = np.arange(len(overlaps) + 1)
    head = np.maximum.accumulate(np.where(np.append(False, overlaps), 0, at))
    return (at - head) % 2 == 0


@lru_cache(maxsize=2)
def loaded(content: bytes) -> RankBPE:
    return RankBPE(content)


def vocabulary(spark: SparkSession, path: str | None = None):
    """The vocabulary file, read by the driver and sent to the workers: a file of fixed size, whatever the corpus."""
    with open(path or public_tokenizers.path(DEFAULT_VOCABULARY), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, text: str = "text", into: str = "ids", path: str | None = None) -> DataFrame:
    """docs with the ids of each text as an array of integers."""
    content = vocabulary(docs.sparkSession, path)

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = loaded(content.value)
        for batch in batches:
            parts = [bpe.encode(part) for part in slices(batch)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return docs.withColumn(into, run.asNondeterministic()(docs[text].cast("string")))


def decode(tokens: DataFrame, ids: str = "ids", into: str = "decoded", path: str | None = None) -> DataFrame:
    """tokens with the bytes of its ids; null ids count as none."""
    content = vocabulary(tokens.sparkSession, path)

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = loaded(content.value)
        for batch in batches:
            parts = [bpe.decode(part).cast(pa.binary()) for part in slices(batch)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

    return tokens.withColumn(into, run.asNondeterministic()(tokens[ids]))


def op12_rank_queue_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: token count, and digests of the ids joined by commas and of the decoded bytes."""
    coded = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
