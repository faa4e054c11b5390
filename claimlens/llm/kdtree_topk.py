"""Exact top-k search by inner product with KD-trees per shard.

Shards are dealt by place: median splits of a sample of ``SPLIT_SAMPLE`` vectors part the space into regions, and a region
of more than about ``SHARD_ROWS`` vectors is dealt out by row number to as many shards as it takes, so a shard's size
grows neither with the table nor with a vector or an id that a large part of the rows share. Each shard is split at medians
of its widest dimension down to leaves, every node with the tight box around its vectors. A query visits a shard's nodes
in the order of the best score that their boxes allow, and stops when that falls below its k-th score.

Blocks of queries are of one region each. A block first searches a shard of its own region. The k-th scores found there
are propagated: the box around a block's queries and the box around a shard bound all scores between them, and where that
bound is below the least k-th score of the block, shard and block never meet; elsewhere the k-th scores bound the search
from the start. Blocks are sent to the trees they meet, a tree to every ``TOGETHER`` blocks once. A box whose bound equals
the k-th score is still visited, since ties go to the smaller id. Results are exact whatever the bounds save.

Vectors that are null, or hold null or non-finite components, take no part; vectors of different lengths don't meet,
and rows with a null id take no part. A query has as candidates all rows with another id; repeated rows count as often
as they occur. Components are whole numbers; scores must fit in a long.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimlens.llm.common import small, stored, table

K = 20
SCALE = 64
SHARD_ROWS = 8192
QUERY_ROWS = 2048
LEAF = 256
#: Vectors that decide where the space is split, and those of them that a region has at least.
SPLIT_SAMPLE = 16384
SPLIT_LEAF = 16
#: Blocks that meet a tree at a time.
TOGETHER = 16
EXACT = 2.0**53
BOX = "least array<long>, most array<long>"
TREE = f"dim int, shard int, ids binary, vectors binary, spans binary, low binary, high binary, {BOX}"
BLOCK = f"dim int, block int, ids binary, vectors binary, floor binary, {BOX}, bar long"
FOUND = "query_id long, vec_id long, score long"
NONE = np.iinfo(np.int64).min


def grid(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as a long; null for vectors that take no part."""
    fit = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(vector.isNotNull() & fit, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def build(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, ...]:
    """The tree over vectors: ids and vectors in leaf order, and per node (start, end, left, right), low and high corner."""
    order = np.lexsort([ids])
    spans, low, high = [], [], []

    def grow(start: int, end: int) -> int:
        node, part = len(spans), vectors[order[start:end]]
        spans.append([start, end, -1, -1])
        low.append(part.min(0))
        high.append(part.max(0))
        if end - start > LEAF and vectors.shape[1]:
            middle = (end - start) // 2
            widest = int((high[-1].astype(np.float64) - low[-1]).argmax())
            order[start:end] = order[start:end][np.argpartition(part[:, widest], middle, kind="introselect")]
            spans[node][2], spans[node][3] = grow(start, start + middle), grow(start + middle, end)
        return node

    grow(0, len(ids))
    return ids[order], vectors[order], np.array(spans), np.array(low), np.array(high)


def search(tree: tuple[np.ndarray, ...], ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its best k of a tree (query number, vec_ids, scores), leaving out what is below its floor."""
    own, vectors, spans, low, high = tree
    largest = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (vectors, queries)]
    if largest[0] * largest[1] * max(1, vectors.shape[1]) < EXACT:
        vectors, queries, low, high = (x.astype(np.float64) for x in (vectors, queries, low, high))  # exact, and much faster
    allowed = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    for n, query in enumerate(queries):
        best_ids, best, least = np.zeros(0, np.int64), np.zeros(0, np.int64), floor[n]
        heap = [(-allowed[n, 0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < least:
                break
            start, end, left, right = spans[node]
            if left >= 0:
                for child in (left, right):
                    heapq.heappush(heap, (-allowed[n, child], child))
                continue
            scores = (vectors[start:end] @ query).astype(np.int64)
            good = np.flatnonzero((scores >= least) & (own[start:end] != ids[n]))
            if good.size:
                best_ids, best = np.concatenate([best_ids, own[start:end][good]]), np.concatenate([best, scores[good]])
                if best.size >= k:
                    first = np.lexsort([best_ids, -best])[:k]
                    best_ids, best = best_ids[first], best[first]
                    least = max(least, int(best[-1]))
        if best.size:
            yield n, best_ids, best


def _packed(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = rows.column("id").to_numpy().astype(np.int64)
    flat = rows.column("v").combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return ids, flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(ids), -1)


def _box(vectors: np.ndarray) -> dict[str, pa.Array]:
    return {n: pa.array([x.tolist()], pa.list_(pa.int64())) for n, x in (("least", vectors.min(0)), ("most", vectors.max(0)))}


def _tree_of(key: tuple, rows: pa.Table) -> pa.Table:
    ids, vectors = _packed(rows)
    parts = build(ids, vectors)
    packed = {n: pa.array([np.ascontiguousarray(x, np.int64).tobytes()], pa.binary()) for n, x in zip(("ids", "vectors", "spans", "low", "high"), parts)}
    return pa.Table.from_pydict({"dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32())} | packed | _box(vectors))


def _block_of(key: tuple, rows: pa.Table) -> pa.Table:
    ids, vectors = _packed(rows)
    floor = rows.column("floor").to_numpy().astype(np.int64)
    packed = {n: pa.array([x.tobytes()], pa.binary()) for n, x in (("ids", ids), ("vectors", np.ascontiguousarray(vectors)), ("floor", floor))}
    bar = {"bar": pa.array([int(floor.min())], pa.int64())}
    return pa.Table.from_pydict({"dim": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32())} | packed | _box(vectors) | bar)


def splits(sample: np.ndarray, regions: int) -> tuple[np.ndarray, np.ndarray]:
    """Axis and threshold of each node of a binary tree that parts a sample at medians; node n has children 2n + 1, 2n + 2. Axis -1: a leaf."""
    depth = max(0, int(np.ceil(np.log2(max(1, regions)))))
    axis, at = np.full((2 << depth) - 1, -1), np.zeros((2 << depth) - 1, np.int64)

    def part(node: int, rows: np.ndarray, level: int) -> None:
        if level == depth or len(rows) < 2 * SPLIT_LEAF or not rows.shape[1]:
            return
        widest = int((rows.max(0).astype(np.float64) - rows.min(0)).argmax())
        middle = int(np.partition(rows[:, widest], (len(rows) - 1) // 2)[(len(rows) - 1) // 2])
        right = rows[:, widest] > middle
        if right.any():
            axis[node], at[node] = widest, middle
            part(2 * node + 1, rows[~right], level + 1)
            part(2 * node + 2, rows[right], level + 1)

    part(0, sample, 0)
    return axis, at


def region_of(vectors: np.ndarray, axis: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The leaf in which each vector lies."""
    node = np.zeros(len(vectors), np.int64)
    while len(on := np.flatnonzero(axis[node] >= 0)):
        here = node[on]
        node[on] = 2 * here + 1 + (vectors[on, axis[here]] > at[here])
    return node


def _placed(rows: DataFrame, n_shards: int) -> DataFrame:
    """rows with the region of each vector, by splits of a sample: the rows of the smallest hashes."""
    drawn = rows.select("dim", "v", F.xxhash64("row").alias("h")).orderBy("h").limit(SPLIT_SAMPLE).toArrow()
    dims = np.array(drawn.column("dim").to_pylist(), np.int64)
    vectors = drawn.column("v").to_pylist()
    regions = min(n_shards, SPLIT_SAMPLE // SPLIT_LEAF)
    found = {d: splits(np.array([v for v, own in zip(vectors, dims) if own == d], np.int64), regions) for d in np.unique(dims[dims > 0]).tolist()}
    sent = rows.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("dim").to_numpy()
            region = np.zeros(len(own), np.int32)
            for d in np.unique(own).tolist():
                if d and d in sent.value:
                    at = np.flatnonzero(own == d)
                    region[at] = region_of(batch.column("v").take(pa.array(at)).flatten().to_numpy().reshape(-1, d), *sent.value[d])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(region)], names=[*batch.schema.names, "region"])

    return rows.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", region int")


def _dealt(rows: DataFrame, size: int, into: str) -> DataFrame:
    """Per (dim, region): the first of the numbers ``into`` that its rows get, and how many there are; numbers run through each dim."""
    counted = rows.groupBy("dim", "region").agg(F.ceil(F.count("*") / size).cast("int").alias(f"{into}s"))
    # A row for each region: as many as the splits have leaves at most.
    before = F.sum(f"{into}s").over(Window.partitionBy("dim").orderBy("region").rowsBetween(Window.unboundedPreceding, -1))
    return stored(counted.withColumn(f"first_{into}", F.coalesce(before, F.lit(0)).cast("int")), f"dealt-{into}")


def _read(row: dict, name: str, width: int | None = None) -> np.ndarray:
    flat = np.frombuffer(row[name], np.int64)
    return flat if width is None else flat.reshape(-1 if width else len(np.frombuffer(row["ids"], np.int64)), width)


def _searched(trees: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """What the blocks find in the trees of the same (dim, shard, part)."""

    def run(tree: pa.Table, block: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        for t in tree.to_pylist():
            dim = t["dim"]
            spans = _read(t, "spans", 4)
            corners = [np.frombuffer(t[n], np.int64).reshape(len(spans), dim) for n in ("low", "high")]
            parts = (_read(t, "ids"), _read(t, "vectors", dim), spans, *corners)
            for b in block.to_pylist():
                ids = _read(b, "ids")
                for n, found, scores in search(parts, ids, _read(b, "vectors", dim), _read(b, "floor"), k):
                    out["query_id"].append(np.full(len(found), ids[n]))
                    out["vec_id"].append(found)
                    out["score"].append(scores)
        return pa.Table.from_pydict({n: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for n, x in out.items()})

    keys = ["dim", "shard", "part"]
    asked = blocks.select(F.col("dim").alias("a_dim"), F.col("shard").alias("a_shard"), F.col("part").alias("a_part")).distinct()
    met = trees.join(asked, (F.col("dim") == F.col("a_dim")) & (F.col("shard") == F.col("a_shard")))
    met = met.select(*trees.columns, F.col("a_part").alias("part"))
    return met.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInArrow(run, FOUND)


def meetings(blocks: DataFrame, trees: DataFrame, shards: DataFrame) -> DataFrame:
    """The (dim, block, shard) in which a score may reach the block's bar, by the box of its queries and that of the shard.

    The bound is a sum of doubles, so a little is added to it.
    """
    boxes = trees.select(F.col("dim").alias("t_dim"), F.col("shard").alias("t_shard"), F.col("least").alias("low"), F.col("most").alias("high"))
    last = shards.groupBy("dim").agg((F.sum("shards") - 1).cast("int").alias("last"))
    asked = blocks.join(small(last), "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("last"))))
    products = ", ".join(f"cast({q}[i] AS double) * {t}[i]" for q in ("least", "most") for t in ("low", "high"))
    bound = F.expr(f"aggregate(transform(least, (x, i) -> greatest({products})), 0D, (a, x) -> a + x)")
    met = asked.join(small(boxes), (F.col("dim") == F.col("t_dim")) & (F.col("shard") == F.col("t_shard")))
    return met.where(bound + F.abs(bound) * 1e-9 + 1 >= F.col("bar").cast("double")).select("dim", "block", "shard")


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per query row (query_id) the k other rows (vec_id) of the highest score, with rank from 1."""
    rows = vectors.select(F.col(id).cast("long").alias("id"), grid(F.col(vector)).alias("v"), is_query.alias("q")).where("id IS NOT NULL AND v IS NOT NULL")
    rows = stored(rows.withColumns({"dim": F.size("v"), "row": F.monotonically_increasing_id()}), "vectors")
    n_shards = -(-max(1, rows.count()) // SHARD_ROWS)
    rows = stored(_placed(rows, n_shards), "placed")
    shards = _dealt(rows, SHARD_ROWS, "shard")
    sharded = rows.join(small(shards), ["dim", "region"]).withColumn("shard", F.col("first_shard") + F.pmod(F.xxhash64("row"), "shards").cast("int"))
    trees = stored(sharded.select("dim", "shard", "id", "v").groupBy("dim", "shard").applyInArrow(_tree_of, TREE), "trees")
    queries = stored(rows.where("q").select("dim", "region", "id", "v").distinct(), "queries")
    dealt = _dealt(queries, QUERY_ROWS, "block")
    queries = queries.join(small(dealt), ["dim", "region"]).withColumn("block", F.col("first_block") + F.pmod(F.xxhash64("id", "v"), "blocks").cast("int"))

    def blocks(of: DataFrame) -> DataFrame:
        return of.select("dim", "block", "id", "v", "floor").groupBy("dim", "block").applyInArrow(_block_of, BLOCK)

    # Each block's first shard is one of its own region.
    own = dealt.join(shards, ["dim", "region"]).withColumn("nth", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    home = stored(own.select("dim", (F.col("first_block") + F.col("nth")).alias("block"), (F.col("first_shard") + F.col("nth") % F.col("shards")).alias("shard")), "home")
    part = F.expr(f"block DIV {TOGETHER}").cast("int")
    first_blocks = blocks(queries.withColumn("floor", F.lit(NONE))).join(home, ["dim", "block"]).withColumn("part", part)
    first = stored(_searched(trees, first_blocks, k), "first-found")
    # Of rows that share an id, each vector may have a floor of its own; the least one bounds them all.
    floors = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") >= k)
    bounded = queries.join(floors.select("query_id", "floor"), queries.id == F.col("query_id"), "left").withColumn("floor", F.coalesce("floor", F.lit(NONE)))
    asking = stored(blocks(bounded), "blocks")
    pairs = meetings(asking.select("dim", "block", "least", "most", "bar"), trees, shards).join(home, ["dim", "block", "shard"], "left_anti")
    rest = _searched(trees, asking.join(stored(pairs, "meetings"), ["dim", "block"]).withColumn("part", part), k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = first.union(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each twentieth vector's best other vectors."""
    return top_k(table(spark, sf_dir, "embeddings"), F.coalesce(F.col("vec_id") % 20 == 0, F.lit(False)))


OP4_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
