import random

import numpy as np
from pyspark.sql import functions as F

from claimlens.llm import kdtree_topk


def brute(rows, is_query, k):
    out = []
    for q, x in rows:
        if is_query(q):
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != q and len(x) == len(y))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def whole(x):
    return [int(np.floor(64 * float(np.float32(c)))) for c in x]


def test_tree_finds_what_brute_force_finds(monkeypatch):
    monkeypatch.setattr(kdtree_topk, "LEAF", 4)
    rng = np.random.default_rng(1)
    for trial in range(30):
        d, n = int(rng.integers(1, 5)), int(rng.integers(1, 60))
        vectors = rng.integers(-3, 4, (n, d)) * (1 if trial % 3 else 10**8)  # many ties; large ones beyond floats
        ids = rng.permutation(n).astype(np.int64)
        tree = kdtree_topk.build(ids, vectors)
        spans, low, high = tree[2:]
        for (a, b, left, right), lo, hi in zip(spans, low, high):
            assert (tree[1][a:b].min(0) == lo).all() and (tree[1][a:b].max(0) == hi).all()
            assert left < 0 or (spans[left][1] == spans[right][0] and right >= 0)
        got = {n: [*zip(f.tolist(), s.tolist())] for n, f, s in kdtree_topk.search(tree, ids, vectors, np.full(n, kdtree_topk.NONE), 3)}
        for q in range(n):
            want = sorted((-int(vectors[q] @ vectors[j]), int(ids[j])) for j in range(n) if j != q)[:3]
            assert sorted((-s, i) for i, s in got.get(q, [])) == want


def test_rows_nulls_lengths_and_ties(spark, monkeypatch):
    monkeypatch.setattr(kdtree_topk, "SHARD_ROWS", 20)
    monkeypatch.setattr(kdtree_topk, "QUERY_ROWS", 5)
    monkeypatch.setattr(kdtree_topk, "LEAF", 4)
    rng = random.Random(2)
    rows = [(k, [rng.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(3)]) for k in range(120)]
    rows += [(k, [0.5, 0.5, 0.5]) for k in range(120, 200)] + [(200, [1.0, 2.0]), (210, [3.0, -1.0]), (220, [])]
    bad = [(300, None), (310, [1.0, None, 2.0]), (320, [float("nan"), 1.0, 1.0]), (330, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows + bad], "vec_id long, embedding array<float>, rank int, dim string")
    got = sorted(tuple(r) for r in kdtree_topk.top_k(df, F.coalesce(F.col("vec_id") % 10 == 0, F.lit(False)), 4).collect())
    assert got == brute([(i, whole(x)) for i, x in rows], lambda i: i % 10 == 0, 4)
    assert kdtree_topk.top_k(df.limit(0), F.lit(True)).count() == 0
    twice = df.where("vec_id < 3").union(df.where("vec_id < 3"))
    assert kdtree_topk.top_k(twice, F.col("vec_id") == 0, 9).count() == 4


def test_an_id_and_a_vector_of_a_third_of_all_rows(spark, monkeypatch):
    """They are dealt to several shards, and no row is lost."""
    monkeypatch.setattr(kdtree_topk, "SHARD_ROWS", 30)
    monkeypatch.setattr(kdtree_topk, "QUERY_ROWS", 5)
    rng = random.Random(3)
    rows = [(7, [1.0, 0.5])] * 100 + [(k, [rng.choice([-1.0, 0.25, 0.75]), rng.random()]) for k in range(200)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, row int")
    sizes = []
    tree_of = kdtree_topk._dealt
    monkeypatch.setattr(kdtree_topk, "_dealt", lambda rows, size, into: sizes.append((size, rows, into)) or tree_of(rows, size, into))
    got = sorted(tuple(r) for r in kdtree_topk.top_k(df, F.col("vec_id") % 40 == 0, 6).collect())
    assert got == brute([(i, [int(np.floor(64 * c)) for c in x]) for i, x in rows], lambda i: i % 40 == 0, 6)
    dealt = tree_of(sizes[0][1], 30, "shard").collect()
    assert sum(r.shards for r in dealt) >= 10 and max(r.shards for r in dealt) >= 4


def test_few_trees_meet_few_blocks_where_vectors_cluster(spark, monkeypatch):
    monkeypatch.setattr(kdtree_topk, "SHARD_ROWS", 50)
    monkeypatch.setattr(kdtree_topk, "QUERY_ROWS", 10)
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 4, (20, 6))
    rows = [(k, (centres[k % 20] + rng.normal(0, 0.05, 6)).tolist()) for k in range(2000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    seen = {}
    meet = kdtree_topk.meetings

    def watched(blocks, trees, shards):
        out = meet(blocks, trees, shards)
        seen["of"], seen["all"] = out.count(), blocks.count() * trees.count()
        return out

    monkeypatch.setattr(kdtree_topk, "meetings", watched)
    got = sorted(tuple(r) for r in kdtree_topk.top_k(df, F.col("vec_id") % 50 == 0, 5).collect())
    assert got == brute([(i, [int(np.floor(64 * c)) for c in x]) for i, x in rows], lambda i: i % 50 == 0, 5)
    assert seen["all"] > 300 and seen["of"] < 0.2 * seen["all"]


def test_splits_part_the_space():
    rng = np.random.default_rng(6)
    vectors = rng.integers(-50, 50, (4000, 3))
    axis, at = kdtree_topk.splits(vectors, 16)
    region = kdtree_topk.region_of(vectors, axis, at)
    counts = np.unique(region, return_counts=True)[1]
    assert len(counts) == 16 and counts.max() < 2 * counts.min()
    same = np.ones((100, 3), np.int64)
    assert kdtree_topk.region_of(same, *kdtree_topk.splits(same, 8)).max() == 0
