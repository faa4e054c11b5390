import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from claimlens.llm import common, components, simhash


def plain(text):
    """The fingerprint, bit by bit."""
    import re

    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(bits):
    """Least member of each one's component, from all pairs."""
    root = list(range(len(bits)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(bits)), 2):
        if (bits[a] ^ bits[b]).bit_count() <= 2:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(bits))]


def components_of(spark, bits):
    rows = [(int(np.uint64(b).astype(np.int64)),) for b in dict.fromkeys(bits)]
    marked = spark.createDataFrame([(i, f) for i, (f,) in enumerate(rows)], "id long, fingerprint long")
    got = {r.fingerprint: r.id for r in simhash._classes(marked).collect()}
    assert [got[f] for (f,) in rows] == brute([*dict.fromkeys(bits)])


def test_fingerprint_equals_plain_one():
    rng = random.Random(2)
    texts = ["", " \t", "one", "One two", "a b c", "É é É x", "\x1c a\x85b c", "w " * 70000]
    texts += [" ".join(rng.choice(["a", "B", "cc", "ü"]) for _ in range(rng.randrange(40))) for _ in range(100)]
    for t in texts:
        assert simhash.fingerprint_bits(t.encode()) == plain(t)


def test_random_neighbours_find_their_components(spark):
    rng = random.Random(3)
    bits = []
    for _ in range(60):
        x = rng.getrandbits(64)
        for _ in range(4):
            bits.append(x)
            for b in rng.sample(range(64), rng.choice([1, 2, 3])):
                x ^= 1 << b
    components_of(spark, bits)


def test_crowded_keys_lose_no_component(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 3)
    rng = random.Random(4)
    base = rng.getrandbits(64)
    bits = [base ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 4, 5]))) for _ in range(150)] + [base ^ 7 << 61, base]
    components_of(spark, bits)


def test_rows_nulls_and_clashing_columns(spark):
    rows = [(3, None, 1, "k"), (2, "", 2, "k"), (None, "a b c d e", 3, "k"), (7, "A b c D e", 4, None), (9, "quite other words here now", 5, "k"), (9, "quite other words here now", 5, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint long, component_id string")
    out = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert out == sorted([(3, 2), (2, 2), (None, 7), (7, 7), (9, 9), (9, 9)], key=str)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 7, 9]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    unnamed = spark.createDataFrame([(None, "a b c"), (None, "x y z q"), (None, "a b c")], "doc_id long, text string")
    assert simhash.one_of_each(unnamed).count() == 2


def test_query_equals_brute_force(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").orderBy("doc_id").collect()
    bits = [plain(d.text) for d in docs]
    want = {(d.doc_id, f"{b:016x}", docs[c].doc_id) for d, b, c in zip(docs, bits, brute(bits))}
    assert {tuple(r) for r in simhash.op10_simhash(spark, small_dir).collect()} == want


def test_one_of_each_equals_brute_force(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    want = sorted((tuple(rows[k]) for k in {*brute([plain(d.text) for d in rows])}), key=str)
    assert sorted(map(tuple, simhash.one_of_each(docs).collect()), key=str) == want and len(want) < len(rows)


def test_one_of_each_of_rows_that_share_an_id(spark):
    rows = [(5, "b same words here", "x"), (5, "b same words here", "y"), (5, None, "n"), (5, "", "e"), (None, "b same words here", "z"), (None, "alone in this one", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    got = {(r.doc_id, r.text) for r in simhash.one_of_each(docs).collect()}
    assert got == {(5, "b same words here"), (5, ""), (None, "alone in this one")} and simhash.one_of_each(docs).count() == 3


def test_a_node_of_very_many_links_is_split(spark, monkeypatch):
    """Links of one node make a third of all and more: AQE parts them in a round's join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        star = spark.range(1, 60_000).selectExpr("if(id % 2 = 0, 0, id - 1) AS a", "id AS b")
        once = components._star(star, True)
        assert len(once.collect()) == 59_999
        assert "skew=true" in once._jdf.queryExecution().executedPlan().toString()
        found = components.components(star)
        assert found.where("root = 0").count() == 60_000 == found.count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_cluster_needs_a_shared_folder(spark):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())
