import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from claimlens.llm import rank_queue

CONTENT = open(public_tokenizers.path(rank_queue.DEFAULT_VOCABULARY), "rb").read()
LETTERS = "ab'sdtlvre   \n\t._-%9é½ßÑ日<|endoftext|>🙂́\x85\xa0\x1c"


def library_of(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def ranks():
    return {base64.b64decode(t): int(r) for t, r in map(bytes.split, CONTENT.splitlines())}


@pytest.fixture(scope="module")
def ours():
    return rank_queue.loaded(CONTENT)


def same(ours, library, texts):
    got = ours.encode(pa.array(texts, pa.string()))
    want = [library.encode_ordinary(x or "") for x in texts]
    assert got.to_pylist() == want
    assert ours.decode(got).to_pylist() == [library.decode_bytes(x) for x in want]


def test_equals_library(ours, ranks):
    rng = random.Random(3)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(60))) for _ in range(4000)]
    same(ours, library_of(ranks), texts + [None, "", "a" * 5000, "ab" * 7000, "the" * 30000, "日本語 テキスト 👩‍👩‍👧", "\x00 \x00"])
    same(ours, library_of(ranks), [])


def test_equals_library_where_a_merge_makes_a_lower_rank():
    """Made-up vocabularies, in which tokens' parts often have higher ranks than the tokens."""
    rng = random.Random(11)
    for _ in range(60):
        tokens = list({bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))) for _ in range(40)})
        rng.shuffle(tokens)
        ranks = {bytes([b]): b for b in range(256)} | {t: 256 + k for k, t in enumerate(tokens)}
        content = b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items())
        small = rank_queue.RankBPE(content)
        same(small, library_of(ranks), ["".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(60)])
        assert small.careful.any()


def test_queue_gives_ranks_in_order_and_takes_new_ones():
    queue = rank_queue.RankQueue(50_000)
    queue.push(np.array([49_999, 7, rank_queue.FREE, 7, 4096], np.int32), np.arange(5))
    assert (r := queue.pop())[0] == 7 and r[1].tolist() == [1, 3]
    queue.push(np.array([3, 4096], np.int32), np.array([2, 9]))
    assert [(r, p.tolist()) for r, p in iter(queue.pop, None)] == [(3, [2]), (4096, [4, 9]), (49_999, [0])]
    assert not queue.root and not any(queue.leaves) and not any(queue.inner)


def test_columns_rows_and_nulls(spark):
    rows = [(1, None, "x"), (1, "", "y"), (None, "a b", None), (1, "a b", "z"), (1, "a b", "z"), (2, "w " * 30000, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids2 string").withColumnRenamed("ids2", "n_tokens")
    coded = rank_queue.decode(rank_queue.encode(docs))
    assert coded.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    out = coded.collect()
    assert len(out) == 6 and all((r.text or "").encode() == r.decoded for r in out)
    assert rank_queue.decode(rank_queue.encode(docs.limit(0))).count() == 0
    assert rank_queue.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>")).collect() == [(None, b""), ([], b"")]


def test_query_equals_library(spark, small_dir, ranks):
    library = library_of(ranks)
    digest = lambda x: hashlib.sha256(x).hexdigest()
    docs = {d.doc_id: d.text or "" for d in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    got = rank_queue.op12_rank_queue_bpe(spark, small_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest(",".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == digest(docs[r.doc_id].encode())
