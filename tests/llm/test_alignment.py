import hashlib
import random
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from claimlens.llm import alignment
from claimlens.llm.bpe import byte_letters

LETTERS = "ab'sdtl re   \n\t._-%9é½ßÑ日🙂▁́\x85\xa0\x1c<s></s><0x41>"
ROWS = [(1, None), (2, ""), (None, " "), (3, "  two  spaces "), (4, "the end<|endoftext|> of <s> it</s>"), (4, "mark ▁here"), (5, "日本語 テキスト"),
        (6, "the the the"), (7, "the the the"), (7, "the the the"), (8, "a\n\n b\tc \x00"), (9, "word " * 3000)]


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(public_tokenizers.path(alignment.FIRST))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.SECOND))


def tokens(text, libraries):
    """(id, end) by A and by B for space and text, from the libraries; none where the bytes differ."""
    first, second = libraries
    letters, want = byte_letters(), (" " + (text or "")).encode()
    if not text:
        return [], []
    a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([i - 3]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()) for i in second.encode(text)]
    if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
        return [], []
    out = []
    for row in (a, b):
        at, ends = 0, []
        for i, x in row:
            at += len(x)
            ends.append((i, at))
        out.append(ends)
    return out


def brute(rows, libraries):
    """Measures by comparing every token of one side with every token of the other, without deduplication."""
    cuts = [tokens(t, libraries) for _, t in rows]
    links = [[(x, y) for x, e in a for y, f in b if e == f] if len(a) < 300 else [(x, dict((f, y) for y, f in b)[e]) for x, e in a if e in {f for _, f in b}] for a, b in cuts]
    counts = Counter(p for row in links for p in row)
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for (i, _), (a, b), own in zip(rows, cuts, links):
        both = {e for _, e in a} & {f for _, f in b}
        groups, left, right = [], iter(a), iter(b)
        for end in sorted(both):
            sides = []
            for side in (left, right):
                ids = []
                for x, e in side:
                    ids.append(str(x))
                    if e == end:
                        break
                sides.append(",".join(ids))
            groups.append("|".join(sides))
        best = sum(counts[p] == most[p[1]] for p in own)
        out.append((i, len(a), len(b), len(groups), len(own), best, sum(counts[p] for p in own), ";".join(groups)))
    return sorted(out, key=str)


def random_rows(n):
    rng = random.Random(8)
    return [(k, "".join(rng.choice(LETTERS) for _ in range(rng.randrange(50)))) for k in range(n)]


@pytest.mark.parametrize("share", [2.0**-20, 0.01, 2.0])  # all pairs hot, some, none
def test_equals_brute_force(spark, monkeypatch, libraries, share):
    monkeypatch.setattr(alignment, "HOT_SHARE", share)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 300)
    rows = ROWS + random_rows(300)
    docs = spark.createDataFrame([(t, i, "x", "y") for i, t in rows], "text string, doc_id long, key string, groups string")
    want = brute(rows, libraries)
    assert sorted((tuple(r) for r in alignment.align(docs).collect()), key=str) == want
    assert sum(r[4] == 0 for r in want) > 4 and len({r[5] for r in want}) > 3


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_tokens_equal_the_libraries(libraries):
    first, second = libraries
    own = alignment.loaded(*(alignment._content(None, x) for x in (alignment.FIRST, alignment.SECOND)))
    texts = [t for _, t in ROWS + random_rows(2000) if t and "▁" not in t]
    spaced = pa.array([" " + t for t in texts]).cast(pa.binary())
    a, (b, good) = alignment._by_first(spaced, own.a), alignment._by_second(spaced, own.b)
    for k, text in enumerate(texts):
        assert a.ids[a.first[k] : a.first[k + 1]].tolist() == first.encode(" " + text, add_special_tokens=False).ids
        assert b.ids[b.first[k] : b.first[k + 1]].tolist() == second.encode(text), text
    assert good.all()


def test_query_equals_brute_force(spark, small_dir, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()]
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest() if x else ""
    want = [(*r[:-1], digest(r[-1])) for r in brute(rows, libraries)]
    got = alignment.op11_alignment(spark, small_dir)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)


def test_a_text_of_very_many_rows_is_joined_by_both_sides_shuffle(spark):
    """Only then can AQE split the rows of one text."""
    docs = spark.range(50).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same text', concat('text ', id)) AS text")
    plan = alignment.align(docs)._jdf.queryExecution().executedPlan().toString()
    top = plan[plan.index("Join") :]
    assert "xxhash64(__key" in top.split("\n")[0]
