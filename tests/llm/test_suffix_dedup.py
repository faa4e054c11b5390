import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from claimlens.llm import anchors, common, suffix_dedup, suffixes

N = 400


def plain(texts):
    """Per text: bytes, removed bytes, removed runs, digest of the rest."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + N] for b in raw for i in range(len(b) - N + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - N + 1):
            if seen[b[i : i + N]] > 1:
                gone[i : i + N] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_cover_and_shifts():
    d = suffixes.cover()
    assert len(d) == 9 and sorted((a - b) % 73 for a in d for b in d if a != b) == [*range(1, 73)]
    s = suffixes.shifts()
    assert (s >= 0).all() and all((r + s[r, q]) % 73 in d and (q + s[r, q]) % 73 in d for r in range(73) for q in range(73))


def words(rng, n, of=40):
    return " ".join(f"w{rng.randrange(of)}é"[: rng.randrange(2, 5)] for _ in range(n))


def test_sorted_windows_equal_counted_ones():
    rng = random.Random(1)
    for trial in range(12):
        pool = [words(rng, 300, 5 if trial % 2 else 4000).encode() for _ in range(3)]
        fragments = [b"".join([rng.randbytes(rng.randrange(90)), p[a : a + rng.randrange(300, 700)], rng.randbytes(rng.randrange(90))]) for p in pool for a in (0, 1, 150, 150)]
        fragments += [b"a" * 500, b"ab" * 250, b"x", b"", fragments[0]]
        seen = Counter(f[i : i + N] for f in fragments for i in range(len(f) - N + 1))
        got = suffixes.repeated_windows(fragments, N)
        for f, runs in zip(fragments, got):
            want = [i for i in range(len(f) - N + 1) if seen[f[i : i + N]] > 1]
            assert [i for a, b in runs for i in range(a, b + 1)] == want
            assert all(b + 1 < c for (_, b), (c, _) in zip(runs, runs[1:]))


def test_equal_windows_have_equal_anchors(monkeypatch):
    monkeypatch.setattr(anchors, "SLICE", 1000)
    rng = random.Random(2)
    shared = words(rng, 200).encode()
    for left in (b"", rng.randbytes(7), rng.randbytes(2000)):
        text = left + shared + rng.randbytes(3)
        places, firsts, lasts = anchors.anchored(text, N)
        assert firsts[0] == 0 and lasts[-1] == len(text) - N and (firsts[1:] == lasts[:-1] + 1).all()
        grams = anchors.gram_hashes(np.frombuffer(text, np.uint8)) >> np.uint64(anchors.PLACE_BITS)
        for p, a, b in zip(places, firsts, lasts):
            for i in (a, b):
                assert i + int(grams[i : i + N - anchors.GRAM + 1].argmin()) == p


def cases():
    rng = random.Random(3)
    passage, long = words(rng, 130), words(rng, 500)
    exact = passage.encode()[:N].decode(errors="ignore")
    texts = [words(rng, rng.randrange(10, 300)) for _ in range(12)]
    texts += [words(rng, 50) + passage + words(rng, 40) for _ in range(6)]
    texts += [long, long, long[:900] + "CHANGED" + long[907:], "é" + long, passage + passage, passage[:-1], exact, "zz" + exact + "qq", exact[1:]]
    texts += ["a" * 900, "a" * 399, "Hent " * 300, "日本語" * 400, None, "", "short", "\0" * 600, words(rng, 30000, 10**6)]
    return texts


def rows_of(spark, texts):
    return spark.createDataFrame([(k if k % 7 else None, t, 1, "s") for k, t in enumerate(texts)], "doc_id long, text string, k1 int, removed string").drop("removed")


def ours(spark, texts):
    docs = rows_of(spark, texts)
    got = suffix_dedup.with_spans(docs).collect()
    out = []
    for r in got:
        raw = (r.text or "").encode()
        runs = suffix_dedup.covered([s.asDict() for s in r.removed or []], N)
        out.append((len(raw), sum(b - a for a, b in runs), len(runs), hashlib.sha256(suffix_dedup.cut(raw, runs)).hexdigest()))
    return sorted(out)


def test_equals_brute_force(spark, monkeypatch):
    texts = cases()
    want = sorted(plain(texts))
    assert sum(w[1] > 0 for w in want) > 10
    assert ours(spark, texts) == want
    monkeypatch.setattr(suffix_dedup, "CROWD", 2)  # crowded cores are counted
    monkeypatch.setattr(suffix_dedup, "BLOCK", 500)
    assert ours(spark, texts) == want


def test_small_tables(spark):
    assert ours(spark, ["x"]) == plain(["x"])
    assert suffix_dedup.with_spans(rows_of(spark, ["x"]).limit(0)).count() == 0


def test_texts_keep_whole_letters_and_columns(spark):
    rng = random.Random(4)
    shared = "é" * 250
    docs = spark.createDataFrame([(1, "x" + shared + "y", "a", 252), (2, "zz" + shared, "b", 252), (3, words(rng, 20), "c", 0), (4, None, "d", None), (5, "", "e", 0), (6, "q" * 800, "f", 800), (6, "q" * 800, "f", 800)], "doc_id long, text string, lang string, n_chars long")
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text == "xy" and got[1].n_chars == 2 and got[2].text == "zz"
    assert got[3].n_chars == 0 and got[4].text is None and got[5].text == "" and 6 not in got


def test_query_equals_brute_force(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").collect()
    want = sorted((d.doc_id, *p) for d, p in zip(docs, plain([d.text for d in docs])))
    got = suffix_dedup.op5_suffix_dedup(spark, small_dir).collect()
    assert sorted(tuple(r)[:5] for r in got) == want
    assert all(r.n_kept == r.n_bytes - r.n_removed for r in got)


def test_query_shows_what_is_kept(spark, tmp_path):
    """A passage of 400 bytes or more is gone from the texts, a shorter one of as many words stays, and so does the rest."""
    rng = random.Random(10)
    fresh = lambda n: " ".join(f"{rng.randrange(10**6)}" for _ in range(n))
    long, short = fresh(70), " ".join(rng.choice("abcdefgh") for _ in range(70))
    texts = [f"{fresh(20)} {p} {fresh(20)}" for p in (long, short) for _ in range(3)] + [fresh(90), None, "", "é" * 300, "zé" * 300]
    spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in suffix_dedup.op5_suffix_dedup(spark, str(tmp_path)).collect()}
    assert [tuple(got[k])[1:5] for k in range(len(texts))] == plain(texts)
    for k, t in enumerate(texts):
        r = got[k]
        assert r.n_kept <= len(r.text.encode()) <= r.n_kept + 6 * r.n_spans and "\ufffd" not in r.text
        assert r.n_removed > 0 or r.text == (t or "")
    assert all(long not in got[k].text and got[k].n_removed >= len(long) for k in range(3))
    assert all(got[k].text == texts[k] and short in got[k].text for k in range(3, 6))


def without_words(texts, n=51):
    """Per text what is left of it without repeated windows of n words, found by counting them."""
    found = [[m.span() for m in re.finditer(rb"\S+", t.encode())] for t in texts]
    words = [[t.encode()[a:b] for a, b in f] for t, f in zip(texts, found)]
    seen = Counter(tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1))
    out = []
    for t, w, f in zip(texts, words, found):
        gone, raw = set(), t.encode()
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i : i + n])] > 1:
                gone.update(range(i, i + n))
        edges = [a for a, _ in f] + [len(raw)]
        dropped = {k for i in gone for k in range(edges[i], edges[i + 1])}
        left = bytes(x for k, x in enumerate(raw) if k not in dropped).decode()
        if not gone or left.split():
            out.append(left)
    return sorted(out)


def test_passages_of_over_fifty_words_go(spark, monkeypatch):
    rng = random.Random(5)
    fresh = lambda n: " ".join(f"{rng.choice(['a', 'no', 'word', 'longer-é'])}{rng.randrange(10**5)}" for _ in range(n))
    texts = [fresh(30)]
    for n in (49, 50, 51, 52, 58, 65, 90):
        for passage in (fresh(n), " ".join(rng.choice("abcdefgh") for _ in range(n))):
            texts += [f"{fresh(20)} {passage}\n{fresh(25)}", f"{fresh(3)}\n{passage.replace(' ', '  ')} {fresh(40)}"]
    alone = fresh(55)
    texts += [alone, f"\n {alone} {alone}", "two words", "w " * 300]
    want = without_words(texts)
    assert len(want) < len(texts) and sum(len(t.split()) for t in want) < sum(len(t.split()) for t in texts) - 1000
    docs = spark.createDataFrame([(k, t, len(t)) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    for crowd in (256, 1):
        monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
        out = suffix_dedup.without_repeated_words(docs).collect()
        assert sorted(r.text for r in out) == want and all(r.n_chars == len(r.text) for r in out)


def test_letters_are_words_where_there_are_no_spaces():
    text = ("日本語" * 30 + " ab é").encode()
    bounds = suffix_dedup.word_bounds(text)
    assert len(bounds) == 92 and text[slice(*bounds[1])].decode() == "本" and text[slice(*bounds[-1])].decode() == "é"
    assert len(suffix_dedup.coded(text)) == 92 * 8


def test_a_long_run_without_spaces_is_one_word(spark):
    """An address, a hash and base64 that stand in two texts are no passages; fifty-one letters of Han are."""
    rng = random.Random(8)
    run = "https://example.org/" + "".join(rng.choice("abcdefghij0123456789/-_=+") for _ in range(900))
    han = "".join(chr(0x4E00 + rng.randrange(2000)) for _ in range(60))
    for shared, kept in ((run, True), ("é" * 300, True), (han[:50], True), (han[:51], False)):
        texts = [f"{words(rng, 20)} {shared} {words(rng, 20)}" for _ in range(2)]
        docs = spark.createDataFrame([(k, t, len(t)) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long")
        out = [r.text for r in suffix_dedup.without_repeated_words(docs).collect()]
        assert (sorted(out) == sorted(texts)) is kept and all((shared in t) is kept for t in out)


def test_one_python_worker_for_each_task(spark, monkeypatch):
    """Words are coded where anchors are chosen, and texts shuffled as they are: a second worker a task would take its memory."""
    plans = []
    monkeypatch.setattr(suffix_dedup, "stored", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or kept(df, name))
    kept = common.stored
    rng = random.Random(9)
    passage = words(rng, 60)
    docs = spark.createDataFrame([(k, f"{words(rng, 30)} {passage}") for k in range(3)], "doc_id long, text string")
    assert not any(passage in r.text for r in suffix_dedup.without_repeated_words(docs).collect())
    count = {name: len(re.findall("ArrowEvalPython|MapInArrow", plan)) for name, plan in plans}
    assert count["anchors"] == 1 and count["fragments"] == 1
    fragments = dict(plans)["fragments"]
    assert fragments.index("ArrowEvalPython") < fragments.index("Exchange")  # after the shuffle: plans have their last step first


def test_texts_without_repeats_stay_out_of_the_worker(spark):
    """What isn't cut isn't sent: a byte that is no UTF-8, on which the worker would fail, passes, and the plan shows why."""
    rng = random.Random(11)
    passage = words(rng, 60)
    docs = spark.createDataFrame([(k, f"{words(rng, 30)} {passage}", 1) for k in range(3)] + [(3, None, None), (4, "", 0)], "doc_id long, text string, n_chars int")
    odd = spark.sql("SELECT 5L AS doc_id, CAST(unhex('61FF62') AS STRING) AS text, 3 AS n_chars")
    out = suffix_dedup.without_repeated_words(docs.union(odd))
    sent = re.search(r"ArrowEvalPython \[run\(([^\]]+)", out._jdf.queryExecution().executedPlan().toString())[1]
    assert out.columns == docs.columns and sent.startswith("CASE WHEN isnotnull(__removed")
    got = {r.doc_id: r for r in out.selectExpr("doc_id", "hex(cast(text AS binary)) AS hex", "text IS NULL AS none", "n_chars").collect()}
    assert got[5].hex == "61FF62" and got[3].none and got[3].n_chars is None and got[4].hex == "" and len(got) == 6
    assert not any(passage.encode().hex().upper() in got[k].hex for k in range(3)) and got[0].n_chars == len(bytes.fromhex(got[0].hex).decode())


def test_texts_leave_the_worker_in_parts(monkeypatch):
    """A worker gives a batch of texts back in parts, in order and whole."""
    monkeypatch.setattr(suffix_dedup, "GIVEN", 3)
    texts = pa.array([b"a b", None, b"", b"c", *[b"d d"] * 6], pa.binary())
    parts = [*suffix_dedup._coded.func(iter([texts, texts[:0]]))]
    assert [len(p) for p in parts] == [3, 3, 3, 1]
    assert pa.concat_arrays(parts).to_pylist() == [None if x is None else suffix_dedup.coded(x) for x in texts.to_pylist()]
