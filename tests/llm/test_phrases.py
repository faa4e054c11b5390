import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from claimlens.llm import phrases

BLANK = re.compile(r"[^\x20\x09]+")
BREAK = re.compile(r"[.,;:!?\x0A-\x0D]")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, minimum, top):
    """All counts by dictionaries, all cuts and all longer candidates by loops."""
    counts, totals, out = {}, Counter(), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in BREAK.split(lowered(text)):
            words = BLANK.findall(piece)
            totals[lang] += len(words)
            own.update(tuple(words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    for lang, own in counts.items():
        held = [p for p, f in own.items() if len(p) > 1 and f >= minimum]
        left = []
        for p in held:
            inside = any(p == q[s : s + len(p)] and own[q] >= own[p] for q in held if len(q) > len(p) for s in range(len(q) - len(p) + 1))
            cuts = [(1000 * own[p] * totals[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if not inside:
                left.append((lang, " ".join(p), own[p], own[p[:k]], own[p[k:]], totals[lang], score))
        left.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], rank, *r[1:]) for rank, r in enumerate(left[:top], 1)]
    return sorted(out)


def texts(n, seed=2):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "été", "日本", "a", "b", "c's", "x-y", "New", "york", "city"]
    fixed = ["new york city", "of the\ta", "a a a a a a a", "b of x-y the é a"]
    rows = []
    for _ in range(n):
        some = [rng.choice(fixed) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randrange(30))]
        rows.append((rng.choice(["en", "en", "en", "fr", None]), "".join(x + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n"]) for x in some)))
    return rows + [("en", None), (None, ""), ("fr", " \t ")] + rows[:20]


def found(spark, rows, minimum=12, top=40):
    docs = spark.createDataFrame([(t, g, 7) for g, t in rows], "text string, lang string, rank int")
    got = phrases.collocations(docs, minimum=minimum, top=top)
    assert dict(got.dtypes) == {"lang": "string", "phrase": "string"} | {c: "bigint" for c in ("rank", "a", "l", "r", "n", "score")}
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("every, proposed, bits", [(16, 3, 26), (1, 1, 26), (1 << 40, 3, 20), (2, 4, 6)])
def test_equals_brute_force(spark, monkeypatch, every, proposed, bits):
    """A fair sample; all; next to none, so that each length fails its border; a bitmap that is nearly full."""
    monkeypatch.setattr(phrases, "SAMPLE_EVERY", every)
    monkeypatch.setattr(phrases, "PROPOSED", proposed)
    monkeypatch.setattr(phrases, "FILTER_BITS", bits)
    rows = texts(150)
    want = brute(rows, 12, 40)
    assert len(want) > 20 and found(spark, rows) == want


def test_slices_and_languages_of_a_batch_do_not_matter(spark, monkeypatch):
    rows = texts(60, 9)
    monkeypatch.setattr(phrases, "SLICE_BYTES", 40)
    assert found(spark, rows, 6) == brute(rows, 6, 40)


def test_large_counts_score_exactly(spark):
    rows = [("x", 1, "p", 3_000_000_007), ("x", 1, "q", 2_999_999_999), ("x", 2, "p q", 2_718_281_828), ("x", 3, "p q q", 5), ("x", 2, "q q", 7)]
    counts = spark.createDataFrame(rows, "lang string, k int, phrase string, f long")
    got = {r.phrase: r for r in phrases.scored(counts, spark.createDataFrame([("x", 9_876_543_210_123)], "lang string, n long")).collect()}
    n = 9_876_543_210_123
    assert got["p q"].score == 1000 * 2_718_281_828 * n // (3_000_000_007 * 2_999_999_999)
    assert (got["p q q"].score, got["p q q"].l) == min((1000 * 5 * n // (3_000_000_007 * 7), 3_000_000_007), (1000 * 5 * n // (2_718_281_828 * 2_999_999_999), 2_718_281_828))


def test_empty_tables(spark):
    assert found(spark, []) == [] and found(spark, [("en", None), (None, "one")]) == []


def test_a_hot_phrase_is_one_row_per_task(spark):
    docs = spark.createDataFrame([("en", "same words here " * 40)], "lang string, text string").crossJoin(spark.range(300)).repartition(6)
    got = phrases.collocations(docs).collect()
    assert got[0].a == 300 * 39 or max(r.a for r in got) <= 300 * 40
    rows = phrases._summed(phrases._read(docs, "text", "lang"), phrases._words_and_sample, "lang string, phrase string, h long")
    assert "partial_sum" in rows._jdf.queryExecution().executedPlan().toString()


def counts(batches):
    return [sorted(r.column("n").to_pylist()) for r in batches]


def test_border_and_what_an_expansion_adds():
    words = phrases._Words(pa.array(["a b c d, a b c d, a b"]), "en")
    whole = np.full(1 << 15, 0xFFFFFFFF, np.uint32)
    assert counts(phrases._border(words, whole, None)) == [[2, 2, 3], [2, 2], [2]]
    assert list(phrases._border(words, whole, whole)) == []
    single = np.zeros(1 << 15, np.uint32)
    for h in words.hash:
        slot = int(h >> np.uint64(44))
        single[slot >> 5] |= np.uint32(1 << (slot & 31))
    got = list(phrases._border(words, single, None))
    assert counts(got) == [[2, 2, 3]] and not any(got[0].column("known").to_pylist())  # pairs of words alone
    more = single.copy()
    for p, w in zip(got[0].column("p").to_numpy().view(np.uint64), got[0].column("w").to_numpy().view(np.uint64)):
        slot = int(phrases._longer(np.array([p]), np.array([w]))[0] >> np.uint64(44))
        more[slot >> 5] |= np.uint32(1 << (slot & 31))
    assert counts(phrases._border(words, more, single)) == [[2, 2], [2]]  # three words, and four at once


def test_another_seed_where_hashes_are_shared(spark, monkeypatch):
    rows, tried = texts(40), []
    shared = phrases._shared
    monkeypatch.setattr(phrases, "_shared", lambda df: tried.append(1) or (len(tried) == 1) or shared(df))
    assert found(spark, rows, 6) == brute(rows, 6, 40) and len(tried) == 3
    df = spark.createDataFrame([(1,), (2,), (1,)], "h long")
    assert shared(df) and not shared(df.distinct())


def test_words_that_name_their_language_have_hashes_of_their_own():
    hashes = [int(h) for lang in ("de", "en", "es") for h in phrases._Words(pa.array(["de en es"]), lang).hash]
    assert len(set(hashes)) == 9


def test_hash_and_tag_give_the_words_back(spark):
    """What is shuffled for a phrase is 12 bytes; the hash of its first words follows from them and the last word's."""
    words = phrases._Words(pa.array(["a b c d e f g, a b"]), "en")
    own = words.hash[words.index]
    p = own[:1]
    for w in own[1:]:
        h = phrases._longer(p, np.array([w]))
        assert phrases._all_but_last(h, np.array([w])) == p
        p = h
    read = phrases._read(spark.createDataFrame([("en", "a b c, a b")], "lang string, text string"), "text", "lang")
    counted = phrases._pass(read, 0, np.full(1 << 21, 0xFFFFFFFF, np.uint32), None)
    assert "p" not in counted.columns and dict(counted.dtypes)["h"] == "bigint" and dict(counted.dtypes)["tag"] == "int"
    assert sorted((r.k, r.n, r.known) for r in counted.collect()) == [(2, 1, True), (2, 2, True), (3, 1, True)]


def test_a_phrase_that_comes_apart_in_two_ways_is_counted_anew(spark, monkeypatch):
    rows, tried, texts_of = texts(40), [], phrases._texts
    monkeypatch.setattr(phrases, "_texts", lambda *a: tried.append(1) or (texts_of(*a).union(texts_of(*a)) if len(tried) == 1 else texts_of(*a)))
    assert found(spark, rows, 6) == brute(rows, 6, 40) and len(tried) == 2
