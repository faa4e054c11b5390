import random
import re

from claimlens.llm import common, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, size=10):
    """Per document: id, words, words hit, sorted items."""
    windows = {}
    for i, t in items:
        w = words(t)
        if i is not None and w:
            for a in range(max(1, len(w) - size + 1)):
                windows.setdefault(tuple(w[a : a + size]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for a in range(len(w)):
            for n in {len(x) for x in windows}:
                if owners := windows.get(tuple(w[a : a + n])) if a + n <= len(w) else None:
                    hit |= {*range(a, a + n)}
                    found |= owners
        out.append((d, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def ours(spark, docs, items, **more):
    d = spark.createDataFrame([(*x, 1, "s") for x in docs], "doc_id long, text string, n_words int, items string")
    i = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, window int")
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontaminate.contamination(d, i, **more).collect()), key=str)


def test_equals_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    pick = lambda n, of: " ".join(rng.choice(of) for _ in range(n))
    few, many = ["a", "b"], [f"w{k}" for k in range(30)] + ["É", "日本"]
    items = [(k, pick(rng.choice([1, 3, 9, 10, 11, 25]), rng.choice([few, many]))) for k in range(12)]
    items += [(None, pick(12, many)), (77, ""), (78, None), (79, "!!"), (80, items[3][1]), (81, "w1, W2 -w3/w4"), (82, "absent " * 12)]
    docs = [(k, pick(rng.randrange(60), rng.choice([few, many]))) for k in range(30)]
    docs += [(100 + k, pick(5, many) + " " + (items[k][1] or "").upper() + "; " + pick(7, few)) for k in range(len(items))]
    docs += [(None, items[0][1]), (None, "x"), (5, docs[5][1]), (5, docs[6][1]), (200, None), (201, ""), (202, "a " * 20000)]
    want = plain(docs, items)
    assert any(x[2] for x in want) and not all(x[2] for x in want)
    assert ours(spark, docs, items) == want
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    assert ours(spark, docs, items) == want
    assert ours(spark, docs, items, size=3) == plain(docs, items, 3)


def test_empty_tables(spark):
    assert ours(spark, [(1, "a b")], [(1, None)]) == [(1, 2, 0, ())]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert decontaminate.contamination(none, spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0


def test_clean_keeps_other_rows_whole(spark):
    docs = spark.createDataFrame([(1, "x a b c y", 5), (None, "a b", 6), (3, None, None), (None, "q a b c", 1)], "doc_id long, text string, window int")
    items = spark.createDataFrame([(1, "A b, c")], "item_id long, text string")
    out = decontaminate.clean(docs, items)
    assert out.columns == docs.columns and sorted(out.collect(), key=str) == sorted([(None, "a b", 6), (3, None, None)], key=str)


def test_no_python_in_the_plan(spark, small_dir):
    plan = decontaminate.op6_decontamination(spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
