import random
import re

import numpy as np
import pyarrow as pa
import regex

from claimlens.llm import cutting
from claimlens.llm.pair_table import FREE, PairTable

LETTERS = "ab'sdtlvre   \n\t._-%9é½ßÑ日🙂́\x85\xa0\x1c"


def texts(n, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(40))) for _ in range(n)]


def words_of(cuts, i):
    return [cuts.words[k].as_py().decode() for k in cuts.index[cuts.first[i] : cuts.first[i + 1]].tolist()]


def test_cuts_equal_the_pattern():
    for rows in (texts(4000), ["abc it's we'll 's ''s  x", "", "plain ascii\n\n  end  ", "'", "x'", "'re", "'r", "a'l", "l"], ["", None, ""]):
        cuts = cutting.cut(pa.array(rows, pa.string()))
        assert [words_of(cuts, i) for i in range(len(rows))] == [regex.findall(cutting.PATTERN, x or "") for x in rows]
        assert len(set(cuts.words.to_pylist())) == len(cuts.words)


def test_added_tokens_stand_alone_and_stay_within_a_text():
    added = re.compile(rb"<\|end\|>")
    rows = ["a <|end|>  b<|end|><|end|>'s", "x <|e", "nd|> y", "<|end|>"]
    cuts = cutting.cut(pa.array(rows), added)
    assert words_of(cuts, 0) == ["a", " ", "<|end|>", " ", " b", "<|end|>", "<|end|>", "'s"]
    assert words_of(cuts, 1) == regex.findall(cutting.PATTERN, rows[1]) and words_of(cuts, 3) == ["<|end|>"]


def test_slices_cover_all_rows_and_long_ones_stand_alone():
    rows = pa.array(["aa", None, "", "b" * 50, "cc", "dd", "e"])
    parts = list(cutting.slices(rows, 4))
    assert pa.concat_arrays(parts).equals(rows)
    assert all(len(p) == 1 or sum(len(x or "") for x in p.to_pylist()) <= 4 for p in parts)
    assert list(cutting.slices(rows.slice(0, 0))) == []
    assert cutting.buffer_of(rows.slice(3, 2))[0].tobytes() == b"b" * 50 + b"cc"


def test_pair_table():
    rng = np.random.default_rng(1)
    left, right = rng.integers(0, 300, 5000), rng.integers(0, 300, 5000)
    table, want = PairTable(left, right, np.arange(5000)), {}
    for k, pair in enumerate(zip(left.tolist(), right.tolist())):
        want.setdefault(pair, k)
    a, b = np.divmod(np.arange(90000), 300)
    assert table.get(a, b).tolist() == [want.get(p, int(FREE)) for p in zip(a.tolist(), b.tolist())]
    assert len(table.get(a[:0], b[:0])) == 0
