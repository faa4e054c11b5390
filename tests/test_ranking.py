import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimlens.functions.joins import join_on_groups
from claimlens.functions.ranking import first_n, with_percent_rank, with_rank

SCHEMA = "id int, grp string, amount bigint"


def mixed_rows(n=3000, seed=7):
    """A hot group, ties, NULLs, negative and very large amounts."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        group = "HOT" if i % 3 == 0 else rng.choice(["A", "B", None])
        amount = rng.choice([
            None, rng.randint(-5, 5), rng.randint(0, 300), rng.randint(65000, 66000),
            rng.randint(-(2**40), 2**40), 2**62 + rng.randint(0, 3),
        ])
        rows.append((i, group, amount))
    return rows + [(n, "ALONE", 4), (n + 1, "NULLS", None), (n + 2, "NULLS", None)]


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("by", [["grp"], []])
def test_ranks_equal_the_plain_window(spark, by, descending):
    df = spark.createDataFrame(mixed_rows(), SCHEMA)
    order = F.desc_nulls_last("amount") if descending else F.asc_nulls_last("amount")
    w = Window.partitionBy(*by).orderBy(order)
    expected = df.select("id", F.rank().over(w).alias("r"), F.percent_rank().over(w).alias("p"))
    ranked = with_rank(df, by, "amount", "r", descending).select("id", "r")
    shares = with_percent_rank(df, by, "amount", "p", descending).select("id", "p")
    assert sorted(ranked.collect()) == sorted(expected.select("id", "r").collect())
    assert sorted(shares.collect()) == sorted(expected.select("id", "p").collect())


def test_rank_keeps_all_columns(spark):
    df = spark.createDataFrame([(1, "A", 5), (2, "A", 9)], SCHEMA)
    assert with_rank(df, ["grp"], "amount", "r").columns == [*df.columns, "r"]


@pytest.mark.parametrize("n", [4, 700, 5000])
def test_first_n_per_group(spark, n):
    df = spark.createDataFrame(mixed_rows(), SCHEMA)
    got = first_n(df, ["grp"], "amount", ["id"], n)
    by_group = {}
    for row in sorted(df.collect(), key=lambda r: (r.amount is None, -(r.amount or 0), r.id)):
        by_group.setdefault(row.grp, []).append(row.id)
    expected = {(g, k, i) for g, ids in by_group.items() for k, i in enumerate(ids[:n], 1)}
    assert {(r.grp, r.row_rank, r.id) for r in got.collect()} == expected


def test_null_groups_meet(spark):
    left = spark.createDataFrame([(1, None), (2, "A"), (3, "B")], "id int, k string")
    right = spark.createDataFrame([(None, "none"), ("A", "a")], "k string, v string")
    got = join_on_groups(left, right, ["k"]).select("id", "v").collect()
    assert sorted(map(tuple, got)) == [(1, "none"), (2, "a"), (3, None)]
    with pytest.raises(ValueError):
        join_on_groups(left, right, [])
