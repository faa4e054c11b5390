"""Samples for a look at the data: the same for any partitioning, and each row as likely as any other."""

from collections import Counter

from pyspark.sql import functions as F

from claimlens.sinks.writers import export_sample, sample_rows


def ids(df):
    return sorted(r.id for r in df.collect())


def test_partitions_do_not_matter(spark):
    df = spark.range(5000).withColumn("s", F.expr("if(id % 7 = 0, NULL, id % 3)"))
    first = ids(sample_rows(df, 40))
    assert len(set(first)) == 40
    for other in (df.repartition(1), df.repartition(13, "s"), df.orderBy(F.desc("id"))):
        assert ids(sample_rows(other, 40)) == first
    assert ids(sample_rows(df, 40, salt=1)) != first
    assert sample_rows(df, 40).columns == df.columns
    assert ids(sample_rows(df, 10_000)) == list(range(5000)) and sample_rows(df.limit(0), 5).count() == 0


def test_each_row_is_drawn_as_often(spark):
    """Of 60 rows 15 are drawn, 400 times: each about 100 times, six deviations being 52."""
    df = spark.range(60).coalesce(2)
    drawn = Counter()
    for base in range(0, 400, 50):
        parts = [sample_rows(df, 15, salt=base + k) for k in range(50)]
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.union(p)
        drawn.update(r.id for r in whole.collect())
    assert sum(drawn.values()) == 6000 and len(drawn) == 60
    assert all(abs(n - 100) < 52 for n in drawn.values())


def test_groups_get_their_own_sample(spark):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id < 10 THEN 'few' WHEN id % 3 = 0 THEN NULL ELSE 'many' END AS state")
    got = Counter(r.state for r in sample_rows(df, 25, by=["state"]).collect())
    assert got == {"few": 10, "many": 25, None: 25}
    plan = sample_rows(df, 25, by=["state"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle
    assert "TakeOrderedAndProject" in sample_rows(df, 25)._jdf.queryExecution().executedPlan().toString()


def test_rows_of_one_key(spark):
    df = spark.range(100).selectExpr("id", "id % 4 AS k")
    got = sample_rows(df, 30, key=["k"])
    assert got.count() == 30 and ids(got) == ids(sample_rows(df.repartition(5), 30, key=["k"]))
    assert len({r.k for r in got.collect()}) == 2


def test_export(spark, tmp_path):
    assert export_sample(spark.range(1000).withColumn("g", F.col("id") % 2), f"{tmp_path}/s", 20, by=["g"]) == 40
