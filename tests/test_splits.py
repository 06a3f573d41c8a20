"""Splits, folds and samples: shares, disjointness, repeatability."""

from collections import Counter

from pyspark.sql import functions as F

from ebbtide.operators import splits


def labels(spark, n=5000):
    return spark.range(n).selectExpr("id AS msno", "int(id % 11 = 0) AS y")


def rare(spark, n=2000):
    """One row in a hundred is of the rare class, a few have no class."""
    return spark.range(n).selectExpr("id AS msno", "int(id % 100 = 3) AS y").selectExpr("msno", "if(msno % 401 = 0, null, y) AS y")


def test_split_has_each_class_to_the_row(spark):
    for df in (labels(spark, 1000), labels(spark, 1003), labels(spark, 57), rare(spark)):
        marked = splits.stratified_split(df, "msno", "y")
        n = df.count()
        assert marked.columns == ["msno", "y", "is_test"] and marked.count() == n
        took = Counter(r.y for r in marked.where("is_test = 1").collect())
        assert sum(took.values()) == -(-n // 5)
        sizes = Counter(r.y for r in df.collect())
        assert all(abs(took[c] - 0.2 * sizes[c]) < 1 for c in sizes)
        again = splits.stratified_split(df.repartition(13), "msno", "y")
        assert sorted(marked.collect(), key=str) == sorted(again.collect(), key=str)


def test_folds_are_even_in_each_class(spark):
    for df in (labels(spark), rare(spark)):
        count = Counter((r.y, r.fold) for r in splits.folds(df, "msno", "y", 5).collect())
        for c in {y for y, _ in count}:
            of_class = [count[c, f] for f in range(5)]
            assert max(of_class) - min(of_class) <= 1
    train = splits.folds(splits.stratified_split(labels(spark), "msno", "y"), "msno", "y").where("is_test = 0")
    assert all(abs(n - 800) < 120 for n in Counter(r.fold for r in train.collect()).values())


def test_no_rows(spark):
    assert splits.stratified_split(labels(spark, 0), "msno", "y").count() == 0
    assert splits.folds(labels(spark, 0), "msno", "y").count() == 0


def test_sample_and_first_match(spark):
    df = labels(spark)
    sample = splits.hash_sample(df, "msno", 100)
    assert sample.count() == 100 == sample.distinct().count()
    assert splits.hash_sample(df, "msno", 9000).count() == 5000
    assert splits.first_match(df, F.col("y") == 1, "msno").first().msno == 0
    assert splits.first_match(df, F.col("y") == 7, "msno").count() == 0
