"""Shapes of physical plans, and exact results when one key holds a third of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import audit, distributions, segments
from ebbtide.operators.distinct import sums_and_distinct
from ebbtide.plans import features as ft
from ebbtide.registry.spark_queries import QUERIES
from ebbtide.sources import files, schemas


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plain_plans(spark):
    """Plans as they are without broadcasts and run-time changes."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_feature_table_shuffles_each_input_once_and_activity_by_day_first(plain_plans, tmp_path):
    spark = plain_plans
    tables = {}
    for name, schema in schemas.CATALOG.items():
        files.write_parquet(spark.createDataFrame([], schema), f"{tmp_path}/{name}")
        tables[name] = files.read_parquet(spark, f"{tmp_path}/{name}")
    plan = physical(ft.churn_features(*tables.values(), "2017-03-01", (20170301, 20170331)))
    assert plan.count("Exchange hashpartitioning") == 5
    assert "Exchange SinglePartition" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert "GreaterThanOrEqual(date,20170301)" in plan and "LessThanOrEqual(date,20170331)" in plan


@pytest.mark.parametrize("name", ["churn_features", "correlation_matrix", "missingness_audit", "quality_checks"])
def test_no_cross_joins(plain_plans, sf_dir, name):
    plan = physical(QUERIES[name](plain_plans, sf_dir))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_marking_split_and_folds_needs_no_shuffle(spark):
    """Cut points are found first; the rows themselves only compare with them."""
    from ebbtide.operators.splits import folds, stratified_split

    df = spark.range(100).selectExpr("id AS msno", "int(id % 2) AS y")
    assert "Exchange" not in physical(folds(stratified_split(df, "msno", "y"), "msno", "y"))


@pytest.fixture(scope="module")
def hot(spark):
    rng = random.Random(2)
    rows = [(7 if rng.random() < 0.34 else rng.randint(0, 400), 20240101 + rng.randint(0, 30), rng.randint(0, 9)) for _ in range(9000)]
    return rows, spark.createDataFrame(rows, "k int, d int, v int").repartition(8).persist()


def test_hot_key_distinct_and_sums(hot):
    rows, df = hot
    for window in (None, (20240101, 20240131)):
        got = sums_and_distinct(df, "k", "d", {"s": F.col("v")}, "days", window)
        for r in got.collect():
            mine = [(d, v) for k, d, v in rows if k == r.k]
            assert (r.days, r.s) == (len({d for d, _ in mine}), sum(v for _, v in mine))


def test_hot_key_references_and_segments(spark, hot):
    rows, df = hot
    parent = spark.range(1, 401).selectExpr("int(id) AS k").where("k <> 7")
    failures = audit.reference_check("m", df, "k", [parent]).first().failures
    assert failures == sum(k in (0, 7) for k, _, _ in rows)
    top = segments.value_counts(df, "k", 1).first()
    assert (top.k, top.n) == (7, sum(k == 7 for k, _, _ in rows))


def test_hot_value_quantiles(hot):
    import numpy as np

    rows, df = hot
    got = distributions.exact_quantiles(df, ["k"], (0.25, 0.5, 0.75)).collect()
    for r in got:
        assert r.value == np.quantile([k for k, _, _ in rows], r.q)
