"""The feature table on hand-made rows and its invariants on the shared tables."""

import os

import pytest

from ebbtide.operators.distinct import sums_and_distinct
from ebbtide.operators.latest import latest_and_totals, latest_rows
from ebbtide.plans import features as ft
from ebbtide.plans.build import gated_build
from ebbtide.plans.features import assemble
from ebbtide.registry.spark_queries import QUERIES, TIES, _tables
from ebbtide.operators.audit import ChecksFailed, gate, not_null, value_checks
from ebbtide.sources import shared_tables as st
from pyspark.sql import functions as F

TXN = (
    "msno string, payment_method_id int, payment_plan_days int, plan_list_price int, actual_amount_paid int, "
    "is_auto_renew int, transaction_date int, membership_expire_date int, is_cancel int, seq int"
)


@pytest.fixture(scope="module")
def txns(spark):
    return spark.createDataFrame(
        [
            ("a", 41, 30, 149, 149, 1, 20170101, 20170131, 0, 1),
            ("a", 41, 30, 149, 99, 1, 20170201, 20170228, 0, 2),
            ("a", 38, 0, 100, 100, 0, 20170201, 20170110, 1, 3),  # same day, later key
            ("b", 40, -7, 70, None, 0, 20170230, 20170301, 0, 4),  # malformed day
            ("c", 40, 7, 70, 70, 0, None, 20170301, 0, 5),
            ("c", 41, 7, 70, 70, 0, 20170105, 20170101, 0, 6),
        ],
        TXN,
    )


def by_user(df):
    return {r.msno: r for r in df.collect()}


def test_transaction_features(txns):
    got = by_user(ft.transaction_features(txns, ties=["seq"]))
    a, b, c = got["a"], got["b"], got["c"]
    assert (a.last_payment_method, a.last_cancel, a.last_price_per_day) == (38, 1, 0.0)
    assert (a.txn_count, a.total_cancels, a.total_auto_renews, a.total_discounts) == (3, 1, 2, 1)
    assert a.days_until_expiry == 27
    assert b.last_price_per_day == -10.0 and b.days_until_expiry is None and b.last_has_discount == 0
    assert c.last_payment_method == 41 and c.days_until_expiry == 55
    assert by_user(ft.transaction_features(txns, "positive", ["seq"]))["b"].last_price_per_day == 0.0


def test_latest_agrees_with_window(txns):
    clean = ft.clean_transactions(txns)
    window = latest_rows(clean, "msno", "transaction_date", ["seq"]).select("msno", "seq")
    fused = latest_and_totals(clean, "msno", "transaction_date", ["seq"], {"seq": "seq"}, {"n": F.count(F.lit(1))})
    assert by_user(window).keys() == by_user(fused).keys()
    assert {k: v.seq for k, v in by_user(window).items()} == {k: v.seq for k, v in by_user(fused).items()}


def test_window_limit_runs_below_the_shuffle(txns):
    plan = latest_rows(txns, "msno", "transaction_date", ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


LOG = "msno string, date int, num_25 int, num_50 int, num_75 int, num_985 int, num_100 int, num_unq int, total_secs double"


def test_activity_features(spark):
    logs = spark.createDataFrame(
        [
            ("a", 20170301, 1, 1, 1, 1, 6, 5, 600.0),
            ("a", 20170301, 1, 0, 0, 0, 4, 5, 600.0),
            ("a", 20170302, 0, 0, None, 0, 9, 2, 60.0),
            ("b", 20170303, 0, 0, 0, 0, 0, 0, 0.0),
            ("c", 20170101, 5, 5, 5, 5, 5, 5, 5.0),
        ],
        LOG,
    )
    for window in (None, (20170301, 20170331), (20170201, 20170901)):
        got = by_user(ft.activity_features(logs, window))
        a, b = got["a"], got["b"]
        assert (a.active_days, a.total_plays, a.complete_plays) == (2, 15, 19)
        assert a.completion_rate == 19 / 15 and a.engagement_depth == 6.0
        assert a.avg_daily_secs == 630.0 and a.mins_per_song == 21.0 / 12
        assert (b.active_days, b.completion_rate, b.mins_per_song) == (1, 0.0, 0.0)
        assert ("c" in got) == (window is None)


def test_distinct_in_a_window_equals_distinct_of_its_rows(spark):
    df = spark.range(4000).selectExpr("id % 7 AS k", "int(20170100 + (id * 37) % 450) AS d", "1 AS one")
    sums = {"n": F.col("one")}
    inside = sums_and_distinct(df, "k", "d", sums, "days", (20170100, 20170500))
    grouped = sums_and_distinct(df.where("d <= 20170500"), "k", "d", sums, "days")
    assert sorted(inside.collect()) == sorted(grouped.collect())


def test_members(spark):
    members = spark.createDataFrame(
        [("a", 1, 25, "male", 3, 20170415), ("b", 1, 5, "", 3, None)],
        "msno string, city int, bd int, gender string, registered_via int, registration_init_time int",
    )
    got = by_user(ft.member_features(members, "2017-03-01"))
    assert got["a"].tenure_days == -45 and got["a"].age == 25
    assert (got["b"].tenure_days, got["b"].age, got["b"].gender) == (None, None, "unknown")


def test_assemble_fills_counts_only(spark, txns):
    labels = spark.createDataFrame([("a", 1), ("x", 0)], "msno string, is_churn int")
    members = spark.createDataFrame(
        [("a", 1, None, "male", 3, 20160101)],
        "msno string, city int, bd int, gender string, registered_via int, registration_init_time int",
    )
    logs = spark.createDataFrame([], LOG)
    mart = ft.churn_features(labels, members, txns, logs, "2017-03-01", txn_ties=["seq"])
    assert mart.columns == ft.MART and len(ft.MART) == 36
    got = by_user(mart)
    assert (got["a"].has_member_data, got["a"].has_age, got["a"].has_transaction_data) == (1, 0, 1)
    x = got["x"]
    assert (x.has_member_data, x.has_transaction_data, x.txn_count, x.active_days, x.mins_per_song) == (0, 0, 0, 0, 0.0)
    assert x.last_cancel is None and x.days_until_expiry is None and x.gender is None


def test_mart_has_one_row_per_label(spark, sf_dir):
    t = _tables(spark, sf_dir)
    mart = ft.churn_features(*t.values(), st.LATER, st.LOG_WINDOW, txn_ties=["txn_id"])
    assert mart.count() == t["labels"].count() == mart.select("msno").distinct().count()
    missing = t["labels"].join(t["transactions"], "msno", "left_anti").count()
    assert mart.where("has_transaction_data = 0").count() == missing


def test_features_do_not_look_ahead(spark, sf_dir, tmp_path):
    """Dropping orders from the reference date on changes labels only."""
    past = str(tmp_path)
    for name in ("customer", "lineitem", "events"):
        st.table(spark, sf_dir, name).write.parquet(f"{past}/{name}.parquet")
    st.table(spark, sf_dir, "orders").where(f"o_orderdate < '{st.LATER}'").write.parquet(f"{past}/orders.parquet")
    marts = []
    for root in (sf_dir, past):
        t = _tables(spark, root)
        mart = ft.churn_features(*t.values(), st.LATER, st.LOG_WINDOW, txn_ties=["txn_id"])
        marts.append(sorted(mart.drop("is_churn").collect(), key=lambda r: r.msno))
    assert marts[0] == marts[1]


def test_checks_and_gate(spark, sf_dir):
    checks = QUERIES["quality_checks"](spark, sf_dir)
    assert checks.count() == 16
    gate(checks)
    broken = value_checks("m", spark.createDataFrame([(None,), (1,)], "x int"), [not_null("x")])
    with pytest.raises(ChecksFailed, match="m.x not_null: 1"):
        gate(broken)


def test_gate_stops_what_depends_on_a_failed_stage(spark, sf_dir, tmp_path):
    t = _tables(spark, sf_dir)
    done = gated_build(t, st.LATER, f"{tmp_path}/fine", ties=TIES)
    assert list(done.frames)[-1] == "feature_table" and len(done.checks) == 16
    assert done.frames["feature_table"].count() == t["labels"].count()
    stages = [done.frames[n] for n in ("staged_labels", "staged_members", "transaction_features", "activity_features")]
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(kept, ("-1", "false")):
            spark.conf.set(k, v)
        plan = assemble(*stages)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    twice = {**t, "members": t["members"].unionByName(t["members"].limit(1))}
    with pytest.raises(ChecksFailed, match="staged_members.msno unique: 1"):
        gated_build(twice, st.LATER, f"{tmp_path}/broken", ties=TIES)
    assert sorted(os.listdir(f"{tmp_path}/broken")) == ["staged_labels", "staged_members"]
    nobody = {**t, "transactions": t["transactions"].withColumn("msno", F.when(F.col("msno") % 2 == 0, F.col("msno")))}
    with pytest.raises(ChecksFailed, match="staged_transactions.msno not_null"):
        gated_build(nobody, st.LATER, f"{tmp_path}/nulls", ties=TIES)
