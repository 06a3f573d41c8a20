"""Profiling operators on small literal tables, against direct computation."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import association, audit, distributions, segments
from ebbtide.plans import profile_report as pr
from ebbtide.registry.spark_queries import _tables
from ebbtide.sources import files
from ebbtide.sources import shared_tables as st
from ebbtide.sources.schemas import CATALOG


def test_segment_rate_support_and_top(spark):
    rows = [("a", 1)] * 3 + [("a", 0)] + [("b", 0)] * 4 + [("c", 1)] * 2 + [(None, 1)]
    df = spark.createDataFrame(rows, "k string, y int")
    rates = {r.k: (r.n, r.churn_rate) for r in segments.segment_rate(df, ["k"], "y").collect()}
    assert rates == {"a": (4, 75.0), "b": (4, 0.0), "c": (2, 100.0), None: (1, 100.0)}
    assert {r.k for r in segments.segment_rate(df, ["k"], "y", min_n=2).collect()} == {"a", "b"}
    assert [r.k for r in segments.segment_rate(df, ["k"], "y", k=2).collect()] == ["a", "b"]
    assert [r.pct for r in segments.value_shares(df, "k").orderBy(F.desc("n"), "k").collect()][:2] == [36.36, 36.36]


def test_rollup_is_unweighted(spark):
    rates = spark.createDataFrame([(0, 10, 50.0), (0, 1, 100.0), (1, 5, 1.0)], "a int, n long, churn_rate double")
    got = {r.a: (r.n, r.churn_rate) for r in segments.rollup_rates(rates, "a").collect()}
    assert got == {0: (11, 75.0), 1: (5, 1.0)}


def test_cohorts(spark):
    df = spark.createDataFrame([(20040101, 1), (20040102, 1), (20040131, 0), (None, 1)], "d int, y int")
    rows = segments.cohort_rate(df, "d", "y", after=20040101, min_n=1).collect()
    assert [(r.reg_month, r.n, r.churn_rate) for r in rows] == [(200401, 2, 50.0)]


@pytest.mark.parametrize("qs", [(0.5,), (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)])
def test_exact_quantiles(spark, qs):
    rng = random.Random(7)
    rows = [(g, rng.choice([0.0, rng.gauss(0, 9), float(rng.randint(0, 5))]), None) for g in ("a", "b") for _ in range(501)]
    rows += [("c", 4.0, None), ("c", None, None), (None, 2.0, None)]
    df = spark.createDataFrame(rows, "g string, x double, empty double")
    got = {(r.g, r.q): r.value for r in distributions.exact_quantiles(df, ["x", "empty"], qs, ["g"]).collect()}
    for g in ("a", "b", "c", None):
        xs = [x for k, x, _ in rows if k == g and x is not None]
        for q in qs:
            assert got[(g, q)] == pytest.approx(float(np.quantile(xs, q)), abs=1e-12)


def test_group_median_matches_builtin(spark, sf_dir):
    df = st.labels(spark, sf_dir).join(pr.payment_history(st.transactions(spark, sf_dir)), "msno")
    got = {r.is_churn: (r.median_txn_count, r.median_days_until_expiry) for r in distributions.group_median(
        df, ["is_churn"], ["txn_count", "days_until_expiry"]).collect()}
    want = df.groupBy("is_churn").agg(F.median("txn_count").alias("a"), F.median("days_until_expiry").alias("b"))
    assert got == {r.is_churn: (r.a, r.b) for r in want.collect()}


@pytest.mark.parametrize("bins, clip", [(7, None), (10, 4.0), (60, None)])
def test_histogram_follows_numpy(spark, bins, clip):
    rng = random.Random(bins)
    rows = [(k, rng.choice([round(rng.uniform(-3, 8), 1), 0.3, 8.0])) for k in (0, 1) for _ in range(400)] + [(0, None)]
    df = spark.createDataFrame(rows, "k int, x double")
    bars = distributions.histogram(df, "x", bins, ["k"], clip, density=True).collect()
    for k in (0, 1):
        xs = np.array([x for g, x in rows if g == k and x is not None])
        xs = np.minimum(xs, clip) if clip is not None else xs
        n, edges = np.histogram(xs, bins)
        dens, _ = np.histogram(xs, bins, density=True)
        mine = {r.bin: r for r in bars if r.k == k}
        assert dict(enumerate(n)) == {i: r.n for i, r in mine.items()}
        for i, r in mine.items():
            assert (r.lower, r.upper) == pytest.approx((edges[i], edges[i + 1]), abs=1e-12)
            assert r.density == pytest.approx(dens[i])


def test_histogram_of_one_value(spark):
    rows = distributions.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 4).collect()
    n, edges = np.histogram([3.0, 3.0], 4)
    got = sorted((r.bin, r.n, r.lower, r.upper) for r in rows)
    assert got == [(i, n[i], edges[i], edges[i + 1]) for i in range(4)]
    gaps = spark.createDataFrame([(float("nan"),), (None,)], "x double")
    assert distributions.histogram(gaps, "x", 4).count() == 0


def test_correlation_pairwise_and_constant(spark):
    rows = [(1.0, 2.0, 7), (2.0, None, 7), (3.0, 1.0, 7), (4.0, 5.0, 7), (None, 3.0, 7)]
    df = spark.createDataFrame(rows, "a double, b double, k int")
    got = {(r.column_a, r.column_b): (r.n, r.r) for r in association.corr_matrix(df, ["a", "b", "k"]).collect()}
    assert got[("a", "b")][0] == 3
    assert got[("a", "b")][1] == pytest.approx(np.corrcoef([1, 3, 4], [2, 1, 5])[0, 1])
    assert got[("a", "k")] == (4, None)
    ranked = association.corr_with(df, "a", ["a", "k", "b"]).collect()
    assert [r.feature for r in ranked] == ["b", "k"]


def test_audit_rules_and_nulls(spark):
    df = spark.createDataFrame([("", 0), (None, 120), ("x", 30)], "g string, bd int")
    row = audit.rule_audit(df, {"blank": pr.blank("g"), "odd": (F.col("bd") <= 0) | (F.col("bd") > 100)}, ["blank"])
    assert row.first().asDict() == {"total_rows": 3, "blank": 2, "blank_pct": 66.7, "odd": 2}
    assert {r.column_name: r.null_count for r in audit.null_counts(df).collect()} == {"g": 1, "bd": 0}


def test_coverage_audit(spark):
    base = spark.createDataFrame([("a", 1), ("b", 0), ("c", 1), ("d", 1)], "k string, y int")
    sides = {
        "one": spark.createDataFrame([("a",), ("a",), ("b",)], "k string"),
        "two": spark.createDataFrame([("a",), ("c",), (None,)], "k string"),
    }
    got = {r.data_group: (r.n, r.pct, r.churn_rate) for r in audit.coverage_audit(base, sides, "k", "y").collect()}
    assert got == {
        "all": (4, 100.0, 75.0), "full_data": (1, 25.0, 100.0), "no_one": (2, 50.0, 100.0), "no_two": (2, 50.0, 50.0),
    }


def test_checks_count_failures(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), (None, None), ("b", 2)], "k string, v int")
    parts = [
        audit.value_checks("m", df, [audit.not_null("k"), audit.accepted_values("v", [1, 2]), audit.in_range("v", 2, 9)]),
        audit.unique_check("m", df, "k"),
        audit.reference_check("m", df, "k", [spark.createDataFrame([("b",)], "k string")]),
    ]
    got = {r.test: r.failures for r in audit.all_checks(parts).collect()}
    assert got == {"not_null": 1, "accepted_values": 1, "in_range": 1, "unique": 1, "relationship": 2}


def counted(spark, df):
    """The same rows, and a number that grows with every row read from them."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


def rounded(df):
    out = [{k: round(v, 6) if isinstance(v, float) else v for k, v in r.asDict().items()} for r in df.collect()]
    return sorted(out, key=lambda r: str(sorted(r.items(), key=str)))


def test_report_reads_each_source_once_and_agrees_with_each_part_alone(spark, sf_dir, tmp_path):
    tables = _tables(spark, sf_dir)
    watched = {name: counted(spark, df) for name, df in tables.items()}
    report = pr.profile_report({n: w[0] for n, w in watched.items()}, st.LATER, ["txn_id"], f"{tmp_path}/p",
                               min_sizes={"city": 3, "channel": 10, "payment_method": 5, "cohort": 0}, cohorts_after=19900101)
    got = {name: rounded(part()) for name, part in report.items()}
    assert {n: w[1].value for n, w in watched.items()} == {n: df.count() for n, df in tables.items()}
    assert len(got) == 34 and all(got.values())

    labels, members, txns, logs = (tables[n] for n in ("labels", "members", "transactions", "user_logs"))
    labelled, last = pr.label_members(labels, members), pr.label_last_transaction(labels, txns, ["txn_id"])
    active, paid = labels.join(pr.user_activity(logs), "msno"), labels.join(pr.payment_history(txns), "msno")
    mini = pr.mini_features(labels, members, txns, logs, st.LATER, ["txn_id"])
    status = segments.segment_rate(last, ["is_auto_renew", "is_cancel"], "is_churn")
    near = paid.where("days_until_expiry > -100 AND days_until_expiry < 400")
    hist, med = distributions.histogram, distributions.group_median
    alone = {
        "inventory": files.inventory(tables),
        "label_balance": segments.value_shares(labels, "is_churn"),
        "members_quality": pr.members_quality(members),
        "transactions_quality": pr.transactions_quality(txns),
        "logs_quality": pr.logs_quality(logs),
        "age_histogram": hist(pr.member_features(members, st.LATER), "age", 60),
        "raw_age_histogram": hist(members, "bd", 100),
        "rate_by_gender": pr.rate_by_gender(labelled),
        "rate_by_city": segments.segment_rate(labelled, ["city"], "is_churn", 3, 15),
        "rate_by_channel": segments.segment_rate(labelled, ["registered_via"], "is_churn", 10),
        "cohorts": segments.cohort_rate(labelled, "registration_init_time", "is_churn", 19900101, 0),
        "transaction_summary": pr.transaction_summary(txns),
        "rate_by_status": status,
        "rate_by_renewal": segments.rollup_rates(status, "is_auto_renew"),
        "plan_lengths": segments.value_counts(txns, "payment_plan_days", 10),
        "plan_shares": segments.value_shares(txns, "payment_plan_days"),
        "rate_by_price_type": pr.rate_by_price_type(last),
        "rate_by_payment_method": segments.segment_rate(last, ["payment_method_id"], "is_churn", 5, 12),
        "payment_medians": med(paid, ["is_churn"], ["txn_count", "days_until_expiry"]),
        "payment_histogram": hist(paid, "txn_count", 20, ["is_churn"], 20),
        "expiry_histogram": hist(near, "days_until_expiry", 50, ["is_churn"]),
        "log_range": pr.log_range(logs),
        "activity_medians": med(active, ["is_churn"], ["active_days", "total_secs", "total_unique_songs"]),
        "seconds_histogram": hist(active, "total_secs", 50, ["is_churn"], 500_000, True),
        "engagement_medians": med(pr.engagement(active), ["is_churn"], ["engagement_depth"]),
        "engagement_histogram": hist(pr.engagement(active), "engagement_depth", 50, ["is_churn"], 5, True),
        "missingness_audit": audit.coverage_audit(labels, {n: tables[n] for n in ("members", "transactions", "user_logs")}, "msno", "is_churn"),
        "null_counts": audit.null_counts(mini.select(*pr.MINI)),
        "correlations": association.corr_matrix(mini, pr.MINI),
        "correlations_with_label": association.corr_with(mini, "is_churn", pr.MINI),
    }
    for name, df in alone.items():
        assert got[name] == rounded(df), name
    nulls = {(r["table_name"], r["column_name"]): r["null_count"] for r in got["source_nulls"]}
    assert nulls["members", "gender"] == members.where("gender IS NULL").count()


def test_report_of_empty_sources(spark, tmp_path):
    empty = {name: spark.createDataFrame([], schema) for name, schema in CATALOG.items()}
    report = pr.profile_report(empty, st.LATER, [], f"{tmp_path}/p")
    assert {r.row_count for r in report["inventory"]().collect()} == {0}
    assert report["log_range"]().first().asDict() == {"min_date": None, "max_date": None, "total_rows": 0, "unique_users": 0}
    assert all(part().count() >= 0 for part in report.values())


@pytest.mark.parametrize("resolved", [0, 20, 1 << 16])
def test_radix_quantiles_follow_numpy(spark, monkeypatch, resolved):
    """Any signs, sizes and repeats; by passes of 16 bits and by value at once."""
    monkeypatch.setattr(distributions, "RESOLVED", resolved)
    rng = random.Random(resolved)
    odd = [0.0, -0.0, 5e-324, -5e-324, 2.2e-308, 1.7e308, -1.7e308, 1.0, 1.0 + 2**-52, 0.1, 1e-9]
    rows = [("a", rng.choice(odd)) for _ in range(60)] + [("b", rng.gauss(0, 1)) for _ in range(501)] + [(None, 7.0)] * 3
    rows += [("c", 1.0 + i * 2**-52) for i in range(40)] + [("d", None)] + [("a", None)] * 5
    df = spark.createDataFrame(rows, "k string, x double").withColumn("n", F.lit(3).cast("int"))
    qs = (0.0, 0.1, 0.5, 0.99, 1.0)
    got = {(r.k, r.metric, r.q): r.value for r in distributions.exact_quantiles(df, ["x", "n"], qs, ["k"]).collect()}
    for k in ("a", "b", "c", None):
        xs = sorted(x for g, x in rows if g == k and x is not None)
        for q in qs:
            at = q * (len(xs) - 1)
            lo, hi = xs[int(np.floor(at))], xs[int(np.ceil(at))]
            w = at - np.floor(at)
            assert got[k, "x", q] == lo * (1 - w) + hi * w
            assert got[k, "n", q] == pytest.approx(3.0)
    assert ("d", "x", 0.5) not in got and got["d", "n", 0.5] == 3.0
    monkeypatch.setattr(distributions, "FOLLOWED", 1)
    again = {(r.k, r.metric, r.q): r.value for r in distributions.exact_quantiles(df, ["x", "n"], qs, ["k"]).collect()}
    assert again == got
    assert distributions.exact_quantiles(df.limit(0), ["x"], qs).count() == 0


def test_order_key_sorts_as_the_numbers(spark):
    from ebbtide.operators.prefix import with_order_key

    rng = random.Random(1)
    xs = [0.0, 5e-324, 1e-310, 2.2250738585072014e-308, 1.7976931348623157e308, float("inf"), float("nan"), 1.0, 2.0, 0.5, 3.0]
    xs += [rng.uniform(-1, 1) * 2.0 ** rng.randint(-1070, 1020) for _ in range(3000)] + [float(2.0**i) for i in range(-1074, 1024, 7)]
    xs += [-x for x in xs if x == x]
    rows = with_order_key(spark.createDataFrame([(x,) for x in xs], "x double"), "x").collect()
    rows.sort(key=lambda r: r["_key"])
    inside = [r.x for r in rows if r.x == r.x]
    assert inside == sorted(inside) and rows[-1].x != rows[-1].x
    assert len({r["_key"] for r in rows}) == len({x for x in inside}) + 1


def test_correlation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(association, "ROWS", 7)
    monkeypatch.setattr(association, "MERGED", 2)
    rng = np.random.default_rng(3)
    x = rng.normal(1e6, 1, (300, 4))
    x[:, 1] += x[:, 0]
    x[rng.random((300, 4)) < 0.2] = np.nan
    rows = [(*[None if np.isnan(v) else float(v) for v in r], 5, None) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e int, f double").repartition(9)
    got = {(r.column_a, r.column_b): (r.n, r.r) for r in association.corr_matrix(df, list("abcdef")).collect()}
    for i in range(4):
        for j in range(i, 4):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            want = np.corrcoef(x[both, i], x[both, j])[0, 1]
            n, r = got["abcd"[i], "abcd"[j]]
            assert n == both.sum() and r == pytest.approx(want, abs=1e-9)
    assert got["a", "e"][1] is None and ("a", "f") not in got and got["e", "e"] == (300, None)
    assert association.corr_matrix(df.limit(0), ["a", "b"]).count() == 0


def test_order_keys_are_worked_out_once(spark, monkeypatch):
    """The passes of the radix selection read keys that were stored with the values."""
    kept, staged = [], distributions.staged
    monkeypatch.setattr(distributions, "staged", lambda df, label: kept.append(df.columns) or staged(df, label))
    df = spark.createDataFrame([(float(v),) for v in (3, -1, 2, 8)], "x double")
    assert [r.value for r in distributions.exact_quantiles(df, ["x"], (0.5,)).collect()] == [2.5]
    assert [columns.count("_key") for columns in kept] == [1]
