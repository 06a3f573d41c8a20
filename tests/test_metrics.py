"""Metric laws, checked against direct computation."""

import math
import random

import numpy as np
import pytest

from ebbtide.operators import metrics as m
from ebbtide.operators.prefix import running_sums


def frame(spark, ys, ps):
    return spark.createDataFrame([(int(y), float(p)) for y, p in zip(ys, ps)], "y_true int, y_prob double")


def ladder(n=60):
    """Scores 1/n, 2/n, ...; label of step i set where i*i leaves an odd rest by 7."""
    steps = range(1, n + 1)
    return [i * i % 7 % 2 for i in steps], [i / n for i in steps]


def one(df):
    return df.first().asDict()


def auc_direct(y, p):
    pos, neg = [s for t, s in zip(y, p) if t], [s for t, s in zip(y, p) if not t]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def ap_direct(y, p):
    total, area, last = sum(y), 0.0, 0.0
    for cut in sorted(set(p), reverse=True):
        hit = sum(t for t, s in zip(y, p) if s >= cut)
        said = sum(s >= cut for s in p)
        area += (hit / total - last) * hit / said
        last = hit / total
    return area


def test_thresholds_are_the_float_range():
    assert m.THRESHOLDS == list(np.arange(0.05, 0.95, 0.01)) and len(m.THRESHOLDS) == 90


def test_record_keys_and_ranges(spark):
    y, p = ladder()
    pred = frame(spark, y, p)
    rounded, plain = one(m.metric_record(pred)), one(m.metric_record(pred, rounded=False))
    assert list(plain) == m.METRICS and list(rounded) == [*m.METRICS, "f1_threshold"]
    assert all(rounded[k] == pytest.approx(plain[k], abs=1e-5) for k in m.METRICS)
    assert plain["roc_auc"] == pytest.approx(auc_direct(y, p)) and rounded["f1_threshold"] in np.round(m.THRESHOLDS, 2)
    assert one(m.metric_record(pred, run="x"))["run"] == "x"


def test_against_direct_computation_with_ties(spark):
    rng = random.Random(5)
    y = [rng.random() < 0.3 for _ in range(400)]
    p = [round(rng.random(), 2) for _ in y]
    r = one(m.metric_record(frame(spark, y, p), rounded=False))
    assert r["roc_auc"] == pytest.approx(auc_direct(y, p), abs=1e-12)
    assert r["pr_auc"] == pytest.approx(ap_direct(y, p), abs=1e-12)
    clip = [min(max(s, m.EPS), 1 - m.EPS) for s in p]
    assert r["log_loss"] == pytest.approx(-sum(math.log(s if t else 1 - s) for t, s in zip(y, clip)) / len(y))
    f1s = []
    for cut in m.THRESHOLDS:
        tp = sum(t and s >= cut for t, s in zip(y, p))
        fp = sum((not t) and s >= cut for t, s in zip(y, p))
        fn = sum(y) - tp
        f1s.append(2 * tp / (2 * tp + fp + fn))
    sweep = sorted(m.f1_sweep(frame(spark, y, p)).collect(), key=lambda r: r.threshold)
    assert [s.f1 for s in sweep] == f1s
    best = one(m.best_threshold(m.f1_sweep(frame(spark, y, p))))
    assert best["f1"] == max(f1s) and best["f1_threshold"] == m.THRESHOLDS[int(np.argmax(f1s))]


def test_turning_scores_around_mirrors_the_area(spark):
    y, p = ladder(41)
    area = one(m.roc_auc(frame(spark, y, p)))["roc_auc"]
    turned = one(m.roc_auc(frame(spark, y, [1 - s for s in p])))["roc_auc"]
    assert area + turned == pytest.approx(1.0)
    apart = frame(spark, [0] * 7 + [1] * 3, [i / 10 for i in range(10)])
    assert one(m.roc_auc(apart))["roc_auc"] == one(m.average_precision(apart))["pr_auc"] == 1.0


def test_any_rising_map_of_scores_keeps_the_ranking(spark):
    y, p = ladder(50)
    for rising in (lambda s: s**3, lambda s: 0.2 + s / 2):
        moved = frame(spark, y, [rising(s) for s in p])
        assert one(m.roc_auc(moved))["roc_auc"] == pytest.approx(auc_direct(y, p))
        assert one(m.average_precision(moved))["pr_auc"] == pytest.approx(ap_direct(y, p))


GAPS = [(1, 0.9), (0, 0.2), (1, 0.4), (None, 0.7), (1, None), (0, float("nan")), (None, None)]


def test_rows_without_label_or_probability_are_left_out_everywhere(spark):
    gaps = spark.createDataFrame(GAPS, "y_true int, y_prob double")
    fine = frame(spark, *zip(*GAPS[:3]))
    assert one(m.left_out(gaps)) == {"n_scored": 3, "n_without_label": 2, "n_without_probability": 3}
    for metric in (m.log_loss, m.brier, m.roc_auc, m.average_precision, m.metric_record, m.reliability, m.f1_sweep,
                   m.roc_curve, m.pr_curve, m.confusion):
        assert sorted(metric(gaps).collect()) == sorted(metric(fine).collect()), metric.__name__
    assert one(m.alert_share(gaps, over=0.5)) == {"n_over": 2, "share_over": 0.5}


def test_no_rows_and_foreign_labels(spark):
    nothing = frame(spark, [], [])
    assert set(one(m.metric_record(nothing, rounded=False)).values()) == {None, 0.0}
    assert one(m.alert_share(nothing)) == {"n_over": 0, "share_over": None}
    for metric in (m.log_loss, m.brier, m.roc_auc, m.average_precision):
        assert list(one(metric(nothing)).values()) == [None]
    assert m.reliability(nothing).count() == m.pr_curve(nothing).count() == 0
    odd = frame(spark, [2, 1, 0], [0.9, 0.8, 0.1])
    assert one(m.average_precision(odd))["pr_auc"] == 1.0 and m.pr_curve(odd).count() == 4
    same = frame(spark, [1], [1.0])
    assert one(m.metric_lift(m.log_loss(same).selectExpr("0.0D AS log_loss"), m.log_loss(same)))["improvement_pct"] is None


def test_all_tied_and_one_class(spark):
    assert one(m.roc_auc(frame(spark, [0, 1, 1, 0], [0.4] * 4)))["roc_auc"] == 0.5
    assert one(m.roc_auc(frame(spark, [1, 1], [0.4, 0.5])))["roc_auc"] is None
    nothing = m.best_threshold(m.f1_sweep(frame(spark, [1, 0], [0.01, 0.02])))
    assert one(nothing)["f1"] == 0.0 and one(nothing)["f1_threshold"] == m.THRESHOLDS[0]


def test_loss_is_least_at_the_observed_rate(spark):
    y = [1] * 3 + [0] * 9
    at = {s: one(m.log_loss(frame(spark, y, [s] * 12)))["log_loss"] for s in (0.1, 0.2, 0.25, 0.3, 0.6)}
    assert min(at, key=at.get) == 0.25
    assert at[0.25] == pytest.approx(-(0.25 * math.log(0.25) + 0.75 * math.log(0.75)))


def test_loss_is_finite_at_zero_and_one(spark):
    loss = one(m.log_loss(frame(spark, [1, 0], [0.0, 1.0])))["log_loss"]
    assert loss == pytest.approx(-math.log(m.EPS), rel=1e-6)


def test_score_on_a_threshold_counts_as_positive(spark):
    sweep = m.f1_sweep(frame(spark, [1, 0], [m.THRESHOLDS[10], 0.01])).collect()
    tp = {r.threshold: r.tp for r in sweep}
    assert tp[m.THRESHOLDS[10]] == 1 and tp[m.THRESHOLDS[11]] == 0


def test_roc_curve_without_straight_points(spark):
    rng = random.Random(3)
    y = [rng.random() < 0.5 for _ in range(300)]
    p = [round(rng.random(), 2) for _ in y]
    full = m.roc_curve(frame(spark, y, p), drop_collinear=False).collect()
    bent = m.roc_curve(frame(spark, y, p)).collect()
    assert set(bent) <= set(full) and len(bent) < len(full)

    def area(points):
        xy = sorted((r.fpr, r.tpr) for r in points)
        return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(xy, xy[1:]))

    assert area(bent) == pytest.approx(area(full)) == pytest.approx(auc_direct(y, p))


def test_pr_curve_ends(spark):
    points = m.pr_curve(frame(spark, [0, 1, 1], [0.2, 0.6, 0.4])).collect()
    assert {(r.precision, r.recall) for r in points if r.threshold is None} == {(1.0, 0.0)}
    assert all(r.prevalence == pytest.approx(2 / 3) for r in points)
    assert len(points) == 4


def test_confusion_reliability_share(spark):
    pred = frame(spark, [0, 1, 1, 0], [0.1, 0.9, 1.0, 0.95])
    cells = {(r.actual, r.predicted): r.n for r in m.confusion(pred).collect()}
    assert sum(cells.values()) == 4 and set(cells) == {(0, 0), (0, 1), (1, 0), (1, 1)}
    bins = {r.bin: (r.n, r.observed_rate) for r in m.reliability(pred).collect()}
    assert bins == {1: (1, 0.0), 9: (3, 2 / 3)}
    assert one(m.alert_share(pred, over=0.9)) == {"n_over": 2, "share_over": 0.5}
    assert one(m.brier(pred))["brier"] == pytest.approx((0.01 + 0.01 + 0 + 0.9025) / 4)


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_with_groups_and_nulls(spark, descending):
    rows = [(g, float(v) / 7 - 3, v % 3, "kept") for g in ("a", "b", None) for v in range(50)]
    df = spark.createDataFrame(rows, "g string, v double, n int, other string")
    out = running_sums(df, "v", ["n"], within=["g"], descending=descending, following=True)
    assert out.columns == ["g", "v", "n", "other", "n_upto", "n_total", "n_next"]
    got = {(r.g, r.v): r for r in out.collect()}
    assert len(got) == 150
    for g in ("a", "b", None):
        total = 0
        mine = sorted(((v, n) for k, v, n, _ in rows if k == g), reverse=descending)
        for i, (v, n) in enumerate(mine):
            total += n
            r = got[g, v]
            assert (r.n_upto, r.n_total, r.n_next) == (total, sum(x for _, x in mine), mine[i + 1][1] if i < 49 else None)


def test_skewed_scores_stay_exact(spark):
    """A third of all rows share one score."""
    rng = random.Random(1)
    p = [0.5 if rng.random() < 0.34 else rng.random() for _ in range(3000)]
    y = [rng.random() < s for s in p]
    assert one(m.roc_auc(frame(spark, y, p)))["roc_auc"] == pytest.approx(auc_direct(y, p), abs=1e-12)
