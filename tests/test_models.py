"""Preparation, learners, search and attributions."""

import math
import random
import threading

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ebbtide.models import explain as ex
from ebbtide.models import learners, prepare, tuning
from ebbtide.operators import metrics
from ebbtide.plans import experiments
from ebbtide.registry.spark_queries import _mart
from ebbtide.sources import files

FEATURES = ["gender", "city", "age", "txn_count", "tenure_days"]


@pytest.fixture(scope="module")
def rows(spark):
    """Labels that depend on the features, so that models have something to find."""
    rng = random.Random(9)
    out = []
    for i in range(600):
        gender, city = rng.choice(["male", "female", None]), rng.randint(1, 5)
        age = rng.choice([None, rng.randint(10, 70)])
        count, tenure = rng.randint(0, 20), rng.randint(-50, 900)
        risk = 1.5 * (city == 3) - 0.2 * count + (0.02 * age if age else 1.0) + (gender == "male")
        out.append((i, int(rng.random() < 1 / (1 + math.exp(-risk))), gender, city, age, count, tenure))
    df = spark.createDataFrame(out, "msno long, is_churn int, gender string, city int, age int, txn_count long, tenure_days int")
    return df.persist()


@pytest.fixture(scope="module")
def trees(rows):
    return learners.fit_trees(rows, FEATURES, {"maxDepth": 3, "minInstancesPerNode": 5}, rounds=6)


def test_weights(rows):
    n = rows.count()
    assert prepare.class_weights(rows).agg(F.sum("weight")).first()[0] == pytest.approx(n)
    ratio = prepare.class_weights(rows, scheme="pos_ratio").groupBy("is_churn").agg(F.sum("weight").alias("w")).collect()
    assert ratio[0].w == pytest.approx(ratio[1].w)


def test_one_hot_of_unseen_levels_is_zero(spark):
    train = spark.createDataFrame([("a",), ("b",), ("b",)], "city string")
    model = Pipeline(stages=prepare.one_hot_stages(["city"])).fit(train)
    seen = model.transform(spark.createDataFrame([("a",), ("b",), ("z",)], "city string"))
    vectors = {r.city: r.v for r in seen.select("city", vector_to_array("city_onehot").alias("v")).collect()}
    assert vectors["b"] == [1.0, 0.0] and vectors["a"] == [0.0, 1.0] and vectors["z"] == [0.0, 0.0]


def test_medians_and_scaling(rows):
    medians = prepare.fit_medians(rows, ["age", "txn_count"])
    ages = [r.age for r in rows.collect() if r.age is not None]
    assert medians["age"] == float(np.median(ages))
    filled = prepare.fill_medians(rows, medians)
    assert filled.where("age IS NULL").count() == 0
    scaled = prepare.standardize(filled, prepare.fit_scaling(filled, ["age"]))
    mean, sd = scaled.agg(F.avg("age"), F.stddev_pop("age")).first()
    assert mean == pytest.approx(0, abs=1e-9) and sd == pytest.approx(1)
    flat = filled.withColumn("age", F.lit(3.0))
    assert prepare.standardize(flat, prepare.fit_scaling(flat, ["age"])).first().age == 0.0


def test_feature_subsets(spark, sf_dir):
    subsets = prepare.feature_subsets(_mart(spark, sf_dir))
    assert [len(v) for v in subsets.values()] == [34, 31, 20]


def test_baseline_finds_the_signal_and_survives_saving(rows, tmp_path):
    model = learners.fit_baseline(rows, FEATURES)
    scored = model.score(rows, ["msno", F.col("is_churn").alias("y_true")])
    assert metrics.roc_auc(scored).first().roc_auc > 0.7
    model.save(f"{tmp_path}/m")
    again = learners.Fitted.load(f"{tmp_path}/m")
    assert (again.kind, again.numeric, again.categorical) == ("linear", FEATURES[2:], FEATURES[:2])
    assert sorted(again.score(rows, ["msno"]).collect()) == sorted(scored.drop("y_true").collect())


def test_tree_attributions_add_up(rows, trees):
    sample = rows.limit(80)
    phi, base = ex.attributions(trees, sample, "msno")
    sums = {r.msno: r.s + base for r in phi.groupBy("msno").agg(F.sum("phi").alias("s")).collect()}
    margins = trees.model.transform(sample).select("msno", vector_to_array("rawPrediction")[1].alias("m"))
    for r in margins.collect():
        assert sums[r.msno] == pytest.approx(r.m, abs=1e-9)


def test_tree_attributions_are_shapley_values(rows, trees):
    """Against the definition: average marginal effect over all coalitions."""
    from itertools import combinations

    nodes = ex.node_table(rows.sparkSession, trees).toPandas()
    weights = trees.model.stages[-1].treeWeights
    tree_of = {t: {n.id: n for n in part.itertuples()} for t, part in nodes.groupby("tree")}
    phi, _ = ex.attributions(trees, rows.limit(3), "msno")
    got = {}
    for r in phi.collect():
        got.setdefault(r.msno, []).append((r.feature, r.value, r.phi))
    names = ex.vector_names(trees.model.transform(rows))

    def game(x, known, tree, i=0):
        n = tree[i]
        if n.leftChild < 0:
            return n.prediction
        left = x[n.feature] in set(n.cut) if n.levels >= 0 else x[n.feature] <= n.cut[0]
        if n.feature in known:
            return game(x, known, tree, n.leftChild if left else n.rightChild)
        a, b = tree[n.leftChild], tree[n.rightChild]
        return (a.cover * game(x, known, tree, a.id) + b.cover * game(x, known, tree, b.id)) / n.cover

    d = len(names)
    for parts in got.values():
        values = {f: v for f, v, _ in parts}
        x = [values[n] for n in names]
        for j, name in enumerate(names):
            others = [i for i in range(d) if i != j]
            want = 0.0
            for size in range(d):
                w = math.factorial(size) * math.factorial(d - 1 - size) / math.factorial(d)
                for s in combinations(others, size):
                    for t, tree in tree_of.items():
                        want += w * weights[t] * (game(x, {*s, j}, tree) - game(x, set(s), tree))
            assert {f: p for f, _, p in parts}[name] == pytest.approx(want, abs=1e-9)


def test_linear_attributions_add_up(rows):
    model = learners.fit_baseline(rows, FEATURES)
    phi, base = ex.linear_attributions(model, rows.limit(20), rows, "msno")
    sums = {r.msno: r.s + base for r in phi.groupBy("msno").agg(F.sum("phi").alias("s")).collect()}
    raw = model.model.transform(rows.limit(20)).select("msno", vector_to_array("rawPrediction")[1].alias("m"))
    for r in raw.collect():
        assert sums[r.msno] == pytest.approx(r.m, abs=1e-9)


def test_summaries_of_attributions(rows, trees):
    phi, _ = ex.attributions(trees, rows.limit(60), "msno")
    phi = phi.persist()
    top = ex.global_attribution(phi, 3).collect()
    assert len(top) == 3 and top[0].mean_abs_phi >= top[2].mean_abs_phi
    direction = {r.feature: r for r in ex.attribution_direction(phi).collect()}
    assert direction["txn_count"].value_corr < 0 and len(direction) == len(FEATURES)
    lines = ex.explain_row(phi, "msno", rows.limit(1), 3).collect()
    total = phi.join(rows.limit(1).select("msno"), "msno").agg(F.sum("phi")).first()[0]
    assert sum(r.phi for r in lines) == pytest.approx(total) and [r.feature for r in lines].count("other") == 1
    gains = ex.gain_importance(trees, rows, 3).collect()
    assert len(gains) == 3 and gains[0].gain >= gains[1].gain


def test_best_round_and_patience():
    assert tuning.best_round([0.9, 0.5, 0.6, 0.5]) == (2, 0.5)
    assert tuning.best_round([0.9, 0.8, 0.85, 0.86, 0.1], patience=2) == (2, 0.8)
    assert tuning.best_round([0.9, 0.8, 0.85, 0.1], patience=2) == (4, 0.1)


def test_draws_stay_in_range():
    rng = random.Random(0)
    for _ in range(200):
        for name, v in tuning.draw(tuning.SPACE, rng).items():
            assert tuning.SPACE[name][1] <= v <= tuning.SPACE[name][2]


def test_search_reports_plain_log_loss(rows):
    study = tuning.random_search(rows, FEATURES, n_trials=2, k=2, rounds=3, space={"maxDepth": ("int", 2, 3)})
    assert study["best_value"] == min(t["value"] for t in study["trials"])
    assert all(len(t["curve"]) == 3 and 0 < t["value"] < 2 for t in study["trials"])
    # One fold's curve ends at the loss that the metric reports for its model.
    ready, data = learners.prepare_trees(rows, FEATURES)
    model = learners.tree_learner({"maxDepth": 2}, 3, 32).fit(data)
    last = model.evaluateEachIteration(data.withColumn("weight", F.lit(1.0)))[-1] / 2
    scored = model.transform(data).select(F.col("is_churn").alias("y_true"), vector_to_array("probability")[1].alias("y_prob"))
    assert last == pytest.approx(metrics.log_loss(scored).first().log_loss)


KNOWN = [
    {"maxDepth": 1, "stepSize": 0.002},
    {"maxDepth": 1, "stepSize": 0.01},
    {"maxDepth": 1, "stepSize": 0.003},
    {"maxDepth": 3, "stepSize": 0.15, "subsamplingRate": 1.0, "featureFraction": 1.0},
    {"maxDepth": 1, "stepSize": 0.001},
    {"maxDepth": 1, "stepSize": 0.004},
]


def test_halving_keeps_the_known_best_candidate(rows):
    """One candidate learns, the others hardly move within the rounds allowed."""
    study = tuning.random_search(rows, FEATURES, k=2, rounds=12, patience=2, finalists=1, candidates=KNOWN)
    assert study["best_trial"] == 3 and study["best_params"] == KNOWN[3]
    by_rung = {}
    for r in study["rungs"]:
        by_rung.setdefault((r["rung"], r["length"]), {})[r["trial"]] = r["kept"]
    # Three rounds, then six, then all twelve; the better half goes on.
    assert [(k, len(v), sum(v.values())) for k, v in sorted(by_rung.items())] == [((0, 3), 6, 3), ((1, 6), 3, 2), ((2, 12), 2, 1)]
    assert [t["trial"] for t in study["trials"] if t["finalist"]] == [3]


def test_no_fit_trains_past_best_round_and_patience(rows):
    study = tuning.random_search(rows, FEATURES, k=2, rounds=200, patience=6, finalists=2, candidates=[
        {"maxDepth": 3, "stepSize": 0.3}, {"maxDepth": 2, "stepSize": 0.3}, {"maxDepth": 5, "stepSize": 0.3}])
    for t in (t for t in study["trials"] if t["finalist"]):
        trained = max(n for trial, _, n in study["fits"] if trial == t["trial"])
        assert len(t["curve"]) <= trained <= t["best_round"] + 6 < 200
        assert t["best_round"] == t["curve"].index(min(t["curve"])) + 1
    # The loss of the winner, from scored rows of each fold.
    losses = [r.log_loss for r in tuning.fold_losses(rows, FEATURES, study).collect()]
    assert sum(losses) / 2 == pytest.approx(study["best_value"], abs=1e-9)


def test_missing_numbers_go_to_the_side_that_parts_the_label(spark):
    """Gaps with the label of the small values, and gaps with that of the great ones."""
    rng = random.Random(4)
    out = []
    for i in range(2000):
        x = rng.random() * 100
        y = int(x > 60)
        out.append((i, y if rng.random() < 0.95 else 1 - y, x if rng.random() > 0.3 or y else None, x if rng.random() > 0.3 or not y else None, 1.0, i % 5))
    df = spark.createDataFrame(out, "msno long, is_churn int, low double, high double, weight double, whole int")
    sides = prepare.missing_sides(df, ["low", "high", "whole"])
    assert sides == {"low": prepare.BELOW, "high": prepare.ABOVE, "whole": prepare.BELOW}
    model = learners.fit_trees(df, ["low", "high"], {"maxDepth": 1, "minInstancesPerNode": 1, "subsamplingRate": 1.0, "featureFraction": 1.0}, 1)
    assert model.numeric == ["low", "high"]
    gaps = model.model.transform(spark.createDataFrame([(None, None, 0), (float("nan"), float("nan"), 0)], "low double, high double, is_churn int"))
    assert [list(r.v) for r in gaps.select(vector_to_array("features").alias("v")).collect()] == [[prepare.BELOW, prepare.ABOVE]] * 2
    assert prepare.missing_sides(df, []) == {}
    empty = df.withColumn("low", F.lit(None).cast("double"))
    assert prepare.missing_sides(empty, ["low"]) == {"low": prepare.BELOW}


def test_models_score_in_a_session_that_has_observed(spark, rows):
    from pyspark.sql import Observation

    seen = Observation("rows")
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 600}
    model = learners.fit_baseline(rows, FEATURES)
    scored = model.score(rows, ["msno", F.col("is_churn").alias("y_true")])
    assert learners.recalibrate(scored, "platt").apply(scored).count() == 600
    assert scored.repartition(3).agg(F.max("y_prob")).first()[0] <= 1.0


def test_recalibration_leaves_missing_scores_missing(spark, rows, trees):
    scored = trees.score(rows, ["msno", F.col("is_churn").alias("y_true")])
    gappy = scored.withColumn("y_prob", F.when(F.col("msno") == 3, None).when(F.col("msno") == 4, float("nan")).otherwise(F.col("y_prob")))
    for method in ("platt", "isotonic"):
        out = {r.msno: r.y_prob_cal for r in learners.recalibrate(gappy, method).apply(gappy).collect()}
        assert out[3] is None and out[4] is None and 0 <= out[5] <= 1


def test_recalibration_moves_the_mean(rows, trees):
    scored = trees.score(rows, ["msno", F.col("is_churn").alias("y_true")]).persist()
    for method in ("platt", "isotonic"):
        out = learners.recalibrate(scored, method).apply(scored)
        mean, rate = out.agg(F.avg("y_prob_cal"), F.avg("y_true")).first()
        assert mean == pytest.approx(rate, abs=0.01)


def test_experiments_run_end_to_end(spark, sf_dir):
    earlier, later = _mart(spark, sf_dir, "2000-08-01"), _mart(spark, sf_dir)
    outcome = experiments.random_split_experiment(later, n_trials=1, k=2, rounds=2)
    assert {r.run for r in outcome["comparison"].collect()} == {"baseline", "trees"}
    assert outcome["lift"].count() == 1
    drift = experiments.temporal_experiment(earlier, later, {"maxDepth": 2}, 2)["drift"].collect()
    assert {r.metric for r in drift} == {"label_rate", "log_loss", "roc_auc", "pr_auc", "f1"}
    report = experiments.explanation_report(
        outcome["models"]["trees"], outcome["test"], outcome["predictions"], p="y_prob_trees", n=20
    )
    assert report["confusion"].count() == 4 and report["global_attribution"].count() == 20
    assert report["positive"].columns == ["msno", "line", "feature", "phi", "value"]


def _counted(spark, n):
    """Rows of a table that says how many of its rows were made, repeats included."""
    made = spark.sparkContext.accumulator(0)

    def row(i):
        made.add(1)
        return i, int(i % 3 == 0), float(i % 7)

    return spark.createDataFrame(spark.sparkContext.parallelize(range(n), 2).map(row), "msno long, is_churn int, x double"), made


def test_a_table_is_made_once_for_its_split(spark):
    mart, made = _counted(spark, 60)
    train, test = experiments.split_mart(mart)
    assert (train.count(), test.count(), made.value) == (48, 12, 60)


def test_an_experiment_and_an_ablation_take_a_split_as_it_is(spark):
    mart, made = _counted(spark, 60)
    split = experiments.split_mart(mart)
    candidates = [{"maxDepth": 1, "minInstancesPerNode": 1}]
    outcome = experiments.random_split_experiment(mart, k=2, rounds=1, patience=1, candidates=candidates, split=split)
    assert outcome["test"].count() == 12
    mart = mart.select("*", *[F.col("x").alias(c) for c in ("age", "last_cancel")])
    split = tuple(part.select("*", *[F.col("x").alias(c) for c in ("age", "last_cancel")]) for part in split)
    assert experiments.ablation(mart, candidates[0], 1, split=split).count() == 3
    assert made.value == 60


def test_the_workbench_hands_its_split_to_the_experiment(spark, monkeypatch):
    from ebbtide.registry.workbench import Workbench

    mart, made = _counted(spark, 60)
    bench, given = Workbench(mart), {}
    bench.study = {}
    monkeypatch.setattr(experiments, "random_split_experiment", lambda mart, **kw: given.update(kw))
    monkeypatch.setattr(experiments, "save_experiment", lambda outcome, path: None)
    assert bench.folder and given["split"] is bench.split and made.value == 60


def test_tree_rows_of_some_tens_of_thousands_are_one_task(spark):
    n = F.col("id")
    rows = spark.range(0, 45_000, 1, 6).select(n.alias("msno"), (n % 2).cast("int").alias("is_churn"), (n % 7).alias("txn_count"))
    _, data = learners.prepare_trees(rows, ["txn_count"])
    try:
        assert data.rdd.getNumPartitions() == 1
        assert data.count() == 45_000
    finally:
        data.unpersist()


def test_an_ablation_finds_the_sides_of_gaps_once(rows, monkeypatch):
    found = learners.tree_sides(rows, FEATURES)
    part = ["age", "city", "gender"]
    assert learners.tree_sides(rows, part) == {c: found[c] for c in prepare.split_kinds(part)[0]}
    table = rows.select("*", *[F.col("age").alias(c) for c in prepare.SUBSCRIPTION])
    asked, plain = [], prepare.missing_sides
    monkeypatch.setattr(prepare, "missing_sides", lambda df, columns, *more: asked.append(list(columns)) or plain(df, columns, *more))
    runs = {r.run: r.n_features for r in experiments.ablation(table, {"maxDepth": 2}, 2, split=(table, table)).collect()}
    assert runs == {"full": 8, "no_subscription": 5, "behaviour_only": 4}
    assert len(asked) == 1 and set(prepare.SUBSCRIPTION) <= set(asked[0])


def test_a_fold_whose_fit_has_ended_is_not_fitted_again(spark, monkeypatch):
    ends = [[3, 20, 9], [2, 2, 2], [30, 4, 2], [1, 1, 1]]  # rounds that each fold falls

    class Learner:
        def __init__(self, trial, rounds):
            self.trial, self.rounds = trial, rounds

        def setParams(self, **_):
            return self

        def fit(self, _):
            return self

    def losses(_, model, fold):
        return [1.0 / i for i in range(1, min(model.rounds, ends[model.trial][fold]) + 1)]

    monkeypatch.setattr(tuning, "tree_learner", lambda params, rounds, *_: Learner(params["trial"], rounds))
    monkeypatch.setattr(tuning.Trials, "_losses", losses)
    rows = spark.range(1).selectExpr("0 AS fold", "1D AS weight")
    trials = tuning.Trials(rows, [{"trial": t} for t in range(4)], 3, 32, "y", 2)
    left, curves, rungs = tuning.halve(trials, 40, 5)
    assert left == [0, 2] and [[len(c) for c in curves[t]] for t in range(4)] == ends
    assert {(r["rung"], r["length"]) for r in rungs} == {(0, 6), (1, 12), (2, 24), (3, 40)}
    assert len(rungs) == 12 + 3 * 6
    again = sorted((t, f) for t, f, _ in trials.fits)
    assert again == sorted([(t, f) for t in range(4) for f in range(3)] + [(0, 1), (0, 2), (2, 0)] + [(0, 1), (2, 0)] + [(2, 0)])


def test_the_workbench_makes_its_table_once(spark):
    from ebbtide.registry.workbench import Workbench

    mart, made = _counted(spark, 60)
    bench = Workbench(mart)
    assert [part.count() for part in (*bench.split, bench.mart, bench.mart)] == [48, 12, 60, 60]
    assert made.value == 60


def test_the_next_period_is_the_table_of_the_workbench(spark, monkeypatch):
    from types import SimpleNamespace

    from ebbtide.registry import spark_queries

    kept = SimpleNamespace(value=lambda _: {"best_params": {}, "best_round": 1})
    bench = SimpleNamespace(mart=object(), kept=kept)
    monkeypatch.setattr(spark_queries, "_bench", lambda *_: bench)
    monkeypatch.setattr(spark_queries, "_mart", lambda *_: None)
    monkeypatch.setattr(experiments, "temporal_experiment", lambda earlier, later, *_: {"drift": later})
    assert spark_queries.temporal_experiment(spark, "/none") is bench.mart


def test_scores_are_made_once_for_both_recalibrations(spark):
    from ebbtide.registry.spark_queries import _recalibrations

    rows, made = _counted(spark, 60)
    earlier = rows.select("msno", F.col("is_churn").alias("y_true"), ((F.col("x") + 1) / 9).alias("y_prob"))
    isotonic, platt = _recalibrations(earlier, earlier.limit(0))
    assert (isotonic.count(), platt.count(), platt.where("y_prob_cal > 0").count()) == (0, 60, 60)
    assert made.value == 60


def test_the_fits_of_the_folds_run_at_once(rows, monkeypatch):
    meet, plain = threading.Barrier(3, timeout=120), tuning.tree_learner

    class Learner:
        def __init__(self, *given):
            self.learner = plain(*given)

        def fit(self, df):
            meet.wait()
            return self.learner.fit(df)

    study = {"folds": 3, "seed": 42, "best_params": {"maxDepth": 2}, "best_round": 2}
    alone = [r.log_loss for r in tuning.fold_losses(rows, FEATURES, study).orderBy("fold").collect()]
    monkeypatch.setattr(tuning, "tree_learner", Learner)
    assert [r.log_loss for r in tuning.fold_losses(rows, FEATURES, study).orderBy("fold").collect()] == pytest.approx(alone, abs=1e-12)


def test_the_fits_of_an_ablation_run_at_once(rows, monkeypatch):
    meet, plain = threading.Barrier(3, timeout=120), experiments.fit_trees

    def fit(*given, **named):
        meet.wait()
        return plain(*given, **named)

    monkeypatch.setattr(experiments, "fit_trees", fit)
    table = rows.select("*", *[F.col("age").alias(c) for c in prepare.SUBSCRIPTION])
    runs = {r.run: r.n_features for r in experiments.ablation(table, {"maxDepth": 2}, 2, split=(table, table)).collect()}
    assert runs == {"full": 8, "no_subscription": 5, "behaviour_only": 4}
