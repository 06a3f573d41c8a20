"""Experiments: random split, temporal holdout, ablations, explanation."""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.models import explain as ex
from ebbtide.models import tuning
from ebbtide.models.learners import Fitted, fit_baseline, fit_trees, tree_sides
from ebbtide.models.prepare import feature_columns, feature_subsets
from ebbtide.operators import metrics as m
from ebbtide.operators.splits import first_match, hash_sample, stratified_split
from ebbtide.plans.features import ID, TARGET
from ebbtide.session import at_once, durable
from ebbtide.sources.artifacts import Artifacts, write_artifacts


def split_mart(mart: DataFrame, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training and test rows. The table is kept before it is cut, since finding the
    cuts reads it twice, and the marked rows are kept because learners read them often."""
    return split_kept(durable(mart), test_share, seed)


def split_kept(kept: DataFrame, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """``split_mart`` of a table that is kept already."""
    marked = durable(stratified_split(kept, ID, TARGET, test_share, seed))
    return marked.where("is_test = 0").drop("is_test"), marked.where("is_test = 1").drop("is_test")


def predictions(test: DataFrame, models: Mapping[str, Fitted]) -> DataFrame:
    """One row per test user: the label and a probability per model."""
    scored = [f.score(test, [ID, F.col(TARGET).alias("y_true")], name) for name, f in models.items()]
    return functools.reduce(lambda a, b: a.join(b.drop("y_true"), ID), scored)


def random_split_experiment(
    mart: DataFrame, n_trials: int = 30, k: int = 5, rounds: int = 1000, patience: int = 50, seed: int = 42,
    study: Mapping | None = None, split: tuple[DataFrame, DataFrame] | None = None, **search,
) -> dict:
    """Baseline and tuned trees on one stratified split; ``study`` takes the place of
    a new search, ``split`` that of cutting the table again."""
    train, test = split or split_mart(mart, seed=seed)
    features = feature_columns(mart)
    baseline = fit_baseline(train, features)
    study = study or tuning.random_search(train, features, n_trials, k, rounds, patience, seed, **search)
    trees = fit_trees(train, features, study["best_params"], study["best_round"])
    scored = durable(predictions(test, {"y_prob_lr": baseline, "y_prob_trees": trees}))
    records = {
        "baseline": m.metric_record(scored, p="y_prob_lr", run="baseline"),
        "trees": m.metric_record(scored, p="y_prob_trees", run="trees"),
    }
    return {
        "models": {"baseline": baseline, "trees": trees},
        "study": study,
        "predictions": scored,
        "test": test,
        "comparison": m.compare_runs(list(records.values())),
        "lift": m.metric_lift(records["baseline"], records["trees"]),
    }


STUDY_VALUES = ("best_params", "best_value", "best_round", "best_trial", "n_trials", "folds", "patience", "seed")


def save_experiment(outcome: Mapping, path: str) -> dict:
    """Everything of a random-split experiment as one folder of artifacts: both
    models, predictions and features of the test users, the comparison, the lift,
    and the study with its trials and rungs. Returns the manifest."""
    spark = outcome["predictions"].sparkSession
    study = outcome["study"]
    tables = {
        "predictions": outcome["predictions"],
        "features": outcome["test"],
        "comparison": outcome["comparison"],
        "lift": outcome["lift"],
        "trials": tuning.trials_frame(spark, study),
        "rungs": tuning.rungs_frame(spark, study),
        "curves": tuning.curve_frame(spark, study),
    }
    return write_artifacts(spark, path, tables, outcome["models"], {"study": {k: study[k] for k in STUDY_VALUES}})


def temporal_experiment(
    earlier: DataFrame, later: DataFrame, params: Mapping[str, float] | None = None, rounds: int = 20
) -> dict:
    """Fit on one period, score the next; features come from the same code.

    The report sets the next period against users of the first one that the
    trees have not seen. The next period's rows are read once.
    """
    train, held_out = split_mart(earlier)
    trees = fit_trees(train, feature_columns(earlier), params, rounds)
    within = durable(trees.score(held_out, [ID, F.col(TARGET).alias("y_true")]))
    ahead = durable(trees.score(later, [ID, F.col(TARGET).alias("y_true")]))
    return {
        "model": trees,
        "predictions": ahead,
        "record": m.metric_record(ahead, run="temporal", rounded=False),
        "drift": m.drift_report(within, ahead),
    }


def ablation(
    mart: DataFrame, params: Mapping[str, float] | None = None, rounds: int = 20, split: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """Metrics of the trees on the full and on the two reduced feature lists;
    ``split`` takes the place of cutting the table again."""
    train, test = split or split_mart(mart)
    sides = tree_sides(train, feature_columns(mart))

    def run(subset: tuple[str, list[str]]) -> DataFrame:
        name, features = subset
        trees = fit_trees(train, features, params, rounds, sides=sides)
        scored = durable(trees.score(test, [ID, F.col(TARGET).alias("y_true")]))
        return m.metric_record(scored, run=name).select("*", F.lit(len(features)).alias("n_features"))

    return m.compare_runs(at_once(run, list(feature_subsets(mart).items())))


def explanation_sample(test: DataFrame, n: int = 2000) -> DataFrame:
    """The users to explain. A top-n ends in one task, while attributions are
    work per row, so the sample is spread again, some 250 rows to a task."""
    cores = test.sparkSession.sparkContext.defaultParallelism
    return durable(hash_sample(test, ID, n).repartition(max(1, min(cores, n // 250)), ID))


def report_from_disk(spark: SparkSession, path: str, model: str = "trees", n: int = 2000) -> dict:
    """The explanation report of a saved experiment; its folder is all that it takes."""
    kept = Artifacts(spark, path)
    return explanation_report(kept.model(model), kept.table("features"), kept.table("predictions"), p=f"y_prob_{model}", n=n)


def explanation_report(
    trees: Fitted, test: DataFrame, scored: DataFrame, y: str = "y_true", p: str = "y_prob", n: int = 2000
) -> dict:
    """Curves, confusion, importances and attributions of one fitted model."""
    sample = explanation_sample(test, n)
    phi, base = ex.attributions(trees, sample, ID)
    phi = durable(phi)
    seen = scored.join(sample.select(ID), ID, "left_semi")
    sure_positive = first_match(seen, (F.col(y) == 1) & (F.col(p) > 0.8), ID)
    sure_negative = first_match(seen, (F.col(y) == 0) & (F.col(p) < 0.02), ID)
    return {
        "roc_curve": m.roc_curve(scored, y, p),
        "pr_curve": m.pr_curve(scored, y, p),
        "confusion": m.confusion(scored, y, p),
        "gain_importance": ex.gain_importance(trees, test),
        "sample": sample,
        "attributions": phi,
        "base_value": base,
        "global_attribution": ex.global_attribution(phi),
        "direction": ex.attribution_direction(phi),
        "positive": ex.explain_row(phi, ID, sure_positive),
        "negative": ex.explain_row(phi, ID, sure_negative),
    }
