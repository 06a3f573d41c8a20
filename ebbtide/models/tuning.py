"""Seeded random search: halving rungs over stratified folds, early stopping on the mean curve."""

from __future__ import annotations

import functools
import math
import random
from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.models.learners import bins_needed, prepare_trees, tree_learner
from ebbtide.operators import metrics
from ebbtide.operators.splits import folds as add_folds
from ebbtide.plans.features import ID, TARGET
from ebbtide.session import at_once

# (distribution, low, high). Depths 4-7 stand for 20-150 leaves; the minimum
# gain takes the place of the two regularisers, which these learners lack.
SPACE = {
    "maxDepth": ("int", 4, 7),
    "stepSize": ("log", 0.01, 0.3),
    "minInstancesPerNode": ("int", 5, 100),
    "subsamplingRate": ("uniform", 0.5, 1.0),
    "featureFraction": ("uniform", 0.5, 1.0),
    "minInfoGain": ("log", 1e-8, 1e-2),
}


def draw(space: Mapping[str, tuple], rng: random.Random) -> dict[str, float]:
    def one(kind, low, high):
        if kind == "int":
            return rng.randint(low, high)
        if kind == "log":
            return math.exp(rng.uniform(math.log(low), math.log(high)))
        return rng.uniform(low, high)

    return {name: one(*spec) for name, spec in space.items()}


def best_round(curve: Sequence[float], patience: int = 50) -> tuple[int, float]:
    """Rounds (from 1) and value of the first minimum, looking no further than
    ``patience`` rounds past the best one so far."""
    best = 0
    for i, value in enumerate(curve):
        if value < curve[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1, curve[best]


#: Candidates that are followed to the end of their patience.
FINALISTS = 2


class Trials:
    """Fits of candidates on folds of the prepared rows.

    The held-out rows get weight 1, so losses are plain ones; the learner reports
    twice the loss. ``fits`` keeps (trial, fold, rounds trained) of each fit made.
    """

    def __init__(self, rows: DataFrame, candidates: Sequence[Mapping[str, float]], k: int, bins: int, label: str, parallel: int):
        self.rows, self.candidates, self.k, self.bins, self.label, self.parallel = rows, candidates, k, bins, label, parallel
        self.fits: list[tuple[int, int, int]] = []

    def every_fold(self, trials: Sequence[int]) -> list[tuple[int, int]]:
        return [(t, f) for t in trials for f in range(self.k)]

    def _all(self, jobs: Sequence[tuple[int, int]], one) -> dict[tuple[int, int], list[float]]:
        return dict(zip(jobs, at_once(lambda job: one(*job), jobs, self.parallel)))

    def _losses(self, model, fold: int) -> list[float]:
        held_out = self.rows.where(F.col("fold") == fold).withColumn("weight", F.lit(1.0))
        return [v / 2.0 for v in model.evaluateEachIteration(held_out)]

    def until_worse(self, jobs: Sequence[tuple[int, int]], rounds: int) -> dict[tuple[int, int], list[float]]:
        """Held-out loss by round of each (trial, fold). A fit ends by itself at the first
        round that does not better its held-out loss, so a curve always falls; one
        of fewer than ``rounds`` rounds has ended."""

        def one(trial: int, fold: int) -> list[float]:
            held = F.col("fold") == fold
            learner = tree_learner(self.candidates[trial], rounds, self.bins, self.label)
            learner = learner.setParams(validationIndicatorCol="held_out", validationTol=0.0)
            marked = self.rows.withColumn("weight", F.when(held, 1.0).otherwise(F.col("weight"))).withColumn("held_out", held)
            curve = self._losses(learner.fit(marked), fold)
            self.fits.append((trial, fold, min(rounds, len(curve) + 1)))
            return curve

        return self._all(jobs, one)

    def curves(self, lengths: Mapping[int, int]) -> dict[int, list[float]]:
        """Fold-mean of the held-out loss by round, over as many rounds as named for each trial."""

        def one(trial: int, fold: int) -> list[float]:
            learner = tree_learner(self.candidates[trial], lengths[trial], self.bins, self.label)
            curve = self._losses(learner.fit(self.rows.where(F.col("fold") != fold)), fold)
            self.fits.append((trial, fold, lengths[trial]))
            return curve

        found = self._all(self.every_fold(list(lengths)), one)
        return {t: [sum(step) / len(step) for step in zip(*(found[t, f] for f in range(self.k)))] for t in lengths}


def halve(
    trials: Trials, rounds: int, patience: int, finalists: int = FINALISTS
) -> tuple[list[int], dict[int, list[list[float]]], list[dict]]:
    """Rungs of ``patience`` + 1 rounds, twice that, and so on up to ``rounds``: at
    each the worse half of the open candidates by fold-mean loss is dropped, down
    to ``finalists``.

    A fold that no longer fell at the end of a rung keeps its losses and is not
    trained again: a longer fit would end at the same round. Returns who is left, the losses by round of
    each fold, and one record for each rung, trial and fold.
    """
    left = list(range(len(trials.candidates)))
    todo = trials.every_fold(left)
    curves: dict[int, list[list[float]]] = {t: [[]] * trials.k for t in left}
    rungs: list[dict] = []
    rung, length = 0, min(rounds, patience + 1)
    while True:
        for (t, f), curve in trials.until_worse(todo, length).items():
            curves[t][f] = curve
        order = sorted(left, key=lambda t: (sum(c[-1] for c in curves[t]) / trials.k, t))
        kept = order[: finalists if length == rounds else max(finalists, -(-len(order) // 2))]
        rungs += [
            {"rung": rung, "length": length, "trial": t, "fold": f, "rounds": len(c), "loss": c[-1], "kept": t in kept}
            for t in sorted(left)
            for f, c in enumerate(curves[t])
        ]
        left = kept
        todo = [(t, f) for t in left for f, c in enumerate(curves[t]) if len(c) == length]
        if length == rounds or (len(left) <= finalists and not todo):
            return left, curves, rungs
        rung, length = rung + 1, min(rounds, 2 * length)


def with_patience(
    trials: Trials, finals: Sequence[int], falling: Mapping[int, Sequence], rounds: int, patience: int
) -> dict[int, list[float]]:
    """Fold-mean curves to ``patience`` rounds past the best one, or to ``rounds``.

    Up to the shortest fold of ``falling`` the mean falls too, so the best round
    cannot lie before it: training to that round and the patience, and from a later
    best round on likewise, never trains more than best round and patience.
    """
    lengths = {t: min(rounds, min(len(c) for c in falling[t]) + patience) for t in finals}
    curves: dict[int, list[float]] = {}
    while lengths:
        curves |= trials.curves(lengths)
        wanted = {t: min(rounds, best_round(curves[t], patience)[0] + patience) for t in lengths}
        lengths = {t: n for t, n in wanted.items() if n > len(curves[t])}
    return curves


def random_search(
    train: DataFrame,
    features: Sequence[str],
    n_trials: int = 30,
    k: int = 5,
    rounds: int = 1000,
    patience: int = 50,
    seed: int = 42,
    label: str = TARGET,
    space: Mapping[str, tuple] = SPACE,
    parallel: int = 8,
    finalists: int = FINALISTS,
    candidates: Sequence[Mapping[str, float]] | None = None,
) -> dict:
    """Minimise the fold-mean log loss over seeded draws (or the given candidates).

    All candidates run through halving rungs, whose fits end at their first worse
    round; the finalists are then followed with patience, and the best of them by
    the least mean loss wins. Returns best_params, best_value, best_round,
    n_trials, one record per trial, the rungs and the fits made.
    """
    rng = random.Random(seed)
    candidates = list(candidates or [draw(space, rng) for _ in range(n_trials)])
    ready, rows = prepare_trees(add_folds(train, ID, label, k, seed), features, label, keep=["fold"])
    try:
        trials = Trials(rows, candidates, k, bins_needed(ready.stages), label, parallel)
        finals, falling, rungs = halve(trials, rounds, patience, finalists)
        curves = with_patience(trials, finals, falling, rounds, patience)
    finally:
        rows.unpersist()
    records = []
    for t, params in enumerate(candidates):
        curve = curves.get(t) or [sum(step) / k for step in zip(*falling[t])]
        n, value = best_round(curve, patience)
        last = max(r["rung"] for r in rungs if r["trial"] == t)
        records.append({"trial": t, "params": dict(params), "best_round": n, "value": value, "curve": curve, "finalist": t in curves, "rung": last})
    best = min((r for r in records if r["finalist"]), key=lambda r: (r["value"], r["trial"]))
    return {
        "best_params": best["params"],
        "best_value": best["value"],
        "best_round": best["best_round"],
        "best_trial": best["trial"],
        "n_trials": len(candidates),
        "folds": k,
        "patience": patience,
        "seed": seed,
        "trials": records,
        "rungs": rungs,
        "fits": sorted(trials.fits),
    }


def fold_losses(
    train: DataFrame, features: Sequence[str], study: Mapping, label: str = TARGET
) -> DataFrame:
    """(fold, log_loss) of the best candidate at its best round, from the scored
    rows of each fold: a fit for each fold, rated by the metric and not by the
    learner's own curve."""
    k = study["folds"]
    ready, rows = prepare_trees(add_folds(train, ID, label, k, study["seed"]), features, label, keep=["fold"])
    learner = tree_learner(study["best_params"], study["best_round"], bins_needed(ready.stages), label)
    models = at_once(lambda fold: learner.fit(rows.where(F.col("fold") != fold)), range(k))
    parts = []
    for fold, model in enumerate(models):
        scored = model.transform(rows.where(F.col("fold") == fold))
        pred = scored.select(F.col(label).alias("y_true"), vector_to_array("probability")[1].alias("y_prob"))
        parts.append(metrics.log_loss(pred).select(F.lit(fold).alias("fold"), "log_loss"))
    return functools.reduce(DataFrame.unionByName, parts)


def trials_frame(spark: SparkSession, study: Mapping) -> DataFrame:
    """One row per trial: parameters, how far it came, best round and its loss."""
    names = list(study["best_params"])
    rows = [
        (t["trial"], *[float(t["params"][n]) for n in names], t["rung"], t["finalist"], t["best_round"], float(t["value"]))
        for t in study["trials"]
    ]
    columns = ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame(rows, f"trial int, {columns}, last_rung int, finalist boolean, best_round int, log_loss double")


def rungs_frame(spark: SparkSession, study: Mapping) -> DataFrame:
    """One row per rung, trial still open and fold: rounds until the loss rose, the loss, and whether the trial stayed."""
    names = ("rung", "length", "trial", "fold", "rounds", "loss", "kept")
    return spark.createDataFrame(
        [tuple(r[n] for n in names) for r in study["rungs"]],
        "rung int, length int, trial int, fold int, rounds int, loss double, kept boolean",
    )


def curve_frame(spark: SparkSession, study: Mapping) -> DataFrame:
    """Held-out loss per finalist and round."""
    rows = [(t["trial"], i, float(v)) for t in study["trials"] if t["finalist"] for i, v in enumerate(t["curve"], start=1)]
    return spark.createDataFrame(rows, "trial int, round int, log_loss double")
