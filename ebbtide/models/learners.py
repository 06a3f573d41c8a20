"""Logistic baseline, boosted trees, scoring and recalibration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.models import prepare as prep
from ebbtide.operators.metrics import EPS, class_balance, scored
from ebbtide.plans.features import TARGET

SEED = 42


class Fitted:
    """A pipeline model that takes raw features; saved, it needs nothing but its path."""

    def __init__(self, model: PipelineModel):
        self.model = model

    @classmethod
    def load(cls, path: str) -> Fitted:
        return cls(PipelineModel.load(path))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    @property
    def kind(self) -> str:
        return "linear" if isinstance(self.model.stages[-1], LogisticRegressionModel) else "tree"

    @property
    def categorical(self) -> list[str]:
        return [prep.unshaped(c) for s in self.model.stages if isinstance(s, StringIndexerModel) for c in s.getInputCols()]

    @property
    def numeric(self) -> list[str]:
        inputs = [c for s in self.model.stages if isinstance(s, VectorAssembler) for c in s.getInputCols()]
        return [prep.unshaped(c) for c in inputs if c.endswith(prep.SHAPED)]

    def score(self, df: DataFrame, keep: Sequence[str], name: str = "y_prob") -> DataFrame:
        """The kept columns and the probability of the positive class."""
        return self.model.transform(df).select(*keep, vector_to_array("probability")[1].alias(name))


def _without_summary(model: PipelineModel) -> PipelineModel:
    """The model without the record of its training. That record holds the session,
    which a task cannot take along once the session has observed a query."""
    for stage in model.stages:
        if isinstance(stage, LogisticRegressionModel) and stage.hasSummary:
            stage._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


def fit_baseline(train: DataFrame, features: Sequence[str], label: str = TARGET) -> Fitted:
    """L2 logistic regression with balanced class weights.

    The weights sum to n and the numbers are standardised beforehand, so a
    penalty of 1/n is the usual unit penalty on the summed loss.
    """
    numeric, categorical = prep.split_kinds(features)
    balance = class_balance(train, label).first()
    weighted = prep.class_weights(train, label, "balanced", balance=balance)
    learner = LogisticRegression(
        featuresCol="features", labelCol=label, weightCol="weight", maxIter=1000,
        regParam=1.0 / max(balance.n_pos + balance.n_neg, 1), elasticNetParam=0.0, standardization=False,
    )
    return Fitted(_without_summary(Pipeline(stages=[*prep.linear_stages(train, numeric, categorical), learner]).fit(weighted)))


DEFAULT_TREES = {
    "maxDepth": 5, "stepSize": 0.1, "minInstancesPerNode": 20,
    "subsamplingRate": 0.8, "featureFraction": 0.8, "minInfoGain": 0.0,
}


#: Rounds between two checkpoints of the running margins; each is a write to the shared folder.
CHECKPOINT_ROUNDS = 50


def tree_learner(params: Mapping[str, float], rounds: int, bins: int, label: str = TARGET) -> GBTClassifier:
    p = {**DEFAULT_TREES, **params}
    return GBTClassifier(
        featuresCol="features", labelCol=label, weightCol="weight", seed=SEED, maxIter=int(rounds), maxBins=bins, checkpointInterval=CHECKPOINT_ROUNDS,
        maxDepth=int(p["maxDepth"]), stepSize=float(p["stepSize"]),
        minInstancesPerNode=int(p["minInstancesPerNode"]), subsamplingRate=float(p["subsamplingRate"]),
        featureSubsetStrategy=str(float(p["featureFraction"])) if p["featureFraction"] < 1.0 else "all",
        minInfoGain=float(p["minInfoGain"]),
    )


def bins_needed(stages: Sequence) -> int:
    """A split on categories needs a bin per level, and one for unseen levels."""
    levels = [len(v) for s in stages if isinstance(s, StringIndexerModel) for v in s.labelsArray]
    return max([32, *[n + 1 for n in levels]])


#: Rows of a task while trees grow. A round is several jobs, and every task of one takes the plan of
#: all rounds so far apart and measures what it keeps: at 20,000 rows nearly half of its time.
TASK_ROWS = 100_000


def prepare_trees(
    train: DataFrame, features: Sequence[str], label: str = TARGET, keep: Sequence[str] = (), sides: Mapping[str, float] | None = None
) -> tuple[PipelineModel, DataFrame]:
    """Fitted tree preparation and the prepared training rows, persisted.

    Learners read their input once per round, so it is built only once; the
    caller unpersists it. ``sides`` takes the place of finding them again.
    """
    numeric, categorical = prep.split_kinds(features)
    balance = class_balance(train, label).first()
    weighted = prep.class_weights(train, label, "pos_ratio", balance=balance)
    sides = sides or prep.missing_sides(weighted, numeric, label)
    ready = Pipeline(stages=prep.tree_stages(numeric, categorical, sides)).fit(weighted)
    rows = ready.transform(weighted).select(*keep, F.col(label).cast("double").alias(label), "weight", "features")
    tasks = -(-(balance.n_pos + balance.n_neg) // TASK_ROWS)
    return ready, rows.coalesce(max(1, tasks)).persist(StorageLevel.MEMORY_AND_DISK)


def tree_sides(train: DataFrame, features: Sequence[str], label: str = TARGET) -> dict[str, float]:
    """``missing_sides`` as the tree preparation finds them: each number's side is its
    own, so those of a feature list serve any part of it on the same rows."""
    numeric, _ = prep.split_kinds(features)
    return prep.missing_sides(prep.class_weights(train, label, "pos_ratio"), numeric, label)


def fit_trees(
    train: DataFrame,
    features: Sequence[str],
    params: Mapping[str, float] | None = None,
    rounds: int = 20,
    label: str = TARGET,
    sides: Mapping[str, float] | None = None,
) -> Fitted:
    """Boosted trees with log loss, positives weighted by n_neg / n_pos; ``sides``
    of at least these features' numbers take the place of finding them again."""
    ready, rows = prepare_trees(train, features, label, sides=sides)
    try:
        model = tree_learner(params or {}, rounds, bins_needed(ready.stages), label).fit(rows)
    finally:
        rows.unpersist()
    return Fitted(PipelineModel([*ready.stages, model]))


def _logit(p: Column) -> Column:
    """Log-odds; NULL and NaN have none (``greatest`` and ``least`` would skip them)."""
    inside = F.greatest(F.lit(EPS), F.least(F.lit(1.0 - EPS), p))
    return F.when(p.isNotNull() & ~F.isnan(p), F.log(inside / (F.lit(1.0) - inside)))


class Recalibrated:
    """A map from old to new probabilities, fitted on a recent window."""

    def __init__(self, model: PipelineModel, method: str):
        self.model, self.method = model, method

    def apply(self, pred: DataFrame, p: str = "y_prob", name: str = "y_prob_cal") -> DataFrame:
        """The rows with a new probability; NULL where there was none."""
        known = pred.withColumns({"_logit": F.coalesce(_logit(F.col(p)), F.lit(0.0)), "_known": _logit(F.col(p)).isNotNull()})
        out = self.model.transform(known)
        value = vector_to_array("_probability")[1] if self.method == "platt" else F.col("_calibrated")
        return out.select(*pred.columns, F.when(F.col("_known"), value).alias(name))


def recalibrate(pred: DataFrame, method: str, y: str = "y_true", p: str = "y_prob") -> Recalibrated:
    """``platt`` fits a logistic curve on the log-odds, ``isotonic`` a monotone step function."""
    rows = scored(pred, y, p).withColumn("_logit", _logit(F.col(p)))
    vector = VectorAssembler(inputCols=["_logit"], outputCol="_x")
    if method == "platt":
        curve = LogisticRegression(
            featuresCol="_x", labelCol=y, probabilityCol="_probability", rawPredictionCol="_raw",
            predictionCol="_class", regParam=0.0,
        )
    elif method == "isotonic":
        # Equal scores are combined first: the learner then sees one weighted
        # row per score instead of every user.
        rows = rows.groupBy("_logit").agg(F.avg(y).alias(y), F.count(F.lit(1)).cast("double").alias("_n"))
        curve = IsotonicRegression(featuresCol="_x", labelCol=y, weightCol="_n", predictionCol="_calibrated")
    else:
        raise ValueError(f"unknown recalibration {method!r}")
    return Recalibrated(_without_summary(Pipeline(stages=[vector, curve]).fit(rows)), method)
