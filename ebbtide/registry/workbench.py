"""What the model queries share: one split, study, experiment folder and explanation.

A workbench belongs to one state of the tables: it is looked up by application,
folder and the files' sizes and times, so changed tables get a new one.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from ebbtide.models import explain, tuning
from ebbtide.models.learners import Fitted
from ebbtide.models.prepare import feature_columns
from ebbtide.plans import experiments
from ebbtide.plans.features import ID
from ebbtide.session import durable, scratch_path
from ebbtide.sources.artifacts import Artifacts, fingerprint


class Workbench:
    """Parts are made when they are first asked for; any can be set beforehand."""

    def __init__(self, mart: DataFrame):
        self.made_from = mart
        self.spark = mart.sparkSession

    @functools.cached_property
    def mart(self) -> DataFrame:
        """The feature table, made once for the split and for all that reads it whole."""
        return durable(self.made_from)

    @functools.cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        return experiments.split_kept(self.mart)

    @property
    def train(self) -> DataFrame:
        return self.split[0]

    @property
    def test(self) -> DataFrame:
        return self.split[1]

    @functools.cached_property
    def study(self) -> dict:
        """The search at full strength: 30 candidates, 5 folds, up to 1,000 rounds, patience 50."""
        return tuning.random_search(self.train, feature_columns(self.train))

    @functools.cached_property
    def folder(self) -> str:
        """Where the finished experiment lies."""
        path = scratch_path(self.spark, "experiment")
        experiments.save_experiment(experiments.random_split_experiment(self.mart, study=self.study, split=self.split), path)
        return path

    @functools.cached_property
    def kept(self) -> Artifacts:
        return Artifacts(self.spark, self.folder)

    @functools.cached_property
    def trees(self) -> Fitted:
        return self.kept.model("trees")

    @functools.cached_property
    def baseline(self) -> Fitted:
        return self.kept.model("baseline")

    @functools.cached_property
    def sample(self) -> DataFrame:
        return experiments.explanation_sample(self.kept.table("features"))

    @functools.cached_property
    def attributions(self) -> tuple[DataFrame, float]:
        phi, base = explain.attributions(self.trees, self.sample, ID)
        return durable(phi), base


_benches: dict[tuple, Workbench] = {}


def workbench(spark: SparkSession, sf_dir: str, mart) -> Workbench:
    """The workbench of these tables; ``mart`` makes the feature table where there is none yet."""
    key = (spark.sparkContext.applicationId, sf_dir, fingerprint(spark, f"{sf_dir}/*.parquet"))
    if key not in _benches:
        _benches.clear()
        _benches[key] = Workbench(mart(spark, sf_dir))
    return _benches[key]


def forget() -> None:
    """Let go of the last workbench."""
    _benches.clear()
