"""Experiment folders: whole or refused, and enough by themselves."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import metrics
from ebbtide.plans import experiments
from ebbtide.registry.spark_queries import _mart
from ebbtide.sources import artifacts
from ebbtide.sources.artifacts import Artifacts, IncompleteArtifacts


@pytest.fixture(scope="module")
def saved(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("runs") / "one")
    outcome = experiments.random_split_experiment(
        _mart(spark, sf_dir), n_trials=2, k=2, rounds=3, patience=1, space={"maxDepth": ("int", 2, 3)}
    )
    manifest = experiments.save_experiment(outcome, path)
    return path, outcome, manifest


def test_folder_holds_what_the_manifest_says(spark, saved):
    path, outcome, manifest = saved
    kept = Artifacts(spark, path)
    assert kept.manifest == manifest and kept.broken() == []
    assert kept.table("predictions").count() == outcome["test"].count() == manifest["tables"]["features"]["rows"]
    assert sorted(kept.table("predictions").collect()) == sorted(outcome["predictions"].collect())
    assert {r.run for r in kept.table("comparison").collect()} == {"baseline", "trees"}
    study = kept.value("study")
    assert study["best_round"] == outcome["study"]["best_round"] and study["best_params"] == outcome["study"]["best_params"]
    assert kept.table("trials").where(F.col("trial") == study["best_trial"]).first().log_loss == study["best_value"]
    assert not [n for n in os.listdir(os.path.dirname(path)) if "partial" in n]


def test_saved_models_score_raw_features_alike(spark, saved):
    path, outcome, _ = saved
    kept = Artifacts(spark, path, verify=False)
    for name, column in (("baseline", "y_prob_lr"), ("trees", "y_prob_trees")):
        again = kept.model(name).score(kept.table("features"), ["msno"], "p")
        both = again.join(kept.table("predictions"), "msno")
        assert both.count() == outcome["test"].count()
        assert both.where(F.abs(F.col("p") - F.col(column)) > 1e-12).count() == 0


def test_report_from_the_folder_alone(spark, saved):
    path, outcome, _ = saved
    report = experiments.report_from_disk(spark, path, n=20)
    assert report["confusion"].agg(F.sum("n")).first()[0] == outcome["test"].count()
    assert report["global_attribution"].count() == 20
    want = metrics.roc_curve(outcome["predictions"], p="y_prob_trees").collect()
    assert sorted(map(str, report["roc_curve"].collect())) == sorted(map(str, want))
    assert report["positive"].columns == ["msno", "line", "feature", "phi", "value"]


def test_half_written_or_changed_folders_are_refused(spark, saved, tmp_path):
    path, _, _ = saved

    def copy(name):
        return shutil.copytree(path, tmp_path / name)

    half = copy("half")
    shutil.rmtree(half / "manifest")
    with pytest.raises(IncompleteArtifacts, match="no manifest"):
        Artifacts(spark, str(half))
    gone = copy("gone")
    shutil.rmtree(gone / "tables" / "predictions")
    with pytest.raises(IncompleteArtifacts, match="predictions"):
        Artifacts(spark, str(gone))
    other = copy("other")
    shutil.rmtree(other / "tables" / "lift")
    spark.createDataFrame([(1.0, 2.0, 3.0)], "before double, after double, improvement_pct double").write.parquet(str(other / "tables" / "lift"))
    with pytest.raises(IncompleteArtifacts, match="lift"):
        Artifacts(spark, str(other))
    no_model = copy("no_model")
    shutil.rmtree(no_model / "models" / "trees")
    with pytest.raises(IncompleteArtifacts, match="trees"):
        Artifacts(spark, str(no_model))
    with pytest.raises(IncompleteArtifacts):
        Artifacts(spark, str(tmp_path / "never"))


def test_a_failed_writer_shows_nothing(spark, tmp_path):
    good = spark.range(3)
    bad = spark.range(3).select(F.raise_error(F.lit("stop")).alias("x"))
    with pytest.raises(Exception, match="stop"):
        artifacts.write_artifacts(spark, str(tmp_path / "run"), {"good": good, "bad": bad})
    assert not (tmp_path / "run").exists()
    artifacts.write_artifacts(spark, str(tmp_path / "run"), {"good": good}, values={"a": 1})
    with pytest.raises(FileExistsError):
        artifacts.write_artifacts(spark, str(tmp_path / "run"), {"good": good})
    assert Artifacts(spark, str(tmp_path / "run")).value("a") == 1


def test_fingerprint_follows_changes(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    spark.range(3).write.parquet(path)
    first = artifacts.fingerprint(spark, path)
    assert first == artifacts.fingerprint(spark, path) and first
    spark.range(4).write.mode("overwrite").parquet(path)
    assert artifacts.fingerprint(spark, path) != first
    assert artifacts.fingerprint(spark, f"{tmp_path}/none") == ()
