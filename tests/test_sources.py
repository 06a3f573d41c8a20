"""Files, schemas, staging and the JSON form of a search."""

import os

import pytest

from ebbtide.session import durable, scratch_path, shared_dir
from ebbtide.sources import files, schemas


STATIONS = [(31, "north", 2.25), (32, "", -7.5), (33, "dune, east", 0.125)]


@pytest.fixture
def stations(tmp_path):
    path = tmp_path / "stations.csv"
    lines = [f'{n},"{site}",{height}' for n, site, height in STATIONS]
    path.write_text("\n".join(["station,site,height", *lines, ""]))
    return str(path)


def test_query_csv(spark, stations):
    high = files.query_csv(spark, stations, "SELECT station FROM read_csv_auto('{path}') WHERE height > 0 ORDER BY 1")
    assert [r.station for r in high.collect()] == [n for n, _, h in STATIONS if h > 0]
    declared = files.query_csv(spark, stations, "SELECT max(site) AS last FROM {path}", "station long, site string, height double")
    assert declared.first().last == "north"


def test_count_and_describe(spark, stations):
    read = files.read_csv(spark, stations)
    assert files.count_rows(read).first().n == len(STATIONS)
    got = [(r.position, r.column_name, r.column_type) for r in files.describe_csv(spark, stations).orderBy("position").collect()]
    assert got == [(1, "station", "int"), (2, "site", "string"), (3, "height", "double")]
    assert [r.station for r in files.preview(read, 2, ("station",)).collect()] == [31, 32]


def test_catalog(spark, tmp_path):
    assert {k: len(v) for k, v in schemas.CATALOG.items()} == {
        "labels": 2, "members": 6, "transactions": 9, "user_logs": 9,
    }
    assert schemas.describe_catalog(spark).where("comment = ''").count() == 0
    paths = schemas.table_paths("/data/", {"labels": "a b/train.csv"})
    assert paths["labels"] == "/data/a b/train.csv" and paths["members"] == "/data/members.csv"
    for name, schema in schemas.CATALOG.items():
        files.write_csv(spark.createDataFrame([], schema), f"{tmp_path}/{name}.csv")
    read = files.read_catalog(spark, str(tmp_path))
    assert all(read[n].schema.fieldNames() == s.fieldNames() for n, s in schemas.CATALOG.items())


def test_stage_modes(spark, tmp_path):
    df = spark.range(10)
    files.stage(df, "view", "ten")
    assert spark.sql("SELECT count(*) AS n FROM ten").first().n == 10
    assert files.stage(df, "table", f"{tmp_path}/t").count() == 10
    kept = files.stage(df, "memory")
    assert kept.is_cached and kept.count() == 10
    kept.unpersist()
    with pytest.raises(ValueError):
        files.stage(df, "elsewhere")


def test_partitioned_logs_prune(spark, tmp_path):
    logs = spark.range(60).selectExpr("id AS msno", "int(20170101 + id % 2 * 100) AS date", "int(201701 + id % 2) AS month")
    files.write_parquet(logs, f"{tmp_path}/logs", partition_by=("month",))
    january = files.read_parquet(spark, f"{tmp_path}/logs").where("month = 201701")
    assert january.count() == 30
    assert "PartitionFilters: [isnotnull(month" in january._jdf.queryExecution().toString()


def test_study_round_trip(spark, tmp_path):
    study = {"best_params": {"maxDepth": 5, "stepSize": 0.1}, "best_value": 0.3, "best_round": 7, "n_trials": 2}
    files.write_study(spark, study, f"{tmp_path}/study")
    assert files.read_study(spark, f"{tmp_path}/study") == {
        "best_params": {"maxDepth": 5.0, "stepSize": 0.1}, "best_value": 0.3, "best_round": 7, "n_trials": 2,
    }


def test_durable_rows_come_from_the_shared_folder(spark):
    kept = durable(spark.range(5))
    assert kept.count() == 5 and shared_dir(spark) == spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


def test_scratch_tables_are_removed_by_their_owner(spark):
    from ebbtide.session import clear_scratch, scratch_path, staged

    clear_scratch(spark)
    kept = staged(spark.range(5), "numbers")
    assert kept.count() == 5
    folder = os.path.dirname(kept.inputFiles()[0].removeprefix("file://").removeprefix("file:"))
    assert os.path.isdir(folder)
    scratch_path(spark, "never-written")
    assert clear_scratch(spark) == 1 and not os.path.exists(folder)
    assert clear_scratch(spark) == 0


def test_bucketed_stage_needs_no_exchange(spark, tmp_path):
    df = spark.range(50).selectExpr("id % 7 AS k", "id")
    kept = files.stage(df, "bucketed", f"{tmp_path}/s", "k")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, df.collect()))
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = kept.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    assert "Exchange" not in plan


def test_catalog_against_tables(spark, sf_dir):
    from ebbtide.registry.spark_queries import _tables

    tables = _tables(spark, sf_dir)
    tables["members"] = tables["members"].drop("bd")
    got = {(r.table_name, r.column_name): r.n_filled for r in schemas.catalog_against(tables).collect()}
    assert len(got) == 26 and got["members", "bd"] is None
    assert got["labels", "msno"] == tables["labels"].count()
