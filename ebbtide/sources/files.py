"""Reading, writing and inspecting tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.sources.schemas import CATALOG, table_paths


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header line. Without a schema the types are inferred, which
    costs a second pass over the file; give one for anything large."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def read_catalog(spark: SparkSession, root: str, files: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """The four declared CSV tables below a root."""
    paths = table_paths(root, dict(files or {}))
    return {name: read_csv(spark, paths[name], schema) for name, schema in CATALOG.items()}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def query_csv(spark: SparkSession, path: str, sql: str, schema: T.StructType | None = None) -> DataFrame:
    """Run SQL over one CSV file, which the text calls ``{path}``.

    ``read_csv_auto('{path}')`` is understood as the same table.
    """
    table = read_csv(spark, path, schema)
    return spark.sql(sql.replace("read_csv_auto('{path}')", "{path}"), path=table)


def describe(df: DataFrame) -> DataFrame:
    """Column names and types as rows, from the schema alone."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, start=1)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, column_type string")


def describe_csv(spark: SparkSession, path: str) -> DataFrame:
    return describe(read_csv(spark, path))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: rows, number of columns and the schema as text."""

    def one(name: str, df: DataFrame) -> DataFrame:
        schema = ", ".join(f"{f.name} ({f.dataType.simpleString()})" for f in df.schema.fields)
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).alias("column_count"),
            F.lit(schema).alias("schema_text"),
        )

    return functools.reduce(DataFrame.unionByName, (one(n, d) for n, d in tables.items()))


def preview(df: DataFrame, n: int = 5, order_by: tuple[str, ...] = ()) -> DataFrame:
    """The first n rows, in the given order if there is one."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def stage(df: DataFrame, mode: str, target: str | None = None, key: str | None = None) -> DataFrame:
    """Fix how an intermediate result is kept.

    ``view`` registers the lazy plan under the name ``target``; ``memory``
    persists it with spill to disk; ``table`` writes Parquet to ``target`` and
    reads it back, which also survives lost executors; ``bucketed`` also lays it
    out by ``key``, in as many buckets as there are shuffle partitions, so that
    later joins and aggregations by that key need no exchange.
    """
    if mode == "view":
        df.createOrReplaceTempView(target)
        return df
    if mode == "memory":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if mode == "table":
        write_parquet(df, target)
        return df.sparkSession.read.parquet(target)
    if mode == "bucketed":
        spark = df.sparkSession
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        name = f"stage_{uuid.uuid4().hex}"
        laid = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
        laid.option("path", target).saveAsTable(name)
        return spark.table(name)
    raise ValueError(f"unknown staging mode {mode!r}")


STUDY_SCHEMA = "best_params map<string,double>, best_value double, best_round int, n_trials int"


def write_study(spark: SparkSession, study: dict, path: str) -> None:
    """Keep the outcome of a parameter search as JSON."""
    row = (
        {k: float(v) for k, v in study["best_params"].items()},
        float(study["best_value"]),
        int(study["best_round"]),
        int(study["n_trials"]),
    )
    spark.createDataFrame([row], STUDY_SCHEMA).write.mode("overwrite").json(path)


def read_study(spark: SparkSession, path: str) -> dict:
    return spark.read.schema(STUDY_SCHEMA).json(path).first().asDict(recursive=True)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
