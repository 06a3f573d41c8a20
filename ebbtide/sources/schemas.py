"""Declared schemas of the four inputs, with a comment on every column.

Reading with a declared schema saves the pass that type inference costs.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _field(name: str, kind: T.DataType, comment: str) -> T.StructField:
    return T.StructField(name, kind, True, {"comment": comment})


_TEXT, _INT, _REAL = T.StringType(), T.IntegerType(), T.DoubleType()

LABELS = T.StructType(
    [
        _field("msno", _TEXT, "user key"),
        _field("is_churn", _INT, "1 when the user did not come back in the outcome window"),
    ]
)

MEMBERS = T.StructType(
    [
        _field("msno", _TEXT, "user key"),
        _field("city", _INT, "city code"),
        _field("bd", _INT, "age as entered, with impossible values"),
        _field("gender", _TEXT, "male, female or blank"),
        _field("registered_via", _INT, "sign-up channel code"),
        _field("registration_init_time", _INT, "sign-up day as YYYYMMDD"),
    ]
)

TRANSACTIONS = T.StructType(
    [
        _field("msno", _TEXT, "user key, many rows per user"),
        _field("payment_method_id", _INT, "payment method code"),
        _field("payment_plan_days", _INT, "length of the plan in days"),
        _field("plan_list_price", _INT, "list price"),
        _field("actual_amount_paid", _INT, "price paid"),
        _field("is_auto_renew", _INT, "1 when the plan renews itself"),
        _field("transaction_date", _INT, "day of payment as YYYYMMDD"),
        _field("membership_expire_date", _INT, "last paid day as YYYYMMDD"),
        _field("is_cancel", _INT, "1 when the row is a cancellation"),
    ]
)

USER_LOGS = T.StructType(
    [
        _field("msno", _TEXT, "user key, many rows per user"),
        _field("date", _INT, "day as YYYYMMDD"),
        _field("num_25", _INT, "plays stopped before 25%"),
        _field("num_50", _INT, "plays stopped before 50%"),
        _field("num_75", _INT, "plays stopped before 75%"),
        _field("num_985", _INT, "plays stopped before 98.5%"),
        _field("num_100", _INT, "plays beyond 98.5%"),
        _field("num_unq", _INT, "different songs on that day"),
        _field("total_secs", _REAL, "seconds listened"),
    ]
)

CATALOG: dict[str, T.StructType] = {
    "labels": LABELS,
    "members": MEMBERS,
    "transactions": TRANSACTIONS,
    "user_logs": USER_LOGS,
}

# Where each table lies below a data root, unless the caller says otherwise.
DEFAULT_FILES = {name: f"{name}.csv" for name in CATALOG}


def table_paths(root: str, files: dict[str, str] | None = None) -> dict[str, str]:
    """Full path per table below a configurable root."""
    return {name: f"{root.rstrip('/')}/{part}" for name, part in {**DEFAULT_FILES, **(files or {})}.items()}


def describe_catalog(spark: SparkSession) -> DataFrame:
    """One row per declared column: table, position, name, type, comment."""
    rows = [
        (table, i, f.name, f.dataType.simpleString(), f.metadata["comment"])
        for table, schema in CATALOG.items()
        for i, f in enumerate(schema.fields, start=1)
    ]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, column_type string, comment string"
    )


def catalog_against(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The declared columns with the values that a set of tables holds in each;
    NULL where a table has no such column. One scan of each table."""

    def one(name: str, schema: T.StructType) -> DataFrame:
        there = [f.name for f in schema if f.name in tables[name].columns]
        counts = tables[name].agg(*[F.count(c).alias(c) for c in there]).unpivot([], there, "column_name", "n_filled")
        declared = describe_catalog(tables[name].sparkSession).where(F.col("table_name") == name)
        return declared.join(counts, "column_name", "left").select("table_name", "position", "column_name", "comment", "n_filled")

    return functools.reduce(DataFrame.unionByName, (one(n, s) for n, s in CATALOG.items()))
