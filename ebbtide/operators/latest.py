"""Latest row per key, alone or together with whole-history totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_rows(df: DataFrame, key: str, order_by: str, ties: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` per key; NULLs rank last.

    Spark turns ``rn = 1`` into a group limit below the shuffle, so each map
    task sends at most one row per key, whatever the size of the key.
    """
    order = [F.desc(order_by), *[F.desc(t) for t in ties]]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where("_rn = 1").drop("_rn")


def latest_and_totals(
    df: DataFrame,
    key: str,
    order_by: str,
    ties: Sequence[str],
    latest: Mapping[str, str],
    totals: Mapping[str, Column],
) -> DataFrame:
    """Latest values and totals per key in one aggregation and one shuffle.

    The latest row is the maximum of a struct that starts with the order
    column; NULL sorts lowest there, which equals descending order with NULLs
    last. Rows that still tie are separated by their own values.
    """
    parts = [F.col(order_by).alias("_order")]
    parts += [F.col(t).alias(f"_tie{i}") for i, t in enumerate(ties)]
    parts += [F.col(source).alias(name) for name, source in latest.items()]
    grouped = df.groupBy(key).agg(
        F.max(F.struct(*parts)).alias("_top"),
        *[agg.alias(name) for name, agg in totals.items()],
    )
    return grouped.select(key, *[F.col(f"_top.{name}").alias(name) for name in latest], *totals)


def top_k(df: DataFrame, by: str, ties: Sequence[str], k: int) -> DataFrame:
    """The k rows with the greatest ``by``; per-task top-k, then one merge."""
    return df.orderBy(F.desc(by), *ties).limit(k)
