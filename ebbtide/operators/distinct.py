"""Exact distinct counts next to sums, without shuffling the raw rows by key alone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def sums_and_distinct(
    df: DataFrame,
    key: str,
    distinct: str,
    sums: Mapping[str, Column],
    distinct_name: str,
    window: tuple[int, int] | None = None,
) -> DataFrame:
    """Per key: the number of different ``distinct`` values and the given sums.

    Rows (those of an integer ``window``, if there is one) are combined per
    (key, value) first, so that a key with a large share of all rows arrives as
    one row per value and task.
    """
    if window is not None:
        df = df.where(F.col(distinct).between(*window))
    per_value = df.groupBy(key, distinct).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    return per_value.groupBy(key).agg(
        F.count(distinct).alias(distinct_name), *[F.sum(n).alias(n) for n in sums]
    )


def approx_distinct(df: DataFrame, keys: Sequence[str], distinct: str, name: str, rsd: float = 0.02) -> DataFrame:
    """Sketch-based distinct count, for callers who accept an error of ``rsd``."""
    return df.groupBy(*keys).agg(F.approx_count_distinct(distinct, rsd).alias(name))
