"""Joins on grouping columns; the join plan is left to the sizes seen at run time."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", plain: Sequence[str] = ()) -> DataFrame:
    """Equi-join on grouping columns in which NULL is a group of its own; the
    ``plain`` columns hold no NULL, so rows that lie by them need not move."""
    aliased = right.withColumnsRenamed({k: f"_r_{k}" for k in (*keys, *plain)})
    tests = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys] + [F.col(k) == F.col(f"_r_{k}") for k in plain]
    same = functools.reduce(lambda a, b: a & b, tests)
    return left.join(aliased, same, how).drop(*[f"_r_{k}" for k in (*keys, *plain)])
