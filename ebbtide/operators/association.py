"""Pearson correlation between columns, pairwise complete, from mergeable co-moments."""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tasks get the code of this module with their function, so that workers need
# not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows that one product of matrices works on, and states that one task merges.
ROWS, MERGED = 1 << 14, 64

# A state is four d x d matrices, one behind the other: for columns i and j, over
# the rows that have both, the rows n, the mean of i, the squared deviations of i
# and the products of both deviations.


def _state(x: np.ndarray) -> np.ndarray:
    """The state of some rows; NaN stands for a missing value."""
    there = ~np.isnan(x)
    m = there.astype(np.float64)
    # Shifted by a value of the column itself: a constant one gets exact zeros.
    some = there.any(axis=0)
    shift = np.where(some, x[there.argmax(axis=0), np.arange(x.shape[1])], 0.0)
    y = np.where(there, x - shift, 0.0)
    n, s = m.T @ m, y.T @ m
    safe = np.maximum(n, 1.0)
    return np.stack([n, np.where(n > 0, shift[:, None] + s / safe, 0.0), (y * y).T @ m - s * s / safe, y.T @ y - s * s.T / safe])


def _merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = a[0] + b[0]
    safe = np.maximum(n, 1.0)
    # Where one side has no rows the other's mean stands.
    gap = np.where((a[0] > 0) & (b[0] > 0), b[1] - a[1], 0.0)
    both = a[0] * b[0] / safe
    mean = np.where(a[0] > 0, a[1], b[1]) + gap * b[0] / safe
    return np.stack([n, mean, a[2] + b[2] + gap * gap * both, a[3] + b[3] + gap * gap.T * both])


def _pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per pair of columns, from one state for each task; states of a few
    kilobytes are merged in groups of ``MERGED`` and then by one task, which also
    divides. A constant column gives NULL instead of a division by zero; a pair
    that no row has both of has no line."""
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    at = {c: i for i, c in enumerate(names)}
    d = len(names)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in part.columns])
                total = _state(x) if total is None else _merge(total, _state(x))
        if total is not None:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["task", "state"])

    def total_of(group: pa.Table) -> np.ndarray:
        # In the order of the tasks, so that a repeated run rounds alike.
        states = [np.frombuffer(v, np.float64).reshape(4, d, d) for v in group.sort_by("task").column("state").to_pylist()]
        return functools.reduce(_merge, states)

    def merged(group: pa.Table) -> pa.Table:
        return pa.table({"task": group.column("task")[:1], "state": pa.array([total_of(group).tobytes()], pa.binary())})

    def divided(group: pa.Table) -> pa.Table:
        n, _, m2, c = total_of(group)
        i, j = (np.array([at[pair[side]] for pair in pairs]) for side in (0, 1))
        spread = np.sqrt(m2[i, j] * m2[j, i])
        r = np.divide(c[i, j], spread, out=np.zeros(len(pairs)), where=spread > 0)
        lines = pa.table({
            "column_a": pa.array([a for a, _ in pairs], pa.string()),
            "column_b": pa.array([b for _, b in pairs], pa.string()),
            "n": pa.array(n[i, j].astype(np.int64)),
            "r": pa.array(r, mask=~(spread > 0)),
        })
        return lines.filter(pa.array(n[i, j] > 0))

    values = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(names)])
    states = values.mapInArrow(sums, "task long, state binary")
    tasks = df.sparkSession.sparkContext.defaultParallelism
    if tasks > MERGED:
        states = states.groupBy(F.pmod("task", F.lit(tasks // MERGED))).applyInArrow(merged, "task long, state binary")
    return states.groupBy().applyInArrow(divided, "column_a string, column_b string, n long, r double")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Upper triangle with diagonal, in the order of ``columns``."""
    return _pair_correlations(df, list(combinations_with_replacement(columns, 2)))


def corr_with(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Absolute correlation of every column with the target, strongest first."""
    pairs = _pair_correlations(df, [(target, c) for c in columns if c != target])
    return pairs.select(F.col("column_b").alias("feature"), "n", F.abs("r").alias("abs_r")).orderBy(
        F.desc_nulls_last("abs_r"), "feature"
    )
