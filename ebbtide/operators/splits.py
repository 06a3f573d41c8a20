"""Reproducible splits, folds and samples from a hash of the user key.

The hash depends on the key and a seed only, never on the layout of the data,
so a lost executor, another cluster or a SQL engine draws the same rows.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_BITS = 32
SPACE = 1 << HASH_BITS


def key_hash(key: str, seed: int | str) -> Column:
    """32 bits of the MD5 of "<seed>:<key>" as a non-negative integer."""
    text = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def stratified_split(df: DataFrame, key: str, label: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test``, with each class's share to the row (all classes together
    ``ceil(share * n)``): a class is cut at its k-th smallest (hash, key)."""
    hashed = df.withColumn("_h", key_hash(key, seed))
    sizes, cells = _cells(hashed, label)
    ranks = {c: [n] for c, n in _quotas(sizes, test_share).items()}
    above = _cuts_passed(hashed, key, label, cells, ranks)
    return hashed.withColumn("is_test", (above == 0).cast("int")).drop("_h")


def folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Add a fold number; the folds of every class differ by one row at most.

    The hash differs from the split's, so a training set is cut as evenly as the
    whole table.
    """
    hashed = df.withColumn("_h", key_hash(key, f"fold{seed}"))
    sizes, cells = _cells(hashed, label)
    ranks = {c: [n * j // k for j in range(1, k)] for c, n in sizes.items()}
    return hashed.withColumn(name, _cuts_passed(hashed, key, label, cells, ranks)).drop("_h")


def _cells(hashed: DataFrame, label: str) -> tuple[dict, dict]:
    """Rows of each class, and its histogram over the top 16 bits of the hash
    (65,536 numbers for a class at most, whatever the number of rows)."""
    cells: dict = {}
    for r in hashed.groupBy(label, F.shiftright("_h", HASH_BITS - 16).alias("cell")).count().collect():
        cells.setdefault(r[label], {})[r["cell"]] = r["count"]
    return {c: sum(v.values()) for c, v in cells.items()}, cells


def _cuts_passed(hashed: DataFrame, key: str, label: str, cells: dict, ranks: dict) -> Column:
    """How many cuts of its class lie below a row; a cut is the row of a given rank by (hash, key).

    The histogram tells the cell of each cut. Only rows of those cells, about one
    in 65,536, are ranked; what comes back is a few cut points for each class,
    and marking the rows is then a comparison, without a shuffle.
    """
    wanted: dict = {}
    for c, of_class in ranks.items():
        seen = 0
        todo = sorted({r for r in of_class if r > 0})
        for cell in sorted(cells[c]):
            seen += cells[c][cell]
            while todo and todo[0] <= seen:
                rank = todo.pop(0)
                wanted.setdefault((c, cell), []).append((rank - seen + cells[c][cell], rank))
    cuts: dict = {}
    if wanted:
        cell = F.shiftright("_h", HASH_BITS - 16)
        spots: dict = {}
        for c, at in wanted:
            spots.setdefault(c, []).append(at)
        chosen = functools.reduce(
            lambda a, b: a | b, [F.col(label).eqNullSafe(F.lit(c)) & cell.isin(at) for c, at in spots.items()]
        )
        place = F.row_number().over(Window.partitionBy(label, "_cell").orderBy("_h", key))
        ranked = hashed.where(chosen).select(label, key, "_h", cell.alias("_cell")).withColumn("_rn", place)
        rows = functools.reduce(
            lambda a, b: a | b,
            [
                F.col(label).eqNullSafe(F.lit(c)) & (F.col("_cell") == at) & F.col("_rn").isin([n for n, _ in places])
                for (c, at), places in wanted.items()
            ],
        )
        for r in ranked.where(rows).collect():
            rank = dict(wanted[r[label], r["_cell"]])[r["_rn"]]
            cuts[r[label], rank] = (r["_h"], r[key])
    here = F.struct(F.col("_h"), F.col(key).alias("_key"))
    kind = dict(hashed.dtypes)[key]
    out = F.lit(0)
    for c, of_class in ranks.items():
        passed = F.lit(0)
        for rank in of_class:
            if rank > 0:
                h, k = cuts[c, rank]
                cut = F.struct(F.lit(h).cast("long").alias("_h"), F.lit(k).cast(kind).alias("_key"))
                passed = passed + (here > cut).cast("int")
            else:
                passed = passed + F.lit(1)
        out = F.when(F.col(label).eqNullSafe(F.lit(c)), passed).otherwise(out)
    return out


def _quotas(sizes: dict, share: float) -> dict:
    """Whole rows per class by largest remainder; the total is rounded up."""
    total = sum(sizes.values())
    wanted = -int(-share * total // 1)
    parts = {c: wanted * n / total for c, n in sizes.items()}
    quota = {c: int(v) for c, v in parts.items()}
    for c in sorted(parts, key=lambda c: (quota[c] - parts[c], str(c)))[: wanted - sum(quota.values())]:
        quota[c] += 1
    return quota


def hash_sample(df: DataFrame, key: str, n: int = 2000, seed: int = 42) -> DataFrame:
    """n rows without replacement: the smallest hashes, by per-task top-n."""
    return df.withColumn("_h", key_hash(key, f"sample{seed}")).orderBy("_h", key).limit(n).drop("_h")


def first_match(df: DataFrame, mask: Column, key: str) -> DataFrame:
    """The row with the smallest key that satisfies the mask."""
    return df.where(mask).orderBy(key).limit(1)
