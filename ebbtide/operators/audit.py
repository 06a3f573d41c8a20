"""Missing and invalid values, join coverage, and checks that can stop a run.

A check is a row (model, column, test, failures). Checks that look at single
values share one scan of their table.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rule_counts(rules: Mapping[str, Column], percent: Sequence[str] = (), digits: int = 1) -> list[Column]:
    """Aggregates: all rows, rows breaking each rule, shares on request."""
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    for name, broken in rules.items():
        aggs.append(F.count_if(broken).alias(name))
        if name in percent:
            share = F.try_divide(F.count_if(broken) * F.lit(100.0), F.count(F.lit(1)))
            aggs.append(F.round(share, digits).alias(f"{name}_pct"))
    return aggs


def rule_audit(df: DataFrame, rules: Mapping[str, Column], percent: Sequence[str] = (), digits: int = 1) -> DataFrame:
    """Rows breaking each rule, all counted in one pass, with shares on request."""
    return df.agg(*rule_counts(rules, percent, digits))


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column, one row for each column."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "column_name", "null_count")


def coverage(base: DataFrame, sides: Mapping[str, DataFrame], key: str, label: str | None = None) -> DataFrame:
    """Base rows with a 0/1 column per side that knows their key.

    Keys are made distinct before the join: a key that fills a third of a side
    is one row by then.
    """
    out = base.select(key, *([label] if label else []))
    for name, side in sides.items():
        keys = side.select(key).distinct().withColumn("_seen", F.lit(1))
        out = out.join(keys, key, "left").withColumn(name, F.col("_seen").isNotNull().cast("int")).drop("_seen")
    return out


def coverage_audit(
    base: DataFrame, sides: Mapping[str, DataFrame], key: str, label: str, digits: int = 2
) -> DataFrame:
    """Size, share and label rate of: everyone, users in all sides, and users
    missing from each side. The groups overlap, so each row of the base is
    counted once per group it belongs to, in one aggregation."""
    seen = coverage(base, sides, key, label)
    everywhere = functools.reduce(lambda a, b: a & b, [F.col(s) == 1 for s in sides])
    groups = {"all": F.lit(True), "full_data": everywhere}
    groups |= {f"no_{s}": F.col(s) == 0 for s in sides}
    member = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in groups.items()]))
    per_group = (
        seen.select(label, F.explode(member).alias("data_group"))
        .groupBy("data_group")
        .agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("rate"))
    )
    total = F.max(F.when(F.col("data_group") == "all", F.col("n"))).over(Window.partitionBy())  # few rows
    return per_group.select(
        "data_group",
        "n",
        F.round(F.col("n") * F.lit(100.0) / total, digits).alias("pct"),
        F.round(F.col("rate") * F.lit(100.0), digits).alias("churn_rate"),
    )


def not_null(column: str) -> tuple[str, str, Column]:
    return column, "not_null", F.count_if(F.col(column).isNull())


def accepted_values(column: str, values: Sequence) -> tuple[str, str, Column]:
    return column, "accepted_values", F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def in_range(column: str, low, high) -> tuple[str, str, Column]:
    return column, "in_range", F.count_if(F.col(column).isNotNull() & ~F.col(column).between(low, high))


CHECK_COLUMNS = ["model", "column_name", "test", "failures"]


def _check_rows(model: str, checks: Sequence[tuple[str, str]], counted: DataFrame) -> DataFrame:
    """Counts c0, c1, … of one row as check rows."""
    rows = F.array(
        *[
            F.struct(
                F.lit(model).alias("model"),
                F.lit(column).alias("column_name"),
                F.lit(test).alias("test"),
                F.col(f"c{i}").alias("failures"),
            )
            for i, (column, test) in enumerate(checks)
        ]
    )
    return counted.select(F.inline(rows))


def value_checks(model: str, df: DataFrame, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Evaluate all single-value checks of one table in one aggregation."""
    counted = df.agg(*[agg.alias(f"c{i}") for i, (_, _, agg) in enumerate(checks)])
    return _check_rows(model, [c[:2] for c in checks], counted)


def keyed_checks(model: str, df: DataFrame, key: str, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Single-value checks and uniqueness of the key in one aggregation: rows are
    counted for each key, then the counts are summed up."""
    named = {f"c{i}": agg for i, (_, _, agg) in enumerate(checks)}
    by_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[agg.alias(c) for c, agg in named.items()])
    repeated = F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias(f"c{len(named)}")
    none = F.lit(0).cast("long")
    counted = by_key.agg(*[F.coalesce(F.sum(c), none).alias(c) for c in named], repeated)
    return _check_rows(model, [*[c[:2] for c in checks], (key, "unique")], counted)


def unique_check(model: str, df: DataFrame, column: str) -> DataFrame:
    """Number of values that occur more than once; NULL is not a value."""
    repeated = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit("unique").alias("test"), "failures"
    )


def reference_check(model: str, child: DataFrame, column: str, parents: Sequence[DataFrame]) -> DataFrame:
    """Child rows whose key no parent holds. The child is counted per key first."""
    orphans = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    for parent in parents:
        orphans = orphans.join(parent.select(column).distinct(), column, "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("failures")).select(
        F.lit(model).alias("model"),
        F.lit(column).alias("column_name"),
        F.lit("relationship").alias("test"),
        "failures",
    )


def all_checks(parts: Sequence[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


class ChecksFailed(RuntimeError):
    pass


def refuse(checks: Sequence[tuple[str, str, str, int]]) -> None:
    """Raise when any of the collected check rows has failures."""
    failed = [c for c in checks if c[3] > 0]
    if failed:
        raise ChecksFailed("; ".join(f"{model}.{column} {test}: {n}" for model, column, test, n in failed))


def gate(checks: DataFrame) -> None:
    """Raise when any check has failures; call it before the next stage is written."""
    refuse([tuple(r) for r in checks.select(*CHECK_COLUMNS).where("failures > 0").collect()])  # one row per declared check
