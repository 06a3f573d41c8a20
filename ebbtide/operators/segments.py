"""Group summaries of a label or a value: rates, shares, cohorts, roll-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.columns import ymd_month
from ebbtide.operators.latest import top_k


def segment_rate(
    df: DataFrame,
    keys: Mapping[str, Column] | Sequence[str],
    label: str,
    min_n: int = 0,
    k: int | None = None,
    digits: int = 2,
    rate_name: str = "churn_rate",
) -> DataFrame:
    """Size and mean label (in percent) per group with more than ``min_n`` rows.

    ``keys`` are columns or named expressions. With ``k`` only the largest
    groups are kept, ordered by size and then by key.
    """
    named = keys if isinstance(keys, Mapping) else {name: F.col(name) for name in keys}
    rates = (
        df.groupBy(*[c.alias(name) for name, c in named.items()])
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.avg(label) * F.lit(100.0), digits).alias(rate_name),
        )
        .where(F.col("n") > min_n)
    )
    return rates if k is None else top_k(rates, "n", list(named), k)


def cohort_rate(df: DataFrame, joined_on: str, label: str, after: int, min_n: int = 100) -> DataFrame:
    """Label rate by sign-up month, for sign-ups after a given YYYYMMDD day."""
    known = df.where(F.col(joined_on).isNotNull() & (F.col(joined_on) > after))
    return segment_rate(known, {"reg_month": ymd_month(joined_on)}, label, min_n)


def rollup_rates(rates: DataFrame, key: str, rate: str = "churn_rate") -> DataFrame:
    """Second level over group rates: total size and unweighted mean of the rates."""
    return rates.groupBy(key).agg(F.sum("n").alias("n"), F.avg(rate).alias(rate))


def value_shares(df: DataFrame, column: str, k: int | None = None, digits: int = 2) -> DataFrame:
    """Frequency and share in percent of every value; the total is the sum of the
    frequencies, from the same exchange."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n")).scalar()
    shares = counts.withColumn("pct", F.round(F.col("n") * F.lit(100.0) / total, digits))
    return shares if k is None else top_k(shares, "n", [column], k)


def value_counts(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Frequency of every value, or of the k most frequent ones."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts if k is None else top_k(counts, "n", [column], k)


def summarize(df: DataFrame, **aggs: Column) -> DataFrame:
    """One row of named aggregates."""
    return df.agg(*[c.alias(name) for name, c in aggs.items()])
