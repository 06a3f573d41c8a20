"""Exact quantiles per group and histograms with equal-width bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.columns import clip_upper
from ebbtide.operators.prefix import running_sums, with_order_key
from ebbtide.operators.small import join_groups
from ebbtide.session import staged


#: Quantile ranks that are followed at once; more groups are ranked by running sums.
FOLLOWED = 20_000
#: Values of a cell that are told apart in one pass.
RESOLVED = 1 << 16


def _long(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(by…, metric, value) of every value that is not NULL."""
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*by, F.inline(cells)).where("value IS NOT NULL")


def _hits(counts: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For each target the cell that holds its rank, the rank inside that cell, and
    the least and greatest value there."""
    upto = F.sum("n").over(Window.partitionBy("target").orderBy("cell"))
    found = join_groups(counts, F.broadcast(targets), keys).withColumn("_upto", upto)
    hit = found.where("_upto > rank AND _upto - n <= rank")
    return hit.select("target", F.col("cell").alias("prefix"), (F.col("rank") - F.col("_upto") + F.col("n")).alias("rank"), "n", "low", "high")


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], qs: Sequence[float] = (0.5,), by: Sequence[str] = ()
) -> DataFrame:
    """Interpolated quantiles per group and column: rows (by…, metric, q, value).

    Radix selection: values are counted by the leading 16 bits of their order key,
    the cells that hold the wanted ranks are found, and only their values are
    counted by the next 16 bits, until a cell holds one value: four passes at most,
    and a cell of ``RESOLVED`` values or fewer is counted by value at once. Counts are combined in the map task, so
    a pass moves 65,536 numbers for each group and column at most, and nothing is
    sorted. The passes read a narrow table of the values and their keys, written once,
    since the input may be costly and a key takes more work than a count. The two ranks of each group, column and quantile come to the
    driver if there are ``FOLLOWED`` of them at most; more groups are ranked by
    running sums.
    """
    keys = [*by, "metric"]
    spark = df.sparkSession
    rows = staged(with_order_key(_long(df, by, columns), "value"), "values")
    ends = [F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")]
    whole, order = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("cell")
    counts = rows.groupBy(*keys, F.shiftright("_key", 48).alias("cell")).agg(*ends)
    counts = counts.withColumns({"_upto": F.sum("n").over(order), "_at": F.sum("n").over(whole) - 1})
    wanted = counts.withColumn("q", F.explode(F.lit([float(q) for q in qs]))).withColumn("_at", F.col("q") * F.col("_at"))
    wanted = wanted.withColumn("rank", F.explode(F.array(F.floor("_at"), F.ceil("_at"))))
    first = wanted.where("_upto > rank AND _upto - n <= rank").select(
        *keys, "q", (F.col("_at") - F.floor("_at")).alias("weight"), (F.col("rank") > F.floor("_at")).alias("upper"),
        F.col("cell").alias("prefix"), (F.col("rank") - F.col("_upto") + F.col("n")).alias("rank"), "n", "low", "high",
    )
    told = first.limit(FOLLOWED + 1).collect()
    if len(told) > FOLLOWED:
        return _quantiles_by_rank(df, columns, qs, by)
    groups: dict[tuple, int] = {}
    for r in told:
        groups.setdefault(tuple(r[k] for k in keys), len(groups))
    state = {t: r for t, r in enumerate(told)}
    cell_shape = T.StructType(
        [*rows.select(*keys).schema, T.StructField("group", T.IntegerType()), T.StructField("prefix", T.LongType())]
    )
    shift = 48
    # NaN is one value, and equal to itself here.
    while todo := [t for t, r in state.items() if r["low"] != r["high"] and not (r["low"] != r["low"] and r["high"] != r["high"])]:
        shift, before = 0 if max(state[t]["n"] for t in todo) <= RESOLVED else shift - 16, shift
        targets = spark.createDataFrame(
            [(t, groups[tuple(told[t][k] for k in keys)], state[t]["prefix"], state[t]["rank"]) for t in todo],
            "target int, group int, prefix long, rank long",
        )
        spots = {(tuple(told[t][k] for k in keys), state[t]["prefix"]) for t in todo}
        cells = F.broadcast(spark.createDataFrame([(*k, groups[k], prefix) for k, prefix in spots], cell_shape))
        near = join_groups(rows.withColumn("prefix", F.shiftright("_key", before)), cells, keys, plain=["prefix"])
        counts = near.groupBy("group", "prefix", F.shiftright("_key", shift).alias("cell")).agg(*ends)
        state.update({r["target"]: r for r in _hits(counts, targets, ["group", "prefix"]).collect()})
    out: dict[tuple, dict[bool, float]] = {}
    for t, r in enumerate(told):
        out.setdefault((*[r[k] for k in keys], r["q"], r["weight"]), {})[r["upper"]] = state[t]["low"]
    lines = [(*k[:-1], v[False] * (1.0 - k[-1]) + v.get(True, v[False]) * k[-1]) for k, v in out.items()]
    shape = [*rows.select(*keys).schema, T.StructField("q", T.DoubleType()), T.StructField("value", T.DoubleType())]
    return spark.createDataFrame(lines, T.StructType(shape))


def _quantiles_by_rank(df: DataFrame, columns: Sequence[str], qs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """The same for any number of groups: equal values are combined and ranked by
    running sums, and a quantile is read off at its two ranks."""
    keys = [*by, "metric"]
    frequencies = _long(df, by, columns).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_sums(frequencies, "value", ["n"], within=keys)
    each_q = ranked.withColumn("q", F.explode(F.lit([float(q) for q in qs]))).withColumn(
        "_at", F.col("q") * (F.col("n_total") - 1)
    )
    low, high = F.floor("_at"), F.ceil("_at")
    hit = each_q.where((F.col("n_upto") > low) & (F.col("n_upto") - F.col("n") <= high))
    at_low = F.min(F.when((F.col("n_upto") - F.col("n") <= low) & (F.col("n_upto") > low), F.col("value")))
    at_high = F.max(F.when((F.col("n_upto") - F.col("n") <= high) & (F.col("n_upto") > high), F.col("value")))
    weight = F.max(F.col("_at") - F.floor("_at"))
    return hit.groupBy(*keys, "q").agg(
        (at_low * (F.lit(1.0) - weight) + at_high * weight).alias("value")
    )


def group_median(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Exact medians, one row per group and one column per measure."""
    long = exact_quantiles(df, columns, (0.5,), by)
    picks = [F.max(F.when(F.col("metric") == c, F.col("value"))).alias(f"median_{c}") for c in columns]
    return long.groupBy(*by).agg(*picks)


def group_median_approx(df: DataFrame, by: Sequence[str], columns: Sequence[str], accuracy: int = 10000) -> DataFrame:
    """Medians within a rank error of 1/accuracy, in a single aggregation."""
    return df.groupBy(*by).agg(*[F.percentile_approx(c, 0.5, accuracy).alias(f"median_{c}") for c in columns])


def histogram(
    df: DataFrame,
    column: str,
    bins: int,
    by: Sequence[str] = (),
    clip: float | None = None,
    density: bool = False,
) -> DataFrame:
    """Rows (by…, bin, lower, upper, n[, density]), one for each bin, empty ones too.

    Every group has its own range from its smallest to its greatest value. Bins
    are half open, the last one is closed. A group with one value gets a range
    of width 1 around it. NULL and NaN are left out.
    """
    value = F.col(column).cast("double")
    value = clip_upper(value, float(clip)) if clip is not None else value
    # Combined by value first: the range and the bins both read that one exchange.
    counts = (
        df.select(*by, value.alias("_v"))
        .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        .groupBy(*by, "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    keys = list(by)
    flat = F.min("_v") == F.max("_v")
    low = F.when(flat, F.min("_v") - 0.5).otherwise(F.min("_v"))
    high = F.when(flat, F.max("_v") + 0.5).otherwise(F.max("_v"))
    ranges = (
        counts.groupBy(*keys)
        .agg(low.alias("_lo"), high.alias("_hi"), F.sum("_n").alias("_total"))
        .where("_total IS NOT NULL")
        .withColumn("_width", (F.col("_hi") - F.col("_lo")) / F.lit(float(bins)))
    )
    if keys:
        ranged = join_groups(counts, ranges, keys)
    else:
        # One range for all: a number that the plan looks up, not a join on a constant.
        whole = ranges.select(F.struct("_lo", "_width")).scalar()
        ranged = counts.withColumn("_r", whole).select("_v", "_n", "_r.*")
    # The edges decide where rounding put a value next to its bin.
    v, lo, w, g = F.col("_v"), F.col("_lo"), F.col("_width"), F.col("_guess")
    cell = F.when(v < g * w + lo, g - 1).when((v >= (g + 1) * w + lo) & (g < bins - 1), g + 1).otherwise(g)
    counted = (
        ranged.withColumn("_guess", F.least(((v - lo) / w).cast("int"), F.lit(bins - 1)))
        .withColumn("bin", cell)
        .groupBy(*keys, "bin")
        .agg(F.sum("_n").alias("n"))
    )
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    full = join_groups(grid, counted, keys, "left", plain=["bin"]).fillna(0, subset=["n"])
    b = F.col("bin")
    upper = F.when(b == bins - 1, F.col("_hi")).otherwise((b + 1) * w + lo)
    out = full.select(*by, "bin", (b * w + lo).alias("lower"), upper.alias("upper"), "n", "_total")
    if density:
        out = out.withColumn("density", F.col("n") / F.col("_total") / (F.col("upper") - F.col("lower")))
    return out.drop("_total")
