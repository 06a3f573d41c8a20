"""From the feature table to what a learner takes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ebbtide.functions.columns import MISSING
from ebbtide.operators.distributions import exact_quantiles
from ebbtide.operators.metrics import class_balance
from ebbtide.plans.features import ID, TARGET

# Columns treated as categories, and the two groups of the ablation.
CATEGORICAL = ["gender", "city", "registered_via", "last_payment_method"]
SUBSCRIPTION = ["last_cancel", "last_auto_renew", "has_transaction_data"]
BEHAVIOUR = [
    "age", "gender", "city", "registered_via", "tenure_days", "has_member_data", "has_age",
    "active_days", "total_secs", "complete_plays", "unique_songs", "partial_plays", "half_plays",
    "three_quarter_plays", "near_complete_plays", "total_plays", "completion_rate",
    "engagement_depth", "avg_daily_secs", "mins_per_song",
]

# Trees get a missing number as a value beyond every real one, on the side that
# the training rows favour; the presence flags carry the same information.
BELOW, ABOVE = -1.0e9, 1.0e9
SHAPED = "__in"


def feature_columns(df: DataFrame, exclude: Sequence[str] = (ID, TARGET)) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def feature_subsets(df: DataFrame) -> dict[str, list[str]]:
    """The full feature list and the two reduced ones of the ablation study."""
    full = feature_columns(df)
    return {
        "full": full,
        "no_subscription": [c for c in full if c not in SUBSCRIPTION],
        "behaviour_only": [c for c in full if c in BEHAVIOUR],
    }


def split_kinds(features: Sequence[str]) -> tuple[list[str], list[str]]:
    """(numeric, categorical) names in their given order."""
    return [c for c in features if c not in CATEGORICAL], [c for c in features if c in CATEGORICAL]


def class_weights(
    df: DataFrame, label: str = TARGET, scheme: str = "balanced", name: str = "weight", balance: Row | None = None
) -> DataFrame:
    """Add a weight per row. ``balanced`` gives both classes the same total and
    leaves the sum at n; ``pos_ratio`` gives positives n_neg / n_pos. The class
    counts are taken from ``balance`` where the caller has them."""
    row = balance or class_balance(df, label).first()
    total = row.n_pos + row.n_neg
    if scheme == "balanced":
        pos, neg = total / (2.0 * max(row.n_pos, 1)), total / (2.0 * max(row.n_neg, 1))
    elif scheme == "pos_ratio":
        pos, neg = row.n_neg / max(row.n_pos, 1), 1.0
    else:
        raise ValueError(f"unknown weighting scheme {scheme!r}")
    return df.withColumn(name, F.when(F.col(label) == 1, F.lit(pos)).otherwise(F.lit(neg)))


# One text for each rule, used on columns and as a stage of a saved pipeline.


def number_sql(column: str) -> str:
    """A number as double; NaN counts as missing."""
    return f"NANVL(CAST(`{column}` AS DOUBLE), CAST(NULL AS DOUBLE))"


def filled_sql(column: str, value: float) -> str:
    return f"COALESCE({number_sql(column)}, {float(value)!r}D)"


def scaled_sql(value: str, mean: float, deviation: float) -> str:
    return f"(({value}) - {float(mean)!r}D) / {float(deviation)!r}D"


def category_sql(column: str) -> str:
    """Category as text, with a sentinel level for NULL."""
    return f"COALESCE(CAST(`{column}` AS STRING), '{MISSING}')"


def shaped(column: str) -> str:
    """The name under which a column enters the learner's stages."""
    return f"{column}{SHAPED}"


def unshaped(name: str) -> str:
    return name.removesuffix("_index").removesuffix(SHAPED)


def shaping(values: Mapping[str, str]) -> SQLTransformer:
    """A stage that adds what learners read, so that a saved pipeline takes raw features."""
    added = ", ".join(f"{sql} AS `{shaped(c)}`" for c, sql in values.items())
    return SQLTransformer(statement=f"SELECT *, {added} FROM __THIS__")


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact training medians, one number per column; 0 for a column without values."""
    found = {r.metric: r.value for r in exact_quantiles(df, columns).collect()}
    return {c: found.get(c, 0.0) for c in columns}


def fill_medians(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    """Columns as double with NULLs replaced by the fitted medians."""
    return df.withColumns({c: F.expr(filled_sql(c, v)) for c, v in medians.items()})


def fit_scaling(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column; a constant column gets 1."""
    aggs = [f(c).alias(f"{f.__name__}_{i}") for i, c in enumerate(columns) for f in (F.avg, F.stddev_pop)]
    row = df.agg(*aggs).first()
    return {c: (row[f"avg_{i}"] or 0.0, row[f"stddev_pop_{i}"] or 1.0) for i, c in enumerate(columns)}


def standardize(df: DataFrame, scaling: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: F.expr(scaled_sql(f"`{c}`", m, s)) for c, (m, s) in scaling.items()})


def missing_sides(
    df: DataFrame, columns: Sequence[str], label: str = TARGET, weight: str = "weight", bins: int = 32
) -> dict[str, float]:
    """For each number the value that stands for a missing one: BELOW or ABOVE.

    Each column that has gaps is cut at quantiles of its values. Over all cuts the
    better of two splits is looked for: gaps with the small values, and gaps with
    the great ones. The side whose best split parts the label better (greater gain
    in weighted squared error) wins; equal gains go below. A cut beyond all values
    parts gaps from values and is open to both sides alike. The table is read
    twice, for quantiles and for counts by cell; a few numbers for each column and
    cell come back.
    """
    numbers = df.select(F.col(label).cast("double").alias("_y"), F.col(weight).alias("_w"), *[F.expr(number_sql(c)).alias(c) for c in columns])
    gaps = numbers.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first().asDict() if columns else {}
    todo = [c for c, n in gaps.items() if n]
    if not todo:
        return {c: BELOW for c in columns}
    probabilities = [i / bins for i in range(1, bins)]
    cuts = {c: v for c, v in zip(todo, numbers.approxQuantile(todo, probabilities, 0.01)) if v}
    if not cuts:
        return {c: BELOW for c in columns}
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("c"),
                F.when(F.col(c).isNull(), -1)
                .otherwise(F.aggregate(F.lit([float(v) for v in sorted(set(cuts[c]))]), F.lit(0), lambda n, cut: n + (F.col(c) > cut).cast("int")))
                .alias("cell"),
            )
            for c in cuts
        ]
    )
    sides = {c: BELOW for c in columns}
    counted: dict[str, dict[int, tuple[float, float]]] = {}
    grouped = numbers.select("_y", "_w", F.inline(cells)).groupBy("c", "cell").agg(F.sum(F.col("_w") * F.col("_y")).alias("g"), F.sum("_w").alias("w"))
    for r in grouped.collect():
        counted.setdefault(r.c, {})[r.cell] = (r.g, r.w)
    for c, of_column in counted.items():
        missing = of_column.pop(-1, (0.0, 0.0))
        total = [sum(v[i] for v in of_column.values()) + missing[i] for i in (0, 1)]
        best = {BELOW: 0.0, ABOVE: 0.0}
        left = [0.0, 0.0]
        for cell in sorted(of_column)[:-1]:
            left = [left[i] + of_column[cell][i] for i in (0, 1)]
            for side, gap in ((BELOW, missing), (ABOVE, (0.0, 0.0))):
                g, w = left[0] + gap[0], left[1] + gap[1]
                parts = [(g, w), (total[0] - g, total[1] - w)]
                best[side] = max(best[side], sum(a * a / b for a, b in parts if b > 0) - total[0] ** 2 / total[1])
        sides[c] = ABOVE if best[ABOVE] > best[BELOW] * (1 + 1e-12) else BELOW
    return sides


def one_hot_stages(categorical: Sequence[str]) -> list:
    """Indexer and encoder. The bucket for unseen levels comes last and is the
    one dropped, so an unseen level is all zeros and no known level is lost."""
    indexed = [f"{c}_index" for c in categorical]
    return [
        StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_onehot" for c in categorical], dropLast=True),
    ]


def linear_stages(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> list:
    """Exact median imputation, scaling to mean 0 and population deviation 1,
    one-hot levels, one feature vector; the numbers are fitted on ``df``."""
    medians = fit_medians(df, numeric)
    scaling = fit_scaling(fill_medians(df, medians), numeric)
    values = {c: scaled_sql(filled_sql(c, medians[c]), *scaling[c]) for c in numeric}
    values |= {c: category_sql(c) for c in categorical}
    levels = [shaped(c) for c in categorical]
    return [
        shaping(values),
        *(one_hot_stages(levels) if levels else []),
        VectorAssembler(inputCols=[*[shaped(c) for c in numeric], *[f"{c}_onehot" for c in levels]], outputCol="features"),
    ]


def tree_stages(numeric: Sequence[str], categorical: Sequence[str], sides: Mapping[str, float]) -> list:
    """Indexed categories keep their nominal metadata in the vector, so trees
    split them by sets of levels."""
    values = {c: filled_sql(c, sides[c]) for c in numeric} | {c: category_sql(c) for c in categorical}
    levels = [shaped(c) for c in categorical]
    indexed = [f"{c}_index" for c in levels]
    indexer = [StringIndexer(inputCols=levels, outputCols=indexed, handleInvalid="keep")]
    return [
        shaping(values),
        *(indexer if levels else []),
        VectorAssembler(inputCols=[*[shaped(c) for c in numeric], *indexed], outputCol="features"),
    ]
