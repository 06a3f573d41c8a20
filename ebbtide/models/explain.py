"""Why a model says what it says: importances and additive attributions."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.models.learners import Fitted
from ebbtide.models.prepare import unshaped
from ebbtide.operators.distributions import exact_quantiles
from ebbtide.session import scratch_path

# Tasks get the code of this module with their function, so that workers need
# not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def vector_names(transformed: DataFrame, column: str = "features") -> list[str]:
    """Names of the slots of an assembled vector, from its metadata."""
    groups = transformed.schema[column].metadata["ml_attr"]["attrs"].values()
    slots = sorted((a for g in groups for a in g), key=lambda a: a["idx"])
    return [unshaped(a["name"]) for a in slots]


def gain_importance(fitted: Fitted, sample: DataFrame, k: int = 25) -> DataFrame:
    """The k features with the greatest total gain."""
    names = vector_names(fitted.model.transform(sample.limit(0)))
    gains = fitted.model.stages[-1].featureImportances.toArray()
    rows = [(n, float(g)) for n, g in zip(names, gains)]
    return (
        sample.sparkSession.createDataFrame(rows, "feature string, gain double")
        .orderBy(F.desc("gain"), "feature")
        .limit(k)
    )


def node_table(spark: SparkSession, fitted: Fitted) -> DataFrame:
    """The nodes of all trees as rows, from the saved form of the model."""
    path = scratch_path(spark, "trees")
    fitted.model.stages[-1].write().overwrite().save(path)
    node = "nodeData."
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        *[F.col(node + c).alias(c) for c in ("id", "prediction", "leftChild", "rightChild")],
        F.get(node + "impurityStats", F.lit(0)).alias("cover"),
        F.col(node + "split.featureIndex").alias("feature"),
        F.col(node + "split.leftCategoriesOrThreshold").alias("cut"),
        F.col(node + "split.numCategories").alias("levels"),
    )


# The paths of one tree are plain arrays, (value, feature, low, high, share,
# levels), one row per leaf and one slot per feature on its path: the interval
# (low, high] the feature must lie in, and the share of the training weight that
# goes this way at the splits on it. ``levels`` maps (leaf, slot) to the allowed
# categories. Short paths are filled up with tests that always hold, which
# changes nothing.
_Paths = tuple


def _base(paths: _Paths) -> float:
    return float(paths[0] @ paths[4].prod(axis=1))


def _add_tree(paths: _Paths, x: np.ndarray, phi: np.ndarray, rules: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
    """Add the attributions of all rows of x to phi.

    The Shapley weights of coalitions by size are the integral over t in (0, 1)
    of t^s (1 - t)^(d - 1 - s). So a slot's value is the integral of the product
    over the other slots of share * (1 - t) + passed * t, a polynomial in t that
    Gauss-Legendre points integrate exactly. Each leaf takes d * ceil(d / 2)
    steps for d slots; ``rules`` keeps the points by d.
    """
    value, feature, low, high, share, levels = paths
    d = share.shape[1]
    if d not in rules:
        at, weight = np.polynomial.legendre.leggauss((d + 1) // 2)
        rules[d] = ((at + 1) / 2, weight / 2)
    t, weight = rules[d]
    for leaf, features in enumerate(feature):
        v = x[:, features]
        ok = (v > low[leaf]) & (v <= high[leaf])
        for j in range(d):
            if (leaf, j) in levels:
                ok[:, j] = np.isin(v[:, j], levels[leaf, j])
        factor = share[leaf][None, :, None] * (1 - t) + ok[:, :, None] * t
        others = ((factor.prod(axis=1, keepdims=True) / factor) * weight).sum(axis=2)
        parts = value[leaf] * (ok - share[leaf]) * others
        for j, f in enumerate(features):
            phi[:, f] += parts[:, j]


def _tree_paths(nodes: pd.DataFrame, weight: float) -> _Paths:
    """Walk one tree from its root and note the tests of each leaf."""
    by_id = {n.id: n for n in nodes.itertuples()}
    leaves: list[tuple[float, dict]] = []
    todo: list[tuple] = [(by_id[0], {})]
    while todo:
        node, tests = todo.pop()
        if node.leftChild < 0:
            leaves.append((node.prediction * weight, tests))
            continue
        low, high, allowed, share = tests.get(node.feature, (-np.inf, np.inf, None, 1.0))
        for child, left in ((by_id[node.leftChild], True), (by_id[node.rightChild], False)):
            part = share * child.cover / node.cover
            if node.levels < 0:
                at = float(node.cut[0])
                test = (low, min(high, at), allowed, part) if left else (max(low, at), high, allowed, part)
            else:
                side = set(node.cut) if left else set(map(float, range(node.levels))) - set(node.cut)
                test = (low, high, side if allowed is None else side & allowed, part)
            todo.append((child, {**tests, node.feature: test}))
    shape = (len(leaves), max(1, max(len(t) for _, t in leaves)))
    feature, share, levels = np.zeros(shape, dtype=int), np.ones(shape), {}
    low, high = np.full(shape, -np.inf), np.full(shape, np.inf)
    for i, (_, tests) in enumerate(leaves):
        for j, (f, (lo, hi, allowed, part)) in enumerate(tests.items()):
            feature[i, j], low[i, j], high[i, j], share[i, j] = f, lo, hi, part
            if allowed is not None:
                levels[i, j] = sorted(allowed)
    return np.array([v for v, _ in leaves]), feature, low, high, share, levels


def attributions(fitted: Fitted, df: DataFrame, user: str) -> tuple[DataFrame, float]:
    """Shapley attributions of a tree model: rows (user, feature, value, phi)
    and the base value. Base plus the phi of a row is its raw margin, the
    weighted sum of the trees.

    This is the path-dependent form: a feature outside the coalition follows
    both branches in the shares of the training weight. Spark spreads the rows;
    the paths of the model go to every task, a few numbers per leaf.
    """
    spark = df.sparkSession
    weights = list(fitted.model.stages[-1].treeWeights)
    nodes = node_table(spark, fitted).toPandas()
    trees = [_tree_paths(part, weights[tree]) for tree, part in nodes.groupby("tree")]
    shared = spark.sparkContext.broadcast(trees)
    rows = fitted.model.transform(df)
    names = vector_names(rows)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rules: dict = {}
        for batch in batches:
            if len(batch):
                x = np.vstack(batch["x"].to_numpy())
                phi = np.zeros_like(x)
                for tree in shared.value:
                    _add_tree(tree, x, phi, rules)
                yield pd.DataFrame({user: batch[user], "x": list(x), "phi": list(phi)})

    kind = dict(df.dtypes)[user]
    explained = rows.select(user, vector_to_array("features").alias("x")).mapInPandas(
        explain, f"{user} {kind}, x array<double>, phi array<double>"
    )
    return _long(explained, user, names), sum(_base(tree) for tree in trees)


def _long(explained: DataFrame, user: str, names: list[str]) -> DataFrame:
    slots = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), F.col("x"), F.col("phi"))
    return explained.select(user, F.inline(slots)).toDF(user, "feature", "value", "phi")


def linear_attributions(fitted: Fitted, df: DataFrame, background: DataFrame, user: str) -> tuple[DataFrame, float]:
    """Attributions of the logistic model on the log-odds: w · (x − mean).

    A category has one slot for each level; they are added up to one row of the
    feature, which has no value.
    """
    learner = fitted.model.stages[-1]
    means = (
        fitted.model.transform(background)
        .agg(Summarizer.mean(F.col("features")).alias("m"))
        .first()
        .m.toArray()
    )
    w = learner.coefficients.toArray()
    rows = fitted.model.transform(df)
    size = len(w)
    centred = F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)),
        lambda i: (F.get("x", i) - F.get(F.lit([float(v) for v in means]), i)) * F.get(F.lit([float(v) for v in w]), i),
    )
    explained = rows.select(user, vector_to_array("features").alias("x")).withColumn("phi", centred)
    levels = [len(v) for stage in fitted.model.stages if isinstance(stage, StringIndexerModel) for v in stage.labelsArray]
    n = len(fitted.numeric)
    starts = [n + sum(levels[:i]) for i in range(len(levels))]
    total = [F.aggregate(F.slice("phi", a + 1, k), F.lit(0.0), lambda s, v: s + v) for a, k in zip(starts, levels)]
    explained = explained.select(
        user,
        F.concat(F.slice("x", 1, n), F.array_repeat(F.lit(None).cast("double"), len(levels))).alias("x"),
        F.concat(F.slice("phi", 1, n), F.array(*total) if total else F.array().cast("array<double>")).alias("phi"),
    )
    return _long(explained, user, [*fitted.numeric, *fitted.categorical]), float(learner.intercept + w @ means)


def global_attribution(phi: DataFrame, k: int = 20) -> DataFrame:
    """Mean absolute attribution per feature, the k greatest."""
    return (
        phi.groupBy("feature")
        .agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))
        .orderBy(F.desc("mean_abs_phi"), "feature")
        .limit(k)
    )


def attribution_direction(phi: DataFrame) -> DataFrame:
    """Per feature: quartiles of phi and its correlation with the feature value."""
    quartiles = exact_quantiles(phi, ["phi"], (0.0, 0.25, 0.5, 0.75, 1.0), by=["feature"])
    wide = quartiles.groupBy("feature").agg(
        *[
            F.max(F.when(F.col("q") == q, F.col("value"))).alias(name)
            for q, name in ((0.0, "phi_min"), (0.25, "phi_q1"), (0.5, "phi_median"), (0.75, "phi_q3"), (1.0, "phi_max"))
        ]
    )
    slope = F.try_divide(F.covar_pop("phi", "value"), F.stddev_pop("phi") * F.stddev_pop("value"))
    return wide.join(phi.groupBy("feature").agg(slope.alias("value_corr")), "feature")


def explain_row(phi: DataFrame, user: str, who: DataFrame, k: int = 12) -> DataFrame:
    """The strongest contributions of the users in ``who``, in k lines each: when
    there are more features, the last line sums up the others."""
    mine = phi.join(who.select(user).distinct(), user, "left_semi")
    strongest = Window.partitionBy(user).orderBy(F.desc(F.abs("phi")), "feature")  # one row per feature
    ranked = mine.withColumns(
        {"_rank": F.row_number().over(strongest), "_all": F.count(F.lit(1)).over(Window.partitionBy(user))}
    )
    alone = (F.col("_all") <= k) | (F.col("_rank") < k)
    line = F.when(alone, F.col("_rank")).otherwise(F.lit(k))
    name = F.when(alone, F.col("feature")).otherwise(F.lit("other"))
    return (
        ranked.groupBy(user, line.alias("line"), name.alias("feature"))
        .agg(F.sum("phi").alias("phi"), F.first(F.when(alone, F.col("value"))).alias("value"))
    )
