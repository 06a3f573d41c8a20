"""Quality of scores: losses, ranking metrics, curves, threshold sweeps, drift.

Every function takes rows of a 0/1 label and a probability. A row without a
label, or whose probability is NULL or NaN, is left out of all of them alike
(``scored``); ``left_out`` counts such rows. Ratios over no rows are NULL.
Ranking metrics first combine equal scores, so a score shared by a third of all
rows is one row.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.columns import percent_lift, safe_divide
from ebbtide.operators.prefix import running_sums

EPS = 2.0**-52  # machine epsilon of a double

# 0.05, 0.06, … 0.94 exactly as a floating-point range with step 0.01 yields
# them; a score equal to a cut point counts as positive.
_STEP = (0.05 + 0.01) - 0.05
THRESHOLDS = [0.05 + i * _STEP for i in range(90)]

METRICS = ["log_loss", "roc_auc", "pr_auc", "f1"]


def _loss(y: Column, p: Column) -> Column:
    p = F.greatest(F.lit(EPS), F.least(F.lit(1.0 - EPS), p))
    return F.when(y == 1, -F.log(p)).otherwise(-F.log(F.lit(1.0) - p))


def _known(p: str) -> Column:
    return F.col(p).isNotNull() & ~F.isnan(F.col(p).cast("double"))


def scored(pred: DataFrame, y: str = "y_true", p: str = "y_prob") -> DataFrame:
    """The rows that count."""
    return pred.where(F.col(y).isNotNull() & _known(p))


def left_out(pred: DataFrame, y: str = "y_true", p: str = "y_prob") -> DataFrame:
    """How many rows count, and how many do not for want of a label or a probability."""
    return pred.agg(
        F.count_if(F.col(y).isNotNull() & _known(p)).alias("n_scored"),
        F.count_if(F.col(y).isNull()).alias("n_without_label"),
        F.count_if(~_known(p)).alias("n_without_probability"),
    )


def log_loss(pred: DataFrame, y: str = "y_true", p: str = "y_prob") -> DataFrame:
    return scored(pred, y, p).agg(F.avg(_loss(F.col(y), F.col(p))).alias("log_loss"))


def brier(pred: DataFrame, y: str = "y_true", p: str = "y_prob") -> DataFrame:
    return scored(pred, y, p).agg(F.avg((F.col(p) - F.col(y)) * (F.col(p) - F.col(y))).alias("brier"))


def alert_share(pred: DataFrame, p: str = "y_prob", over: float = 0.5) -> DataFrame:
    """Share of rows whose probability lies above a cut."""
    return pred.where(_known(p)).agg(
        F.count_if(F.col(p) > over).alias("n_over"),
        F.try_divide(F.count_if(F.col(p) > over), F.count(p)).alias("share_over"),
    )


def score_counts(pred: DataFrame, y: str = "y_true", p: str = "y_prob") -> DataFrame:
    """Positives and negatives per distinct score."""
    return scored(pred, y, p).groupBy(F.col(p).alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")
    )


def ranked_counts(pred: DataFrame, y: str = "y_true", p: str = "y_prob") -> DataFrame:
    """Score counts with running counts from the highest score down."""
    return running_sums(score_counts(pred, y, p), "score", ["pos", "neg"], descending=True)


def _auc_terms() -> tuple[Column, Column]:
    """Ranking areas as sums over distinct scores, highest first.

    ROC: every positive beats the negatives below it and half of those tied.
    Average precision: precision at each score weighted by the positives it adds.
    """
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    lost = F.sum(F.col("pos") * (F.col("neg_upto") - F.col("neg") / F.lit(2.0)))
    roc = F.when(pairs > 0, (pairs - lost) / pairs)
    precision = F.coalesce(F.try_divide("pos_upto", F.col("pos_upto") + F.col("neg_upto")), F.lit(0.0))
    ap = F.when(F.sum("pos") > 0, F.sum(F.col("pos") * precision) / F.sum("pos"))
    return roc, ap


def roc_auc(pred: DataFrame, y: str = "y_true", p: str = "y_prob") -> DataFrame:
    return ranked_counts(pred, y, p).agg(_auc_terms()[0].alias("roc_auc"))


def average_precision(pred: DataFrame, y: str = "y_true", p: str = "y_prob") -> DataFrame:
    return ranked_counts(pred, y, p).agg(_auc_terms()[1].alias("pr_auc"))


def _sweep_counts(counts: DataFrame) -> DataFrame:
    """True and false positives and misses at each threshold, from score counts."""
    cuts = [float("-inf"), *THRESHOLDS, float("inf")]
    cells = (
        Bucketizer(splits=cuts, inputCol="score", outputCol="_cell")
        .transform(counts.where(F.col("score").isNotNull()))
        .groupBy(F.col("_cell").cast("int").alias("_cell"))
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    # One row per threshold, also where no score fell between two of them.
    grid = counts.sparkSession.createDataFrame(
        list(enumerate([0.0, *THRESHOLDS])), "_cell int, threshold double"
    )
    full = grid.join(cells, "_cell", "left").fillna(0, subset=["pos", "neg"])
    # At most 91 rows from here on, so one task is enough for the window.
    from_top = Window.partitionBy().orderBy(F.desc("_cell"))
    everything = Window.partitionBy()
    return full.select(
        "_cell",
        "threshold",
        F.sum("pos").over(from_top).alias("tp"),
        F.sum("neg").over(from_top).alias("fp"),
        (F.sum("pos").over(everything) - F.sum("pos").over(from_top)).alias("fn"),
        (F.sum("neg").over(everything) - F.sum("neg").over(from_top)).alias("tn"),
    ).where("_cell > 0")


def _with_f1(sweep: DataFrame) -> DataFrame:
    hits = F.col("tp") * F.lit(2.0)
    total = hits + F.col("fp") + F.col("fn")
    return sweep.withColumn("f1", F.when(total > 0, hits / total).otherwise(F.lit(0.0)))


def f1_sweep(pred: DataFrame, y: str = "y_true", p: str = "y_prob") -> DataFrame:
    """F1 and the four counts at each of the 90 thresholds."""
    return _with_f1(_sweep_counts(score_counts(pred, y, p))).select(
        "threshold", "tp", "fp", "fn", "tn", "f1"
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The row with the greatest F1; the lowest threshold wins a tie."""
    best = F.max(F.struct("f1", (-F.col("threshold")).alias("_down"), "tp", "fp", "fn", "tn")).alias("b")
    return sweep.agg(best).select(
        F.col("b.f1").alias("f1"),
        (-F.col("b._down")).alias("f1_threshold"),
        *[F.col(f"b.{c}").alias(c) for c in ("tp", "fp", "fn", "tn")],
    )


def metric_record(
    pred: DataFrame, y: str = "y_true", p: str = "y_prob", run: str | None = None, rounded: bool = True
) -> DataFrame:
    """One row with log loss, ROC-AUC, average precision and best F1.

    Rounded records also hold the threshold; unrounded ones leave it out. All
    metrics come from the combined scores, so the predictions are read once.
    """
    ranked = ranked_counts(pred, y, p)
    roc, ap = _auc_terms()
    loss = F.try_divide(
        F.sum(F.col("pos") * _loss(F.lit(1), F.col("score")) + F.col("neg") * _loss(F.lit(0), F.col("score"))),
        F.sum(F.col("pos") + F.col("neg")),
    )
    ranking = ranked.agg(loss.alias("log_loss"), roc.alias("roc_auc"), ap.alias("pr_auc"))
    best = best_threshold(_with_f1(_sweep_counts(ranked.select("score", "pos", "neg"))))
    both = _side_by_side(ranking, best.select("f1", "f1_threshold"))
    if rounded:
        out = both.select(
            *[F.round(m, 5).alias(m) for m in METRICS], F.round("f1_threshold", 2).alias("f1_threshold")
        )
    else:
        out = both.select(*METRICS)
    return out if run is None else out.select(F.lit(run).alias("run"), *out.columns)


def _side_by_side(*rows: DataFrame) -> DataFrame:
    """Columns of several one-row frames in one row, without a join."""
    stacked = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def compare_runs(records: Sequence[DataFrame]) -> DataFrame:
    """Metric records of several runs, one row each."""
    return functools.reduce(DataFrame.unionByName, records)


def roc_curve(pred: DataFrame, y: str = "y_true", p: str = "y_prob", drop_collinear: bool = True) -> DataFrame:
    """(fpr, tpr, threshold) per distinct score plus the origin (threshold NULL).

    Points in the middle of a straight segment are left out unless asked for:
    those whose next step adds exactly as many positives and negatives as the
    step that led to them.
    """
    ranked = running_sums(score_counts(pred, y, p), "score", ["pos", "neg"], descending=True, following=drop_collinear)
    if drop_collinear:
        first = (F.col("pos_upto") == F.col("pos")) & (F.col("neg_upto") == F.col("neg"))
        bends = F.col("pos_next").isNull() | (F.col("pos_next") != F.col("pos")) | (F.col("neg_next") != F.col("neg"))
        ranked = ranked.where(first | bends)
    curve = ranked.select(
        safe_divide("neg_upto", "neg_total").alias("fpr"),
        safe_divide("pos_upto", "pos_total").alias("tpr"),
        F.col("score").alias("threshold"),
    )
    origin = pred.sparkSession.createDataFrame([(0.0, 0.0, None)], "fpr double, tpr double, threshold double")
    return curve.unionByName(origin)


def pr_curve(pred: DataFrame, y: str = "y_true", p: str = "y_prob") -> DataFrame:
    """(precision, recall, threshold) per distinct score, the end point (1, 0)
    and, on every row, the prevalence that a random score would reach."""
    ranked = ranked_counts(pred, y, p)
    prevalence = safe_divide("pos_total", F.col("pos_total") + F.col("neg_total")).alias("prevalence")
    curve = ranked.select(
        F.try_divide("pos_upto", F.col("pos_upto") + F.col("neg_upto")).alias("precision"),
        safe_divide("pos_upto", "pos_total", default=1.0).alias("recall"),
        F.col("score").alias("threshold"),
        prevalence,
    )
    end = ranked.select(
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), F.lit(None).cast("double").alias("threshold"),
        prevalence,
    )
    return curve.unionByName(end.limit(1))


def curves_by_model(
    pred: DataFrame, y: str, scores: Mapping[str, str], curve: Callable[..., DataFrame]
) -> DataFrame:
    """One curve per model, told apart by the column ``model``."""
    parts = [curve(pred, y, column).withColumn("model", F.lit(name)) for name, column in scores.items()]
    return functools.reduce(DataFrame.unionByName, parts)


def confusion(pred: DataFrame, y: str = "y_true", p: str = "y_prob") -> DataFrame:
    """Counts by actual and predicted class at the threshold of the best F1."""
    best = best_threshold(f1_sweep(pred, y, p))
    return best.select(
        "f1_threshold",
        F.expr("stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (actual, predicted, n)"),
    )


def reliability(pred: DataFrame, y: str = "y_true", p: str = "y_prob", bins: int = 10) -> DataFrame:
    """Mean probability against observed rate in equal-width probability bins."""
    cell = F.least(F.floor(F.col(p) * F.lit(float(bins))), F.lit(bins - 1)).cast("int")
    return scored(pred, y, p).groupBy(cell.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_prob"), F.avg(y).alias("observed_rate")
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Class counts, prevalence and negatives per positive."""
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(
        pos.alias("n_pos"),
        neg.alias("n_neg"),
        safe_divide(pos, pos + neg).alias("prevalence"),
        safe_divide(neg, pos).alias("imbalance_ratio"),
    )


def drift_report(before: DataFrame, after: DataFrame, y: str = "y_true", p: str = "y_prob") -> DataFrame:
    """Label rate and metrics of two periods with absolute and relative change."""

    def long(pred: DataFrame, name: str) -> DataFrame:
        record = metric_record(pred, y, p, rounded=False)
        rate = scored(pred, y, p).agg(F.avg(y).alias("v")).select(F.lit("label_rate").alias("metric"), F.col("v").alias(name))
        return rate.unionByName(record.unpivot([], METRICS, "metric", name))

    # Five rows on each side.
    joined = long(before, "before").join(F.broadcast(long(after, "after")), "metric")
    change = F.col("after") - F.col("before")
    return joined.select(
        "metric", "before", "after", change.alias("change"), safe_divide(change, "before").alias("relative_change")
    )


def top_at_risk(pred: DataFrame, user: str, p: str = "y_prob", n: int = 100) -> DataFrame:
    """The n users with the highest score; the key decides among equal scores."""
    return pred.select(user, p).orderBy(F.desc(p), user).limit(n)


def metric_lift(before: DataFrame, after: DataFrame, metric: str = "log_loss") -> DataFrame:
    """Improvement of one metric between two one-row records, in percent."""
    both = _side_by_side(before.select(F.col(metric).alias("before")), after.select(F.col(metric).alias("after")))
    return both.withColumn("improvement_pct", percent_lift("before", "after"))
