"""Every registered query over the shared tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.functions import columns as c
from ebbtide.models import explain as ex
from ebbtide.models import learners, prepare, tuning
from ebbtide.operators import association, audit, distinct, distributions, latest, metrics, segments, splits
from ebbtide.plans import build, experiments
from ebbtide.plans import features as ft
from ebbtide.plans import profile_report as pr
from ebbtide.registry.workbench import Workbench, forget, workbench
from ebbtide.session import durable, scratch_path
from ebbtide.sources import files, schemas
from ebbtide.sources import shared_tables as st

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TIES = ("txn_id",)
LABEL = ft.TARGET


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Inputs ---------------------------------------------------------------------


def _tables(spark, sf_dir, as_of=st.LATER, window=None) -> dict[str, DataFrame]:
    return {
        "labels": st.labels(spark, sf_dir, as_of),
        "members": st.members(spark, sf_dir, as_of),
        "transactions": st.transactions(spark, sf_dir, as_of),
        "user_logs": st.user_logs(spark, sf_dir, window),
    }


def _mart(spark, sf_dir, as_of=st.LATER, window=None, mode="nonzero") -> DataFrame:
    t = _tables(spark, sf_dir, as_of, window)
    return ft.churn_features(
        t["labels"], t["members"], t["transactions"], t["user_logs"], as_of, window, mode, TIES
    )


def _labelled(spark, sf_dir) -> DataFrame:
    return pr.label_members(st.labels(spark, sf_dir), st.members(spark, sf_dir))


def _last(spark, sf_dir) -> DataFrame:
    return pr.label_last_transaction(st.labels(spark, sf_dir), st.transactions(spark, sf_dir), TIES)


def _paid(spark, sf_dir) -> DataFrame:
    return st.labels(spark, sf_dir).join(pr.payment_history(st.transactions(spark, sf_dir)), ft.ID)


def _active(spark, sf_dir) -> DataFrame:
    return st.labels(spark, sf_dir).join(pr.user_activity(st.user_logs(spark, sf_dir)), ft.ID)


def _mini(spark, sf_dir) -> DataFrame:
    t = _tables(spark, sf_dir)
    return pr.mini_features(
        t["labels"], t["members"], t["transactions"], t["user_logs"], st.LATER, TIES
    )


def _rounded(df: DataFrame, columns, digits=6) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in columns})


# Feature table --------------------------------------------------------------


@query
def member_features(spark, sf_dir):
    return ft.member_features(st.members(spark, sf_dir), st.LATER)


@query
def transaction_features(spark, sf_dir):
    return ft.transaction_features(st.transactions(spark, sf_dir), ties=TIES)


@query
def transaction_features_positive(spark, sf_dir):
    return ft.transaction_features(st.transactions(spark, sf_dir), "positive", TIES)


@query
def last_transaction(spark, sf_dir):
    return latest.latest_rows(st.transactions(spark, sf_dir), ft.ID, "transaction_date", TIES).select(
        "msno", "txn_id", "transaction_date", "is_auto_renew", "is_cancel", "payment_plan_days"
    )


@query
def last_with_totals_by_join(spark, sf_dir):
    """The two-step form: latest row by window, inner-joined with the totals."""
    txns = st.transactions(spark, sf_dir)
    last = latest.latest_rows(txns, ft.ID, "transaction_date", TIES).select("msno", "txn_id", "is_cancel")
    totals = txns.groupBy("msno").agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum("is_cancel").alias("total_cancels"),
        F.max("membership_expire_date").alias("latest_expire"),
    )
    return last.join(totals, "msno", "inner")


@query
def activity_features(spark, sf_dir):
    return ft.activity_features(st.user_logs(spark, sf_dir))


@query
def activity_features_all_days(spark, sf_dir):
    return ft.activity_features(st.user_logs(spark, sf_dir), None, "positive")


@query
def active_days(spark, sf_dir):
    """Distinct days and seconds per user over all logs."""
    return pr.user_activity(st.user_logs(spark, sf_dir)).select("msno", "active_days", "total_secs")


@query
def active_days_approx(spark, sf_dir):
    return distinct.approx_distinct(st.user_logs(spark, sf_dir), [ft.ID], "date", "active_days")


@query
def logs_in_window(spark, sf_dir):
    week = (20240108, 20240114)
    logs = st.user_logs(spark, sf_dir, week).where(c.in_ymd_window("date", week))
    return logs.withColumn("total_secs", F.col("total_secs").cast("double"))


@query
def churn_features(spark, sf_dir):
    return _mart(spark, sf_dir)


@query
def churn_features_prior_round(spark, sf_dir):
    return _mart(spark, sf_dir, st.EARLIER, (20240101, 20240115), "positive")


@query
def staged_features(spark, sf_dir):
    """Feature stages kept as Parquet before the final join."""
    t = _tables(spark, sf_dir)
    txn = files.stage(ft.transaction_features(t["transactions"], ties=TIES), "table", scratch_path(spark, "txn"))
    act = files.stage(ft.activity_features(t["user_logs"]), "table", scratch_path(spark, "act"))
    mart = ft.assemble(t["labels"], ft.member_features(t["members"], st.LATER), txn, act)
    return mart.select("msno", "has_transaction_data", "txn_count", "days_until_expiry", "active_days")


# Sources and inspection -----------------------------------------------------


@query
def csv_scan(spark, sf_dir):
    """Members written as CSV and scanned with the declared schema."""
    path = scratch_path(spark, "members-csv")
    files.write_csv(st.members(spark, sf_dir).select(schemas.MEMBERS.fieldNames()), path)
    return files.read_csv(spark, path, schemas.MEMBERS)


@query
def sql_over_file(spark, sf_dir):
    path = scratch_path(spark, "labels-csv")
    files.write_csv(st.labels(spark, sf_dir), path)
    text = "SELECT is_churn, count(*) AS n FROM read_csv_auto('{path}') GROUP BY is_churn"
    return files.query_csv(spark, path, text, schemas.LABELS)


@query
def parquet_round_trip(spark, sf_dir):
    path = scratch_path(spark, "txn-parquet")
    files.write_parquet(st.transactions(spark, sf_dir), path)
    return files.read_parquet(spark, path)


@query
def table_inventory(spark, sf_dir):
    """Tables as their files are: rows, and columns with the types found there."""
    names = ("customer", "orders", "lineitem", "events")
    return files.inventory({name: files.read_parquet(spark, f"{sf_dir}/{name}.parquet") for name in names})


@query
def source_catalog(spark, sf_dir):
    """Every declared column of the four inputs, and how many values it has."""
    return schemas.catalog_against(_tables(spark, sf_dir))


@query
def row_counts(spark, sf_dir):
    return files.count_rows(st.table(spark, sf_dir, "lineitem"))


@query
def describe_table(spark, sf_dir):
    """Columns of the orders table with type and number of NULLs."""
    orders = files.read_parquet(spark, f"{sf_dir}/orders.parquet")
    return files.describe(orders).join(audit.null_counts(orders), "column_name")


@query
def row_preview(spark, sf_dir):
    return files.preview(st.labels(spark, sf_dir), 5, ("msno",))


# Profiling ------------------------------------------------------------------


@query
def label_balance(spark, sf_dir):
    return segments.value_shares(st.labels(spark, sf_dir), LABEL)


@query
def members_quality(spark, sf_dir):
    return pr.members_quality(st.members(spark, sf_dir))


@query
def transactions_quality(spark, sf_dir):
    return pr.transactions_quality(st.transactions(spark, sf_dir))


@query
def logs_quality(spark, sf_dir):
    return pr.logs_quality(st.user_logs(spark, sf_dir))


@query
def segment_rate_gender(spark, sf_dir):
    return pr.rate_by_gender(_labelled(spark, sf_dir))


@query
def segment_rate_city_topk(spark, sf_dir):
    return segments.segment_rate(_labelled(spark, sf_dir), ["city"], LABEL, min_n=40, k=15)


@query
def segment_rate_channel(spark, sf_dir):
    return segments.segment_rate(_labelled(spark, sf_dir), ["registered_via"], LABEL, min_n=100)


@query
def cohort_churn_rate(spark, sf_dir):
    cohorts = segments.cohort_rate(
        _labelled(spark, sf_dir), "registration_init_time", LABEL, after=19950131, min_n=5
    )
    return cohorts.withColumn("month", c.month_start("reg_month"))


@query
def txn_summary(spark, sf_dir):
    return pr.transaction_summary(st.transactions(spark, sf_dir))


@query
def rate_by_renew_cancel(spark, sf_dir):
    return segments.segment_rate(_last(spark, sf_dir), ["is_auto_renew", "is_cancel"], LABEL)


@query
def renew_rollup_mean(spark, sf_dir):
    return segments.rollup_rates(rate_by_renew_cancel(spark, sf_dir), "is_auto_renew")


@query
def plan_frequency_topk(spark, sf_dir):
    return segments.value_counts(st.transactions(spark, sf_dir), "payment_plan_days", k=10)


@query
def plan_shares(spark, sf_dir):
    return segments.value_shares(st.transactions(spark, sf_dir), "payment_plan_days")


@query
def discount_rate(spark, sf_dir):
    return pr.rate_by_price_type(_last(spark, sf_dir))


@query
def payment_method_topk(spark, sf_dir):
    return segments.segment_rate(_last(spark, sf_dir), ["payment_method_id"], LABEL, min_n=50, k=12)


@query
def txn_temporal_medians(spark, sf_dir):
    return distributions.group_median(_paid(spark, sf_dir), [LABEL], ["txn_count", "days_until_expiry"])


@query
def txn_temporal_medians_approx(spark, sf_dir):
    return distributions.group_median_approx(_paid(spark, sf_dir), [LABEL], ["txn_count", "days_until_expiry"])


@query
def log_date_range(spark, sf_dir):
    return pr.log_range(st.user_logs(spark, sf_dir))


@query
def activity_medians(spark, sf_dir):
    return distributions.group_median(
        _active(spark, sf_dir), [LABEL], ["active_days", "total_secs", "total_unique_songs"]
    )


@query
def engagement_median(spark, sf_dir):
    return distributions.group_median(pr.engagement(_active(spark, sf_dir)), [LABEL], ["engagement_depth"])


@query
def engagement_log1p(spark, sf_dir):
    activity = ft.activity_features(st.user_logs(spark, sf_dir))
    return activity.select("msno", F.round(c.log1p("engagement_depth"), 9).alias("log_engagement_depth"))


@query
def missingness_audit(spark, sf_dir):
    t = _tables(spark, sf_dir)
    sides = {"members": t["members"], "transactions": t["transactions"], "user_logs": t["user_logs"]}
    return audit.coverage_audit(t["labels"], sides, ft.ID, LABEL)


@query
def join_coverage(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return audit.coverage(
        t["labels"], {"in_transactions": t["transactions"], "in_user_logs": t["user_logs"]}, ft.ID, LABEL
    )


@query
def null_counts(spark, sf_dir):
    return audit.null_counts(_mini(spark, sf_dir).select(*pr.MINI))


@query
def correlation_matrix(spark, sf_dir):
    return _rounded(association.corr_matrix(_mini(spark, sf_dir), pr.MINI), ["r"])


@query
def correlation_with_target(spark, sf_dir):
    return _rounded(association.corr_with(_mini(spark, sf_dir), LABEL, pr.MINI), ["abs_r"])


#: Every numeric feature of the table.
SEGMENT_COLUMNS = [n for n in ft.MART if n not in (ft.ID, LABEL, *prepare.CATEGORICAL)]


@query
def correlation_in_segment(spark, sf_dir):
    """Among users on auto-renewal who have not cancelled."""
    steady = _mart(spark, sf_dir).where("last_auto_renew = 1 AND last_cancel = 0")
    return _rounded(association.corr_with(steady, LABEL, SEGMENT_COLUMNS), ["abs_r"])


@query
def histogram_age(spark, sf_dir):
    members = ft.member_features(st.members(spark, sf_dir), st.LATER)
    return _rounded(distributions.histogram(members, "age", 60), ["lower", "upper"])


@query
def histogram_raw_age(spark, sf_dir):
    return _rounded(distributions.histogram(st.members(spark, sf_dir), "bd", 100), ["lower", "upper"])


@query
def histogram_by_class(spark, sf_dir):
    return _rounded(
        distributions.histogram(_paid(spark, sf_dir), "txn_count", 20, [LABEL], clip=20), ["lower", "upper"]
    )


@query
def histogram_expiry(spark, sf_dir):
    near = _paid(spark, sf_dir).where("days_until_expiry > -100 AND days_until_expiry < 400")
    return _rounded(distributions.histogram(near, "days_until_expiry", 50, [LABEL]), ["lower", "upper"])


@query
def histogram_density(spark, sf_dir):
    bars = distributions.histogram(_active(spark, sf_dir), "total_secs", 50, [LABEL], clip=500_000, density=True)
    return _rounded(_rounded(bars, ["lower", "upper"]), ["density"], 9)


@query
def histogram_active_days(spark, sf_dir):
    bars = distributions.histogram(_active(spark, sf_dir), "active_days", 31, [LABEL], density=True)
    return _rounded(_rounded(bars, ["lower", "upper"]), ["density"], 9)


@query
def histogram_unique_songs(spark, sf_dir):
    bars = distributions.histogram(_active(spark, sf_dir), "total_unique_songs", 50, [LABEL], clip=3000, density=True)
    return _rounded(_rounded(bars, ["lower", "upper"]), ["density"], 9)


@query
def histogram_complete_plays(spark, sf_dir):
    activity = st.labels(spark, sf_dir).join(ft.activity_features(st.user_logs(spark, sf_dir)), ft.ID)
    bars = distributions.histogram(activity, "complete_plays", 50, [LABEL], clip=5000, density=True)
    return _rounded(_rounded(bars, ["lower", "upper"]), ["density"], 9)


@query
def histogram_engagement(spark, sf_dir):
    depth = pr.engagement(_active(spark, sf_dir))
    bars = distributions.histogram(depth, "engagement_depth", 50, [LABEL], clip=5, density=True)
    return _rounded(_rounded(bars, ["lower", "upper"]), ["density"], 9)


@query
def profile_in_one_pass(spark, sf_dir):
    """Rows of every part of the report, whose sources are scanned once each."""
    report = pr.profile_report(
        _tables(spark, sf_dir), st.LATER, TIES, min_sizes={"city": 40, "channel": 100, "payment_method": 50, "cohort": 5}, cohorts_after=19950131
    )
    parts = [part().agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n") for name, part in report.items()]
    return functools.reduce(DataFrame.unionByName, parts)


# Checks ---------------------------------------------------------------------


@query
def quality_checks(spark, sf_dir):
    """The 16 declared checks, made while the stages of the feature table are written."""
    stages = build.Stages(scratch_path(spark, "build"))
    for _ in build.steps(_tables(spark, sf_dir), st.LATER, stages, ties=TIES):
        pass
    return stages.table(spark)


@query
def gated_build(spark, sf_dir):
    """Rows of every stage that passed the gate."""
    stages = build.gated_build(_tables(spark, sf_dir), st.LATER, scratch_path(spark, "build"), ties=TIES)
    counted = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n") for name, df in stages.frames.items()]
    return functools.reduce(DataFrame.unionByName, counted)


@query
def raw_checks(spark, sf_dir):
    """Checks that do find something: raw genders, and repeated keys in raw payments."""
    t = _tables(spark, sf_dir)
    return audit.all_checks(
        [
            audit.value_checks("members", t["members"], [audit.accepted_values("gender", ["male", "female"])]),
            audit.unique_check("transactions", t["transactions"], ft.ID),
        ]
    )


@query
def referential_check(spark, sf_dir):
    """Activity and payments against users of the earlier outcome window."""
    t = _tables(spark, sf_dir)
    returned = t["labels"].where("is_churn = 0")
    return audit.all_checks(
        [
            audit.reference_check("transactions", t["transactions"], ft.ID, [t["members"]]),
            audit.reference_check("user_logs", t["user_logs"], ft.ID, [returned]),
        ]
    )


@query
def range_check(spark, sf_dir):
    return audit.value_checks(
        "feature_table", _mart(spark, sf_dir),
        [
            audit.in_range("completion_rate", 0.0, 1.0),
            audit.in_range("age", 10, 70),
            audit.in_range("days_until_expiry", 0, 400),
        ],
    )


# Splits and preparation -----------------------------------------------------


@query
def stratified_split(spark, sf_dir):
    return splits.stratified_split(st.labels(spark, sf_dir), ft.ID, LABEL)


@query
def stratified_split_exact(spark, sf_dir):
    """Another share than the usual one."""
    return splits.stratified_split(st.labels(spark, sf_dir), ft.ID, LABEL, test_share=0.35)


@query
def stratified_folds(spark, sf_dir):
    return splits.folds(st.labels(spark, sf_dir), ft.ID, LABEL)


@query
def hash_sample(spark, sf_dir):
    return splits.hash_sample(st.labels(spark, sf_dir), ft.ID, 500)


@query
def class_weights(spark, sf_dir):
    labels = st.labels(spark, sf_dir)
    both = prepare.class_weights(prepare.class_weights(labels, name="balanced"), scheme="pos_ratio", name="pos_ratio")
    return both


@query
def class_balance(spark, sf_dir):
    return metrics.class_balance(st.labels(spark, sf_dir), LABEL)


IMPUTED = ["age", "tenure_days", "last_plan_days", "last_amount_paid", "days_until_expiry"]


@query
def median_impute(spark, sf_dir):
    """Medians of the training part fill both parts."""
    marked = splits.stratified_split(_mart(spark, sf_dir), ft.ID, LABEL).select("msno", "is_test", *IMPUTED)
    medians = prepare.fit_medians(marked.where("is_test = 0"), IMPUTED)
    return prepare.fill_medians(marked, medians)


@query
def category_sentinel(spark, sf_dir):
    return _mart(spark, sf_dir).select("msno", *[c.category_text(n).alias(n) for n in prepare.CATEGORICAL])


@query
def standardize(spark, sf_dir):
    columns = ["txn_count", "total_secs", "active_days"]
    mart = _mart(spark, sf_dir).select("msno", *columns)
    return _rounded(prepare.standardize(mart, prepare.fit_scaling(mart, columns)), columns)


@query
def one_hot(spark, sf_dir):
    """Rows per encoded level, read back from the one-hot vectors; levels are
    fitted on the training part and counted on the test part."""
    marked = durable(splits.stratified_split(_mart(spark, sf_dir), ft.ID, LABEL))
    shaping = prepare.shaping({c: prepare.category_sql(c) for c in prepare.CATEGORICAL})
    stages = [shaping, *prepare.one_hot_stages([prepare.shaped(c) for c in prepare.CATEGORICAL])]
    model = Pipeline(stages=stages).fit(marked.where("is_test = 0"))
    encoded = model.transform(marked.where("is_test = 1"))
    levels = model.stages[1].labelsArray
    parts = []
    for name, known in zip(prepare.CATEGORICAL, levels):
        totals = encoded.agg(Summarizer.sum(F.col(f"{prepare.shaped(name)}_onehot")).alias("v"))
        pairs = totals.select(
            F.posexplode(learners.vector_to_array("v")).alias("i", "n"),
        )
        parts.append(
            pairs.select(
                F.lit(name).alias("column_name"),
                F.get(F.lit(list(known)), F.col("i")).alias("level"),
                F.col("n").cast("long").alias("n"),
            )
        )
    return functools.reduce(DataFrame.unionByName, parts).where("n > 0")


@query
def temporal_holdout(spark, sf_dir):
    """Both periods from one code path, told apart by a column."""
    parts = [
        _mart(spark, sf_dir, as_of).select(
            F.lit(as_of).alias("period"), "msno", LABEL, "tenure_days", "txn_count", "last_cancel"
        )
        for as_of in (st.EARLIER, st.LATER)
    ]
    return parts[0].unionByName(parts[1])


@query
def feature_subsets(spark, sf_dir):
    """Feature lists of the ablation study with the values they cover."""
    mart = _mart(spark, sf_dir)
    filled = audit.null_counts(mart.select(*prepare.feature_columns(mart))).withColumnRenamed("column_name", "feature")
    named = [
        filled.where(F.col("feature").isin(*cols)).withColumn("subset", F.lit(name))
        for name, cols in prepare.feature_subsets(mart).items()
    ]
    return functools.reduce(DataFrame.unionByName, named)


# Metrics on a deterministic score -------------------------------------------


@query
def log_loss(spark, sf_dir):
    return _rounded(metrics.log_loss(st.scores(spark, sf_dir)), ["log_loss"])


@query
def roc_auc(spark, sf_dir):
    return _rounded(metrics.roc_auc(st.scores(spark, sf_dir)), ["roc_auc"])


@query
def average_precision(spark, sf_dir):
    return _rounded(metrics.average_precision(st.scores(spark, sf_dir)), ["pr_auc"])


@query
def f1_sweep(spark, sf_dir):
    return _rounded(metrics.f1_sweep(st.scores(spark, sf_dir)), ["f1"], 9)


@query
def metric_record(spark, sf_dir):
    return metrics.metric_record(st.scores(spark, sf_dir))


@query
def run_comparison(spark, sf_dir):
    return metrics.compare_runs(
        [metrics.metric_record(st.scores(spark, sf_dir, d), run=d) for d in (st.EARLIER, st.LATER)]
    )


@query
def metric_lift(spark, sf_dir):
    records = [metrics.metric_record(st.scores(spark, sf_dir, d)) for d in (st.EARLIER, st.LATER)]
    return _rounded(metrics.metric_lift(*records), ["improvement_pct"])


@query
def roc_curve(spark, sf_dir):
    return _rounded(metrics.roc_curve(st.scores(spark, sf_dir)), ["fpr", "tpr", "threshold"], 9)


@query
def pr_curve(spark, sf_dir):
    return _rounded(
        metrics.pr_curve(st.scores(spark, sf_dir)), ["precision", "recall", "threshold", "prevalence"], 9
    )


@query
def curves_by_model(spark, sf_dir):
    pred = st.scores(spark, sf_dir).withColumn("y_prob_flip", F.lit(1.0) - F.col("y_prob"))
    curves = metrics.curves_by_model(
        pred, "y_true", {"recency": "y_prob", "flipped": "y_prob_flip"},
        functools.partial(metrics.roc_curve, drop_collinear=False),
    )
    return _rounded(curves, ["fpr", "tpr", "threshold"], 9)


@query
def confusion_matrix(spark, sf_dir):
    return _rounded(metrics.confusion(st.scores(spark, sf_dir)), ["f1_threshold"], 9)


@query
def brier(spark, sf_dir):
    return _rounded(metrics.brier(st.scores(spark, sf_dir)), ["brier"])


def _gappy_scores(spark, sf_dir) -> DataFrame:
    """Scores with a label or a probability missing, or no number, here and there."""
    pred = st.scores(spark, sf_dir)
    p = F.when(F.col("msno") % 7 == 0, F.lit(None)).when(F.col("msno") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("y_prob"))
    return pred.withColumn("y_prob", p).withColumn("y_true", F.when(F.col("msno") % 5 != 0, F.col("y_true")))


@query
def metrics_with_gaps(spark, sf_dir):
    """What is left out, and the metrics of what is not."""
    pred = _gappy_scores(spark, sf_dir)
    parts = [
        metrics.left_out(pred).unpivot([], ["n_scored", "n_without_label", "n_without_probability"], "metric", "v"),
        metrics.metric_record(pred, rounded=False).unpivot([], metrics.METRICS, "metric", "v"),
        metrics.log_loss(pred).select(F.lit("log_loss_by_row").alias("metric"), F.col("log_loss").alias("v")),
        metrics.brier(pred).select(F.lit("brier").alias("metric"), F.col("brier").alias("v")),
    ]
    rows = [part.select("metric", F.round(F.col("v").cast("double"), 6).alias("v")) for part in parts]
    return functools.reduce(DataFrame.unionByName, rows)


@query
def reliability_table(spark, sf_dir):
    return _rounded(metrics.reliability(st.scores(spark, sf_dir)), ["mean_prob", "observed_rate"])


@query
def alert_share(spark, sf_dir):
    return metrics.alert_share(st.scores(spark, sf_dir), over=0.6)


@query
def drift_report(spark, sf_dir):
    report = metrics.drift_report(st.scores(spark, sf_dir, st.EARLIER), st.scores(spark, sf_dir))
    return _rounded(report, ["before", "after", "change", "relative_change"])


@query
def top_n_at_risk(spark, sf_dir):
    return metrics.top_at_risk(st.scores(spark, sf_dir), "msno", n=50)


@query
def first_confident(spark, sf_dir):
    """One confident positive and one confident negative user."""
    pred = st.scores(spark, sf_dir)
    yes = splits.first_match(pred, (F.col("y_true") == 1) & (F.col("y_prob") > 0.8), "msno")
    no = splits.first_match(pred, (F.col("y_true") == 0) & (F.col("y_prob") < 0.02), "msno")
    return yes.unionByName(no)


@query
def predictions_with_features(spark, sf_dir):
    """Scores lined up with features by user."""
    return st.scores(spark, sf_dir).join(_mart(spark, sf_dir).select("msno", "txn_count", "gender"), "msno")


# Models ---------------------------------------------------------------------


def _bench(spark, sf_dir) -> Workbench:
    return workbench(spark, sf_dir, _mart)


def forget_models() -> None:
    """Drop the fits that several queries share, for timing them."""
    forget()


@query
def baseline_fit(spark, sf_dir):
    """Test scores of the baseline as it was saved; its folder is all that scoring takes."""
    kept = _bench(spark, sf_dir).kept
    return kept.model("baseline").score(kept.table("features"), ["msno", F.col(LABEL).alias("y_true")])


@query
def baseline_record(spark, sf_dir):
    return _bench(spark, sf_dir).kept.table("comparison").where("run = 'baseline'")


@query
def gbt_fit(spark, sf_dir):
    """Test scores of the trees with the study's best parameters and round."""
    return _bench(spark, sf_dir).kept.table("predictions").select("msno", "y_true", F.col("y_prob_trees").alias("y_prob"))


@query
def gbt_search(spark, sf_dir):
    """All trials of the full search; the outcome also goes through its JSON form."""
    study = _bench(spark, sf_dir).study
    path = scratch_path(spark, "study")
    files.write_study(spark, study, path)
    kept = files.read_study(spark, path)
    return tuning.trials_frame(spark, study).withColumn("is_best", F.col("finalist") & (F.col("log_loss") == kept["best_value"]))


@query
def best_round(spark, sf_dir):
    return tuning.curve_frame(spark, _bench(spark, sf_dir).study)


def _by_rung(spark, study) -> DataFrame:
    """Mean loss over the folds of each trial and rung."""
    rungs = tuning.rungs_frame(spark, study)
    return rungs.groupBy("rung", "length", "trial", "kept").agg(F.avg("loss").alias("loss"), F.count(F.lit(1)).alias("folds"))


@query
def search_rungs(spark, sf_dir):
    """Rungs that dropped candidates: how many were open and stayed, and how many
    went although they had the lower loss."""
    means = _by_rung(spark, _bench(spark, sf_dir).study)
    worst = F.max(F.when(F.col("kept"), F.col("loss"))).over(Window.partitionBy("rung"))
    counted = means.withColumn("worst", worst).groupBy("rung", "length").agg(
        F.count(F.lit(1)).alias("n_open"),
        F.count_if("kept").alias("n_kept"),
        F.sum("folds").alias("n_fits"),
        F.count_if(~F.col("kept") & (F.col("loss") < F.col("worst"))).alias("wrongly_dropped"),
    )
    return counted.where("n_kept < n_open")


@query
def experiment_artifacts(spark, sf_dir):
    """The tables of the experiment's folder, read again, as the manifest names them."""
    kept = _bench(spark, sf_dir).kept
    broken = kept.broken()
    fixed = ("predictions", "features", "comparison", "lift", "trials")
    parts = [
        kept.table(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("artifact"), "n", F.lit(name not in broken).alias("intact"))
        for name in fixed
    ]
    return functools.reduce(DataFrame.unionByName, parts)


@query
def temporal_experiment(spark, sf_dir):
    """Trees with the stored best parameters, fitted on the earlier period."""
    bench = _bench(spark, sf_dir)
    study = bench.kept.value("study")
    outcome = experiments.temporal_experiment(
        _mart(spark, sf_dir, st.EARLIER), bench.mart, study["best_params"], study["best_round"]
    )
    return outcome["drift"]


@query
def ablation(spark, sf_dir):
    """The trees of the study, fitted anew on each feature list."""
    bench = _bench(spark, sf_dir)
    study = bench.kept.value("study")
    return experiments.ablation(bench.mart, study["best_params"], study["best_round"], split=bench.split)


@query
def recalibration(spark, sf_dir):
    """Platt and isotonic maps of the recency score, fitted on the earlier period."""
    earlier, later = st.scores(spark, sf_dir, st.EARLIER), st.scores(spark, sf_dir)
    platt = learners.recalibrate(earlier, "platt").apply(later, name="y_prob_platt")
    return learners.recalibrate(earlier, "isotonic").apply(platt, name="y_prob_isotonic")


@query
def gain_importance(spark, sf_dir):
    bench = _bench(spark, sf_dir)
    return ex.gain_importance(bench.trees, bench.test)


@query
def attributions(spark, sf_dir):
    return _bench(spark, sf_dir).attributions[0]


@query
def linear_attributions(spark, sf_dir):
    bench = _bench(spark, sf_dir)
    return ex.linear_attributions(bench.baseline, bench.sample, bench.train, "msno")[0]


@query
def global_attribution(spark, sf_dir):
    return ex.global_attribution(_bench(spark, sf_dir).attributions[0])


@query
def attribution_direction(spark, sf_dir):
    return ex.attribution_direction(_bench(spark, sf_dir).attributions[0])


def _confident(bench: Workbench) -> DataFrame:
    """A sampled churner scored above 0.8 and a loyal user scored below 0.02."""
    scored = bench.kept.table("predictions").select("msno", "y_true", F.col("y_prob_trees").alias("y_prob"))
    seen = scored.join(bench.sample.select("msno"), "msno", "left_semi")
    yes = splits.first_match(seen, (F.col("y_true") == 1) & (F.col("y_prob") > 0.8), "msno")
    no = splits.first_match(seen, (F.col("y_true") == 0) & (F.col("y_prob") < 0.02), "msno")
    return yes.unionByName(no)


@query
def row_explanation(spark, sf_dir):
    bench = _bench(spark, sf_dir)
    return ex.explain_row(bench.attributions[0], "msno", _confident(bench))


# Checks of models whose answer is known --------------------------------------


def _failures(counts: dict[str, DataFrame]) -> DataFrame:
    """Each check with the number of rows that break it."""
    rows = [df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check"), "failures") for name, df in counts.items()]
    return functools.reduce(DataFrame.unionByName, rows)


def _gradient(rows: DataFrame, x: str, y: str, p: str, weight: str) -> dict[int, float]:
    """Slope of the weighted mean log loss in each coefficient, from scored rows.

    The residual p - y is positive for all rows of class 0 and negative for all of
    class 1, so two weighted vector sums make it up.
    """
    sums = rows.withColumn("_r", F.col(weight) * F.abs(F.col(p) - F.col(y))).groupBy(y).agg(
        Summarizer.sum(F.col(x), F.col("_r")).alias("s"), F.sum(weight).alias("w"), F.sum("_r").alias("r")
    )
    out: dict[int, float] = {}
    total = 0.0
    for row in sums.collect():
        sign = 1.0 if row[y] == 0 else -1.0
        total += row.w
        for j, v in enumerate([*row.s.toArray().tolist(), row.r]):
            out[j] = out.get(j, 0.0) + sign * v
    return {j: v / total for j, v in out.items()}


def _steep(spark, slopes: dict[int, float], most: float) -> DataFrame:
    return spark.createDataFrame([(j, float(v)) for j, v in slopes.items()], "slot int, slope double").where(F.abs("slope") > most)


def _recalibrations(earlier: DataFrame, later: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The later period by the isotonic map and the earlier one by Platt's; the earlier
    rows are kept, since both fits and what follows read them several times."""
    earlier = durable(earlier)
    return learners.recalibrate(earlier, "isotonic").apply(later), learners.recalibrate(earlier, "platt").apply(earlier)


@query
def model_checks(spark, sf_dir):
    """What must hold for fitted models and searches, whatever the data."""
    bench = _bench(spark, sf_dir)
    study, train, test = bench.study, bench.train, bench.test
    scored = gbt_fit(spark, sf_dir)
    phi, base = bench.attributions
    linear = bench.baseline.model.transform(prepare.class_weights(train, LABEL, "balanced")).withColumn(
        "y_prob", learners.vector_to_array("probability")[1]
    )
    learner = bench.baseline.model.stages[-1]
    n = train.count()
    slopes = _gradient(linear, "features", LABEL, "y_prob", "weight")
    slopes |= {j: slopes[j] + float(c) / n for j, c in enumerate(learner.coefficients.toArray())}
    margins = bench.trees.model.transform(bench.sample).select("msno", learners.vector_to_array("rawPrediction")[1].alias("margin"))
    sums = phi.groupBy("msno").agg((F.sum("phi") + F.lit(base)).alias("total")).join(margins, "msno", "full")
    monotone, platt = _recalibrations(st.scores(spark, sf_dir, st.EARLIER), st.scores(spark, sf_dir))
    falls = monotone.groupBy("y_prob").agg(F.min("y_prob_cal").alias("lo"), F.max("y_prob_cal").alias("hi"))
    # Scores are days since the last order here, so there is a row for each day at most.
    before = F.max("hi").over(Window.orderBy("y_prob").rowsBetween(Window.unboundedPreceding, -1))
    odds = platt.where("y_prob > 0 AND y_prob < 1").count() == platt.count()
    platt = platt.withColumns({"one": F.lit(1.0), "x": array_to_vector(F.array(F.log(F.col("y_prob") / (1 - F.col("y_prob")))))}) if odds else None
    ratio = prepare.class_weights(st.labels(spark, sf_dir), LABEL, "pos_ratio")
    by_class = F.sum(F.when(F.col(LABEL) == 1, F.col("weight"))) - F.sum(F.when(F.col(LABEL) == 0, F.col("weight")))
    outside = ~F.col("y_prob").between(0.0, 1.0) | F.col("y_prob").isNull()
    losses = tuning.fold_losses(train, prepare.feature_columns(train), study).agg(F.avg("log_loss").alias("v"))
    trained = spark.createDataFrame(
        [(t["trial"], max(f[2] for f in study["fits"] if f[0] == t["trial"]), min(1000, t["best_round"] + study["patience"])) for t in study["trials"] if t["finalist"]],
        "trial int, trained int, allowed int",
    )
    path = scratch_path(spark, "study")
    files.write_study(spark, study, path)
    again = files.read_study(spark, path)
    counts = {
        "trees_score_each_test_user_once": test.select("msno").join(scored.groupBy("msno").count(), "msno", "full").where(
            "count is null or count <> 1"),
        "tree_probabilities_in_range": scored.where(outside),
        "baseline_probabilities_in_range": linear.where(outside),
        "baseline_gradient_is_zero": _steep(spark, slopes, 1e-3),
        "platt_gradient_is_zero": _steep(spark, _gradient(platt, "x", "y_true", "y_prob_cal", "one"), 1e-3) if odds else spark.range(1),
        "attributions_add_up": sums.where("total is null or margin is null or abs(total - margin) > 1e-6"),
        "best_loss_from_scored_rows": losses.where(F.abs(F.col("v") - study["best_value"]) > 1e-9),
        "no_fit_past_best_round_and_patience": trained.where("trained > allowed"),
        "best_trial_has_the_least_loss": tuning.trials_frame(spark, study).where(F.col("finalist") & (F.col("log_loss") < study["best_value"])),
        "study_survives_json": spark.range(1).where(F.lit(any(again[k] != study[k] for k in ("best_params", "best_value", "best_round", "n_trials")))),
        "isotonic_never_falls": falls.withColumn("before", before).where("lo < before - 1e-12 or hi > lo + 1e-12"),
        "weights_balance_the_classes": ratio.agg(by_class.alias("d"), F.sum("weight").alias("n")).where("abs(d) > 1e-9 * n"),
    }
    return _failures(counts)


@query
def report_checks(spark, sf_dir):
    """What must hold for the explanation report, made from the experiment's folder alone."""
    bench = _bench(spark, sf_dir)
    report = experiments.report_from_disk(spark, bench.folder)
    phi, scored = report["attributions"], gbt_fit(spark, sf_dir)
    features = bench.kept.table("features")
    alike = bench.trees.score(features, ["msno"], "again").join(scored, "msno", "full")
    gains = ex.gain_importance(bench.trees, features, k=10**6)
    mean_abs = phi.groupBy("feature").agg((F.sum(F.abs("phi")) / F.count(F.lit(1))).alias("want"))
    top = report["global_attribution"].join(mean_abs, "feature", "full")
    least = report["global_attribution"].agg(F.min("mean_abs_phi").alias("least"))
    rows = bench.trees.model.transform(features.limit(0))
    nominal = rows.schema["features"].metadata["ml_attr"]["attrs"].get("nominal", [])
    levels = {prepare.unshaped(a["name"]): len(a["vals"]) for a in nominal}
    known = {c: bench.train.select(F.expr(prepare.category_sql(c))).distinct().count() for c in bench.trees.categorical}
    who = report["positive"].unionByName(report["negative"])
    lines = who.groupBy("msno").agg(F.sum("phi").alias("lines"), F.count(F.lit(1)).alias("k")).join(phi.groupBy("msno").agg(F.sum("phi").alias("whole")), "msno")
    curve = report["roc_curve"]
    counts = {
        "saved_trees_score_as_they_did": alike.where("again is null or y_prob is null or abs(again - y_prob) > 1e-12"),
        "gains_sum_to_one": gains.agg(F.sum("gain").alias("s")).where("abs(s - 1) > 1e-9"),
        "top_gains_are_the_greatest": report["gain_importance"].join(gains.withColumnRenamed("gain", "want"), "feature", "right").where(
            F.col("gain").isNull() & (F.col("want") > F.lit(report["gain_importance"].agg(F.min("gain")).first()[0] or 0.0))),
        "global_attribution_is_the_mean": top.where("mean_abs_phi is not null and abs(mean_abs_phi - want) > 1e-12"),
        "global_attribution_keeps_the_greatest": mean_abs.join(report["global_attribution"], "feature", "left_anti").join(F.broadcast(least)).where("want > least"),
        "direction_quartiles_ordered": report["direction"].where(
            "not (phi_min <= phi_q1 and phi_q1 <= phi_median and phi_median <= phi_q3 and phi_q3 <= phi_max) or abs(value_corr) > 1 + 1e-9"),
        "row_explanations_add_up": lines.where("abs(lines - whole) > 1e-9 or k > 12"),
        "categories_are_nominal": spark.createDataFrame([(c, levels.get(c, 0), n) for c, n in known.items()], "c string, levels int, known int").where("levels <> known + 1"),
        "confusion_counts_every_test_user": report["confusion"].agg(F.sum("n").alias("n")).where(F.col("n") != features.count()),
        "roc_from_origin_to_one": curve.agg(F.min(F.col("fpr") + F.col("tpr")).alias("lo"), F.max(F.col("fpr") + F.col("tpr")).alias("hi")).where("lo <> 0 or hi <> 2"),
        "roc_never_falls": curve.withColumn("next", F.lead("tpr").over(Window.orderBy("fpr", "tpr"))).where("next < tpr"),
        "drift_change_is_after_less_before": temporal_experiment(spark, sf_dir).where("abs(change - (after - before)) > 1e-12"),
        "ablation_has_three_runs": ablation(spark, sf_dir).agg(F.countDistinct("run").alias("n"), F.max("n_features").alias("most")).where("n <> 3 or most <> 34"),
    }
    return _failures(counts)
