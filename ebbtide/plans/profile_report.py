"""The profiling report: what the four inputs look like and how they relate to the label."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ebbtide.functions.columns import days_between, less_flag, normalize_category, parse_ymd, safe_divide, zero_to_null
from ebbtide.operators import association, audit, distributions, segments
from ebbtide.operators.distinct import sums_and_distinct
from ebbtide.operators.latest import latest_and_totals, latest_rows
from ebbtide.plans.features import GENDERS, ID, TARGET, member_features
from ebbtide.session import scratch_path
from ebbtide.sources.files import stage


def blank(column: str):
    return F.col(column).isNull() | (F.col(column) == "")


# The names of the rules in the report.
MEMBER_SHARES = ["gender_missing", "age_invalid"]
TRANSACTION_NULLS = {
    "pay_method_null": "payment_method_id", "txn_date_null": "transaction_date",
    "expire_null": "membership_expire_date", "amount_null": "actual_amount_paid",
}
LOG_NULLS = {"total_secs_null": "total_secs", "num_unq_null": "num_unq", "date_null": "date"}


def member_rules() -> dict[str, Column]:
    return {
        "gender_missing": blank("gender"),
        "age_invalid": (F.col("bd") <= 0) | (F.col("bd") > 100),
        "city_missing": F.col("city").isNull(),
        "reg_via_missing": F.col("registered_via").isNull(),
        "reg_time_missing": F.col("registration_init_time").isNull(),
    }


def members_quality(members: DataFrame) -> DataFrame:
    return audit.rule_audit(members, member_rules(), percent=MEMBER_SHARES)


def _nulls(columns: Mapping[str, str]) -> dict[str, Column]:
    return {n: F.col(c).isNull() for n, c in columns.items()}


def transactions_quality(transactions: DataFrame) -> DataFrame:
    return audit.rule_audit(transactions, _nulls(TRANSACTION_NULLS))


def logs_quality(logs: DataFrame) -> DataFrame:
    return audit.rule_audit(logs, _nulls(LOG_NULLS))


def label_members(labels: DataFrame, members: DataFrame) -> DataFrame:
    return labels.join(members, ID)


def label_last_transaction(labels: DataFrame, transactions: DataFrame, ties: Sequence[str]) -> DataFrame:
    """Labels with the latest payment of each user."""
    return labels.join(latest_rows(transactions, ID, "transaction_date", ties), ID)


def rate_by_gender(labelled: DataFrame) -> DataFrame:
    return segments.segment_rate(labelled, {"gender": normalize_category("gender", GENDERS)}, TARGET)


def rate_by_price_type(last: DataFrame) -> DataFrame:
    kind = F.when(F.col("actual_amount_paid") < F.col("plan_list_price"), "Discounted").otherwise("Full price")
    return segments.segment_rate(last, {"price_type": kind}, TARGET)


SUMMED = {"plan_days": "payment_plan_days", "list_price": "plan_list_price", "amount_paid": "actual_amount_paid"}


def _volumes() -> list[Column]:
    """Rows, sums and counts behind the payment summary."""
    return [
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias(f"s_{k}") for k, c in SUMMED.items()],
        *[F.count(c).alias(f"n_{k}") for k, c in SUMMED.items()],
        F.sum(less_flag("actual_amount_paid", "plan_list_price")).alias("discounted"),
        F.sum("is_auto_renew").alias("renew"),
        F.sum("is_cancel").alias("cancel"),
    ]


def _summary(volumes: DataFrame, users: Column) -> DataFrame:
    def mean(name):
        return F.round(safe_divide(F.sum(f"s_{name}"), F.sum(f"n_{name}")), 1).alias(f"avg_{name}")

    def share(name, out):
        return F.round(F.sum(name) * F.lit(100.0).cast("double") / F.sum("n"), 1).alias(out)

    return volumes.agg(
        F.sum("n").alias("total_transactions"),
        users.alias("unique_users"),
        *[mean(k) for k in SUMMED],
        share("discounted", "discount_pct"),
        share("renew", "auto_renew_pct"),
        share("cancel", "cancel_pct"),
    )


def transaction_summary(transactions: DataFrame) -> DataFrame:
    """Volume, users, averages and shares. Users are counted after combining
    per user, so that the distinct count is a plain count."""
    return _summary(transactions.groupBy(ID).agg(*_volumes()), F.count(ID))


def log_range(logs: DataFrame) -> DataFrame:
    """First and last day, rows and users, by way of one row per user."""
    per_user = logs.groupBy(ID).agg(
        F.min("date").alias("lo"), F.max("date").alias("hi"), F.count(F.lit(1)).alias("n")
    )
    return per_user.agg(
        F.min("lo").alias("min_date"), F.max("hi").alias("max_date"),
        F.sum("n").alias("total_rows"), F.count(ID).alias("unique_users"),
    )


def history_totals() -> dict[str, Column]:
    return {
        "txn_count": F.count(F.lit(1)),
        "_on": F.max("transaction_date"),
        "_until": F.max("membership_expire_date"),
    }


def payment_history(transactions: DataFrame) -> DataFrame:
    """Payments per user and days from the last payment to the last paid day,
    from the greatest raw dates, parsed strictly."""
    per_user = transactions.groupBy(ID).agg(*[agg.alias(name) for name, agg in history_totals().items()])
    return _with_gap(per_user).select(ID, "txn_count", "days_until_expiry")


def _with_gap(per_user: DataFrame) -> DataFrame:
    gap = days_between(parse_ymd("_on", strict=True), parse_ymd("_until", strict=True))
    return per_user.withColumn("days_until_expiry", gap)


def user_activity(logs: DataFrame, window: tuple[int, int] | None = None) -> DataFrame:
    sums = {
        "total_secs": F.col("total_secs"), "total_complete_plays": F.col("num_100"),
        "total_unique_songs": F.col("num_unq"), "total_partial_plays": F.col("num_25"),
    }
    per_user = sums_and_distinct(logs, ID, "date", sums, "active_days", window)
    return per_user.withColumn("total_secs", F.col("total_secs").cast("double"))


def engagement(activity: DataFrame) -> DataFrame:
    """Different songs per early stop; NULL where nothing was stopped early."""
    ratio = F.col("total_unique_songs") / zero_to_null("total_partial_plays")
    return activity.withColumn("engagement_depth", ratio)


MINI = [
    TARGET, "age", "tenure_days", "last_auto_renew", "last_cancel", "last_plan_days", "has_discount",
    "txn_count", "days_until_expiry", "active_days", "total_secs", "total_unique_songs",
]


def mini_features(
    labels: DataFrame, members: DataFrame, transactions: DataFrame, logs: DataFrame, as_of: str,
    ties: Sequence[str], window: tuple[int, int] | None = None,
) -> DataFrame:
    """The small numeric table behind the correlation report. Payments are read
    once: the latest row and the history come from one aggregation."""
    paid = _with_gap(last_and_history(transactions, ties))
    return assemble_mini(labels, members, paid, user_activity(logs, window), as_of)


def last_and_history(transactions: DataFrame, ties: Sequence[str]) -> DataFrame:
    """Latest payment and totals of each user, by one aggregation."""
    latest = {c: c for c in ("is_auto_renew", "is_cancel", "payment_plan_days", "actual_amount_paid", "plan_list_price", "payment_method_id")}
    return latest_and_totals(transactions, ID, "transaction_date", ties, latest=latest, totals=history_totals())


def assemble_mini(labels: DataFrame, members: DataFrame, paid: DataFrame, activity: DataFrame, as_of: str) -> DataFrame:
    last = {"is_auto_renew": "last_auto_renew", "is_cancel": "last_cancel", "payment_plan_days": "last_plan_days"}
    return (
        labels.join(member_features(members, as_of).select(ID, "age", "tenure_days"), ID, "left")
        .join(paid.withColumnsRenamed(last), ID, "left")
        .join(activity, ID, "left")
        .withColumn("has_discount", less_flag("actual_amount_paid", "plan_list_price"))
        .select(ID, *MINI)
    )


class StagedSources:
    """The four sources, each scanned once.

    Labels, members and payments are written as Parquet, activity as one row per
    user; rows, NULLs, rules, sums and date range of a source are observed while
    it passes by. Payments are reduced to one row per user from what was written.
    Everything of the report comes from these tables and numbers.
    """

    def __init__(self, tables: Mapping[str, DataFrame], ties: Sequence[str], root: str, window: tuple[int, int] | None = None):
        self.schemas = {name: df.schema for name, df in tables.items()}
        self.spark = tables["labels"].sparkSession
        self.numbers: dict[str, DataFrame] = {}
        rules = {
            "labels": [],
            "members": audit.rule_counts(member_rules(), MEMBER_SHARES),
            "transactions": [*audit.rule_counts(_nulls(TRANSACTION_NULLS)), *_volumes()],
            "user_logs": [*audit.rule_counts(_nulls(LOG_NULLS)), F.min("date").alias("min_date"), F.max("date").alias("max_date")],
        }

        def staged(name: str, reduce=lambda df: df) -> DataFrame:
            df = tables[name]
            nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns]
            wanted = [F.count(F.lit(1)).alias("row_count"), *nulls, *rules[name]]
            seen = Observation(f"{name}_{uuid.uuid4().hex}")
            kept = stage(reduce(df.observe(seen, *wanted)), "table", f"{root}/{name}")
            shape = df.agg(*wanted).schema
            try:
                got = seen.get
            except Py4JJavaError:
                # A source known to be empty is planned away with its observer; counting it costs nothing.
                got = df.agg(*wanted).first().asDict()
            self.numbers[name] = self.spark.createDataFrame([tuple(got[f.name] for f in shape)], shape)
            return kept

        self.labels, self.members = staged("labels"), staged("members")
        self.transactions = staged("transactions")
        self.activity = staged("user_logs", lambda logs: user_activity(logs, window))
        self.paid = stage(_with_gap(last_and_history(self.transactions, ties)), "table", f"{root}/paid")

    def inventory(self) -> DataFrame:
        """Rows as observed; columns and types as the sources had them."""

        def one(name: str, schema) -> DataFrame:
            text = ", ".join(f"{f.name} ({f.dataType.simpleString()})" for f in schema.fields)
            return self.numbers[name].select(
                F.lit(name).alias("table_name"), "row_count", F.lit(len(schema.fields)).alias("column_count"), F.lit(text).alias("schema_text")
            )

        return functools.reduce(DataFrame.unionByName, (one(n, s) for n, s in self.schemas.items()))

    def source_nulls(self) -> DataFrame:
        """NULLs per table and column."""

        def one(name: str, schema) -> DataFrame:
            counts = [F.col(f"null_{f.name}").alias(f.name) for f in schema.fields]
            long = self.numbers[name].select(*counts).unpivot([], schema.names, "column_name", "null_count")
            return long.select(F.lit(name).alias("table_name"), "column_name", "null_count")

        return functools.reduce(DataFrame.unionByName, (one(n, s) for n, s in self.schemas.items()))

    def quality(self, name: str) -> DataFrame:
        rules = {"members": member_rules(), "transactions": TRANSACTION_NULLS, "user_logs": LOG_NULLS}[name]
        shares = [f"{r}_pct" for r in MEMBER_SHARES] if name == "members" else []
        names = [c for c in self.numbers[name].columns if c in {"total_rows", *rules, *shares}]
        return self.numbers[name].select(*names)

    def transaction_summary(self) -> DataFrame:
        return _summary(self.numbers["transactions"].withColumn("_users", self.paid.select(F.count(ID)).scalar()), F.max("_users"))

    def log_range(self) -> DataFrame:
        users = self.activity.select(F.count(ID)).scalar()
        return self.numbers["user_logs"].select("min_date", "max_date", F.col("row_count").alias("total_rows"), users.alias("unique_users"))


#: Smallest groups that the report lists.
MIN_SIZES = {"city": 1000, "channel": 500, "payment_method": 500, "cohort": 100}


def profile_report(
    tables: Mapping[str, DataFrame],
    as_of: str,
    ties: Sequence[str],
    root: str | None = None,
    window: tuple[int, int] | None = None,
    min_sizes: Mapping[str, int] | None = None,
    cohorts_after: int = 20040101,
) -> dict[str, Callable[[], DataFrame]]:
    """All parts of the report by name, each built when it is called for.

    The sources are staged below ``root`` first, with one scan of each.
    """
    spark = tables["labels"].sparkSession
    src = StagedSources(tables, ties, root or scratch_path(spark, "profile"), window)
    least = {**MIN_SIZES, **(min_sizes or {})}
    labels, members = src.labels, src.members
    labelled = label_members(labels, members)
    last = labels.join(src.paid, ID)
    active = labels.join(src.activity, ID)
    depth = engagement(active)
    mini = assemble_mini(labels, members, src.paid, src.activity, as_of)
    by_status = segments.segment_rate(last, ["is_auto_renew", "is_cancel"], TARGET)
    near = last.where("days_until_expiry > -100 AND days_until_expiry < 400")
    sides = {"members": members, "transactions": src.paid, "user_logs": src.activity}

    def bars(df: DataFrame, column: str, bins: int, clip: float | None = None, by=(TARGET,), density: bool = False):
        return lambda: distributions.histogram(df, column, bins, list(by), clip, density)

    def medians(df: DataFrame, columns: Sequence[str]):
        return lambda: distributions.group_median(df, [TARGET], columns)

    return {
        "inventory": src.inventory,
        "source_nulls": src.source_nulls,
        "label_balance": lambda: segments.value_shares(labels, TARGET),
        "members_quality": lambda: src.quality("members"),
        "transactions_quality": lambda: src.quality("transactions"),
        "logs_quality": lambda: src.quality("user_logs"),
        "age_histogram": bars(member_features(members, as_of), "age", 60, by=()),
        "raw_age_histogram": bars(members, "bd", 100, by=()),
        "rate_by_gender": lambda: rate_by_gender(labelled),
        "rate_by_city": lambda: segments.segment_rate(labelled, ["city"], TARGET, least["city"], k=15),
        "rate_by_channel": lambda: segments.segment_rate(labelled, ["registered_via"], TARGET, least["channel"]),
        "cohorts": lambda: segments.cohort_rate(labelled, "registration_init_time", TARGET, cohorts_after, least["cohort"]),
        "transaction_summary": src.transaction_summary,
        "rate_by_status": lambda: by_status,
        "rate_by_renewal": lambda: segments.rollup_rates(by_status, "is_auto_renew"),
        "plan_lengths": lambda: segments.value_counts(src.transactions, "payment_plan_days", k=10),
        "plan_shares": lambda: segments.value_shares(src.transactions, "payment_plan_days"),
        "rate_by_price_type": lambda: rate_by_price_type(last),
        "rate_by_payment_method": lambda: segments.segment_rate(last, ["payment_method_id"], TARGET, least["payment_method"], k=12),
        "payment_medians": medians(last, ["txn_count", "days_until_expiry"]),
        "payment_histogram": bars(last, "txn_count", 20, 20),
        "expiry_histogram": bars(near, "days_until_expiry", 50),
        "log_range": src.log_range,
        "activity_medians": medians(active, ["active_days", "total_secs", "total_unique_songs"]),
        "active_days_histogram": bars(active, "active_days", 50, density=True),
        "seconds_histogram": bars(active, "total_secs", 50, 500_000, density=True),
        "songs_histogram": bars(active, "total_unique_songs", 50, 3000, density=True),
        "plays_histogram": bars(active, "total_complete_plays", 50, 5000, density=True),
        "engagement_medians": medians(depth, ["engagement_depth"]),
        "engagement_histogram": bars(depth, "engagement_depth", 50, 5, density=True),
        "missingness_audit": lambda: audit.coverage_audit(labels, sides, ID, TARGET),
        "null_counts": lambda: audit.null_counts(mini.select(*MINI)),
        "correlations": lambda: association.corr_matrix(mini, MINI),
        "correlations_with_label": lambda: association.corr_with(mini, TARGET, MINI),
    }
