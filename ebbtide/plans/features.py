"""The feature table: one row per labelled user, for any reference date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.columns import (
    date_literal,
    days_between,
    less_flag,
    normalize_category,
    null_outside,
    parse_ymd,
    present_flag,
    row_sum,
    safe_divide,
)
from ebbtide.operators.distinct import sums_and_distinct
from ebbtide.operators.latest import latest_and_totals

ID, TARGET = "msno", "is_churn"

# The names and the order of the feature columns.
PRESENCE = ["has_member_data", "has_transaction_data", "has_age"]
MEMBER = ["age", "gender", "city", "registered_via", "tenure_days"]
LAST = [
    "last_payment_method", "last_auto_renew", "last_cancel", "last_plan_days",
    "last_amount_paid", "last_list_price", "last_has_discount",
]
COUNTS = ["txn_count", "total_cancels", "total_auto_renews", "total_discounts"]
PLAYS = [
    "complete_plays", "unique_songs", "partial_plays", "half_plays",
    "three_quarter_plays", "near_complete_plays", "total_plays",
]
RATIOS = ["completion_rate", "engagement_depth", "avg_daily_secs", "mins_per_song"]
ACTIVITY = ["active_days", "total_secs", *PLAYS, *RATIOS]
MART = [
    ID, TARGET, *PRESENCE, *MEMBER, *LAST, "last_price_per_day",
    *COUNTS, "days_until_expiry", *ACTIVITY,
]

AGE_RANGE = (10, 70)
GENDERS = ("male", "female")


def member_features(members: DataFrame, as_of: str, strict_dates: bool = True) -> DataFrame:
    """Cleaned member attributes and tenure at ``as_of`` (negative for later sign-ups)."""
    joined = parse_ymd("registration_init_time", strict=strict_dates)
    return members.select(
        ID,
        "city",
        null_outside("bd", *AGE_RANGE).alias("age"),
        normalize_category("gender", GENDERS).alias("gender"),
        "registered_via",
        "registration_init_time",
        days_between(joined, date_literal(as_of)).alias("tenure_days"),
    )


def clean_transactions(transactions: DataFrame) -> DataFrame:
    """Dates parsed leniently and a discount flag; further columns are kept."""
    return transactions.withColumns(
        {
            "transaction_date": parse_ymd("transaction_date"),
            "membership_expire_date": parse_ymd("membership_expire_date"),
            "has_discount": less_flag("actual_amount_paid", "plan_list_price"),
        }
    )


def transaction_features(
    transactions: DataFrame, ratio_mode: str = "nonzero", ties: Sequence[str] = ()
) -> DataFrame:
    """State of the latest payment and totals of the whole history, per user."""
    sources = [
        "payment_method_id", "is_auto_renew", "is_cancel", "payment_plan_days",
        "actual_amount_paid", "plan_list_price", "has_discount",
    ]
    per_user = latest_and_totals(
        clean_transactions(transactions),
        key=ID,
        order_by="transaction_date",
        ties=ties,
        latest=dict(zip(LAST, sources)),
        totals={
            "txn_count": F.count(F.lit(1)),
            "total_cancels": F.sum("is_cancel"),
            "total_auto_renews": F.sum("is_auto_renew"),
            "total_discounts": F.sum("has_discount"),
            "_paid_until": F.max("membership_expire_date"),
            "_paid_on": F.max("transaction_date"),
        },
    )
    return per_user.select(
        ID,
        *LAST,
        safe_divide("last_list_price", "last_plan_days", mode=ratio_mode).alias("last_price_per_day"),
        *COUNTS,
        days_between("_paid_on", "_paid_until").alias("days_until_expiry"),
    )


def activity_features(
    logs: DataFrame, window: tuple[int, int] | None = None, ratio_mode: str = "nonzero"
) -> DataFrame:
    """Active days, play counts and their ratios per user, inside ``window``."""
    counters = {
        "complete_plays": "num_100",
        "unique_songs": "num_unq",
        "partial_plays": "num_25",
        "half_plays": "num_50",
        "three_quarter_plays": "num_75",
        "near_complete_plays": "num_985",
    }
    sums = {"total_secs": F.col("total_secs")}
    sums |= {name: F.col(source) for name, source in counters.items()}
    sums["total_plays"] = row_sum(["num_25", "num_50", "num_75", "num_985", "num_100"])
    per_user = sums_and_distinct(logs, ID, "date", sums, "active_days", window).withColumn(
        "total_secs", F.col("total_secs").cast("double")
    )

    def ratio(num, den):
        return safe_divide(num, den, mode=ratio_mode)

    return per_user.select(
        ID,
        "active_days",
        F.coalesce("total_secs", F.lit(0.0)).alias("total_secs"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in PLAYS],
        ratio("complete_plays", "total_plays").alias("completion_rate"),
        ratio("unique_songs", "partial_plays").alias("engagement_depth"),
        ratio("total_secs", "active_days").alias("avg_daily_secs"),
        ratio(F.col("total_secs") / F.lit(60.0), "unique_songs").alias("mins_per_song"),
    )


def assemble(labels: DataFrame, member: DataFrame, txn: DataFrame, activity: DataFrame) -> DataFrame:
    """Every labelled user with whatever the three sides know about them.

    Each side has one row per user and is already laid out by user, so the
    joins add no skew; labels are the only side shuffled for the join itself.
    Counts and activity become 0 where a side has no row, the rest stays NULL.
    """
    wide = (
        labels.select(ID, TARGET)
        .join(member.withColumn("_in_members", F.lit(1)), ID, "left")
        .join(txn.withColumn("_in_transactions", F.lit(1)), ID, "left")
        .join(activity, ID, "left")
    )
    flagged = wide.withColumns(
        {
            "has_member_data": present_flag("_in_members"),
            "has_transaction_data": present_flag("_in_transactions"),
            "has_age": present_flag("age"),
        }
    )
    return flagged.fillna(0, subset=[*COUNTS, *ACTIVITY]).select(*MART)


def churn_features(
    labels: DataFrame,
    members: DataFrame,
    transactions: DataFrame,
    logs: DataFrame,
    as_of: str,
    log_window: tuple[int, int] | None = None,
    ratio_mode: str = "nonzero",
    txn_ties: Sequence[str] = (),
    strict_dates: bool = True,
) -> DataFrame:
    """The 36-column feature table; the same code serves every period."""
    return assemble(
        labels,
        member_features(members, as_of, strict_dates),
        transaction_features(transactions, ratio_mode, txn_ties),
        activity_features(logs, log_window, ratio_mode),
    )
