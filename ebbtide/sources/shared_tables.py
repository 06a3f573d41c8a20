"""The four logical inputs derived from the shared order and event tables.

Money is summed in whole cents, so that results do not depend on task order.
"""

from __future__ import annotations

import datetime as dt
import decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.columns import date_literal, ymd_of

OUTCOME_DAYS = 180
EARLIER, LATER = "2000-08-01", "2001-01-31"
LOG_WINDOW = (20240101, 20240131)


# Declared types spare the job that reads file footers for them.
SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _hundredths(name: str) -> Column:
    return F.rint(F.col(name) * 100).cast("long")


def _orders_before(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(F.col("o_orderdate") < date_literal(as_of))


def labels(spark: SparkSession, sf_dir: str, as_of: str = LATER) -> DataFrame:
    """1 for a customer without an order in the outcome window from ``as_of`` on."""
    start = date_literal(as_of)
    returned = (
        table(spark, sf_dir, "orders")
        .where((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < F.date_add(start, OUTCOME_DAYS)))
        .groupBy(F.col("o_custkey").alias("msno"))
        .agg(F.lit(1).alias("returned"))
    )
    return (
        table(spark, sf_dir, "customer")
        .select(F.col("c_custkey").alias("msno"))
        .join(returned, "msno", "left")
        .select("msno", F.col("returned").isNull().cast("int").alias("is_churn"))
    )


def members(spark: SparkSession, sf_dir: str, as_of: str = LATER) -> DataFrame:
    first_order = (
        _orders_before(spark, sf_dir, as_of)
        .groupBy(F.col("o_custkey").alias("msno"))
        .agg(ymd_of(F.min("o_orderdate")).alias("registration_init_time"))
    )
    segment = F.col("c_mktsegment")
    return (
        table(spark, sf_dir, "customer")
        .select(
            F.col("c_custkey").alias("msno"),
            F.col("c_nationkey").alias("city"),
            F.floor(F.col("c_acctbal") / 100).cast("int").alias("bd"),
            F.when(segment == "BUILDING", "male")
            .when(segment == "MACHINERY", "female")
            .otherwise(segment)
            .alias("gender"),
            F.pmod("c_custkey", F.lit(5)).cast("int").alias("registered_via"),
        )
        .join(first_order, "msno", "left")
    )


def transactions(spark: SparkSession, sf_dir: str, as_of: str = LATER) -> DataFrame:
    """One row per order before ``as_of``; ``txn_id`` breaks ties of one day.

    Lines are combined per order before the join, so a crowded order is reduced
    on the map side.
    """
    price = _hundredths("l_extendedprice")
    paid_parts = price * (F.lit(100) - _hundredths("l_discount"))  # hundredths of a cent
    per_order = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.sum(F.col("l_quantity").cast("int")).cast("int").alias("payment_plan_days"),
            (F.sum(price) / F.lit(100.0)).alias("plan_list_price"),
            (F.sum(paid_parts) / F.lit(10000.0)).alias("actual_amount_paid"),
            F.max("l_shipdate").alias("last_ship"),
        )
    )
    status = F.col("o_orderstatus")
    return (
        _orders_before(spark, sf_dir, as_of)
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
        .join(per_order, "o_orderkey", "left")
        .select(
            F.col("o_custkey").alias("msno"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_method_id"),
            "payment_plan_days",
            "plan_list_price",
            "actual_amount_paid",
            (status == "F").cast("int").alias("is_auto_renew"),
            ymd_of("o_orderdate").alias("transaction_date"),
            ymd_of("last_ship").alias("membership_expire_date"),
            (status == "P").cast("int").alias("is_cancel"),
            F.col("o_orderkey").alias("txn_id"),
        )
    )


# Which event type stands for which play counter (fixed values).
PLAY_EVENTS = {
    "num_25": "click",
    "num_50": "view",
    "num_75": "error",
    "num_985": "signup",
    "num_100": "purchase",
}


def user_logs(spark: SparkSession, sf_dir: str, window: tuple[int, int] | None = None) -> DataFrame:
    """One row per user and day, of all days or of a window of YYYYMMDD days.

    The window is put to the scan as a range of time stamps. Distinct ``props``
    are found by grouping on them first: the counters are combined at every
    step, so a user with very many events stays small.
    """
    day = ymd_of("ts").alias("date")
    events = table(spark, sf_dir, "events")
    if window is not None:
        first, last = (dt.datetime.strptime(str(d), "%Y%m%d").date() for d in window)
        events = events.where(
            (F.col("ts") >= date_literal(first)) & (F.col("ts") < date_literal(last + dt.timedelta(days=1)))
        )
    per_props = (
        events.groupBy(F.col("user_id").alias("msno"), day, "props")
        .agg(
            *[F.count_if(F.col("event_type") == kind).alias(name) for name, kind in PLAY_EVENTS.items()],
            F.sum(_hundredths("value")).alias("parts"),
        )
    )
    return per_props.groupBy("msno", "date").agg(
        *[F.sum(name).alias(name) for name in PLAY_EVENTS],
        F.count("props").alias("num_unq"),
        (F.sum("parts").cast("decimal(18,0)") * F.lit(decimal.Decimal("0.01"))).alias("total_secs"),
    )


def scores(spark: SparkSession, sf_dir: str, as_of: str = LATER) -> DataFrame:
    """A deterministic score from recency, so that metrics have exact SQL twins."""
    last = (
        _orders_before(spark, sf_dir, as_of)
        .groupBy(F.col("o_custkey").alias("msno"))
        .agg(F.datediff(date_literal(as_of), F.max("o_orderdate")).alias("recency"))
    )
    gap = F.col("recency")
    return (
        labels(spark, sf_dir, as_of)
        .join(last, "msno", "left")
        .select(
            "msno",
            F.col("is_churn").alias("y_true"),
            F.coalesce(gap / (gap + F.lit(180.0)), F.lit(0.5)).alias("y_prob"),
        )
    )
