"""Time two forms of "latest row and totals per user": the maximum of a struct
(a sort-based aggregate) and max_by on a packed decimal key (a hash aggregate).

Usage: python tools/latest_variants.py [sf_dir] [copies]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from ebbtide.operators.latest import latest_and_totals  # noqa: E402
from ebbtide.session import local_session  # noqa: E402
from ebbtide.sources import shared_tables as st  # noqa: E402

LATEST = ["payment_method_id", "is_auto_renew", "is_cancel", "payment_plan_days", "actual_amount_paid", "plan_list_price"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 12
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    rows = st.transactions(spark, sf_dir).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    rows = rows.withColumn("txn_id", F.col("txn_id") * copies + F.col("copy")).drop("copy").persist()
    print(rows.count(), "rows")
    totals = {"n": F.count(F.lit(1)), "cancels": F.sum("is_cancel"), "until": F.max("membership_expire_date")}

    def struct():
        return latest_and_totals(rows, "msno", "transaction_date", ["txn_id"], {c: c for c in LATEST}, totals)

    def packed():
        day = F.coalesce("transaction_date", F.lit(-1)).cast("decimal(18,0)")
        key = (day * F.expr("CAST(9223372036854775807 AS DECIMAL(19,0))") + F.col("txn_id").cast("decimal(19,0)")).cast("decimal(38,0)")
        picks = [F.max_by(c, "key").alias(c) for c in LATEST]
        return rows.withColumn("key", key).groupBy("msno").agg(*picks, *[a.alias(n) for n, a in totals.items()])

    assert not struct().select("msno", *LATEST).exceptAll(packed().select("msno", *LATEST)).count()
    for _ in range(3):
        for form in (struct, packed):
            start = time.perf_counter()
            form().write.format("noop").mode("overwrite").save()
            print(form.__name__, round(time.perf_counter() - start, 2), "s")


if __name__ == "__main__":
    main()
