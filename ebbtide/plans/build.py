"""The feature table built stage by stage; each stage is checked before anything that depends on it is written.

A stage is written once as Parquet, in buckets by user: neither its checks nor the
joins of the feature table move its rows again. All its checks, uniqueness too, are one
aggregation over what was written, one row per user: combined by user first, then
summed. Of the two sources that are combined on the way (payments, activity) only
the key column is read again for its own check. Stages that don't need each other
run side by side. The gate looks at the collected check rows; when one has
failures, nothing that depends on its stage is written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession

from ebbtide.operators import audit
from ebbtide.plans import features as ft
from ebbtide.sources import files

Checks = Sequence[tuple[str, str, Column]]
GENDERS = ["male", "female", "unknown"]


class Stages:
    """Stages written so far, and every check made on them."""

    def __init__(self, root: str):
        self.root = root
        self.frames: dict[str, DataFrame] = {}
        self.checks: list[tuple[str, str, str, int]] = []

    def check(self, name: str, df: DataFrame, checks: Checks) -> None:
        self.checks += [tuple(r) for r in audit.value_checks(name, df, checks).select(*audit.CHECK_COLUMNS).collect()]

    def write(self, name: str, df: DataFrame, checks: Checks) -> None:
        kept = self.frames[name] = files.stage(df, "bucketed", f"{self.root}/{name}", ft.ID)
        self.checks += [tuple(r) for r in audit.keyed_checks(name, kept, ft.ID, checks).select(*audit.CHECK_COLUMNS).collect()]

    def side_by_side(self, *jobs: Callable[[], None]) -> None:
        """Independent stages at the same time, each with its own Spark jobs."""
        session = SparkSession.active()
        with ThreadPool(len(jobs)) as pool:
            pool.map(inheritable_thread_target(session)(lambda job: job()), jobs, chunksize=1)

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame(self.checks, "model string, column_name string, test string, failures long")

    def gate(self) -> None:
        audit.refuse(self.checks)


def steps(
    tables: Mapping[str, DataFrame], as_of: str, stages: Stages, window=None, mode: str = "nonzero", ties: Sequence[str] = ()
) -> Iterator[str]:
    """Write one layer of stages after the other; the caller decides between them whether to go on."""
    key, label = ft.ID, ft.TARGET
    members = ft.member_features(tables["members"], as_of)
    stages.side_by_side(
        lambda: stages.write("staged_labels", tables["labels"], [audit.not_null(key), audit.not_null(label), audit.accepted_values(label, [0, 1])]),
        lambda: stages.write("staged_members", members, [audit.not_null(key), audit.accepted_values("gender", GENDERS)]),
        lambda: stages.check("staged_transactions", tables["transactions"], [audit.not_null(key)]),
        lambda: stages.check("staged_logs", tables["user_logs"], [audit.not_null(key)]),
    )
    yield "sources"
    stages.side_by_side(
        lambda: stages.write("transaction_features", ft.transaction_features(tables["transactions"], mode, ties), [audit.not_null(key)]),
        lambda: stages.write("activity_features", ft.activity_features(tables["user_logs"], window, mode), [audit.not_null(key)]),
    )
    yield "features"
    done = stages.frames
    mart = ft.assemble(done["staged_labels"], done["staged_members"], done["transaction_features"], done["activity_features"])
    stages.write("feature_table", mart, [audit.not_null(key), audit.not_null(label)])
    yield "feature_table"


def gated_build(tables: Mapping[str, DataFrame], as_of: str, root: str, **options) -> Stages:
    """Build below ``root``; raises ``audit.ChecksFailed`` at the first layer with a stage that fails a check."""
    stages = Stages(root)
    for _ in steps(tables, as_of, stages, **options):
        stages.gate()
    return stages
