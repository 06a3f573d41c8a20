"""Results of an experiment as one folder that appears whole or not at all.

Tables, models and values are written below a folder of another name, the
manifest last; then that folder is renamed to its place in one step. The manifest
names every artifact with its rows, columns and a digest of its content, so that a
reader needs nothing else and notices what is missing or has changed. (A store
whose renames are not atomic still shows no manifest before all is written.)
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.models.learners import Fitted

FORMAT = 1


class IncompleteArtifacts(RuntimeError):
    pass


def _path(spark: SparkSession, path: str):
    """The file system of a path and the path, as the cluster's store knows them."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    store, at = _path(spark, path)
    return store.exists(at)


def fingerprint(spark: SparkSession, *paths: str) -> tuple:
    """Path, size and time of change of each file or folder of files."""
    out = []
    for path in paths:
        store, at = _path(spark, path)
        for status in store.globStatus(at) or []:
            files = store.listStatus(status.getPath()) if status.isDirectory() else [status]
            out += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files]
    return tuple(sorted(out))


def content(df: DataFrame) -> tuple[int, str]:
    """Rows, and the sum of their hashes, which no order or layout changes."""
    hashes = F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)"))
    row = df.agg(F.count(F.lit(1)).alias("n"), hashes.alias("h")).first()
    return row.n, str(row.h or 0)


def write_artifacts(
    spark: SparkSession,
    path: str,
    tables: Mapping[str, DataFrame],
    models: Mapping[str, Fitted] | None = None,
    values: Mapping[str, object] | None = None,
) -> dict:
    """Write everything, then make ``path`` visible; returns the manifest."""
    if exists(spark, path):
        raise FileExistsError(path)
    hidden = f"{path}.partial-{uuid.uuid4().hex}"
    manifest: dict = {"format": FORMAT, "tables": {}, "models": {}, "values": dict(values or {})}
    for name, df in tables.items():
        df.write.parquet(f"{hidden}/tables/{name}")
        kept = spark.read.parquet(f"{hidden}/tables/{name}")
        n, digest = content(kept)
        manifest["tables"][name] = {"rows": n, "digest": digest, "columns": kept.columns}
    for name, fitted in (models or {}).items():
        fitted.save(f"{hidden}/models/{name}")
        manifest["models"][name] = {"kind": fitted.kind, "stages": len(fitted.model.stages), "features": [*fitted.numeric, *fitted.categorical]}
    text = spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string")
    text.coalesce(1).write.text(f"{hidden}/manifest")
    store, source = _path(spark, hidden)
    if exists(spark, path) or not store.rename(source, _path(spark, path)[1]):
        raise FileExistsError(path)
    return manifest


class Artifacts:
    """A finished folder. Opening it refuses one without manifest; ``verify``
    also reads every table and refuses one that is not what was written."""

    def __init__(self, spark: SparkSession, path: str, verify: bool = True):
        self.spark, self.path = spark, path
        if not exists(spark, f"{path}/manifest/_SUCCESS"):
            raise IncompleteArtifacts(f"{path} has no manifest")
        lines = spark.read.option("wholetext", True).text(f"{path}/manifest").collect()
        try:
            self.manifest = json.loads("".join(r.value for r in lines))
        except json.JSONDecodeError as e:
            raise IncompleteArtifacts(f"{path} has a broken manifest") from e
        if self.manifest.get("format") != FORMAT:
            raise IncompleteArtifacts(f"{path} has format {self.manifest.get('format')}, not {FORMAT}")
        if verify:
            broken = self.broken()
            if broken:
                raise IncompleteArtifacts(f"{path}: {', '.join(broken)} missing or changed")

    def broken(self) -> list[str]:
        """Names of artifacts that are missing or differ from the manifest."""
        out = []
        for name, told in self.manifest["tables"].items():
            there = exists(self.spark, f"{self.path}/tables/{name}/_SUCCESS")
            kept = self.table(name) if there else None
            if kept is None or kept.columns != told["columns"] or content(kept) != (told["rows"], told["digest"]):
                out.append(name)
        out += [name for name in self.manifest["models"] if not exists(self.spark, f"{self.path}/models/{name}/metadata/_SUCCESS")]
        return out

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/tables/{name}")

    def model(self, name: str) -> Fitted:
        return Fitted.load(f"{self.path}/models/{name}")

    def value(self, name: str):
        return self.manifest["values"][name]
