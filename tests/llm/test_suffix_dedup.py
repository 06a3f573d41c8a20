import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import common, suffix_dedup as sd

SCHEMA = "doc_id long, text string"


def brute(rows, width=100):
    """Every window of every document, in order of id and start."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            w = b[p : p + width]
            if w in seen:
                gone[p : p + width] = b"\1" * width
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and (not p or not gone[p - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def as_dict(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in df.collect()}


def test_whole_documents_against_every_window(spark, sf_dir):
    rows = [tuple(r) for r in common.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in sd.op1_suffix_dedup(spark, sf_dir).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("run_bytes,stretch", [(1 << 24, 1 << 21), (1500, 300)])
def test_edges_runs_and_stretches(spark, monkeypatch, run_bytes, stretch):
    monkeypatch.setattr(sd, "RUN_BYTES", run_bytes)
    monkeypatch.setattr(sd, "STRETCH", stretch)
    draw = random.Random(3)
    words = [draw.choice(["alpha", "be", "gamma", "dé", "e"]) + str(draw.randrange(30)) for _ in range(3000)]
    text = lambda a, b: " ".join(words[a:b])
    rows = [
        (5, text(0, 60)),
        (3, text(20, 90)),
        (9, text(0, 60)),
        (4, "a" * 1000),
        (8, "a" * 99),
        (7, "b" + "a" * 150 + "c"),
        (1, None),
        (2, ""),
        (6, "x" * 100),
        (10, "x" * 99 + "y" + "x" * 100),
        (11, text(100, 900)),
        (12, "é" * 80 + text(150, 170) + text(300, 340)),
        (13, "\0" * 250),
        (14, text(100, 900) + text(100, 900)),
    ]
    for i in range(20, 60):
        a = draw.randrange(2500)
        rows.append((i, text(a, a + draw.randrange(10, 200)) + text(40, 40 + draw.randrange(60))))
    df = spark.createDataFrame([(*r, 0, "s") for r in rows], SCHEMA + ", start int, text_key string")
    assert as_dict(sd.dedup(df)) == brute(rows)


def test_large_group_by_distance(spark):
    common_part = "".join(chr(97 + i % 26) for i in range(130))
    rows = [(i, f"{i:06d}" * 20 + common_part + f"{i % 40:05d}" * 20) for i in range(1400)]
    got = as_dict(sd.dedup(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert got == brute(rows)


def test_repeated_rows_null_ids_and_no_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text)], SCHEMA)
    got = sorted((r["doc_id"] or 99, r["n_removed"]) for r in sd.dedup(df).collect())
    assert got == [(1, 0), (1, 0), (2, len(text)), (99, len(text))]
    assert sd.dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_task_merges_one_range_and_gets_its_blocks_in_small_batches(spark):
    common.ship(spark)
    size = common.BATCH_BYTES // 4
    runs = spark.createDataFrame([(p, 0, 0, 0, 0) for p in range(31)] * 9 + [(None, i, i, i, i) for i in range(50)], "part int, doc_id long, text_key long, start long, end long")
    runs = runs.withColumn("block", F.when(F.col("part") < 3, F.expr(f"cast(repeat('x', {size}) as binary)")))

    def seen(batches):
        for b in batches:
            parts = b.column(b.schema.get_field_index("part")).to_pylist()
            late = None in parts[1:] and parts[0] is not None
            columns = [pa.array([sorted({p for p in parts if p is not None})], pa.list_(pa.int32())), pa.array([b.nbytes]), pa.array([late])]
            yield pa.RecordBatch.from_arrays(columns, ["parts", "size", "late"])

    placed = sd.by_range(runs, 31)
    in_task = placed.where("part is not null").groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("part").alias("n")).collect()
    assert [r["n"] for r in in_task] == [1] * 31
    got = placed.mapInArrow(seen, "parts array<int>, size long, late boolean").collect()
    assert max(r["size"] for r in got) < common.BATCH_BYTES + size + 1000
    assert not any(r["late"] or len(r["parts"]) > 1 for r in got)
