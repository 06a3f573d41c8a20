"""Merkle manifest of a table: a proof for every row, built by a butterfly exchange.

Rows are ranked inside their group by (key, leaf). A partition is an aligned run
of FANOUT ** k leaves of one group; it hashes its own subtree. Then aligned sets
of FANOUT partitions swap the roots of their subtrees: in round r the sets are
the partitions whose numbers agree in all digits but digit r. Each hashes the
common parent for itself, so after log(partitions) rounds every partition holds
the group's root and the siblings of all its upper ancestors, and nothing has to
travel back down. Where the last run of a level is short, its partitions take
turns in answering, so that none is asked by more partitions than needed. The
roots of the groups are the leaves of a second tree, built the same way.

A step of a proof is (left, right): the hex digests of the run's other nodes
before and after the own one, run together. ``fold`` hashes a leaf up a proof.

Memory: a task holds one partition (MOST leaves at most) and its proofs. A group
with most rows is many partitions. No digests come to the driver, only counts.

Nulls, edges: a null field is hashed as ``-``, another as byte count, ``:`` and
value. A null key comes before all others, a null group is a group of its own
and comes first. Rows equal in group and key are ranked by their leaves; equal
leaves are alike, so which comes first makes no difference. Texts may be of any
length. An empty table gives no rows. Columns not asked for are not read, so
their names cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ebbtide.llm import common

FANOUT = 2
#: Levels of the tree inside one partition: between these, by the number of rows for each task.
LEAST, MOST = 8, 16
#: Rounds of the exchange between two tables in the shared folder.
ROUNDS_KEPT = 4

STEPS = "array<struct<left: string, right: string>>"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]).cast("binary"), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof, upwards and from left to right, run together."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def _hash(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def _levels(leaves: list[str], n: int, levels: int, fanout: int) -> list[list[str]]:
    """The nodes of a partition level by level; n: leaves of the whole group."""
    out = [leaves]
    while n > 1 and len(out) <= levels:
        below = out[-1]
        out.append([_hash(below[i : i + fanout]) for i in range(0, len(below), fanout)])
        n = -(-n // fanout)
    return out


def ranked(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """grp and the other columns, with pos (from 0) and n (rows) inside the group."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The number of the row parts even equal rows, so a range holds its share and no more.
    named = rows.withColumns({f"_o{i}": c for i, c in enumerate(order)}).withColumn("_row", F.monotonically_increasing_id())
    keys = [*[f"_o{i}" for i in range(len(order))], "_row"]
    laid = named.repartitionByRange(parts, "grp", *keys).withColumn("_range", F.spark_partition_id())
    laid = common.stage(laid, "ranges")
    upto = Window.partitionBy("grp").orderBy("_range")
    sizes = laid.groupBy("grp", "_range").agg(F.count("*").alias("_n"))
    sizes = sizes.select(
        "grp", "_range", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy("grp")).alias("n")
    )
    inside = Window.partitionBy("grp", "_range").orderBy(*keys)
    numbered = laid.withColumn("_at", F.row_number().over(inside))
    out = numbered.join(sizes, ["grp", "_range"]).withColumn("pos", F.col("_before") + F.col("_at") - 1)
    return out.drop(*keys, "_range", "_before", "_at")


def exchange(state: DataFrame, rounds: int, fanout: int = FANOUT) -> DataFrame:
    """grp, chunk, m, digest, path after all rounds: the group's root and the upper proof of each partition.

    ``state`` has a row for each partition: its number, how many there are in the
    group, its subtree's root and an empty path.
    """
    for r in range(rounds):
        width = fanout**r
        block = F.floor(F.col("chunk") / width)
        blocks = F.ceil(F.col("m") / width)
        at = state.withColumns({"block": block, "blocks": blocks})
        first = (F.floor(F.col("block") / fanout) * fanout).cast("long")
        last = F.least(first + fanout, F.col("blocks")) - 1
        # The partitions of this block share out those of each other block of the set.
        mine = F.col("chunk") - F.col("block") * width
        held = F.least(F.lit(width).cast("long"), F.col("m") - F.col("block") * width)
        targets = F.flatten(
            F.transform(
                F.filter(F.sequence(first, last), lambda t: (t != F.col("block")) & (t * width + mine < F.col("m"))),
                lambda t: F.filter(
                    F.sequence(t * width + mine, F.greatest(t * width + mine, F.least((t + 1) * width, F.col("m")) - 1), held),
                    lambda c: c < F.least((t + 1) * width, F.col("m")),
                ),
            )
        )
        none = F.lit(None)
        sent = at.select("grp", F.explode(targets).alias("chunk"), none.cast("long").alias("m"), "block", "digest", none.cast(STEPS).alias("path"))
        own = at.select("grp", "chunk", "m", "block", "digest", "path")
        met = own.unionByName(sent).groupBy("grp", "chunk").agg(
            F.max("m").alias("m"),
            F.first("path", ignorenulls=True).alias("path"),
            F.sort_array(F.collect_list(F.struct("block", "digest"))).alias("run"),
        )
        here = F.floor(F.col("chunk") / width)

        def some(keep):
            return F.array_join(F.transform(F.filter("run", keep), lambda x: x["digest"]), "")

        step = F.struct(some(lambda x: x["block"] < here).alias("left"), some(lambda x: x["block"] > here).alias("right"))
        above = F.ceil(F.col("m") / width) > 1
        state = met.select(
            "grp",
            "chunk",
            "m",
            F.when(above, F.sha2(some(lambda x: x["block"] >= 0).cast("binary"), 256)).otherwise(F.col("run")[0]["digest"]).alias("digest"),
            F.when(above, F.concat("path", F.array(step))).otherwise(F.col("path")).alias("path"),
        )
        if r % ROUNDS_KEPT == ROUNDS_KEPT - 1:
            state = common.stage(state, "butterfly")
    return state


def proofs(leaves: DataFrame, order: Sequence[Column], fanout: int = FANOUT, levels: int | None = None) -> DataFrame:
    """The rows of ``leaves`` (grp, leaf and others) with their proof inside the group and the group's root."""
    spark = leaves.sparkSession
    common.ship(spark)
    rows = common.stage(ranked(leaves, order), "leaves")
    total, most = rows.agg(F.count("*"), F.max("n")).first()
    if levels is None:
        tasks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        levels = min(MOST, max(LEAST, int(math.log2(max(1, total // tasks)))))
        levels = max(1, int(levels / math.log2(fanout)))
    size = fanout**levels
    rows = rows.withColumn("chunk", F.floor(F.col("pos") / size).cast("long"))

    def top(part: pa.Table) -> pa.Table:
        part = part.sort_by("pos")
        n = part.column("n")[0].as_py()
        root = _levels(part.column("leaf").to_pylist(), n, levels, fanout)[-1][0]
        return pa.table(
            [part.column("grp")[:1], part.column("chunk")[:1], pa.array([-(-n // size)], pa.int64()), pa.array([root])],
            ["grp", "chunk", "m", "digest"],
        )

    needed = rows.select("grp", "chunk", "pos", "n", "leaf").groupBy("grp", "chunk")
    tops = needed.applyInArrow(top, "grp string, chunk long, m long, digest string")
    tops = tops.withColumn("path", F.array().cast(STEPS))
    rounds = 0
    while fanout**rounds * size < (most or 0):
        rounds += 1
    upper = common.stage(exchange(common.stage(tops, "tops"), rounds, fanout), "uppers")
    kept = rows.drop("chunk", "n").columns
    schema = upper.select("path").withColumnRenamed("path", "proof").schema.add("top", "string")
    schema = StructType([*rows.select(*kept).schema, *schema])

    def prove(part: pa.Table, told: pa.Table) -> pa.Table:
        part = part.sort_by("pos")
        below = _levels(part.column("leaf").to_pylist(), part.column("n")[0].as_py(), levels, fanout)
        above = told.column("path")[0].as_py()
        steps = []
        for nodes in below[:-1]:
            here = []
            for i in range(len(nodes)):
                first = i - i % fanout
                here.append({"left": "".join(nodes[first:i]), "right": "".join(nodes[i + 1 : first + fanout])})
            steps.append(here)
        paths = [[s[i // fanout**j] for j, s in enumerate(steps)] + above for i in range(part.num_rows)]
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        out = part.select(kept).append_column("proof", pa.array(paths, kind))
        return out.append_column("top", pa.array([told.column("digest")[0].as_py()] * part.num_rows, pa.string()))

    both = rows.groupBy("grp", "chunk").cogroup(upper.groupBy("grp", "chunk"))
    return both.applyInArrow(prove, schema)


def manifest(leaves: DataFrame, group: Column, key: Column, fanout: int = FANOUT, levels: int | None = None) -> DataFrame:
    """Every row of ``leaves`` (a column leaf and others) with subroot, root and proof."""
    taken = leaves.columns
    # A text that sorts as the group does, null first, and is never null.
    grouped = leaves.withColumn("grp", F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("")))
    inner = common.stage(proofs(grouped, [key, F.col("leaf")], fanout, levels), "proofs")
    roots = inner.where("pos = 0").select(F.lit("").alias("grp"), F.col("top").alias("leaf"), F.col("grp").alias("name"))
    outer = common.stage(proofs(roots, [F.col("name")], fanout, levels), "roots")
    outer = outer.select(F.col("name").alias("grp"), F.col("top").alias("root"), F.col("proof").alias("upper"))
    return inner.join(outer, "grp").select(
        *taken, F.col("top").alias("subroot"), "root", F.concat("proof", "upper").alias("proof")
    )


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op11_merkle_manifest(spark, sf_dir):
    """Manifest of the documents by language, and what a changed length does to its root."""
    docs = common.table(spark, sf_dir, "documents").select(*FIELDS)
    values = {c: F.col(c) for c in FIELDS}
    forged = leaf_digest(*{**values, "n_chars": F.try_add(F.col("n_chars"), F.lit(1))}.values())
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaves = docs.select("doc_id", "lang", leaf_digest(*values.values()).alias("leaf"), F.when(marked, forged).alias("forged"))
    told = manifest(leaves, F.col("lang"), F.col("doc_id"))
    folded = told.withColumn("folded_root", fold(F.coalesce("forged", "leaf"), F.col("proof")))
    return folded.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _sql_field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_sql_field(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


ORACLE_SQL = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, lang, {_sql_leaf("n_chars")} AS leaf, {_sql_leaf("n_chars + 1")} AS forged,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n,
    xor(4294967295, list_reduce(
      list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: list_concat([CAST(ord(c) AS BIGINT)], [-1, -1, -1, -1, -1, -1, -1, -1])))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)) AS crc
  FROM documents
), tree(lvl, lang, i, h, n) AS (
  SELECT CAST(0 AS BIGINT), lang, i, leaf, n FROM base
  UNION ALL
  SELECT lvl + 1, lang, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2
  FROM tree WHERE n > 1 GROUP BY lvl, lang, i // 2, n
), subroots AS (
  SELECT lang, lvl AS height, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1
), upper(lvl, i, h, n) AS (
  SELECT CAST(0 AS BIGINT), i, h, n FROM subroots
  UNION ALL
  SELECT lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM upper WHERE n > 1 GROUP BY lvl, i // 2, n
), steps AS (
  SELECT b.doc_id, t.lvl AS step, (b.i >> t.lvl) % 2 = 1 AS is_right, s.h
  FROM base b JOIN tree t ON t.lang IS NOT DISTINCT FROM b.lang AND t.i = b.i >> t.lvl AND t.n > 1
  LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM t.lang AND s.lvl = t.lvl AND s.i = xor(t.i, 1)
  UNION ALL
  SELECT b.doc_id, r.height + t.lvl, (r.i >> t.lvl) % 2 = 1, s.h
  FROM base b JOIN subroots r ON r.lang IS NOT DISTINCT FROM b.lang
  JOIN upper t ON t.i = r.i >> t.lvl AND t.n > 1
  LEFT JOIN upper s ON s.lvl = t.lvl AND s.i = xor(t.i, 1)
), folded(doc_id, step, h) AS (
  SELECT doc_id, CAST(0 AS BIGINT), CASE WHEN crc % 7 = 0 THEN forged ELSE leaf END FROM base
  UNION ALL
  SELECT f.doc_id, f.step + 1, sha256(CASE WHEN s.is_right THEN coalesce(s.h, '') || f.h ELSE f.h || coalesce(s.h, '') END)
  FROM folded f JOIN steps s ON s.doc_id = f.doc_id AND s.step = f.step
), proved AS (
  SELECT doc_id, sha256(coalesce(string_agg(h, '' ORDER BY step), '')) AS proof_sha256 FROM steps GROUP BY doc_id
), ends AS (
  SELECT doc_id, arg_max(h, step) AS folded_root FROM folded GROUP BY doc_id
)
SELECT b.doc_id, b.leaf, r.h AS subroot, top.h AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
       e.folded_root, e.folded_root = top.h AS verified
FROM base b JOIN subroots r ON r.lang IS NOT DISTINCT FROM b.lang
CROSS JOIN (SELECT h FROM upper WHERE n = 1) top
JOIN ends e USING (doc_id) LEFT JOIN proved p USING (doc_id)
"""
