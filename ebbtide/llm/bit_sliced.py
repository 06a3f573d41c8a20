"""Exact top-k inner products over a bit-sliced index.

Each vector component becomes an integer, floor(scale * x). A block of rows (in
ascending id) holds, for every dimension, the bits of (value - least value of the
block) as packed bitmaps: slice b has bit b of all rows. A query adds the slices
of all dimensions, shifted by the set bits of its own integers, with bitmap
adders: three bitmaps of one weight become a sum of that weight and a carry of
the next. A negative query component uses the complement of the slices, so all
terms are non-negative and the rest is one constant for query and block. The sum
is again bit-sliced; from its most significant slice downward, rows are taken as
surely in or surely out, and those that tie at the boundary are resolved exactly
by the smaller id. Every block gives its best k for each query, and a ranking
over blocks gives the answer.

Rows are dealt out evenly, and each partition streams into one block of the index,
which is a single row of bitmaps. The queries go to the blocks as single rows: a
partition receives one block, and after it its queries in small batches. A block
has as many copies as it takes to keep all cores at work, each with a share of the
queries. So a task holds one block and one batch, however large the tables are;
nothing is broadcast and no row pair is ever made.

Nulls, edges: a vector that is null, or holds a null or a non-finite component,
is neither candidate nor query; so is a row without id. Vectors of fewer
components than others are filled with 0. Rows of one id are not candidates of a
query with that id; other repeated rows each count. Fewer candidates than k give
all. Ties go to the smaller id. An empty table gives no rows; only the two named
columns are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm import common

#: Most rows of an index block, and most bytes of its integers.
ROW_BLOCK, BLOCK_BYTES = 1 << 16, 1 << 25
#: Queries that are worth a copy of an index block where cores are idle, and most queries of one copy.
QUERY_BLOCK, MOST_QUERIES = 128, 1 << 14


def to_integers(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """id, v: the integer vectors of the rows that take part."""
    x = F.col(vec_col)
    fine = F.col(id_col).isNotNull() & x.isNotNull() & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf"))
    )
    return df.where(F.coalesce(fine, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), F.transform(x, lambda e: F.floor(e.cast("double") * scale)).alias("v")
    )


def _matrix(vectors: pa.Array) -> np.ndarray:
    at = np.asarray(vectors.offsets)
    flat = np.asarray(vectors.values)[at[0] : at[-1]]
    lengths = np.diff(at)
    wide = int(lengths.max(initial=0))
    if len(flat) == wide * len(lengths):
        return flat.reshape(len(lengths), wide).astype(np.int64)
    out = np.zeros((len(lengths), wide), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(at[:-1] - at[0], lengths)] = flat
    return out


class Slices:
    """The bit-sliced index of one block of rows, sorted by id."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.n, self.dims = rows.shape
        self.words = (self.n + 63) // 64
        self.low = rows.min(axis=0)
        self.high = rows.max(axis=0)
        self.slices: list[list[np.ndarray]] = []
        for d in range(self.dims):
            u = (rows[:, d][order] - self.low[d]).astype(np.uint64)
            bits = int(self.high[d] - self.low[d]).bit_length()
            self.slices.append([self._pack((u >> np.uint64(b)) & np.uint64(1)) for b in range(bits)])
        self.full = self._pack(np.ones(self.n, np.uint8))

    def to_bytes(self) -> bytes:
        """Rows and dimensions, ids, least and greatest values, then all bitmaps."""
        parts = [np.array([self.n, self.dims], np.int64), self.ids, self.low, self.high]
        return b"".join(part.tobytes() for part in (*parts, *(s for column in self.slices for s in column)))

    @classmethod
    def from_bytes(cls, data) -> Slices:
        words = np.frombuffer(data, np.int64)
        self = cls.__new__(cls)
        self.n, self.dims = words[:2].tolist()
        self.words = (self.n + 63) // 64
        self.ids, self.low, self.high, flat = np.split(words[2:], np.cumsum([self.n, self.dims, self.dims]))
        bitmaps = iter(flat.view(np.uint64).reshape(-1, self.words))
        self.slices = [[next(bitmaps) for _ in range(int(high - low).bit_length())] for low, high in zip(self.low, self.high, strict=True)]
        self.full = self._pack(np.ones(self.n, np.uint8))
        return self

    def _pack(self, bits: np.ndarray) -> np.ndarray:
        packed = np.zeros(self.words * 8, np.uint8)
        got = np.packbits(bits.astype(np.uint8), bitorder="little")
        packed[: len(got)] = got
        return packed.view(np.uint64)

    def add_up(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the score, least significant first, and the constant to add to it."""
        columns: list[list[np.ndarray]] = []
        constant = 0
        for d in range(min(self.dims, len(query))):
            q = int(query[d])
            if not q:
                continue
            if q > 0:
                terms, constant = self.slices[d], constant + q * int(self.low[d])
            else:
                # q * v = |q| * (ones - u) + q * (low + ones), for u = v - low
                ones = (1 << len(self.slices[d])) - 1
                terms, constant = [s ^ self.full for s in self.slices[d]], constant + q * (int(self.low[d]) + ones)
            weight = abs(q)
            for shift in range(weight.bit_length()):
                if weight >> shift & 1:
                    while len(columns) < shift + len(terms):
                        columns.append([])
                    for b, s in enumerate(terms):
                        columns[shift + b].append(s)
        total, place = [], 0
        while place < len(columns):
            column = columns[place]
            if len(column) > 1 and place + 1 == len(columns):
                columns.append([])
            while len(column) > 1:
                a, b = column.pop(), column.pop()
                odd = a ^ b
                if column:
                    c = column.pop()
                    column.insert(0, odd ^ c)
                    columns[place + 1].append((a & b) | (odd & c))
                else:
                    column.append(odd)
                    columns[place + 1].append(a & b)
            total.append(column[0] if column else np.zeros(self.words, np.uint64))
            place += 1
        return total, constant

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the k best rows, those with the query's id left out."""
        total, constant = self.add_up(query)
        maybe = self.full.copy()
        for i in range(*np.searchsorted(self.ids, [own, own + 1])):
            maybe[i >> 6] &= ~(np.uint64(1) << np.uint64(i & 63))
        sure = np.zeros(self.words, np.uint64)
        have, left = 0, int(np.bitwise_count(maybe).sum())
        for s in reversed(total):
            if have + left <= k:
                break
            more = maybe & s
            n = int(np.bitwise_count(more).sum())
            if have + n <= k:
                sure, maybe, have, left = sure | more, maybe & ~s, have + n, left - n
            else:
                maybe, left = more, n
        inside = self._positions(sure)
        at = np.concatenate((inside, self._positions(maybe)[: k - len(inside)]))
        score = np.full(len(at), constant, np.int64)
        for b, s in enumerate(total):
            score += ((s[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << b
        return at, score

    def _positions(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), count=self.n, bitorder="little"))


def _spread(blocks: int, queries: int, cores: int) -> int:
    """Copies of each index block: enough to bound the queries of one, and to keep
    the cores at work where a copy still gets ``QUERY_BLOCK`` queries."""
    return max(1, -(-queries // MOST_QUERIES), min(-(-3 * cores // blocks), -(-queries // QUERY_BLOCK)))


def top_k(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """query_id, rank, the id and the integer score of the k best rows for each query."""
    common.ship(df.sparkSession)
    held, asked = (to_integers(x, id_col, vec_col, scale) for x in (df, queries))
    n, wide = held.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    blocks = max(1, -(-n // max(1, min(ROW_BLOCK, BLOCK_BYTES // (8 * max(wide or 0, 1))))))
    copies = _spread(blocks, asked.count(), df.sparkSession.sparkContext.defaultParallelism)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, parts = 0, [], []
        for batch in batches:
            if batch.num_rows:
                block = batch.column("block")[0].as_py()
                ids.append(np.array(batch.column("id")))
                parts.append(_matrix(batch.column("v")))
        if ids:
            rows = np.zeros((sum(map(len, ids)), max(p.shape[1] for p in parts)), np.int64)
            at = len(rows)
            while parts:
                part = parts.pop()
                at -= len(part)
                rows[at : at + len(part), : part.shape[1]] = part
            index = Slices(np.concatenate(ids), rows).to_bytes()
            del rows
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([index], pa.binary())], ["block", "index"])
        common.trim()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, held_unit = None, None
        for batch in batches:
            units = np.asarray(batch.column("unit"))
            cuts = np.flatnonzero(np.diff(units)) + 1
            for start, end in itertools.pairwise([0, *cuts.tolist(), batch.num_rows]):
                asks = batch.slice(start, end - start)
                if asks.num_rows and asks.column("index")[0].is_valid:  # a block goes before its queries
                    index, held_unit = Slices.from_bytes(asks.column("index")[0].as_buffer()), units[start]
                    asks = asks.slice(1)
                if not asks.num_rows or units[start] != held_unit:  # a block may have got no rows
                    continue
                out: list[tuple[int, np.ndarray, np.ndarray]] = []
                for q, v in zip(asks.column("id").to_pylist(), _matrix(asks.column("v")), strict=True):
                    at, score = index.best(v, q, k)
                    out.append((q, index.ids[at], score))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat([q for q, _, _ in out], [len(a) for _, a, _ in out]), pa.int64()),
                        pa.array(np.concatenate([a for _, a, _ in out]), pa.int64()),
                        pa.array(np.concatenate([s for _, _, s in out]), pa.int64()),
                    ],
                    ["query_id", "vec_id", "score"],
                )

    index = held.repartition(blocks).withColumn("block", F.spark_partition_id()).mapInArrow(build, "block int, index binary")
    index = index.select(
        F.explode(F.sequence(F.col("block") * copies, F.col("block") * copies + (copies - 1))).alias("unit"), "index",
        F.lit(None).cast("long").alias("id"), F.lit(None).cast("array<bigint>").alias("v"),
    )
    share = F.pmod(F.xxhash64("id", "v"), F.lit(copies)).cast("int")
    asks = asked.withColumn("share", share).select(
        F.explode(F.sequence(F.col("share"), F.col("share") + (blocks - 1) * copies, F.lit(copies))).alias("unit"),
        F.lit(None).cast("binary").alias("index"), "id", "v",
    )
    dealt = index.unionByName(asks).repartitionById(blocks * copies, "unit").sortWithinPartitions("unit", F.col("index").isNull())
    best = dealt.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_bit_sliced_top_k(spark, sf_dir):
    """The ten best rows for every vector whose id is divisible by 100."""
    rows = common.table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.where(F.col("vec_id") % 100 == 0))


ORACLE_SQL = """
WITH fine AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM fine q JOIN fine r ON r.vec_id <> q.vec_id
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
