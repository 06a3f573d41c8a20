"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

Documents are packed in groups. For each part of the hash space a group sends one
compressed block of its distinct words and word pairs with their counts in its
training documents, so an n-gram moves once a group however often it stands
there. One task sums a part. Counts are quantised to levels of a logarithm (base
``BASE``), and an n-gram of level q puts the keys (n-gram, 1) to (n-gram, q) into
the part's segment of a Bloom filter, ``BITS_PER_KEY`` bits for each of its keys,
however many there are: the filter grows with the input, is never in one place,
and its rate of errors stays. All words and pairs enter, also those seen once.

The same task then probes its segment for each block: a count is what level the
probes (n-gram, 1), (n-gram, 2), ... reach before one misses. The levels go back
to the group, whose documents are scored. A task holds the blocks of its part
compressed, and the sums of a part; more parts make both smaller.
p(w | v) is Dirichlet-smoothed, (c(vw) + MU p(w)) / (c(v) + MU), over
p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)). The first word follows the end mark, and
the end mark is a token.

The base score is exact. The ``COMMON`` most frequent words are looked up in a
broadcast table of that size; other words go, once for each document, through an
equi-join with the exact counts.

Nulls, edges: a null text is empty and has the end token only. A null id is not
held out. Rows equal in id and text each get the same result, and both teach.
Long texts are hashed whole. An empty table gives no rows; without training
documents N and V are 0. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm import common, words

BASE, BITS_PER_KEY = 1.5, 10
MU, ADD = 2.0, 0.1
COMMON = 1 << 17
GROUP_BYTES, PART_GROUPS = 8 << 20, 2
WORD, PAIR, DOCS = 0, 1, 2
END = common.mix(np.array([0xE0D], np.uint64))[0]

BLOCK = "kind int, part int, grp long, block binary"


def _tokens(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with the end mark behind each text, and where each text's begin."""
    data, at = common.as_bytes(batch.column(column))
    h, _, _, first = words.words(data, at)
    n = len(first) - 1
    begin = first + np.arange(n + 1)
    out = np.empty(begin[-1], np.uint64)
    ends = begin[1:] - 1
    out[ends] = END
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = h
    return out, begin


def _pairs(tokens: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A hash of (token before, token) at every token."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[begin[:-1]] = END
    return common.mix(before * np.uint64(0x9FB21C651E98DF25) + tokens)


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _pack(h: np.ndarray, c: np.ndarray) -> bytes:
    """Ascending hashes as differences, and counts; bytes of one weight stand together."""
    step = np.diff(h, prepend=np.uint64(0))
    body = np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8).T).tobytes() + c.astype(np.uint64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(len(h).to_bytes(8, "little") + body)


def _unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    n = int.from_bytes(raw[:8], "little")
    step = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, 8).reshape(8, n).T).view(np.uint64).ravel()
    return np.cumsum(step, dtype=np.uint64), np.frombuffer(raw, np.uint64, n, 8 + 8 * n)


def _summed(blocks: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    h = np.concatenate([b[0] for b in blocks])
    c = np.concatenate([b[1] for b in blocks])
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    return h[at], np.add.reduceat(c, at) if len(at) else c


def packed(rows: DataFrame) -> DataFrame:
    """grp, docs: the documents (key, doc_id, text, held_out) in groups of about GROUP_BYTES, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, group = 0, TaskContext.get().partitionId() << 32

        def flush() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema) as out:
                for batch in held:
                    out.write_batch(batch)
            held.clear()
            body = zstandard.ZstdCompressor(level=1).compress(sink.getvalue())
            return pa.RecordBatch.from_arrays([pa.array([group], pa.int64()), pa.array([body], pa.binary())], ["grp", "docs"])

        for batch in common.pieces(batches, "text"):
            held.append(batch)
            size += len(common.as_bytes(batch.column(2))[0])
            if size >= GROUP_BYTES:
                yield flush()
                size, group = 0, group + 1
        if held:
            yield flush()

    return rows.mapInArrow(run, "grp long, docs binary")


def _docs(body: bytes) -> pa.RecordBatch:
    table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(body)).read_all()
    return table.combine_chunks().to_batches()[0]


def asked(groups: DataFrame, parts: int) -> DataFrame:
    """kind, part, grp, block: the distinct n-grams of each group, and how often its training documents hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                docs = _docs(body)
                tokens, begin = _tokens(docs, 2)
                learn = np.repeat(~docs.column(3).to_numpy(zero_copy_only=False), np.diff(begin))
                for kind, grams in ((WORD, tokens), (PAIR, _pairs(tokens, begin))):
                    h, at = np.unique(grams, return_inverse=True)
                    c = np.bincount(at[learn], minlength=len(h))
                    at = np.searchsorted(_part(h, parts), np.arange(parts + 1))
                    some = np.flatnonzero(np.diff(at))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(some), kind), pa.int32()),
                            pa.array(some, pa.int32()),
                            pa.array(np.full(len(some), group), pa.int64()),
                            pa.array([_pack(h[at[p] : at[p + 1]], c[at[p] : at[p + 1]]) for p in some], pa.binary()),
                        ],
                        ["kind", "part", "grp", "block"],
                    )
        common.trim()

    return groups.mapInArrow(run, BLOCK)


def answered(blocks: DataFrame, parts: int) -> DataFrame:
    """For each part its sums (grp is null; the block holds words only) and the levels of what each group asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple[int, int] | None = None
        asks: list[tuple[int, bytes]] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def row(groups: list, n: int | None, distinct: int | None, bits: int | None, bodies: list[bytes]) -> pa.RecordBatch:
            size = len(groups)
            return pa.RecordBatch.from_arrays(
                [
                    *(pa.array([x] * size, pa.int32()) for x in now),
                    pa.array(groups, pa.int64()),
                    *(pa.array([x] * size, pa.int64()) for x in (n, distinct, bits)),
                    pa.array(bodies, pa.binary()),
                ],
                ["kind", "part", "grp", "n", "distinct", "bits", "block"],
            )

        def close() -> Iterator[pa.RecordBatch]:
            if now is None:
                return
            h, c = _summed(held)
            held.clear()
            h, c = h[c > 0], c[c > 0]
            n, distinct = int(c.sum()), len(h)
            body = _pack(h, c) if now[0] == WORD else b""
            segment = Filter.of(now[0], h, c)
            yield row([None], n, distinct, segment.rooms[now[0]], [body])
            for a in range(0, len(asks), 256):
                some = asks[a : a + 256]
                got = [segment.level(now[0], _unpack(block)[0]).astype(np.uint8).tobytes() for _, block in some]
                yield row([g for g, _ in some], None, None, None, [zstandard.ZstdCompressor(level=1).compress(x) for x in got])

        for batch in batches:
            for kind, part, group, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (kind, part) != now:
                    yield from close()
                    now, asks, held = (kind, part), [], []
                asks.append((group, block))
                held.append(_unpack(block))
                if len(held) > 64:
                    held = [_summed(held)]
        yield from close()

    blocks = blocks.repartition(parts, "kind", "part").sortWithinPartitions("kind", "part")
    return blocks.mapInArrow(run, "kind int, part int, grp long, n long, distinct long, bits long, block binary")


def levels(c: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(c, 1).astype(np.float64)) / np.log(BASE) + 1e-9).astype(np.int64)


def _spots(h: np.ndarray, level: np.ndarray | int, room: int) -> tuple[np.ndarray, np.ndarray]:
    x = common.mix(h + np.asarray(level).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    r = np.uint64(room)
    return (x & np.uint64(0xFFFFFFFF)) * r >> np.uint64(32), (x >> np.uint64(32)) * r >> np.uint64(32)


class Filter:
    """Segments of equal size for each part, words and pairs apart."""

    def __init__(self, parts: int, rooms: tuple[int, int], segments: dict[tuple[int, int], bytes]):
        self.parts, self.rooms = parts, rooms
        self.bits = []
        for kind in (WORD, PAIR):
            empty = bytes(rooms[kind] // 8)
            self.bits.append(np.frombuffer(b"".join(segments.get((kind, p), empty) for p in range(parts)), np.uint8))

    @staticmethod
    def segment(h: np.ndarray, c: np.ndarray, room: int) -> bytes:
        out = np.zeros(room, bool)
        q = levels(c)
        for level in range(1, int(q.max(initial=0)) + 1):
            for spot in _spots(h[q >= level], level, room):
                out[spot] = True
        return np.packbits(out, bitorder="little").tobytes()

    @classmethod
    def of(cls, kind: int, h: np.ndarray, c: np.ndarray) -> Filter:
        """The segment of one part, BITS_PER_KEY bits for each of its keys."""
        room = -(-int(levels(c).sum()) * BITS_PER_KEY // 64) * 64
        return cls(1, (room, 0) if kind == WORD else (0, room), {(kind, 0): cls.segment(h, c, room)})

    def level(self, kind: int, h: np.ndarray) -> np.ndarray:
        """The level that the probes reach before one misses."""
        room, bits = self.rooms[kind], self.bits[kind]
        base = (_part(h, self.parts) * room).astype(np.uint64)
        level = np.zeros(len(h), np.int64)
        live = np.arange(len(h))
        step = 1
        while len(live) and room:
            hit = np.ones(len(live), bool)
            for spot in _spots(h[live], step, room):
                at = base[live] + spot
                hit &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            live = live[hit]
            level[live] = step
            step += 1
        return level

    def count(self, kind: int, h: np.ndarray) -> np.ndarray:
        return middle(self.level(kind, h))


def middle(level: np.ndarray) -> np.ndarray:
    """The count that a level stands for (the geometric middle), 0 where the first probe misses."""
    level = level.astype(np.int64)
    return np.where(level > 0, np.maximum(1.0, BASE ** (level - 0.5) - 0.5 * (level <= 2)), 0.0)


def _common_words(sums: DataFrame, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """About the COMMON most frequent words: each part gives its own best, 4 * COMMON / parts at most."""
    each = max(1, 4 * COMMON // parts)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(0).to_pylist():
                h, c = _unpack(block)
                top = np.sort(np.argsort(c, kind="stable")[-each:])
                yield pa.RecordBatch.from_arrays([pa.array([_pack(h[top], c[top])], pa.binary())], ["block"])

    blocks = [_unpack(bytes(r[0])) for r in sums.where(F.col("kind") == WORD).select("block").mapInArrow(best, "block binary").collect()]
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h, c = _summed(blocks)
    keep = np.sort(np.argsort(c, kind="stable")[-COMMON:])
    return h[keep], c[keep]


def _exact_counts(sums: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(0).to_pylist():
                h, c = _unpack(block)
                for a in range(0, len(h), 50_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[a : a + 50_000].view(np.int64)), pa.array(c[a : a + 50_000].astype(np.int64))], ["h", "c"]
                    )

    return sums.where(F.col("kind") == WORD).select("block").mapInArrow(rows, "h long, c long")


SCORED = (
    "key long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, "
    "rare array<long>, times array<int>"
)


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = docs.sparkSession
    common.ship(spark)
    key = F.xxhash64("doc_id", "text")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), held_out.alias("held_out"))
    groups = common.stage(packed(rows.select(key.alias("key"), "doc_id", "text", "held_out")), "groups")
    # A part holds the n-grams of PART_GROUPS groups, however many groups there are.
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-groups.count() // PART_GROUPS))
    answers = common.stage(answered(asked(groups, parts), parts), "ngrams")
    sums = answers.where(F.col("grp").isNull())
    total = sums.where(F.col("kind") == WORD).agg(F.sum("n"), F.sum("distinct")).first()
    n_train, n_words = total[0] or 0, total[1] or 0
    sent = spark.sparkContext.broadcast(_common_words(sums, parts))
    bottom = n_train + ADD * (n_words + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, often_c = sent.value
        levels_of: tuple[list[bytes], list[bytes]] = ([], [])
        for kind, body in ((k.as_py(), b.as_py()) for batch in batches for k, b in zip(*batch.columns, strict=True)):
            if kind != DOCS:
                levels_of[kind].append(zstandard.ZstdDecompressor().decompress(body))
                continue
            # The parts follow each other as the hashes do, and the documents come behind the answers.
            c1, c2 = (middle(np.frombuffer(b"".join(x), np.uint8)) for x in levels_of)
            levels_of[WORD].clear(), levels_of[PAIR].clear()
            batch = _docs(body)
            tokens, begin = _tokens(batch, 2)
            n, size = batch.num_rows, np.diff(begin)
            kinds, at = np.unique(tokens, return_inverse=True)
            pair, pair_at = np.unique(_pairs(tokens, begin), return_inverse=True)
            if (len(kinds), len(pair)) != (len(c1), len(c2)):
                raise ValueError("answers are missing")
            c2 = c2[pair_at]
            context = np.empty(len(tokens))
            context[1:] = c1[at][:-1]
            context[begin[:-1]] = c1[np.searchsorted(kinds, END)]
            p = ((c1 + ADD) / bottom)[at]
            p = (np.minimum(c2, context) + MU * p) / (context + MU)
            value = np.add.reduceat(np.log10(p), begin[:-1])
            where = np.minimum(np.searchsorted(often, kinds), max(0, len(often) - 1))
            seen = often[where] == kinds if len(often) else np.zeros(len(kinds), bool)
            part = np.where(seen, np.log10((often_c[where] if len(often) else 0) + ADD), 0.0)
            rare = np.flatnonzero(~seen[at])
            doc = np.repeat(np.arange(n), size)[rare]
            order = np.lexsort((at[rare], doc))
            doc, kind = doc[order], at[rare][order]
            new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (kind[1:] != kind[:-1])))) if len(doc) else np.zeros(0, np.int64)
            ends = pa.array(np.searchsorted(doc[new], np.arange(n + 1)).astype(np.int32))
            times = np.diff(np.append(new, len(doc)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(3),
                    pa.array(size.astype(np.int64)),
                    pa.array(np.add.reduceat(seen[at].astype(np.int64), begin[:-1])),
                    pa.array(np.add.reduceat(part[at], begin[:-1])),
                    pa.array(value),
                    pa.ListArray.from_arrays(ends, pa.array(kinds[kind[new]].view(np.int64))),
                    pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32))),
                ],
                [c.split()[0] for c in SCORED.split(", ")],
            )

    told = answers.where(F.col("grp").isNotNull()).select("grp", "kind", "part", "block")
    told = told.union(groups.select("grp", F.lit(DOCS), F.lit(0), "docs"))
    told = told.repartition(parts, "grp").sortWithinPartitions("grp", "kind", "part").select("kind", "block")
    scored = common.stage(told.mapInArrow(run, SCORED), "scored")
    rare = scored.dropDuplicates(["key"]).select("key", F.explode(F.arrays_zip("rare", "times")).alias("x"))
    found = rare.select("key", F.col("x.rare").alias("h"), F.col("x.times").alias("m")).join(_exact_counts(sums), "h", "left")
    c = F.coalesce("c", F.lit(0))
    rest = found.groupBy("key").agg(
        F.sum(F.col("m") * F.log10(c + F.lit(ADD))).alias("more"), F.sum(F.when(c > 0, F.col("m")).otherwise(0)).alias("more_known")
    )
    return scored.join(rest, "key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * float(np.log10(bottom))).alias("base_score"),
        "score",
    )


def op10_ngram_filter(spark, sf_dir):
    """Scores of all documents by a model of nine tenths of them."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    return score(common.table(spark, sf_dir, "documents"), held)
