"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document is the set of its distinct 5-word shingles (``words``). Its signature
has ``FUNCTIONS`` minima; each of ``TREES`` sorted orders compares the minima in a
rotation of its own, so that the first three are shared with no other order.
Documents beside each other in an order have the longest common prefixes: those
that share three minima or more are candidates. A region, the documents that
share a prefix of an order, is read at depth three; where it is crowded (more
than ``CROWD`` documents) it is cut deeper, by one minimum at a time up to eight.

1. Rows with one word sequence become one document (the smallest id).
2. Neighbours of all orders are candidates. Every candidate is verified on the
   full shingle sets; confirmed links make the first components.
3. In each region that still holds several components, every document outside
   the largest one is a candidate of every document of another component.
   These are verified too.
4. A crowded region that is still of several components after that goes through
   an exact join, since documents that meet in it at depth three may be parted
   deeper: shingles are ordered by how many of its documents hold them, two sets
   at the threshold share one among their rarest quarter, and its place in both
   tells how much they can have in common (prefix and positional filter). The
   links of all rounds give the components.

So a group of thousands of copies is linked by its neighbours in round one and
never paired out, and no link between components is left untried in a region,
however many documents it holds.
A 2-bit sketch of the whole signature (96 minima) leaves out candidates that
agree in fewer than ``ALIKE`` of 96, 4.7 standard deviations below what the
threshold gives. Two documents at the threshold meet in some order at depth three
but for (1 - 0.75**3)**32 = 2.6e-8. The join of step 4 uses no sketch.

Candidates are verified in cells: the documents that candidates connect, cut
into blocks of ``CELL`` by a hash, each pair of blocks with its texts in one task.
Only documents that have candidates send their texts; a fixed bitmap of 2**24
bits, filled by a combined aggregate, leaves out the others before the shuffle,
and a join makes that exact.

Nulls, edges: a null or blank text is a document of its own with no shingles,
linked with nothing. With fewer than five words the whole sequence is the one
shingle. Rows with a null id take part in nothing and are not returned. Several
rows of one id: each is compared under that id, the result has one row for the
id, with the largest set. Very long texts are read whole. An empty table gives
no rows; only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm import common, components, words

WIDTH, PERCENT = 5, 75
FUNCTIONS, TREES, DEPTH = 96, 32, 8
CROWD, ALIKE, CELL = 4096, 60, 512
FILTER_BITS = 24

_rng = np.random.default_rng(20240229)
_A = _rng.integers(1, 1 << 63, FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, FUNCTIONS, dtype=np.uint64)

PROFILE = "doc_id long, k1 long, k2 long, n_shingles long, minima binary"
ROW = "region long, deep long, doc_id long, comp long, n long, s0 long, s1 long, s2 long"
LISTS = "u long, partners array<long>, comp long, comps array<long>"


def signatures(s: np.ndarray, first: np.ndarray) -> np.ndarray:
    """FUNCTIONS minima (32 bits) for each document; all ones where the set is empty."""
    n = len(first) - 1
    out = np.full((n, FUNCTIONS), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        starts = first[some]
        for i in range(FUNCTIONS):
            h = ((s * _A[i] + _B[i]) >> np.uint64(32)).astype(np.uint32)
            out[some, i] = np.minimum.reduceat(h, starts)
    return out


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.pieces(batches, "text"):
        data, at = common.as_bytes(batch.column(1))
        h, _, _, first = words.words(data, at)
        k1, k2 = words.sequence_keys(h, first)
        s, begin = words.shingles(h, first, WIDTH)
        minima = signatures(s, begin)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(k1.view(np.int64)),
                pa.array(k2.view(np.int64)),
                pa.array(np.diff(begin).astype(np.int64)),
                pa.array([m.tobytes() for m in minima], pa.binary()),
            ],
            ["doc_id", "k1", "k2", "n_shingles", "minima"],
        )
    common.trim()


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row of each sorted order for each document: region (three minima), five deeper ones, sketch."""
    names = [c.split()[0] for c in ROW.split(", ")]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        doc, comp, size = (np.asarray(batch.column(i)) for i in range(3))
        minima = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint32).reshape(n, FUNCTIONS)
        two = (minima & np.uint32(3)).astype(np.uint64).reshape(n, 3, 32)
        sketch = (two << (2 * np.arange(32, dtype=np.uint64))).sum(axis=2, dtype=np.uint64).view(np.int64)
        for t in range(TREES):
            turn = minima[:, (3 * t + np.arange(DEPTH)) % FUNCTIONS].astype(np.uint64)
            region = np.full(n, t + 1, np.uint64)
            for i in range(3):
                region = common.mix(region * np.uint64(0x9E3779B97F4A7C15) + turn[:, i])
            deep = np.zeros(n, np.uint64)
            for i in range(3, DEPTH):
                deep = (deep << np.uint64(12)) | (turn[:, i] >> np.uint64(7) & np.uint64(0xFFF))
            columns = [region.view(np.int64), deep.view(np.int64), doc, comp, size, *sketch.T]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns], names)


def _alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many of the 96 two-bit values agree, for rows of sketches that broadcast."""
    unlike = 0
    for i in range(3):
        d = x[..., i] ^ y[..., i]
        unlike = unlike + np.bitwise_count((d | d >> np.uint64(1)) & np.uint64(0x5555555555555555)).astype(np.int16)
    return FUNCTIONS - unlike


def _close(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)


def _listed(u, v, comp_u, comp_v) -> pa.RecordBatch:
    """Candidate pairs as one row for each u with its partners."""
    order = np.argsort(u, kind="stable")
    u, v, comp_u, comp_v = u[order], v[order], comp_u[order], comp_v[order]
    at = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1]))) if len(u) else np.zeros(0, np.int64)
    ends = pa.array(np.append(at, len(u)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(u[at], pa.int64()),
            pa.ListArray.from_arrays(ends, pa.array(v, pa.int64())),
            pa.array(comp_u[at], pa.int64()),
            pa.ListArray.from_arrays(ends, pa.array(comp_v, pa.int64())),
        ],
        ["u", "partners", "comp", "comps"],
    )


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of sorted rows, cut only where a region ends."""
    kept: list[np.ndarray] | None = None
    for batch in batches:
        now = [np.asarray(c) for c in batch.columns]
        if kept is not None:
            now = [np.concatenate(x) for x in zip(kept, now, strict=True)]
        if not len(now[0]):
            continue
        last = int(np.searchsorted(now[0], now[0][-1]))
        if last:
            yield [c[:last] for c in now]
        kept = [c[last:] for c in now]
    if kept is not None and len(kept[0]):
        yield kept


def _sketch(rows: list[np.ndarray]) -> np.ndarray:
    return np.stack(rows[5:8], axis=1).view(np.uint64)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows next to each other, and next but one, that share at least three minima."""
    for rows in _streamed(batches):
        region, doc, n, sketch = rows[0], rows[2], rows[4], _sketch(rows)
        parts = []
        for step in (1, 2):
            if len(doc) <= step:
                continue
            i = np.flatnonzero((region[step:] == region[:-step]) & _close(n[step:], n[:-step]) & (doc[step:] != doc[:-step]))
            i = i[_alike(sketch[i], sketch[i + step]) >= ALIKE]
            parts.append((np.maximum(doc[i], doc[i + step]), np.minimum(doc[i], doc[i + step])))
        if parts:
            u, v = (np.concatenate(x) for x in zip(*parts, strict=True))
            if len(u):
                yield _listed(u, v, u, v)


def _crowded(rows: list[np.ndarray], crowd: int) -> Iterator[pa.RecordBatch]:
    """The documents of regions that are cut, as lists without partners; comp is the region."""
    at = np.flatnonzero(np.concatenate(([True], rows[0][1:] != rows[0][:-1])))
    for a, b in zip(at, np.append(at[1:], len(rows[0])), strict=True):
        if b - a > crowd and (rows[3][a:b] != rows[3][a]).any():
            none = pa.ListArray.from_arrays(pa.array(np.zeros(b - a + 1, np.int32)), pa.array([], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(rows[2][a:b]), none, pa.array(rows[0][a:b]), none], ["u", "partners", "comp", "comps"])


def _regions(rows: list[np.ndarray], crowd: int, depth: int = 3) -> Iterator[list[np.ndarray]]:
    """Regions of two components or more, crowded ones cut deeper."""
    if depth == 3:
        key = rows[0]
    else:
        key = rows[1] >> (12 * (DEPTH - depth))
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    for a, b in zip(at, np.append(at[1:], len(key)), strict=True):
        if b - a < 2 or (rows[3][a:b] == rows[3][a]).all():
            continue
        part = [c[a:b] for c in rows]
        if b - a > crowd and depth < DEPTH:
            yield from _regions(part, crowd, depth + 1)
        else:
            yield part


def _across(batches: Iterator[pa.RecordBatch], crowd: int) -> Iterator[pa.RecordBatch]:
    """Candidates between different components of a region, and who is in a crowded one."""
    for chunk in _streamed(batches):
        yield from _crowded(chunk, crowd)
        found: list[tuple] = []
        for rows in _regions(chunk, crowd):
            doc, comp, n, sketch = rows[2], rows[3], rows[4], _sketch(rows)
            names, count = np.unique(comp, return_counts=True)
            minor = np.flatnonzero(comp != names[count.argmax()])
            for a in range(0, len(minor), 256):
                m = minor[a : a + 256]
                ok = (comp[m, None] != comp[None]) & _close(n[m, None], n[None])
                # Two documents outside the largest component meet once, from the larger id.
                inside = np.zeros(len(doc), bool)
                inside[minor] = True
                ok &= ~inside[None] | (doc[m, None] > doc[None])
                i, j = np.nonzero(ok)
                hit = _alike(sketch[m[i]], sketch[j]) >= ALIKE
                i, j = m[i[hit]], j[hit]
                found.append((doc[i], doc[j], comp[i], comp[j]))
        if found:
            u, v, cu, cv = (np.concatenate(x) for x in zip(*found, strict=True))
            if len(u):
                yield _listed(u, v, cu, cv)


def _flat_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A forest over each partition's candidate lists: enough to know what they connect."""

    def pairs() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            partners = batch.column(1)
            u = np.repeat(np.asarray(batch.column(0)), np.diff(np.asarray(partners.offsets)))
            yield pa.RecordBatch.from_arrays([pa.array(u), partners.flatten()], ["u", "v"])

    yield from components._local(pairs())


def _block(doc: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    return (common.mix(doc.view(np.uint64)) >> np.uint64(8)).astype(np.int64) % blocks


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate lists by cell: group, pair of blocks."""
    for batch in batches:
        if not batch.num_rows:
            continue
        u, comp, group, blocks = (np.asarray(batch.column(i)) for i in (0, 2, 4, 5))
        partners = batch.column(1)
        each = np.diff(np.asarray(partners.offsets))
        at = np.repeat(np.arange(len(u)), each)
        v, comp_v = np.asarray(partners.flatten()), np.asarray(batch.column(3).flatten())
        x, y = _block(u, blocks)[at], _block(v, blocks[at])
        low, high = np.minimum(x, y), np.maximum(x, y)
        order = np.lexsort((high, low, at))
        at, v, comp_v, low, high = (c[order] for c in (at, v, comp_v, low, high))
        new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])))) if len(at) else np.zeros(0, np.int64)
        ends = pa.array(np.append(new, len(at)).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(group[at[new]]),
                pa.array(low[new]),
                pa.array(high[new]),
                pa.array(u[at[new]]),
                pa.nulls(len(new), pa.string()),
                pa.ListArray.from_arrays(ends, pa.array(v)),
                pa.array(comp[at[new]]),
                pa.ListArray.from_arrays(ends, pa.array(comp_v)),
            ],
            ["group", "low", "high", "doc_id", "text", "partners", "comp", "comps"],
        )


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a cell come together, texts first; the links that connect something new go out."""
    cell: tuple = ()
    sets: dict[int, np.ndarray] = {}
    forest = components.Forest()
    for batch in batches:
        u_out, v_out = [], []
        for piece in common.pieces([batch], "text"):
            data, at = common.as_bytes(piece.column(4))
            h, _, _, first = words.words(data, at)
            s, begin = words.shingles(h, first, WIDTH)
            keys = list(zip(*(piece.column(i).to_pylist() for i in range(3)), strict=True))
            docs, partners, comp, comps = (piece.column(i).to_pylist() for i in (3, 5, 6, 7))
            for i, key in enumerate(keys):
                if key != cell:
                    cell, sets, forest = key, {}, components.Forest()
                u = docs[i]
                if partners[i] is None:
                    if u not in sets or len(sets[u]) < begin[i + 1] - begin[i]:
                        sets[u] = s[begin[i] : begin[i + 1]].copy()
                    continue
                mine = sets.get(u)
                for v, c in zip(partners[i], comps[i], strict=True):
                    other = sets.get(v)
                    if mine is None or other is None or forest.find(comp[i]) == forest.find(c):
                        continue
                    small, large = (mine, other) if len(mine) <= len(other) else (other, mine)
                    if 100 * len(small) < PERCENT * len(large):
                        continue
                    where = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    both = int((large[where] == small).sum())
                    if 100 * both >= PERCENT * (len(small) + len(large) - both):
                        forest.join(comp[i], c)
                        u_out.append(u)
                        v_out.append(v)
        if u_out:
            yield pa.RecordBatch.from_arrays([pa.array(u_out, pa.int64()), pa.array(v_out, pa.int64())], ["u", "v"])


def _bitmap(ids: DataFrame) -> np.ndarray:
    """Which of 2**FILTER_BITS hash values occur among the ids; 2 MB whatever their number."""
    h = F.xxhash64("node").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    cells = ids.select(F.shiftright(h, 6).alias("w"), h.alias("h"))
    bit = F.expr("shiftleft(1L, cast(h & 63 as int))")
    got = cells.groupBy("w").agg(F.bit_or(bit).alias("bits")).toPandas()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[got["w"].to_numpy()] = got["bits"].to_numpy()
    return out.view(np.uint64)


def verified(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """The candidate pairs (u, v) whose full sets reach the threshold, as many as connect something new."""
    spark = docs.sparkSession
    lists = common.stage(lists, "candidates")
    joined = components.components(lists.mapInArrow(_flat_pairs, "u long, v long"))
    joined = joined.unionByName(joined.select(F.col("root").alias("node"), "root").distinct())
    sizes = joined.groupBy("root").agg(F.ceil(F.count("*") / CELL).alias("blocks"))
    joined = common.stage(joined.join(sizes, "root"), "groups")
    filled = spark.sparkContext.broadcast(_bitmap(joined))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filled.value
        for batch in batches:
            h = np.asarray(batch.column(2)).view(np.uint64) & np.uint64((1 << FILTER_BITS) - 1)
            keep = (bits[h >> np.uint64(6)] >> (h & np.uint64(63)) & np.uint64(1)).astype(bool)
            yield batch.filter(pa.array(keep)).select([0, 1])

    some = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("h")).mapInArrow(sift, "doc_id long, text string")
    held = some.join(joined.withColumnRenamed("node", "doc_id"), "doc_id")
    texts = held.mapInArrow(_spread, "group long, low long, high long, doc_id long, text string, partners array<long>, comp long, comps array<long>")
    asked = lists.join(joined.select(F.col("node").alias("u"), "root", "blocks"), "u").select(
        "u", "partners", "comp", "comps", "root", "blocks"
    )
    asked = asked.mapInArrow(_cells, texts.schema)
    rows = texts.unionByName(asked).withColumn("kind", F.col("partners").isNotNull())
    rows = rows.repartition("group", "low", "high").sortWithinPartitions("group", "low", "high", "kind").drop("kind")
    return rows.mapInArrow(_verify, "u long, v long")


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A text goes to every cell of its group that its block is part of."""
    for batch in batches:
        if not batch.num_rows:
            continue
        doc, group, blocks = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("doc_id", "root", "blocks"))
        mine = _block(doc, blocks)
        at = np.repeat(np.arange(len(doc)), blocks)
        other = np.concatenate([np.arange(b) for b in blocks])
        for a in range(0, len(at), common.BATCH_ROWS):
            i, o = at[a : a + common.BATCH_ROWS], other[a : a + common.BATCH_ROWS]
            n = len(i)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(group[i]),
                    pa.array(np.minimum(mine[i], o)),
                    pa.array(np.maximum(mine[i], o)),
                    pa.array(doc[i]),
                    batch.column(batch.schema.get_field_index("text")).take(pa.array(i)),
                    pa.nulls(n, pa.list_(pa.int64())),
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.list_(pa.int64())),
                ],
                ["group", "low", "high", "doc_id", "text", "partners", "comp", "comps"],
            )


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each text."""
    for piece in common.pieces(batches, "text"):
        data, at = common.as_bytes(piece.column(3))
        h, _, _, first = words.words(data, at)
        s, begin = words.shingles(h, first, WIDTH)
        size = np.diff(begin)
        row = np.repeat(np.arange(len(size)), size)
        doc, text, comp = (np.asarray(piece.column(i)) for i in range(3))
        for a in range(0, len(s), 50_000):
            i = row[a : a + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (s[a : a + 50_000].view(np.int64), doc[i], text[i], comp[i], size[i].astype(np.int64))],
                ["shingle", "doc_id", "tie", "comp", "n"],
            )
    common.trim()


def _prefix_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of different components that share a shingle of their prefixes and can reach the threshold."""
    for rows in _streamed(batches):
        at = np.flatnonzero(np.concatenate(([True], rows[0][1:] != rows[0][:-1])))
        for a, b in zip(at, np.append(at[1:], len(rows[0])), strict=True):
            _, doc, comp, n, place = (c[a:b] for c in rows)
            if b - a < 2 or (comp == comp[0]).all():
                continue
            names, count = np.unique(comp, return_counts=True)
            inside = comp != names[count.argmax()]
            minor = np.flatnonzero(inside)
            for k in range(0, len(minor), 256):
                m = minor[k : k + 256]
                most = np.minimum((n - place)[m, None], (n - place)[None]) + 1
                ok = (comp[m, None] != comp[None]) & ((100 + PERCENT) * most >= PERCENT * (n[m, None] + n[None]))
                ok &= _close(n[m, None], n[None]) & (~inside[None] | (doc[m, None] > doc[None]))
                i, j = np.nonzero(ok)
                if len(i):
                    i = m[i]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[i], doc[j], comp[i], comp[j])], ["u", "v", "comp", "comp_v"])


def _exact(docs: DataFrame, crowd: DataFrame, roots: DataFrame) -> DataFrame:
    """Candidates between the components of crowded regions, by a prefix join of the full sets."""
    comp = F.coalesce("root", "doc_id")
    crowd = crowd.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("region", "doc_id", comp.alias("comp"))
    mixed = crowd.groupBy("region").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a < b").select("region")
    some = crowd.join(mixed, "region").select("doc_id", "comp").distinct()
    texts = docs.join(some, "doc_id").select("doc_id", F.xxhash64("text").alias("tie"), "comp", "text").dropDuplicates(["doc_id", "tie"])
    rows = common.stage(texts.mapInArrow(_shingled, "shingle long, doc_id long, tie long, comp long, n long"), "shingles")
    held = rows.groupBy("shingle").agg(F.count("*").alias("df"))
    order = Window.partitionBy("doc_id", "tie").orderBy("df", "shingle")
    ranked = rows.join(held, "shingle").withColumn("place", F.row_number().over(order).cast("long"))
    # Of a set of n, n - ceil(n * threshold) + 1.
    prefix = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1
    ranked = ranked.where((F.col("place") <= prefix) & (F.col("df") > 1)).select("shingle", "doc_id", "comp", "n", "place")
    pairs = ranked.repartition("shingle").sortWithinPartitions("shingle", "doc_id").mapInArrow(
        _prefix_pairs, "u long, v long, comp long, comp_v long"
    )
    return pairs.distinct().select("u", F.array("v").alias("partners"), "comp", F.array("comp_v").alias("comps"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    common.ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    profile = common.stage(docs.mapInArrow(_profiles, PROFILE), "profiles")
    blank = F.col("n_shingles") == 0
    keyed = profile.select("doc_id", "n_shingles", "k1", "k2")
    leader = keyed.where(~blank).groupBy("k1", "k2").agg(F.min("doc_id").alias("leader"))
    leaders = common.stage(
        profile.where(~blank)
        .join(leader, ["k1", "k2"])
        .where(F.col("doc_id") == F.col("leader"))
        .dropDuplicates(["doc_id", "k1", "k2"])
        .select("doc_id", "n_shingles", "minima"),
        "leaders",
    )

    def orders(comp: F.Column, rows: DataFrame) -> DataFrame:
        out = rows.select("doc_id", comp.alias("comp"), "n_shingles", "minima").mapInArrow(_orders, ROW)
        return out.repartition("region").sortWithinPartitions("region", "deep", "doc_id")

    near = orders(F.col("doc_id"), leaders).mapInArrow(_neighbours, LISTS)
    first = common.stage(verified(docs, near), "links")
    roots = components.components(first)
    known = leaders.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    most = CROWD
    wide = orders(F.coalesce("root", "doc_id"), known).mapInArrow(lambda batches: _across(batches, most), LISTS)
    wide = common.stage(wide, "wide")
    second = common.stage(verified(docs, wide.where(F.size("partners") > 0)), "links")
    links = first.unionByName(second)
    crowd = wide.where(F.size("partners") == 0).select(F.col("comp").alias("region"), F.col("u").alias("doc_id"))
    if not crowd.isEmpty():
        links = links.unionByName(common.stage(verified(docs, _exact(docs, crowd, components.components(links))), "links"))
    copies = keyed.where(~blank).join(leader, ["k1", "k2"]).where(F.col("doc_id") != F.col("leader"))
    links = links.unionByName(copies.select(F.col("doc_id").alias("u"), F.col("leader").alias("v")))
    roots = components.components(links)
    rows = keyed.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
    out = rows.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component_id", F.coalesce("root", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op2_minhash_forest(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return near_duplicates(common.table(spark, sf_dir, "documents"))
