"""Removal of every byte covered by a string of ``WIDTH`` bytes that also starts earlier.

The suffixes that matter are sorted by a distributed merge sort that knows common
prefixes. Of the windows of 100 bytes only one suffix for each run is taken: a
window's anchor is the position in it whose next 16 bytes have the smallest hash
(the first of equals), so equal windows have their anchor at the same place, and
neighbouring windows mostly share it. Such a run is one entry: the suffix that
begins at the anchor, to the end of the run's last window, and as its tail the
bytes from the run's first window to the anchor. There is one for about 43 bytes,
and every window is inside exactly one of them.

1. A task sorts the entries of ``RUN_BYTES`` of text. Entries start with a hash
   of their first 16 bytes, so ranges of the order are even without sampling.
   Equal entries inside the run are settled at once: the earliest stays, the
   others are removed. So copies by the thousand leave a task as one entry.
2. Each range of the run is front-coded (common prefix with the entry before,
   then the rest) and compressed. That is what is exchanged.
3. The task of a range merges its runs with a loser tree whose nodes keep the
   common prefix with the last winner: the longer one wins unseen, and only on
   equality are bytes compared, from that prefix on. Entries that come out with
   a common prefix of the first 16 bytes or more form a group. Equal entries are
   settled; of different ones, the windows that the prefixes allow are compared.
4. Removed spans are written, and joined with the texts by document in one
   sorted exchange. Only documents that a fixed bitmap of 2**24 bits marks as
   having spans send their text; all others are digested where they are read.

Nulls, edges: a null text is empty; texts under 100 bytes keep everything. A null
id ranks after all others. Rows of one id rank by a hash of their text; rows equal
in both are one document written twice: neither removes the other's first, and
each gets the same result. Very long texts are cut into overlapping stretches, so
memory stays bounded, with equal results. An empty table gives no rows; only the
two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm import common

WIDTH, SEED = 100, 16
LEFT = WIDTH - SEED
RUN_BYTES, STRETCH, TIES = 16 << 20, 1 << 17, 16_000
HEAD = 8
#: Layout of an entry: hash, suffix (zero-filled), its length, tail.
TAIL = HEAD + WIDTH + 1
ROOM = TAIL + LEFT
FILTER_BITS = 24
LAST_ID = (1 << 63) - 1

_POS = np.uint64((1 << 27) - 1)
RUNS = "part int, block binary, doc_id long, text_key long, start long, end long"
SPANS = "doc_id long, text_key long, start long, end long"


def _words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, as one number."""
    n = len(data)
    padded = np.zeros(n + 32, np.uint8)
    padded[:n] = data
    out = np.empty(n + 16, np.uint64)
    for r in range(8):
        part = out[r::8]
        part[:] = padded[r : r + 8 * len(part)].view("<u8")
    return out


def anchors(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, anchor and hash of every run; ``at`` parts the texts."""
    none = np.zeros(0, np.int64)
    if len(data) < WIDTH:
        return none, none, none, none.view(np.uint64)
    w = _words_at(data)
    n = len(data)
    h = common.mix(w[:n] * np.uint64(0x9E3779B97F4A7C15) + common.mix(w[8 : n + 8]))
    key = (h & ~_POS) | np.arange(n, dtype=np.uint64)
    step = 1
    while step < 64:
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    rest = LEFT + 1 - 64
    key = np.minimum(key[:-rest], key[rest:])
    last = np.repeat(at[1:] - WIDTH, np.diff(at))
    start = np.flatnonzero(np.arange(n) <= last)
    if not len(start):
        return none, none, none, none.view(np.uint64)
    anchor = (key[start] & _POS).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    return start[first], np.diff(np.append(first, len(start))), anchor[first], common.mix(h[anchor[first]])


class _Run:
    """Texts of a task until there is enough for a sorted run."""

    def __init__(self, parts: int):
        self.parts = parts
        self.clear()

    def clear(self) -> None:
        self.data: list[np.ndarray] = []
        self.size = 0
        self.ids: list[int] = []
        self.keys: list[int] = []
        self.found: list[tuple[np.ndarray, ...]] = []

    def add(self, doc_id: int, text_key: int, text: np.ndarray) -> None:
        """A long text comes in stretches that overlap by a window less one byte."""
        for base in range(0, max(1, len(text) - WIDTH + 1), STRETCH):
            self._stretches.append((len(self.ids), base, text[base : base + STRETCH + WIDTH - 1]))
        self.ids.append(doc_id)
        self.keys.append(text_key)

    def piece(self, ids: list[int], keys: list[int], data: np.ndarray, at: np.ndarray) -> None:
        self._stretches: list[tuple[int, int, np.ndarray]] = []
        for i, k, a, b in zip(ids, keys, at[:-1], at[1:], strict=True):
            if b - a >= WIDTH:
                self.add(i, k, data[a:b])
        waiting: list[tuple[int, int, np.ndarray]] = []
        size = 0
        for s in self._stretches:
            waiting.append(s)
            size += len(s[2])
            if size >= STRETCH:
                self._scan(waiting)
                waiting, size = [], 0
        if waiting:
            self._scan(waiting)

    def _scan(self, stretches: list[tuple[int, int, np.ndarray]]) -> None:
        data = np.concatenate([s[2] for s in stretches])
        at = np.concatenate(([0], np.cumsum([len(s[2]) for s in stretches])))
        start, count, anchor, order = anchors(data, at)
        which = np.searchsorted(at, start, "right") - 1
        row = np.array([s[0] for s in stretches])[which]
        place = start - at[which] + np.array([s[1] for s in stretches])[which]
        self.found.append((start + self.size, count, anchor + self.size, order, row, place))
        self.data.append(data)
        self.size += len(data)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.found:
            self.clear()
            return
        data = np.concatenate([*self.data, np.zeros(WIDTH, np.uint8)])
        start, count, anchor, lead, row, place = (np.concatenate(x) for x in zip(*self.found, strict=True))
        ids, keys = np.array(self.ids, np.int64), np.array(self.keys, np.int64)
        self.clear()
        by = np.lexsort((keys, ids))
        fresh = np.ones(len(by), bool)
        fresh[1:] = (ids[by][1:] != ids[by][:-1]) | (keys[by][1:] != keys[by][:-1])
        rank = np.empty(len(by), np.int64)
        rank[by] = np.cumsum(fresh) - 1
        ids, keys = ids[by][fresh], keys[by][fresh]
        row = rank[row]
        left = anchor - start
        right = count + WIDTH - 1 - left
        view_right = np.lib.stride_tricks.sliding_window_view(data, WIDTH)
        view_left = np.lib.stride_tricks.sliding_window_view(data, LEFT)

        def shaped(i: np.ndarray) -> np.ndarray:
            out = np.zeros((len(i), ROOM), np.uint8)
            out[:, :HEAD] = lead[i].astype(">u8").view(np.uint8).reshape(-1, HEAD)
            body = view_right[anchor[i]]
            out[:, HEAD : HEAD + WIDTH] = np.where(np.arange(WIDTH) < right[i, None], body, 0)
            out[:, TAIL - 1] = right[i]
            out[:, TAIL:] = np.where(np.arange(LEFT) < left[i, None], view_left[start[i]], 0)
            return out

        order = np.argsort(lead, kind="stable")
        same = np.zeros(len(order) + 1, bool)
        same[1:-1] = lead[order][1:] == lead[order][:-1]
        tied = np.flatnonzero(same[:-1] | same[1:])
        dropped = np.zeros(len(order), bool)
        spans: list[tuple[np.ndarray, ...]] = []
        # Entries that share the hash are put in order by their bytes, groups of them at a time.
        breaks = np.append(np.flatnonzero(~same[tied]), len(tied)) if len(tied) else np.zeros(1, np.int64)
        a = 0
        while a < len(tied):
            b = int(breaks[min(np.searchsorted(breaks, a + TIES), len(breaks) - 1)])
            spot = tied[a:b]
            i = order[spot]
            m = np.zeros((len(i), (ROOM + 7) // 8 * 8), np.uint8)
            m[:, :ROOM] = shaped(i)
            wide = m.view(">u8").astype(np.uint64)
            inner = np.lexsort((place[i], row[i], left[i], *wide.T[::-1]))
            i, wide = i[inner], wide[inner]
            order[spot] = i
            equal = np.zeros(len(i), bool)
            equal[1:] = (wide[1:] == wide[:-1]).all(axis=1) & (left[i][1:] == left[i][:-1])
            dropped[spot[equal]] = True
            lead_of = np.maximum.accumulate(np.where(equal, 0, np.arange(len(i))))
            gone = equal & ((row[i] != row[i[lead_of]]) | (place[i] != place[i[lead_of]]))
            j = i[gone]
            spans.append((row[j], place[j], place[j] + left[j] + right[j]))
            a = b
        if spans:
            r, s, e = (np.concatenate(x) for x in zip(*spans, strict=True))
            for a in range(0, len(r), 50_000):
                c = slice(a, a + 50_000)
                n = len(r[c])
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), *(pa.array(x) for x in (ids[r[c]], keys[r[c]], s[c], e[c]))],
                    [x.split()[0] for x in RUNS.split(", ")],
                )
        order = order[~dropped]
        part = ((lead[order] >> np.uint64(32)) * np.uint64(self.parts) >> np.uint64(32)).astype(np.int64)
        cut = np.searchsorted(part, np.arange(self.parts + 1))
        for p in np.flatnonzero(np.diff(cut)):
            i = order[cut[p] : cut[p + 1]]
            m = shaped(i)
            size = TAIL + left[i]
            shared = np.zeros(len(i), np.int64)
            unlike = m[1:] != m[:-1]
            shared[1:] = np.where(unlike.any(axis=1), unlike.argmax(axis=1), ROOM)
            shared[1:] = np.minimum(shared[1:], np.minimum(size[1:], size[:-1]))
            columns = np.arange(ROOM)
            rest = m[(columns >= shared[:, None]) & (columns < size[:, None])]
            used, local = np.unique(row[i], return_inverse=True)
            raw = b"".join(
                x.tobytes()
                for x in (
                    np.array([len(i), len(used)], np.int64),
                    ids[used],
                    keys[used],
                    place[i].astype(np.int64),
                    local.astype(np.int32),
                    shared.astype(np.uint8),
                    size.astype(np.uint8),
                    rest,
                )
            )
            block = zstandard.ZstdCompressor(level=1).compress(raw)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(p)], pa.int32()), pa.array([block], pa.binary()), *(pa.nulls(1, pa.int64()) for _ in range(4))],
                [x.split()[0] for x in RUNS.split(", ")],
            )


class _Block:
    """A front-coded run of one range, read entry by entry from where it was unpacked."""

    def __init__(self, block: bytes | pa.Buffer):
        raw = zstandard.ZstdDecompressor().decompress(block)
        n, docs = np.frombuffer(raw, np.int64, 2).tolist()
        at = 16
        self.n = n
        self.ids = np.frombuffer(raw, np.int64, docs, at)
        self.keys = np.frombuffer(raw, np.int64, docs, at + 8 * docs)
        at += 16 * docs
        self.place = np.frombuffer(raw, np.int64, n, at)
        self.local = np.frombuffer(raw, np.int32, n, at + 8 * n)
        self.shared = np.frombuffer(raw, np.uint8, n, at + 12 * n)
        self.size = np.frombuffer(raw, np.uint8, n, at + 13 * n)
        self.raw, self.rest = raw, at + 14 * n

    def entries(self) -> Iterator[tuple[bytes, int]]:
        """Entry and the prefix it shares with the one before."""
        raw, at, entry = self.raw, self.rest, b""
        for a in range(0, self.n, 4096):
            shared = self.shared[a : a + 4096].tolist()
            size = self.size[a : a + 4096].tolist()
            for h, s in zip(shared, size, strict=True):
                end = at + s - h
                entry = entry[:h] + raw[at:end]
                at = end
                yield entry, h

    def where(self, i: int) -> tuple[int, int, int]:
        d = self.local[i]
        return int(self.ids[d]), int(self.keys[d]), int(self.place[i])


def _common(a: bytes, b: bytes, h: int) -> int:
    """Length of the common prefix of two entries that are known to share h bytes."""
    end = min(len(a), len(b))
    while h < end:
        x, y = a[h : h + 8], b[h : h + 8]
        if x != y:
            n = min(len(x), len(y))
            d = int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")
            return h + (n - (d.bit_length() + 7) // 8)
        h += 8
    return end


def merged(blocks: list[_Block]) -> Iterator[tuple[bytes, int, int, int]]:
    """All entries in order: entry, prefix shared with the one before, block, index in it.

    A loser tree: every inner node keeps the run that lost there and the prefix
    it shares with the run that beat it. A run that has ended shares -1 and so
    loses to all.
    """
    k = 1
    while k < len(blocks):
        k *= 2
    feeds = [b.entries() for b in blocks] + [iter(())] * (k - len(blocks))
    now: list[bytes] = [b""] * k
    have = [-1] * k
    index = [0] * k
    for r in range(k):
        got = next(feeds[r], None)
        if got is not None:
            now[r], have[r] = got[0], 0
    loser = [0] * k

    def play(node: int) -> int:
        """Fill the tree from below; the winner of the subtree."""
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        win, lose = a, b
        if have[a] < 0 or have[b] < 0:
            if have[a] < 0:
                win, lose = b, a
        else:
            h = _common(now[a], now[b], 0)
            if now[b][h:] < now[a][h:]:
                win, lose = b, a
            have[lose] = h
        loser[node] = lose
        return win

    winner = play(1) if k > 1 else 0
    if have[winner] >= 0:
        have[winner] = 0
    while have[winner] >= 0:
        yield now[winner], have[winner], winner, index[winner]
        got = next(feeds[winner], None)
        index[winner] += 1
        if got is None:
            have[winner] = -1
        else:
            now[winner], have[winner] = got
        node = (winner + k) >> 1
        h = have[winner]
        while node:
            other = loser[node]
            g = have[other]
            if g > h:
                loser[node] = winner
                winner, h = other, g
            elif g == h and g >= 0:
                a, b = now[winner], now[other]
                both = _common(a, b, h)
                if b[both:] < a[both:]:
                    have[winner] = both
                    loser[node] = winner
                    winner = other
                else:
                    have[other] = both
            node >>= 1
        have[winner] = h


def _between(entries: list[tuple[bytes, int, tuple[int, int, int]]], out: list[tuple[int, int, int, int]]) -> None:
    """Windows shared by different entries of one group. Each entry: bytes, prefix with the one before, place."""
    texts = []
    for i, (entry, shared, place) in enumerate(entries):
        right = entry[TAIL - 1]
        left = len(entry) - TAIL
        reach = max(shared if i else 0, entries[i + 1][1] if i + 1 < len(entries) else 0) - HEAD
        # A window that begins o bytes before the anchor needs the suffix to agree on 100 - o bytes.
        windows = min(left + right - WIDTH + 1, left - WIDTH + min(reach, WIDTH) + 1)
        if windows > 0:
            texts.append((entry[TAIL:] + entry[HEAD : HEAD + right], left, windows, place))
    if len(texts) < 2:
        return
    # All windows at once in a small group; in a large one those of one distance to the anchor.
    turns = [None] if len(texts) <= 1000 else range(LEFT + 1)
    for only in turns:
        best: dict[int, tuple[int, int, int]] = {}
        hashed = []
        for text, left, windows, (doc, key, start) in texts:
            first, end = (0, windows) if only is None else (left - only, left - only + 1)
            if first < 0 or first >= windows:
                hashed.append([])
                continue
            hs = [hash(text[j : j + WIDTH]) for j in range(first, end)]
            hashed.append(hs)
            for j, h in enumerate(hs, start + first):
                old = best.get(h)
                if old is None or (doc, key, j) < old:
                    best[h] = (doc, key, j)
        for (_, left, _, (doc, key, start)), hs in zip(texts, hashed, strict=True):
            first = start if only is None else start + left - only
            run = None
            for j, h in enumerate(hs, first):
                if best[h] != (doc, key, j):
                    if run is None:
                        run = j
                elif run is not None:
                    out.append((doc, key, run, j - 1 + WIDTH))
                    run = None
            if run is not None:
                out.append((doc, key, run, first + len(hs) - 1 + WIDTH))


def repeats(blocks: list[_Block]) -> Iterator[tuple[int, int, int, int]]:
    """Removed spans that show when the runs of one range are merged: doc_id, text_key, start, end."""
    out: list[tuple[int, int, int, int]] = []
    group: list[tuple[bytes, int, int, int]] = []

    def settle() -> None:
        different: list[tuple[bytes, int, tuple[int, int, int]]] = []
        at = 0
        while at < len(group):
            entry, shared = group[at][0], group[at][1]
            places = [blocks[group[at][2]].where(group[at][3])]
            at += 1
            while at < len(group) and group[at][1] == len(entry) == len(group[at][0]):
                places.append(blocks[group[at][2]].where(group[at][3]))
                at += 1
            first = min(places)
            length = len(entry) - TAIL + entry[TAIL - 1]
            out.extend((d, k, p, p + length) for d, k, p in places if (d, k, p) != first)
            different.append((entry, shared, first))
        if len(different) > 1:
            _between(different, out)

    for item in merged(blocks):
        if item[1] < HEAD + SEED:
            if len(group) > 1:
                settle()
                if len(out) > 50_000:
                    yield from out
                    out.clear()
            group = [item]
        else:
            group.append(item)
    if len(group) > 1:
        settle()
    yield from out


def by_range(runs: DataFrame, parts: int) -> DataFrame:
    """Each range in a partition of its own (hashed, several would meet in one and others stay
    empty), after the spans found inside runs, which are spread by document."""
    spread = F.coalesce("part", F.pmod(F.xxhash64("doc_id", "start"), F.lit(parts)).cast("int"))
    placed = runs.withColumn("to", spread).repartitionById(parts, "to")
    return placed.sortWithinPartitions(F.col("part").asc_nulls_first()).drop("to")


def removed_spans(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Spans to remove (they may overlap) of ``doc_id, text_key, text``, written to the shared folder."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _Run(parts)
        for batch in common.pieces(batches, "text"):
            data, at = common.as_bytes(batch.column(2))
            run.piece(batch.column(0).to_pylist(), batch.column(1).to_pylist(), data, at)
            if run.size >= RUN_BYTES:
                yield from run.flush()
        yield from run.flush()
        common.trim()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blocks = None, []

        def close() -> Iterator[pa.RecordBatch]:
            rows: list[tuple[int, int, int, int]] = []
            for span in repeats(blocks) if blocks else ():
                rows.append(span)
                if len(rows) == 50_000:
                    yield spans(rows)
                    rows.clear()
            if rows:
                yield spans(rows)

        def spans(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], [x.split()[0] for x in SPANS.split(", ")])

        for batch in batches:
            # Loose spans come first. Blocks are unpacked from the batch, without a copy.
            n_loose = batch.column(0).null_count
            if n_loose:
                yield batch.slice(0, n_loose).select([2, 3, 4, 5])
            for i in range(n_loose, batch.num_rows):
                part = batch.column(0)[i].as_py()
                if part != now:
                    yield from close()
                    now, blocks = part, []
                blocks.append(_Block(batch.column(1)[i].as_buffer()))
        batch = None
        yield from close()
        blocks = []
        common.trim()

    runs = docs.select("doc_id", "text_key", "text").mapInArrow(sort, RUNS)
    return common.stage(by_range(runs, parts).mapInArrow(merge, SPANS), "spans")


def _joined(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of a set of spans; spans that touch are one."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    at = np.flatnonzero(new)
    return start[at], end[np.append(at[1:], len(start)) - 1]


def _whole_chars(body: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans without characters that they cover in part."""
    out = []
    for s, e in spans:
        while s < e and body[s] & 0xC0 == 0x80:
            s += 1
        while s < e < len(body) and body[e] & 0xC0 == 0x80:
            e -= 1
        if s < e:
            out.append((s, e))
    return out


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), whole_chars: bool = False
) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (start, end), kept (remaining bytes) of every document.

    ``keep`` names columns that come along in a struct ``rest``. With
    ``whole_chars`` a character of which only a part repeats stays, so that what
    is left of a text is a text.
    """
    spark = docs.sparkSession
    common.ship(spark)
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("text_key"),
        F.col(text_col).alias("text"),
        F.struct(F.lit(0).alias("_"), *(F.col(c) for c in keep)).alias("rest"),
    )
    spans = removed_spans(rows)
    rest_type = rows.schema["rest"].dataType.simpleString()
    mask = F.lit((1 << FILTER_BITS) - 1)
    h = F.xxhash64("doc_id").bitwiseAND(mask)
    marked = spans.select(h.alias("h")).groupBy(F.shiftright("h", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits")).toPandas()
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bitmap[marked["w"].to_numpy()] = marked["bits"].to_numpy()
    sent = spark.sparkContext.broadcast(bitmap.view(np.uint64))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            x = np.asarray(batch.column(4)).view(np.uint64)
            hit = bits[x >> np.uint64(6)] >> (x & np.uint64(63)) & np.uint64(1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(hit.astype(bool))], ["doc_id", "text_key", "text", "rest", "marked"])

    texts = rows.withColumn("h", h).mapInArrow(sift, f"doc_id long, text_key long, text string, rest {rest_type}, marked boolean")
    result = f"doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary, rest {rest_type}"
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    whole = texts.where(~F.col("marked")).select(
        "doc_id",
        F.length(body).cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.expr("cast(array() as array<struct<start:long,end:long>>)").alias("spans"),
        body.alias("kept"),
        "rest",
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spans of a document come before its texts."""
        now: tuple[int, int] | None = None
        found: list[tuple[np.ndarray, np.ndarray]] = []
        runs: tuple[np.ndarray, np.ndarray] | None = None
        for batch in batches:
            ids, keys = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            start, end = (np.asarray(batch.column(i).fill_null(-1)) for i in (3, 4))
            new = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]) | ((start[1:] < 0) != (start[:-1] < 0)))))
            out: list[tuple] = []
            chosen: list[int] = []
            for a, b in zip(new, np.append(new[1:], len(ids)), strict=True):
                if (ids[a], keys[a]) != now:
                    now, found, runs = (ids[a], keys[a]), [], None
                if start[a] >= 0:
                    found.append((start[a:b], end[a:b]))
                    continue
                if runs is None:
                    runs = _joined(*(np.concatenate(x) for x in zip(*found, strict=True))) if found else (start[:0], end[:0])
                for text in batch.column(2).slice(a, b - a).to_pylist():
                    body = (text or "").encode("utf-8", "surrogatepass")
                    cuts = list(zip(*(r.tolist() for r in runs), strict=True))
                    if whole_chars:
                        cuts = _whole_chars(body, cuts)
                    edges = [0, *(x for c in cuts for x in c), len(body)]
                    kept = b"".join(body[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
                    pairs = [{"start": s, "end": e} for s, e in cuts]
                    out.append((int(ids[a]), len(body), len(body) - len(kept), pairs, kept))
                chosen.extend(range(a, b))
            if out:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary())
                rest = batch.column(5).take(pa.array(chosen, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)), rest],
                    ["doc_id", "n_bytes", "n_removed", "spans", "kept", "rest"],
                )

    long = F.lit(None).cast("long")
    with_spans = (
        texts.where("marked")
        .select("doc_id", "text_key", "text", long.alias("start"), long.alias("end"), "rest")
        .unionByName(spans.select("doc_id", "text_key", F.lit(None).cast("string").alias("text"), "start", "end", F.lit(None).cast(rest_type).alias("rest")))
        .repartition("doc_id")
        .sortWithinPartitions("doc_id", "text_key", F.col("start").asc_nulls_last())
        .mapInArrow(cut, result)
    )
    return whole.unionByName(with_spans).withColumn("doc_id", F.when(F.col("doc_id") != LAST_ID, F.col("doc_id")))


def op1_suffix_dedup(spark, sf_dir):
    """What is left of every document without its repeated strings of 100 bytes."""
    out = dedup(common.table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
