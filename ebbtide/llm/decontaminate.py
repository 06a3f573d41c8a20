"""Benchmark passages inside documents, found by edit distance.

Texts are words (runs of letters, digits and non-ASCII bytes, A-Z lower-cased);
an item leaks where a stretch of a document is within ``RATE`` of its length in
word edits (insertions, deletions, replacements).

1. Windows of item size: items are binned by length (each bin 25% wider than the
   last) and a bin's window is its longest item. Every word position is
   looked at. By the q-gram lemma a window within reach of an item shares at
   least half of the item's word pairs; the sorted places of the items' pairs give
   the windows that do, and lose none. Of a run of such windows those at every
   eighth of their width and those with most shared pairs go to the walks.
2. CGK embedding: for each of ``REPEATS`` random walks, position i of a string
   moves on by a random bit of (step, word); in the words met on the way a few
   edits change few places. Places come from the first ``STEPS`` times the length,
   where walks are still inside the string. A repetition keys a window by ``SAMPLES`` random places of its walk (bit
   sampling); windows that agree with an item in any repetition are candidates.
   Walks miss some leaks, more of them the longer the item and the more its edits
   throw a walk out of step. So the filter of 1 is also asked item by item: where
   an item's own pairs stand close enough together and are enough of them for a
   leak, that place is a candidate too. This loses none.
3. Candidates that hold enough of the item's own pairs are verified by the exact
   edit distance of the item to the best stretch of the window and a margin
   around it, and then to what is left on both sides of a find.

The benchmark is read in blocks of ``ITEM_BLOCK`` words, each broadcast in its
turn, so what is sent is bounded; documents are not shuffled at all.

Nulls, edges: null or empty texts have no words and match nothing, nor do items
under ``MIN_WORDS`` words (too short to be evidence). Documents with a null id
are searched and reported with it. Repeated rows and items each report their own
matches. Overlapping finds of one item in a document are one match, the closest.
Long texts are searched whole. Empty tables give no rows; only the named columns
are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm import common, words

RATE, MIN_WORDS, BIN = 0.25, 5, 1.25
REPEATS, SAMPLES, STEPS = 32, 3, 1.6
ITEM_BLOCK = 2_000_000
HELD = 20_000
PLACES = 4_000_000

MATCH = "doc_id long, item_id long, start_word long, end_word long, distance long, item_words long"
_C = np.uint64(0x9E3779B97F4A7C15)


def _walk_plan(length: int) -> tuple[list[list[int]], np.ndarray]:
    """For each step the repetitions that sample it, and a multiplier for each step and repetition."""
    draw = np.random.default_rng(length)
    steps = max(1, int(STEPS * length))
    sampled: list[list[int]] = [[] for _ in range(steps)]
    for repeat in range(REPEATS):
        for step in draw.choice(steps, min(SAMPLES, steps), replace=False).tolist():
            sampled[step].append(repeat)
    return sampled, draw.integers(1, 1 << 63, (steps, REPEATS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def keys(strings: np.ndarray) -> np.ndarray:
    """CGK walks over rows of word hashes (0 behind the end): a key of sampled places for each repetition."""
    m, width = strings.shape
    sampled, factor = _walk_plan(width)
    out = np.empty((m, REPEATS), np.uint64)
    for a in range(0, m, 2048):
        part = strings[a : a + 2048]
        n = len(part)
        padded = np.concatenate((part, np.zeros((n, 1), np.uint64)), axis=1).ravel()
        base = (np.arange(n) * (width + 1))[:, None]
        at = np.zeros((n, REPEATS), np.int64)
        key = np.tile(np.arange(1, REPEATS + 1, dtype=np.uint64), (n, 1))
        for step in range(max(i for i, x in enumerate(sampled) if x) + 1):
            word = padded[base + at]
            for repeat in sampled[step]:
                key[:, repeat] = common.mix(key[:, repeat] * _C + word[:, repeat])
            at += (word * factor[step] >> np.uint64(63)).astype(np.int64)
            np.minimum(at, width, out=at)
        out[a : a + 2048] = key
    return out


def fitted(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of the item to a stretch of the text, and that stretch (start, end)."""
    n = len(text)
    row = np.zeros(n + 1, np.int64)
    start = np.arange(n + 1)
    span = np.arange(n + 1)
    for i, word in enumerate(item.tolist()):
        from_above = row + 1
        across = row[:-1] + (text != word)
        best, origin = from_above.copy(), start.copy()
        better = across < best[1:]
        best[1:][better] = across[better]
        origin[1:][better] = start[:-1][better]
        best[0], origin[0] = i + 1, 0
        # Deletions run from left to right: a running minimum of (value - place).
        shifted = best - span
        low = np.minimum.accumulate(shifted)
        lead = np.maximum.accumulate(np.where(shifted == low, span, 0))
        row, start = low + span, origin[lead]
    end = int(row.argmin())
    return int(row[end]), int(start[end]), end


class Items:
    """One block of benchmark items, ready to be looked for."""

    def __init__(self, ids: list[int], texts: pa.Array, rate: float):
        self.rate = rate
        data, at = common.as_bytes(texts)
        h, _, _, first = words.words(data, at, words.NOT_LETTERS)
        self.items = [(i, h[a:b].copy()) for i, a, b in zip(ids, first[:-1], first[1:], strict=True) if b - a >= MIN_WORDS]
        self.own_pairs = [frozenset(_pairs(item).tolist()) for _, item in self.items]
        self.least = [max(1, len(p) - 2 * int(rate * len(item))) for p, (_, item) in zip(self.own_pairs, self.items, strict=True)]
        # Most words that a leak of the item has.
        self.reach = np.array([len(item) + int(rate * len(item)) for _, item in self.items], np.int64)
        self.need = np.array(self.least, np.int64)
        bins: dict[int, list[int]] = {}
        for k, (_, item) in enumerate(self.items):
            bins.setdefault(int(np.log(len(item)) / np.log(BIN)), []).append(k)
        self.bins = []
        for members in bins.values():
            width = max(len(self.items[k][1]) for k in members)
            least = min(self.least[k] for k in members)
            own = [np.unique(_pairs(self.items[k][1])) for k in members]
            pairs, which = np.unique(np.concatenate(own), return_inverse=True)
            order = np.argsort(which, kind="stable")
            holders = np.repeat(members, [len(x) for x in own])[order]
            begin = np.searchsorted(which[order], np.arange(len(pairs) + 1))
            rows = np.zeros((len(members), width), np.uint64)
            for r, k in enumerate(members):
                rows[r, : len(self.items[k][1])] = self.items[k][1]
            tables = []
            for key in keys(rows).T:
                order = np.argsort(key, kind="stable")
                tables.append((key[order], np.array(members)[order]))
            self.bins.append((width, least, pairs, tables, begin, holders))
        self.pairs = np.unique(np.concatenate([b[2] for b in self.bins])) if self.bins else np.zeros(0, np.uint64)
        # A bit for each hash value, so that most pairs of a text are turned away by one look.
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[(self.pairs >> np.uint64(42)).astype(np.int64)] = True

    def candidates(self, strings: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, item) of the rows of a bin that agree with an item in some repetition."""
        found = []
        for mine, (key, item) in zip(keys(strings).T, self.bins[which][3], strict=True):
            a, b = np.searchsorted(key, mine), np.searchsorted(key, mine, "right")
            row = np.repeat(np.arange(len(mine)), b - a)
            if len(row):
                at = np.arange(len(row)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + a[row]
                found.append(row << 32 | item[at])
        both = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return both >> 32, both & 0xFFFFFFFF

    def places(self, hit: np.ndarray, pair: np.ndarray, doc: np.ndarray, which: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word, item) wherever enough pairs of one item begin within its reach; pair is the number of the pair at each hit."""
        begin, holders = self.bins[which][4:]
        parts = 1 + int((begin[pair + 1] - begin[pair]).sum()) // PLACES
        for part in range(parts):
            mine = holders % parts == part
            at = np.concatenate(([0], np.cumsum(mine)))[begin]
            n = at[pair + 1] - at[pair]
            row = np.repeat(np.arange(len(hit)), n)
            item = holders[mine][np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + at[pair][row]]
            order = np.argsort(item, kind="stable")
            item, place = item[order], hit[row[order]]
            i = np.arange(len(item))
            j = i + self.need[item] - 1
            i, j = i[j < len(item)], j[j < len(item)]
            ok = (item[i] == item[j]) & (doc[place[i]] == doc[place[j]]) & (place[j] - place[i] <= self.reach[item[i]] - 2)
            yield place[i[ok]], item[i[ok]]


def _pairs(h: np.ndarray) -> np.ndarray:
    return common.mix(h[:-1] * _C + h[1:])


class _Search:
    """Windows held back until there are enough for a walk; matches by document and item."""

    def __init__(self, items: Items):
        self.items = items
        self.held: list[list[tuple]] = [[] for _ in items.bins]
        self.seeds: list[tuple] = []
        self.count = 0

    def add(self, ids: list, h: np.ndarray, first: np.ndarray) -> None:
        it = self.items
        if len(h) < 2 or not it.bins:
            return
        pair = _pairs(h)
        doc = np.repeat(np.arange(len(ids)), np.diff(first))
        ok = it.sieve[(pair >> np.uint64(42)).astype(np.int64)] & (doc[1:] == doc[:-1])
        spots = np.flatnonzero(ok)
        if not len(spots):
            return
        pair = pair[spots]
        for which, (width, least, pairs, *_) in enumerate(it.bins):
            where = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
            same = pairs[where] == pair
            hit, where = spots[same], where[same]
            if len(hit) < least:
                continue
            # Windows that begin between (the least-th hit back) - reach and a hit hold enough of
            # them, where reach allows for the words that a leak may have put in.
            reach = width + int(it.rate * width)
            near = hit[least - 1 :] - hit[: len(hit) - least + 1] < reach
            a = np.maximum(hit[least - 1 :][near] - reach + 2, 0)
            b = hit[: len(hit) - least + 1][near] + 1
            if not len(a):
                continue
            mark = np.zeros(len(h) + 1, np.int64)
            np.add.at(mark, np.minimum(a, b - 1), 1)
            np.add.at(mark, b, -1)
            starts = np.flatnonzero(np.cumsum(mark)[:-1] > 0)
            starts = self._spread(starts, hit, width)
            seeds = list(it.places(hit, where, doc, which))
            used = np.unique(doc[np.concatenate((starts, *(place for place, _ in seeds)))])
            texts = {d: (ids[d], h[first[d] : first[d + 1]].copy()) for d in used.tolist()}
            place = starts[:, None] + np.arange(width)
            inside = place < first[doc[starts] + 1][:, None]
            strings = np.where(inside, h[np.minimum(place, len(h) - 1)], np.uint64(0))
            rows = [(texts[d], s) for d, s in zip(doc[starts].tolist(), (starts - first[doc[starts]]).tolist(), strict=True)]
            self.held[which].append((strings, rows))
            self.count += len(rows)
            for place, item in seeds:
                inner = (place - first[doc[place]]).tolist()
                self.seeds += [(texts[d], s, k) for d, s, k in zip(doc[place].tolist(), inner, item.tolist(), strict=True)]
                self.count += len(place)

    @staticmethod
    def _spread(starts: np.ndarray, hit: np.ndarray, width: int) -> np.ndarray:
        """Of each run of windows every eighth of a width, and where the number of shared pairs peaks."""
        count = np.searchsorted(hit, starts + width - 1) - np.searchsorted(hit, starts)
        new = np.concatenate(([True], starts[1:] != starts[:-1] + 1))
        run = np.maximum.accumulate(np.where(new, starts, 0))
        before = np.concatenate(([0], count[:-1])) * ~new
        after = np.concatenate((count[1:], [0])) * ~np.concatenate((new[1:], [True]))
        top = np.maximum.reduceat(count, np.flatnonzero(new))[np.cumsum(new) - 1]
        peak = (count >= before) & (count >= after) & ((count > before) | (count > after)) & (count >= 0.9 * top)
        return starts[((starts - run) % max(1, width // 8) == 0) | peak]

    def drain(self) -> list[tuple]:
        """Matches (doc, item, start, end, distance, words) of all windows held."""
        close: dict[tuple[int, int], list] = {}
        for which, rows in enumerate(self.held):
            if not rows:
                continue
            for strings, part in rows:
                for r, k in zip(*(x.tolist() for x in self.items.candidates(strings, which)), strict=True):
                    (doc, text), s = part[r]
                    close.setdefault((id(text), k), [doc, text, []])[2].append(s)
        for (doc, text), s, k in self.seeds:
            close.setdefault((id(text), k), [doc, text, []])[2].append(s)
        out: list[tuple] = []
        for (_, k), (doc, text, starts) in close.items():
            item_id, item = self.items.items[k]
            margin = len(item) // 2 + 1
            starts.sort()
            # Windows that lie close together are one place in the text.
            a = 0
            for i in range(1, len(starts) + 1):
                if i < len(starts) and starts[i] - starts[i - 1] <= margin:
                    continue
                low = max(0, starts[a] - margin)
                stretch = text[low : starts[i - 1] + len(item) + 2 * margin]
                a = i
                for distance, s, e in self._finds(k, stretch):
                    out.append((doc, item_id, low + s, low + e, distance, len(item)))
        self.held = [[] for _ in self.items.bins]
        self.seeds = []
        self.count = 0
        return out

    def _finds(self, k: int, stretch: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """The closest place of an item in a stretch, and those beside it."""
        item, todo = self.items.items[k][1], [(0, len(stretch))]
        while todo:
            a, b = todo.pop()
            # Within reach of the item only with enough of its pairs: most candidates end here.
            if len(self.items.own_pairs[k].intersection(_pairs(stretch[a:b]).tolist())) < self.items.least[k]:
                continue
            distance, s, e = fitted(item, stretch[a:b])
            if distance <= self.items.rate * len(item):
                yield distance, a + s, a + e
                todo += [(a, a + s), (a + e, b)]


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = RATE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, item_id, start_word, end_word, distance, item_words of every leak."""
    spark = docs.sparkSession
    common.ship(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = None
    for block in _item_blocks(benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t"))):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, texts = sent.value
            search = _Search(Items(ids, texts, rate))

            def rows() -> pa.RecordBatch:
                got = search.drain()
                columns = list(zip(*got, strict=True)) or [()] * 6
                return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [c.split()[0] for c in MATCH.split(", ")])

            for batch in common.pieces(batches, "text"):
                data, at = common.as_bytes(batch.column(1))
                h, _, _, first = words.words(data, at, words.NOT_LETTERS)
                search.add(batch.column(0).to_pylist(), h, first)
                if search.count >= HELD:
                    yield rows()
            yield rows()

        now = source.mapInArrow(run, MATCH)
        found = now if found is None else found.unionByName(now)
    return spark.createDataFrame([], MATCH) if found is None else found


def _item_blocks(benchmark: DataFrame) -> Iterator[tuple[list, pa.Array]]:
    """Items in blocks of about ITEM_BLOCK words: the driver holds one block at a time."""
    ids: list = []
    texts: list[str] = []
    size = 0
    for row in benchmark.where("t is not null and i is not null").toLocalIterator():
        ids.append(row["i"])
        texts.append(row["t"])
        size += row["t"].count(" ") + 1
        if size >= ITEM_BLOCK:
            yield ids, pa.array(texts, pa.large_string())
            ids, texts, size = [], [], 0
    if ids:
        yield ids, pa.array(texts, pa.large_string())


def op4_decontaminate(spark, sf_dir):
    """Every passage of the benchmark found in a document: one row for a document and an item."""
    found = matches(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(
        F.min("distance").alias("distance"), F.max("item_words").alias("item_words"), F.count("*").alias("n_places")
    )
