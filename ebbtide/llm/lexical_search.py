"""Exact ranked lexical search over posting lists in geometric blocks.

Texts are read once for a block of items: each document becomes a sparse vector of
the block's terms, with its number of terms, written to the shared folder. Counts
over all of them give the weights. A task then takes its vectors in shards of about
``POSTINGS`` entries. In a shard, the posting list of each term is clustered by the
likeness of the documents (a random projection of their weighted vectors; centres
are members of the list, some BLOCK postings to each), and each cluster is a block
with a summary: for every term that shares an item with the list's term, the
largest entry of the block's documents. No document of a block scores more for an
item than the item's inner product with the summary. An item visits the blocks of
its terms from the highest bound down, scores their documents in full, and stops
when no bound reaches its k-th best score: that skips blocks by exact bounds only,
and equal scores are still read. The k-th best scores of a sample of documents are
the first thresholds of all shards; they only save work.

The entry of a term in a document is (1e9 tf) div (1000 tf + 12 m), m growing with
the document's length; weights and scores are integers, so results are exact.

Memory: a task holds one shard and the k best rows of each item so far. Items come
in blocks of ``ITEM_TERMS`` distinct terms (or of one item); only a block's terms
are on the driver and in the broadcast, which is destroyed after its pass.

Nulls, edges: a null text has no term and is not counted; an item without terms
has no rows. Rows are documents of their own, also those of one id; equal scores go
by ascending id, null last. Items are told apart by row: two of one id each have
their ranks. Terms are compared as bytes. Texts of any length are read whole, in
pieces cut between terms. Documents of score 0 are not listed. Empty tables give no
rows. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm import common
from ebbtide.llm.words import NOT_LETTERS

K = 20
#: Postings of a block on average, and of a shard.
BLOCK, POSTINGS = 64, 1 << 19
#: Distinct terms of the items that go over the documents together.
ITEM_TERMS = 1 << 13
#: Documents that give the first thresholds, about.
SAMPLE = 1 << 13
#: Blocks that an item reads before it looks at its threshold again.
AT_ONCE = 16
DIMENSIONS = 32

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

VECTORS = "doc_id long, n long, terms array<int>, tfs array<int>"


def split_terms(data: np.ndarray, at: np.ndarray, limit: int = 4 << 20) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The lower-case terms of all texts in turn, and the number of the text that holds each."""
    start = 0
    while start < len(data):
        end = min(len(data), start + limit)
        while end < len(data) and not NOT_LETTERS[data[end]] and at[np.searchsorted(at, end)] != end:
            border = at[np.searchsorted(at, end)]
            ahead = NOT_LETTERS[data[end : min(border, end + limit)]]
            end += int(ahead.argmax()) if ahead.any() else len(ahead)
        piece = data[start:end]
        solid = ~NOT_LETTERS[piece]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        inner = at[np.searchsorted(at, start, "right") : np.searchsorted(at, end)] - start
        begins[inner] = solid[inner]
        b = np.flatnonzero(begins)
        # Without what parts them, the terms stand end to end.
        upto = np.concatenate(([0], np.cumsum(solid)))
        offsets = np.append(upto[b], upto[-1]).astype(np.int64)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[piece[solid]])]
        yield pa.Array.from_buffers(pa.large_binary(), len(b), buffers), np.searchsorted(at, b + start, "right") - 1
        start = end


def terms_of(text: str | None) -> list[bytes]:
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return [t for words, _ in split_terms(data, np.array([0, len(data)])) for t in words.to_pylist()]


class Items:
    """A block of items: their terms as numbers, how often each asks for which."""

    def __init__(self, asked: Sequence[Counter]):
        self.terms = sorted({t for item in asked for t in item})
        number = {t: i for i, t in enumerate(self.terms)}
        self.asks = [
            (np.array(sorted(number[t] for t in item), np.int64), np.array([item[self.terms[i]] for i in sorted(number[t] for t in item)], np.int64))
            for item in asked
        ]
        self.askers: list[list[int]] = [[] for _ in self.terms]
        for q, (terms, _) in enumerate(self.asks):
            for t in terms.tolist():
                self.askers[t].append(q)


def item_blocks(items: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[tuple[list, Items]]:
    """Ids and terms of successive items; those of a block have ``limit`` distinct terms or the block is one item."""
    ids: list = []
    asked: list[Counter] = []
    seen: set[bytes] = set()
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).orderBy("id", "text")
    for row in rows.toLocalIterator():
        terms = Counter(terms_of(row.text))
        if ids and len(seen | set(terms)) > limit:
            yield ids, Items(asked)
            ids, asked, seen = [], [], set()
        ids.append(row.id)
        asked.append(terms)
        seen |= set(terms)
    if ids:
        yield ids, Items(asked)


def vectors(docs: DataFrame, terms: Sequence[bytes]) -> DataFrame:
    """doc_id, n, terms, tfs of each (doc_id, text): all its terms counted, the asked ones by number."""
    sent = docs.sparkSession.sparkContext.broadcast(list(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = pa.array(sent.value, pa.large_binary())
        wide = max(1, len(asked))
        for batch in common.pieces(batches, "text", 4 << 20):
            data, at = common.as_bytes(batch.column(1))
            n, found = np.zeros(batch.num_rows, np.int64), []
            for words, text in split_terms(data, at):
                n += np.bincount(text, minlength=batch.num_rows)
                term = pc.index_in(words, value_set=asked).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                keys, tfs = np.unique((text * wide + term)[term >= 0], return_counts=True)
                found.append((keys, tfs))
            keys = np.concatenate([k for k, _ in found]) if found else np.zeros(0, np.int64)
            tfs = np.concatenate([c for _, c in found]) if found else np.zeros(0, np.int64)
            keys, where = np.unique(keys, return_inverse=True)
            tfs = np.bincount(where, tfs, len(keys)).astype(np.int64)
            ends = pa.array(np.searchsorted(keys, np.arange(batch.num_rows + 1) * wide), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n),
                    pa.ListArray.from_arrays(ends, pa.array((keys % wide).astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(tfs.astype(np.int32))),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    return docs.mapInArrow(run, VECTORS)


class Corpus:
    """Counts over all documents, and what follows from them."""

    def __init__(self, n_docs: int, n_terms: int, df: dict[int, int], wide: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weights = np.array(
            [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(wide)], np.int64
        )

    @classmethod
    def of(cls, found: DataFrame, wide: int) -> Corpus:
        n_docs, n_terms = found.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        df = found.select(F.explode("terms").alias("t")).groupBy("t").count()
        return cls(n_docs, n_terms or 0, {r["t"]: r["count"] for r in df.collect()}, wide)

    def entries(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 75 + 25 * n * self.n_docs // max(1, self.n_terms)
        return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def _rows(first: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all entries of some documents, and where each document's begin."""
    size = first[docs + 1] - first[docs]
    upto = np.cumsum(size)
    at = np.arange(upto[-1] if len(upto) else 0) + np.repeat(first[docs] - (upto - size), size)
    return at, upto - size


class Shard:
    """Posting lists of some documents in geometric blocks with summaries."""

    def __init__(self, items: Items, weights: np.ndarray, first: np.ndarray, terms: np.ndarray, values: np.ndarray, block: int = BLOCK):
        self.items, self.weights, self.first, self.terms, self.values = items, weights, first, terms, values
        self.n, wide = len(first) - 1, len(weights)
        doc = np.repeat(np.arange(self.n), np.diff(first))
        by_term = np.argsort(terms, kind="stable")
        lists, begin = doc[by_term], np.searchsorted(terms[by_term], np.arange(wide + 1))
        place = self._projected()
        #: For each term: the documents, block by block, where blocks begin, the summary's terms and the summary.
        self.lists: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for t in np.flatnonzero((np.diff(begin) > 0) & (weights > 0)).tolist():
            docs = lists[begin[t] : begin[t + 1]]
            starts = np.zeros(1, np.int64)
            if len(docs) > block:
                # Centres from all over the list; each document goes to the one most like it.
                near = (place[docs] @ place[docs[:: block]].T).argmax(axis=1)
                order = np.argsort(near, kind="stable")
                docs, near = docs[order], near[order]
                starts = np.flatnonzero(np.concatenate(([True], near[1:] != near[:-1])))
            beside = np.unique(np.concatenate([items.asks[q][0] for q in items.askers[t]]))
            self.lists[t] = (docs, starts, beside, self._summary(docs, starts, beside, wide))

    def _projected(self) -> np.ndarray:
        random = np.random.default_rng(17).choice(np.array([-1, 1], np.float32), (len(self.weights), DIMENSIONS))
        out = np.zeros((self.n, DIMENSIONS), np.float32)
        for a in range(0, self.n, 512):
            z = min(self.n, a + 512)
            here = slice(self.first[a], self.first[z])
            x = (self.values[here] * self.weights[self.terms[here]]).astype(np.float32)
            some = np.flatnonzero(np.diff(self.first[a : z + 1]))
            if len(some):
                out[a + some] = np.add.reduceat(random[self.terms[here]] * x[:, None], self.first[a + some] - self.first[a])
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def _summary(self, docs: np.ndarray, starts: np.ndarray, beside: np.ndarray, wide: int) -> np.ndarray:
        """The largest entry of each block's documents, for each of the terms beside."""
        column = np.full(wide, -1, np.int64)
        column[beside] = np.arange(len(beside))
        at, begins = _rows(self.first, docs)
        block = np.searchsorted(starts, np.arange(len(docs)), "right") - 1
        row = np.repeat(block, np.diff(np.append(begins, len(at))))
        to = column[self.terms[at]]
        keep = to >= 0
        out = np.zeros(len(starts) * len(beside), np.int64)
        np.maximum.at(out, row[keep] * len(beside) + to[keep], self.values[at[keep]])
        return out.reshape(len(starts), len(beside))

    def scores(self, q: int, docs: np.ndarray) -> np.ndarray:
        """Full scores of some documents."""
        terms, times = self.items.asks[q]
        ask = np.zeros(len(self.weights), np.int64)
        ask[terms] = times * self.weights[terms]
        at, begins = _rows(self.first, docs)
        return np.add.reduceat(ask[self.terms[at]] * self.values[at], begins) if len(docs) else np.zeros(0, np.int64)

    def best(self, q: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int, int]:
        """Documents that score ``floor`` or more and may be among the k best, their scores; blocks read, and all."""
        terms, times = self.items.asks[q]
        bounds, blocks = [], []
        for t in terms.tolist():
            if t in self.lists:
                docs, starts, beside, summary = self.lists[t]
                bounds.append(summary[:, np.searchsorted(beside, terms)] @ (times * self.weights[terms]))
                blocks += [docs[a:z] for a, z in zip(starts, np.append(starts[1:], len(docs)), strict=True)]
        bound = np.concatenate(bounds) if bounds else np.zeros(0, np.int64)
        order = np.argsort(-bound, kind="stable")
        seen = np.zeros(self.n, bool)
        docs, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        read = 0
        while read < len(order) and bound[order[read]] >= floor:
            some = order[read : read + AT_ONCE]
            some = some[bound[some] >= floor]
            read += len(some)
            new = np.unique(np.concatenate([blocks[b] for b in some]))
            new = new[~seen[new]]
            seen[new] = True
            docs, score = np.concatenate((docs, new)), np.concatenate((score, self.scores(q, new)))
            keep = score >= floor
            docs, score = docs[keep], score[keep]
            if len(score) >= k:
                floor = max(floor, int(np.partition(score, len(score) - k)[len(score) - k]))
                keep = score >= floor
                docs, score = docs[keep], score[keep]
        return docs, score, read, len(order)


def _search(found: DataFrame, items: Items, corpus: Corpus, floors: Sequence[int], k: int) -> DataFrame:
    """q, doc_id, score: for each task the k best rows of every item, of at least the item's floor."""
    sent = found.sparkSession.sparkContext.broadcast((items, corpus, list(floors)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, corpus, floors = sent.value
        best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [
            (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in items.asks
        ]

        def work(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            ids = table.column(0).combine_chunks()
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            lists = table.column(2).combine_chunks()
            first = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy()))).astype(np.int64)
            terms = lists.flatten().to_numpy().astype(np.int64)
            tfs = table.column(3).combine_chunks().flatten().to_numpy().astype(np.int64)
            values = corpus.entries(tfs, np.repeat(table.column(1).to_numpy(), np.diff(first)))
            shard = Shard(items, corpus.weights, first, terms, values)
            for q in range(len(items.asks)):
                docs, score, _, _ = shard.best(q, k, floors[q])
                if not len(docs):
                    continue
                a, b, c = (np.concatenate(x) for x in zip(best[q], (score, missing[docs], ids[docs]), strict=True))
                top = np.lexsort((c, b, -a))[:k]
                best[q] = (a[top], b[top], c[top])
                if len(top) == k:
                    floors[q] = max(floors[q], int(a[top[-1]]))

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            start = 0
            upto = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy())
            while start < batch.num_rows:
                before = int(upto[start - 1]) if start else 0
                end = max(start + 1, int(np.searchsorted(upto, before + POSTINGS - size, "right")))
                held.append(batch.slice(start, end - start))
                size += int(upto[end - 1]) - before
                start = end
                if size >= POSTINGS or start < batch.num_rows:
                    work(held)
                    held, size = [], 0
        if held:
            work(held)
        for q, (score, missing, ids) in enumerate(best):
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), q), pa.int32()), pa.array(ids, pa.int64(), mask=missing), pa.array(score, pa.int64())],
                    ["q", "doc_id", "score"],
                )

    # Documents without any asked term can't score.
    return found.where(F.size("terms") > 0).mapInArrow(run, "q int, doc_id long, score long")


def _first(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    item_terms: int = ITEM_TERMS,
) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents for every item."""
    spark: SparkSession = docs.sparkSession
    common.ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for ids, block in item_blocks(items, item_id_col, item_text_col, item_terms):
        if not block.terms:
            continue
        found = common.stage(vectors(rows, block.terms), "vectors")
        corpus = Corpus.of(found, len(block.terms))
        nth = max(1, corpus.n_docs // SAMPLE)
        some = found.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(nth)) == 0)
        worst = _first(_search(some, block, corpus, [1] * len(ids), k), k).where(F.col("rank") == k)
        floors = {r.q: r.score for r in worst.collect()}
        best = _first(_search(found, block, corpus, [floors.get(q, 1) for q in range(len(ids))], k), k)
        names = spark.createDataFrame(list(enumerate(ids)), "q int, item_id long")
        ranked = best.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score")
        out = out.unionByName(common.stage(ranked, "ranked"))
    return out


def op13_lexical_search(spark, sf_dir):
    """The twenty best documents for every benchmark item."""
    return search(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


_UPPER, _LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SQL_TERMS = (
    f"regexp_extract_all(translate(text, '{_UPPER}', '{_LETTERS}'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

ORACLE_SQL = f"""
WITH counted AS (
  SELECT doc_id, terms, len(terms) AS n FROM (SELECT doc_id, {_SQL_TERMS} AS terms FROM documents WHERE text IS NOT NULL)
), totals AS (
  SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM counted WHERE n > 0
), postings AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM counted) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings CROSS JOIN totals GROUP BY term
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_SQL_TERMS}) AS term FROM benchmark) GROUP BY ALL
), scored AS (
  SELECT a.item_id, p.doc_id,
    CAST(sum(a.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * p.n * t.docs) // t.words)))) AS BIGINT) AS score
  FROM asked a JOIN postings p USING (term) JOIN weights w USING (term) CROSS JOIN totals t
  GROUP BY a.item_id, p.doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {K}
"""
