import math
import re
from collections import Counter

import numpy as np
import pytest

from ebbtide.llm import common, lexical_search as ls

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").encode().lower())


def brute(docs, items, k=20):
    """(item, rank, doc_id, score); rows are documents and items of their own."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(1 for _, b in bags if b)
    total = sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, bag in bags:
            m = 75 + 25 * bag.total() * n_docs // max(1, total)
            s = 0
            for t, times in Counter(terms(text)).items():
                if t in bag:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += times * w * (10**9 * bag[t] // (1000 * bag[t] + 12 * m))
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_tables(spark, sf_dir):
    docs = [tuple(r) for r in common.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in common.table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    assert found(ls.op13_lexical_search(spark, sf_dir)) == brute(docs, items)


def planted(n=300, seed=5):
    draw = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(400)]
    # Topics: a document takes most of its words from one of ten ranges.
    docs = [(i, " ".join(vocab[int(x)] for x in (draw.integers(0, 40, 30) + 40 * (i % 10)) % 400)) for i in range(n)]
    items = [(j, " ".join(docs[j * 7][1].split()[:12])) for j in range(20)]
    return docs, items


@pytest.mark.parametrize(("postings", "block", "item_terms"), [(200, 4, 1 << 13), (1 << 19, 16, 60), (1000, 2, 1)])
def test_shards_blocks_and_item_blocks_of_any_size(spark, monkeypatch, postings, block, item_terms):
    monkeypatch.setattr(ls, "POSTINGS", postings)
    monkeypatch.setattr(ls.Shard.__init__, "__defaults__", (block,))
    monkeypatch.setattr(ls, "SAMPLE", 50)
    docs, items = planted()
    got = ls.search(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), k=5, item_terms=item_terms)
    assert found(got) == brute(docs, items, 5)


def shard_of(docs, items, block):
    asked = ls.Items([Counter(terms(t)) for _, t in items])
    number = {t: i for i, t in enumerate(asked.terms)}
    bags = [Counter(terms(t)) for _, t in docs]
    df = Counter(number[t] for b in bags for t in b if t in number)
    corpus = ls.Corpus(sum(1 for b in bags if b), sum(b.total() for b in bags), df, len(number))
    rows = [sorted((number[t], c) for t, c in b.items() if t in number) for b in bags]
    first = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    tf = np.array([c for r in rows for _, c in r])
    values = corpus.entries(tf, np.repeat([b.total() for b in bags], np.diff(first)))
    return ls.Shard(asked, corpus.weights, first, np.array([t for r in rows for t, _ in r]), values, block)


def test_summaries_bound_their_blocks_and_most_blocks_are_skipped(monkeypatch):
    monkeypatch.setattr(ls, "AT_ONCE", 1)
    docs, items = planted()
    shard = shard_of(docs, items, 4)
    read = total = 0
    for q in range(len(items)):
        terms_, times = shard.items.asks[q]
        everything = shard.scores(q, np.arange(shard.n))
        for t in terms_.tolist():
            members, starts, beside, summary = shard.lists[t]
            bound = summary[:, np.searchsorted(beside, terms_)] @ (times * shard.weights[terms_])
            block = np.searchsorted(starts, np.arange(len(members)), "right") - 1
            assert (everything[members] <= bound[block]).all()
        got, score, seen, blocks = shard.best(q, 1, 1)
        read, total = read + seen, total + blocks
        assert max(score) == max(everything)
        assert (score == everything[got]).all()
    assert read < total / 2


def test_blocks_hold_like_documents():
    """Documents of one topic share blocks: the blocks of a word of all topics are purer than chance."""
    docs, items = planted()
    docs = [(i, t + " common") for i, t in docs]
    shard = shard_of(docs + [(1000 + i, f"x{i}") for i in range(200)], [(0, " ".join(t for _, t in docs[:10]))], 16)
    members, starts, _, _ = shard.lists[shard.items.terms.index(b"common")]
    parts = np.split(members, starts[1:])
    pure = np.mean([np.bincount(p % 10).max() / len(p) for p in parts])
    assert len(parts) > 5 and pure > 0.5


def test_pieces_cut_between_terms():
    texts = ["Ab-cD", "", "é9 x", "y" * 300, "", "z.z", "end"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    at = np.cumsum([0, *[len(t.encode()) for t in texts]])
    want = [(w, i) for i, t in enumerate(texts) for w in terms(t)]
    for limit in (1, 2, 3, 7, 50, 1000):
        got = [(w, int(i)) for words, text in ls.split_terms(data, at, limit) for w, i in zip(words.to_pylist(), text)]
        assert got == want


def test_ties_nulls_repeats_long_texts_and_clashing_columns(spark):
    docs = [(i, "alpha beta" if i % 2 else f"gamma delta{i}") for i in range(60)]
    docs += [(7, "alpha beta")] * 3 + [(None, "alpha beta"), (None, None), (90, None), (91, ""), (92, "--- ..."), (93, "alpha " * 300_000 + "omega")]
    items = [(1, "Alpha, BETA alpha"), (1, "gamma"), (2, None), (3, "..."), (None, "omega"), (4, "nowhere")]
    extra = ", q int, rank int, score long, n long, terms string"
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, "t") for r in docs], DOCS + extra)
    got = ls.search(df, spark.createDataFrame([(*r, 1, 2, 3, 4, "t") for r in items], ITEMS + extra))
    assert found(got) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([(1, "a")], ITEMS)
    assert ls.search(docs.limit(0), items).count() == 0
    assert ls.search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert ls.search(docs, items.limit(0)).count() == 0
