import random
import re

import numpy as np
import pyarrow as pa

from ebbtide.llm import decontaminate as dc, words


def plain(text):
    return [w.lower() for w in re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", text or "")]


def distance(item, text):
    """Edit distance to the best stretch, row by row."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (w != x)))
        row = new
    return min(row)


def made(seed=11):
    draw = random.Random(seed)
    vocab = ["".join(draw.choice("abcdefgh") for _ in range(draw.randrange(1, 7))) for _ in range(3000)]
    common_words = ["the", "of", "and", "to"]
    word = lambda: draw.choice(common_words) if draw.random() < 0.4 else draw.choice(vocab)
    items = [[word() for _ in range(draw.randrange(12, 70))] for _ in range(40)]
    docs = []
    for i in range(200):
        body = [word() for _ in range(draw.randrange(0, 400))]
        if i % 2:
            leak = list(draw.choice(items))
            for _ in range(int(draw.choice((0, 0.05, 0.1, 0.2, 0.35)) * len(leak))):
                at = draw.randrange(len(leak))
                kind = draw.randrange(3)
                if kind == 0:
                    leak[at] = word()
                elif kind == 1:
                    leak.insert(at, word())
                else:
                    del leak[at]
            at = draw.randrange(len(body) + 1)
            body[at:at] = leak
        docs.append((i, draw.choice((" ", ", ", "\n")).join(body).title()))
    return docs, [(k, " ".join(x)) for k, x in enumerate(items)]


def test_recall_and_exactness_against_every_pair(spark):
    docs, items = made()
    want = {}
    for i, t in docs:
        for k, x in items:
            item = plain(x)
            d = distance(item, plain(t))
            if d <= dc.RATE * len(item):
                want[i, k] = d
    d = spark.createDataFrame([(*r, 0) for r in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, doc_id int")
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in dc.matches(d, b).collect()}
    assert set(got) <= set(want)
    assert all(got[p] == want[p] for p in got)
    assert len(got) >= 0.97 * len(want) > 50


def test_place_of_a_match():
    draw = random.Random(2)
    for _ in range(200):
        item = np.array([draw.randrange(6) for _ in range(draw.randrange(1, 12))], np.uint64)
        text = np.array([draw.randrange(6) for _ in range(draw.randrange(1, 40))], np.uint64)
        d, s, e = dc.fitted(item, text)
        assert d == distance(item.tolist(), text.tolist())
        row = list(range(e - s + 1))
        for i, w in enumerate(item.tolist(), 1):
            new = [i]
            for j, x in enumerate(text[s:e].tolist(), 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (w != x)))
            row = new
        assert row[-1] == d


def test_nulls_ties_long_and_empty(spark, monkeypatch):
    item = " ".join(f"q{i}" for i in range(20))
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    docs = [(1, None), (2, ""), (3, item.upper()), (3, item.upper()), (None, item), (5, f"{long} {item} {long} {item}"), (6, "q1 q2 q3"), (7, long)]
    items = [(10, item), (11, item), (12, None), (13, "two words"), (None, item)]
    monkeypatch.setattr(dc, "ITEM_BLOCK", 15)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r["doc_id"] or 0, r["item_id"], r["distance"]) for r in dc.matches(d, b).collect())
    assert got == [(i, k, 0) for i in (0, 3, 3, 5, 5) for k in (10, 11)] or got == sorted((i, k, 0) for i in (0, 3, 3, 5, 5) for k in (10, 11))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert dc.matches(empty, b).count() == 0
    assert dc.matches(d, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_walk_brings_near_strings_together():
    draw = np.random.default_rng(4)
    base = draw.integers(1, 2**63, (200, 40), dtype=np.uint64)
    near = base.copy()
    near[:, 10:-1] = base[:, 11:]  # one word left out
    near[:, 25] = 5  # and one replaced
    far = draw.integers(1, 2**63, (200, 40), dtype=np.uint64)
    same = (dc.keys(base) == dc.keys(near)).any(axis=1).mean()
    assert same > 0.95
    assert (dc.keys(base) == dc.keys(far)).mean() < 0.001


def test_words_without_punctuation():
    data = np.frombuffer("Ab,c-dé\t«x» 9".encode(), np.uint8)
    h, start, end, first = words.words(data, np.array([0, len(data)]), words.NOT_LETTERS)
    assert [data[a:b].tobytes().decode() for a, b in zip(start, end)] == ["Ab", "c", "dé", "«x»", "9"]
    assert pa.array([1]).null_count == 0 and len(h) == 5


def test_no_leak_at_the_full_rate_is_missed(spark):
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    items = [(k, [word() for _ in range(n)]) for k, n in enumerate((40, 60, 80, 120, 160, 200) * 6)]
    docs, want = [], {}
    for k, x in items:
        for share in (0.15, 0.2, 0.25):
            leak = list(x)
            for at in sorted(draw.sample(range(len(x)), int(share * len(x))), reverse=True):
                kind = draw.randrange(3)
                if kind == 0:
                    leak[at] = word()
                elif kind == 1:
                    leak.insert(at, word())
                else:
                    del leak[at]
            # A whole copy beside it is the stronger place.
            beside = x if share == 0.2 else [word() for _ in range(30)]
            docs.append((len(docs), [word() for _ in range(30)] + beside + leak + [word() for _ in range(30)]))
            want[len(docs) - 1, k] = 2 if share == 0.2 else 1
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    b = spark.createDataFrame([(k, " ".join(x)) for k, x in items], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["count"] for r in dc.matches(d, b).groupBy("doc_id", "item_id").count().collect()}
    assert got == want
