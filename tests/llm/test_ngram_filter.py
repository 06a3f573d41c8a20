import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import common, ngram_filter as nf


def tokens(text):
    lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def brute(rows, held):
    count = Counter()
    for i, t in rows:
        if not held(i):
            count.update(tokens(t))
    n, v = sum(count.values()), len(count)
    out = {}
    for i, t in rows:
        w = tokens(t)
        base = sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        out[i] = (held(i), len(w), sum(count[x] > 0 for x in w), n, base)
    return out


def check(got, want):
    assert {r["doc_id"]: (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got} == {i: w[:4] for i, w in want.items()}
    for r in got:
        assert r["base_score"] == pytest.approx(want[r["doc_id"]][4], rel=1e-9)
        assert r["score"] < 0


def test_whole_documents(spark, sf_dir):
    rows = [tuple(r) for r in common.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = nf.op10_ngram_filter(spark, sf_dir).collect()
    check(got, brute(rows, lambda i: zlib.crc32(str(i).encode()) % 10 == 0))
    unseen = [r for r in got if r["held_out"]]
    # Seen pairs help: the model beats single words on texts it has learned and on held-out ones.
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    assert sum(r["score"] for r in unseen) / sum(r["n_tokens"] for r in unseen) > -10


def test_rare_words_go_through_the_join(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(nf, "COMMON", 8)
    rows = [(i, f"the The cat{i % 3} sat{i}" if i else None) for i in range(40)] + [(40, ""), (41, "x " * 30_000)]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id long, text string, key long, known long")
    check(nf.score(df, F.col("doc_id") % 7 == 0).collect(), brute(rows, lambda i: i % 7 == 0))


def test_repeated_rows_nulls_and_nothing_learned(spark):
    schema = "doc_id long, text string"
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], schema)
    got = sorted(nf.score(df, F.lit(True)).collect(), key=str)
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got] == [(3, 0, 0), (3, 0, 0), (1, 0, 0)]
    assert nf.score(spark.createDataFrame([], schema), F.lit(False)).count() == 0


def test_levels_and_probes():
    h = common.mix(np.arange(5000, dtype=np.uint64))
    c = np.random.default_rng(1).integers(1, 2000, 5000)
    room = int(nf.levels(c).sum()) * nf.BITS_PER_KEY // 64 * 64
    f = nf.Filter(1, (room, 0), {(0, 0): nf.Filter.segment(h, c, room)})
    got = f.count(nf.WORD, h)
    assert (got >= c / nf.BASE / 1.3).all()
    assert np.mean((got / c < 1.6) & (got / c > 0.6)) > 0.9
    assert np.mean(f.count(nf.WORD, common.mix(h + np.uint64(10**6))) == 0) > 0.93
    packed = nf._unpack(nf._pack(np.sort(h), c))
    assert (packed[0] == np.sort(h)).all() and (packed[1] == c).all()


def test_the_filter_grows_with_its_keys(spark):
    # 27.6 million keys, more than 2**28 bits hold at BITS_PER_KEY.
    h = np.sort(common.mix(np.arange(400_000, dtype=np.uint64)))
    f = nf.Filter.of(nf.PAIR, h, np.full(len(h), 2**40))
    assert f.rooms[nf.PAIR] >= nf.BITS_PER_KEY * len(h) * nf.levels(np.array([2**40]))[0] > 1 << 28
    assert np.mean(f.level(nf.PAIR, common.mix(h + np.uint64(3))) == 0) > 0.93
    rows = [(k, i, " ".join(f"w{j % 97}" for j in range(i, 2 * i)), i % 5 == 0) for k, i in enumerate(range(1, 200))]
    df = spark.createDataFrame(rows, "key long, doc_id long, text string, held_out boolean")
    got = nf.answered(nf.asked(nf.packed(df), 3), 3).where("grp is null").collect()
    want = Counter(w for _, _, t, held in rows if not held for w in tokens(t))
    assert sum(r["n"] for r in got if r["kind"] == nf.WORD) == sum(want.values())
    keys = int(nf.levels(np.array(list(want.values()))).sum()) * nf.BITS_PER_KEY
    assert keys <= sum(r["bits"] for r in got if r["kind"] == nf.WORD) <= keys + 3 * 64


def test_pairs_seen_once_count(spark):
    draw = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{k}" for k in draw.integers(0, 300, 200))) for i in range(40)]
    one, two = Counter(), Counter()
    for i, t in rows:
        if i % 10:
            w = tokens(t)
            one.update(w)
            two.update(zip([None, *w], w))
    assert np.mean([c == 1 for c in two.values()]) > 0.9
    about = lambda c: float(nf.middle(nf.levels(np.array([c])))[0]) if c else 0.0
    n, v = sum(one.values()), len(one)
    got = nf.score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") % 10 == 0).collect()
    for r in got:
        w = tokens(rows[r["doc_id"]][1])
        want = 0.0
        for a, b in zip([None, *w], w):
            p = (about(one[b]) + nf.ADD) / (n + nf.ADD * (v + 1))
            want += math.log10((min(about(two[a, b]), about(one[a])) + nf.MU * p) / (about(one[a]) + nf.MU))
        # A probe in thirty hits where it should miss.
        assert r["score"] == pytest.approx(want, rel=0.06)


def test_words_in_pieces_are_the_words_of_the_whole(monkeypatch):
    """Cut at spaces and where texts begin; a word longer than a piece stays whole."""
    import numpy as np

    from ebbtide.llm import words

    draw = np.random.default_rng(2)
    texts = ["", "One two", "x" * 90, " a  b\n", "ünï cödé", ""] + ["".join(draw.choice(list("ab \n"), 40)) for _ in range(30)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    at = np.cumsum([0, *[len(t.encode()) for t in texts]])
    whole = words.words(data, at)
    assert len(whole[0]) == sum(len(t.encode().split()) for t in texts)
    for chunk in (1, 3, 16, 64):
        monkeypatch.setattr(words, "CHUNK", chunk)
        words._powers.clear()
        for got, want in zip(words.words(data, at), whole, strict=True):
            assert (got == want).all()
    words._powers.clear()
    none = words.words(data[:0], at[:1])
    assert [len(x) for x in none] == [0, 0, 0, 1]
