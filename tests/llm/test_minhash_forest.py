import re

import pytest

from ebbtide.llm import minhash_forest as mf
from ebbtide.llm import common


def shingle_set(text):
    lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def brute(rows):
    """Components by comparing every pair of documents that share a shingle."""
    sets = {i: shingle_set(t) for i, t in rows}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    tried = set()
    for ids in holders.values():
        for a in ids:
            for b in ids:
                if a < b and (a, b) not in tried:
                    tried.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= 75 * len(sets[a] | sets[b]):
                        x, y = sorted((find(a), find(b)))
                        up[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def as_dict(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_whole_documents_against_every_pair(spark, sf_dir):
    rows = [(r[0], r[1]) for r in common.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert as_dict(mf.op2_minhash_forest(spark, sf_dir)) == brute(rows)


def test_threshold_and_edges(spark):
    base = [f"w{i}" for i in range(46)]
    near = base[:3] + ["other"] + base[4:]
    rows = [
        (9, " ".join(base)),
        (4, "  ".join(base).upper()),
        (5, " ".join(near)),
        (6, " ".join(base[:30] + ["x", "y", "z"] + base[33:])),
        (1, None),
        (2, ""),
        (3, " \n\t"),
        (10, "One two"),
        (11, "one  TWO"),
        (12, "two one"),
        (13, "ÀÉ à"),
        (14, "àé à"),
        (15, " ".join(f"long{i}" for i in range(40_000))),
        (16, " ".join(f"long{i}" for i in range(39_000))),
    ]
    df = spark.createDataFrame([(i, t, i, "x") for i, t in rows], "doc_id long, text string, comp long, root string")
    assert as_dict(mf.near_duplicates(df)) == brute(rows)


def test_repeated_rows_null_ids_and_no_rows(spark):
    schema = "doc_id long, text string"
    df = spark.createDataFrame([(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (1, "a b c d e f")], schema)
    assert as_dict(mf.near_duplicates(df)) == {1: (2, 1, True), 3: (2, 1, False)}
    assert mf.near_duplicates(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("crowd", [4, 4096])
def test_crowd_of_near_copies(spark, monkeypatch, crowd):
    monkeypatch.setattr(mf, "CROWD", crowd)
    import random

    draw = random.Random(5)
    base = [f"s{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for at in draw.sample(range(120), draw.choice((1, 2, 4, 6))):
            w[at] = f"n{draw.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got, want = as_dict(mf.near_duplicates(df)), brute(rows)
    assert got == want if crowd == 4096 else sum(got[i] != want[i] for i in want) <= 3


def test_no_pair_of_a_crowded_family_is_lost(spark, monkeypatch):
    # All documents share most of a template, few reach 75% with another, and those just so.
    monkeypatch.setattr(mf, "CROWD", 4)
    import random

    draw = random.Random(3)
    base = [f"s{i}" for i in range(109)]
    rows = []
    for i in range(300):
        places = draw.sample(range(10, 100, 6), 6)
        w = list(base)
        for k, at in enumerate(places):
            w[at] = f"n{i}x{k}"
            if k == 2:
                rows.append((2 * i, " ".join(w)))
        rows.append((2 * i + 1, " ".join(w)))
    want = brute(rows)
    assert 300 <= sum(not kept for _, _, kept in want.values()) < 450
    assert as_dict(mf.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == want
