import numpy as np

from ebbtide.llm import bit_sliced as bs, common

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, ask, k=10, scale=1024):
    fine = [(i, [int(np.floor(float(np.float32(x)) * scale)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, v in fine:
        if not ask(q):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fine if i != q)[:k]
        out |= {(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)}
    return out


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding").collect()]
    got = {tuple(r) for r in bs.op6_bit_sliced_top_k(spark, sf_dir).select("query_id", "rank", "vec_id", "score").collect()}
    assert got == brute(rows, lambda i: i % 100 == 0)


def test_blocks_ties_signs_and_bad_rows(spark, monkeypatch):
    monkeypatch.setattr(bs, "ROW_BLOCK", 40)
    monkeypatch.setattr(bs, "QUERY_BLOCK", 3)
    draw = np.random.default_rng(8)
    rows = [(i, draw.integers(-3, 4, 5).astype(float).tolist()) for i in range(150)]
    rows += [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0]), (202, [float("nan")] * 5), (203, [float("inf")] * 5), (None, [1.0] * 5)]
    rows += [(300, [0.0] * 5), (310, [2.0]), (320, []), (321, [2.0**20, -(2.0**20), 1.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", rank int, id int")
    got = {tuple(r) for r in bs.top_k(df, df.where("vec_id % 10 = 0")).collect()}
    want = brute([(i, (v + [0.0] * 5)[:5] if v is not None and len(v) < 5 else v) for i, v in rows], lambda i: i % 10 == 0)
    assert got == want


def test_few_rows_repeats_and_none(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (0, [1.0, 1.0])], SCHEMA)
    got = sorted(tuple(r)[1:] for r in bs.top_k(df, df.where("vec_id = 0")).collect())
    assert got == [(1, 1, 3 * 1024 * 1024), (2, 2, 1024 * 1024), (3, 2, 1024 * 1024)]
    assert bs.top_k(df.limit(0), df.limit(0)).count() == 0


def test_no_row_holds_a_block_of_vectors(spark, monkeypatch):
    """Index blocks travel as bitmaps and queries one by one; rows of one id are parted too."""
    monkeypatch.setattr(bs, "ROW_BLOCK", 40)
    monkeypatch.setattr(bs, "QUERY_BLOCK", 3)
    draw = np.random.default_rng(9)
    rows = [(i if i < 60 else 7, draw.integers(-3, 4, 5).astype(float).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = bs.top_k(df, df.where("vec_id % 10 = 0"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Join" not in plan
    assert {tuple(r) for r in found.collect()} == brute(rows, lambda i: i % 10 == 0)


def test_blocks_without_rows_answer_nothing(spark, monkeypatch):
    monkeypatch.setattr(bs, "ROW_BLOCK", 1)
    rows = [(i, [float(i), 1.0]) for i in range(0, 130, 10)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert {tuple(r) for r in bs.top_k(df, df.where("vec_id % 20 = 0"), k=3).collect()} == brute(rows, lambda i: i % 20 == 0, 3)


def test_a_block_is_the_same_after_its_bytes():
    draw = np.random.default_rng(10)
    block = bs.Slices(draw.integers(0, 90, 200), draw.integers(-5000, 5000, (200, 6)) * [1, 1, 0, 3, 1, 1])
    again = bs.Slices.from_bytes(block.to_bytes())
    for q in draw.integers(-50, 50, (5, 6)):
        for a, b in zip(block.best(q, 4, 9), again.best(q, 4, 9)):
            assert (a == b).all()


def test_copies_of_a_block_follow_cores_and_queries():
    assert bs._spread(1, 500, 12) == 4
    assert bs._spread(11, 7200, 12) == 4
    assert bs._spread(1500, 10**6, 12) == 62
    assert bs._spread(1, 0, 12) == 1
