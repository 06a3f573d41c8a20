import hashlib
import re

import pytest

from ebbtide.llm import common, imatch as im

SCHEMA = "doc_id long, text string"


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def terms(text):
    return set(re.split(im.APART, text.lower())) - {""}


def brute(rows, common_share=im.COMMON, rare_share=im.RARE):
    """The result rows by doc_id; ids are distinct."""
    docs = [(i, t or "") for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    df = {}
    for _, text in docs:
        for t in terms(text):
            df[t] = df.get(t, 0) + 1
    n = len(docs)
    held = {t: int(md5(t)[:15], 16) for t, c in df.items() if c * common_share <= n <= c * rare_share}

    def subsets(text):
        h = sorted(held[t] for t in terms(text) if t in held)
        out = []
        for k in range(im.CHAINS):
            for level in range(im.LEVELS):
                some = [x for x in h if x % 16 == k and (x >> 4) % (1 << level) == 0]
                out.append(md5(",".join(map(str, some)))[:6] if some else None)
        return out

    def as_text(text):
        d = subsets(text)
        return ".".join(x or "" for x in d) if any(d) else "=" + md5(text)

    def near(a, b):
        pairs = [(x, y) for x, y in zip(subsets(a), subsets(b)) if x or y]
        return sum(x == y for x, y in pairs) / len(pairs) if pairs else float(a == b)

    out = {}
    for at, (i, text) in enumerate(docs):
        after = docs[(at + 1) % n][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out[i] = (i, len(text), hashlib.sha256(edited.encode()).hexdigest(), as_text(text), as_text(edited), near(text, edited), near(text, after))
    return out


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in common.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = {r["doc_id"]: tuple(r) for r in im.op12_imatch(spark, sf_dir).collect()}
    want = brute(rows)
    assert got == want
    assert sum(r[5] for r in want.values()) > 2 * sum(r[6] for r in want.values())


def test_equal_texts_and_few_changed_words(spark):
    """A changed word of many leaves most subsets alone; a copy leaves all."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[(i * 7 + j) % 400] for j in range(120))) for i in range(60)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, rows[3][1].replace(rows[3][1].split()[5], "other"))]
    got = {r["doc_id"]: r for r in im.fingerprints(spark.createDataFrame(rows, SCHEMA), common_share=2).collect()}
    assert got[100]["fingerprint"] == got[101]["fingerprint"] == got[3]["fingerprint"]
    assert got[100]["near_next"] == 1.0 and 0.0 < got[100]["near_edited"] < 1.0
    assert 0.8 < got[101]["near_next"] < 1.0
    # The next document holds 113 of the 120 words, the edited text not half.
    assert 1.0 > got[3]["near_next"] > got[3]["near_edited"] > 0.0


def test_no_python_on_the_main_path(spark, sf_dir):
    plan = im.op12_imatch(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    # The texts move once; grouping and neighbours use the same layout.
    assert plan.count("Exchange hashpartitioning") == 1


def test_a_lexicon_too_large_to_send_is_joined(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * j) % 31}" for j in range(1, 9))) for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, im.fingerprints(df).collect()))
    monkeypatch.setattr(im, "SENT", 0)
    assert sorted(map(tuple, im.fingerprints(df).collect())) == want


@pytest.mark.parametrize("n", [1, 2, 3])
def test_few_documents(spark, n):
    rows = [(i, f"Some text {i}") for i in range(n)]
    got = {r["doc_id"]: tuple(r) for r in im.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)


def test_nulls_long_texts_repeats_and_clashing_columns(spark):
    rows = [(i, None if i % 5 == 0 else "" if i % 5 == 1 else f"a{i % 7} b{i % 4} Ünï {i % 3} 😀" * (i % 3 + 1)) for i in range(40)]
    rows += [(50, "long " + " ".join(f"x{i % 977}" for i in range(300_000))), (None, "a1 b1"), (51, "😀é")]
    extra = "block int, at int, guest string, key string, term string, h string, about string, kind int"
    clash = spark.createDataFrame([(*r, 1, 2, "g", "k", "t", "h", "a", 3) for r in rows], SCHEMA + ", " + extra)
    got = {r["doc_id"]: tuple(r) for r in im.fingerprints(clash).collect()}
    assert got == brute(rows)
    again = spark.createDataFrame([(1, "same text here")] * 30 + [(1, "another"), (2, None)], SCHEMA)
    out = im.fingerprints(again).collect()
    assert len(out) == 32 and len({r["fingerprint"] for r in out}) == 3


def test_empty_table(spark):
    assert im.fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0
