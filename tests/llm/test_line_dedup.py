import re

import pytest

from ebbtide.llm import common, line_dedup as ld

SCHEMA = "doc_id long, text string"
A = "one two three four five six seven eight nine"
B = "alpha beta gamma delta epsilon zeta eta theta."


def brute(rows, min_words=1, long_words=50):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        if text is None:
            out[i] = (None, [])
            continue
        kept, gone, at = [], [], 0
        lines = text.split("\n")
        for n, line in enumerate(lines):
            parts = re.split(r"(?<=[.!?]) ", line) if len(line.split()) > long_words else [line]
            for m, part in enumerate(parts):
                sep = " " if m + 1 < len(parts) else "\n" if n + 1 < len(lines) else ""
                body = b" ".join(part.encode().lower().split())
                if len(body.split()) >= min_words and body in seen:
                    gone.append((at, at + len(part)))
                else:
                    seen.add(body)
                    kept.append(part + sep)
                at += len(part) + len(sep)
        out[i] = ("".join(kept), gone)
    return out


def as_dict(df):
    return {r["doc_id"]: (r["text"], [tuple(s) for s in r["removed"]]) for r in df.collect()}


def test_whole_documents(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    assert as_dict(ld.dedup(docs)) == brute([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("text", [f"{A}\n{B}", f"{B}\n\n{A}\n", f" {A.upper()} \t\n x", "", "\n", f"{A}  \n{A}", f"é{A}\n{B} {A}. " * 9])
def test_against_one_earlier_document(spark, text):
    rows = [(1, f"{A}\n{B}\nshort line"), (2, text)]
    df = spark.createDataFrame([(*r, "d", 0) for r in rows], SCHEMA + ", digest string, start int")
    assert as_dict(ld.dedup(df)) == brute(rows)


def test_short_units_go_unless_asked_to_stay(spark):
    """A repeated line of one word is a repeated line; white space alone is none."""
    rows = [(1, f"Menu\n\n{A}\n  \nEnd."), (2, f"menu\n\n{B}\n  \nEND.\nend."), (3, f"x\nMenu {A}\nmenu")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = as_dict(ld.dedup(df))
    assert got == brute(rows)
    assert got[2] == (f"\n{B}\n  \n", [(0, 4), (len(B) + 10, len(B) + 14), (len(B) + 15, len(B) + 19)])
    assert as_dict(ld.dedup(df, min_words=8)) == brute(rows, 8)


def test_paragraphs_nulls_repeats_and_no_rows(spark):
    rows = [(2, f"{A}\n{A}\n \n{B}"), (1, B), (None, f"{A}\n{A}"), (3, None)]
    got = as_dict(ld.dedup(spark.createDataFrame(rows, SCHEMA), unit="paragraph"))
    assert got == {1: (B, []), 2: (f"{A}\n{A}\n \n", [(len(A) * 2 + 4, len(A) * 2 + 4 + len(B))]), None: ("", [(0, 2 * len(A) + 1)]), 3: (None, [])}
    twice = spark.createDataFrame([(1, A), (1, A)], SCHEMA)
    assert [r["text"] for r in ld.dedup(twice).collect()] == [A, A]
    assert ld.dedup(twice.limit(0)).count() == 0
