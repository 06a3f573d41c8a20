import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import common, piece_dropout as pd

sentencepiece = pytest.importorskip("sentencepiece")

ODD = ["", " ", "  a  b", "a" * 500, "x\n\ty <s> \x00é\U0001d518 字漢", "▁▁ a▁b", "  " * 40, "é" * 70, "ab" * 40_000, "<0x41> </s>"]


@pytest.fixture(scope="module")
def vocabulary():
    return pd.vocabulary(pd.MODEL)


def pieces(v, texts, dropout, seed=1):
    ids, at = pd.encode_texts(v, texts, [pd.document_key(i, seed) for i in range(len(texts))], dropout)
    return ids, at, [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


def test_without_dropout_it_is_the_model(spark, sf_dir, vocabulary):
    texts = [r[0] for r in common.table(spark, sf_dir, "documents").select("text").collect()] + ODD
    model = sentencepiece.SentencePieceProcessor(model_file=pd.MODEL)
    for text, got in zip(texts, pieces(vocabulary, texts, 0.0)[2], strict=True):
        if "▁" not in text:
            assert got == model.encode(text)


def by_hand(v, text, key, dropout):
    """The agenda over a whole text, one merge after the other."""
    limit = int(dropout * 2**64)
    s = [(0 if i == 0 else i, v.char[pd.MARK if c == " " or i == 0 else ord(c)] if not (c == "▁" and i) else -1) for i, c in enumerate("▁" + text)]
    s = [(p, int(x)) for p, x in s]
    while True:
        best = None
        for i in range(len(s) - 1):
            piece = v.pairs.get(s[i][1] << 20 | s[i + 1][1]) if s[i][1] >= 0 and s[i + 1][1] >= 0 else None
            if piece is None:
                continue
            if limit and pd._skipped(np.array([key], np.uint64), np.array([s[i][0]]), np.array([piece]), np.uint64(limit))[0]:
                continue
            if best is None or v.rank[piece] < best[0]:
                best = (v.rank[piece], i, piece)
        if best is None:
            break
        _, i, piece = best
        s[i : i + 2] = [(s[i][0], piece)]
    out = []
    for p, x in s:
        out += [x] if x >= 0 else [int(v.byte[b]) for b in text[p - 1].encode()]
    return out


def test_dropout_follows_the_keyed_agenda(vocabulary):
    texts = ["The engine reads  whole texts,\nnever parts of them.", "übergroße Wörter und naïve façades", "a" * 90 + " end"]
    for dropout in (0.1, 0.5):
        got = pieces(vocabulary, texts, dropout)[2]
        want = [by_hand(vocabulary, t, pd.document_key(i, 1) & (2**64 - 1), dropout) for i, t in enumerate(texts)]
        assert got == want


def test_round_trip_seeds_and_variety(vocabulary):
    texts = ODD + ["reproducible segmentation of ordinary sentences " * 20] * 2
    ids, at, first = pieces(vocabulary, texts, 0.2)
    assert [b.decode() for b in pd.decode_ids(vocabulary, ids, at)] == texts
    assert pieces(vocabulary, texts, 0.2)[2] == first
    assert pieces(vocabulary, texts, 0.2, seed=2)[2] != first
    assert first[-1] != first[-2] and len(first[-1]) > len(pieces(vocabulary, texts, 0.0)[2][-1])


def test_query_is_lossless_and_whole(spark, sf_dir):
    rows = pd.op5_piece_dropout(spark, sf_dir)
    assert rows.where("lossless").count() == rows.count() == common.table(spark, sf_dir, "documents").count()


def test_nulls_repeats_clashes_and_no_rows(spark):
    schema = "doc_id long, text string, pieces string"
    df = spark.createDataFrame([(1, None, "x"), (None, "a b", "y"), (2, "", "z"), (2, "", "z")], schema)
    out = pd.encode(df)
    back = pd.decode(out).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["text"]) for r in back] == [(None, "a b"), (1, None), (2, ""), (2, "")]
    assert out.where(F.col("pieces").isNull()).count() == 1
    assert pd.encode(spark.createDataFrame([], schema)).count() == 0
