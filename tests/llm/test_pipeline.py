import random

import sentencepiece

import corpus_pipeline as cp
from ebbtide.llm import common, piece_dropout as pd

from . import test_decontaminate as leaks, test_minhash_forest as near, test_suffix_dedup as suffix

COLUMNS = list(cp.COLUMNS)


def cut_by_hand(rows, width=100):
    """Text left over when every window seen earlier goes, but no part of a character."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        b = text.encode()
        gone = [False] * len(b)
        for p in range(len(b) - width + 1):
            w = b[p : p + width]
            if w in seen:
                gone[p : p + width] = [True] * width
            seen.add(w)
        kept, at = [], 0
        for c in text:
            n = len(c.encode())
            if not all(gone[at : at + n]):
                kept.append(c)
            at += n
        out[i] = "".join(kept)
    return out


def fixture(spark):
    draw = random.Random(9)
    vocab = ["".join(draw.choice("abcdeéfgh") for _ in range(draw.randrange(2, 8))) for _ in range(900)]
    body = lambda n: " ".join(draw.choice(vocab) for _ in range(n))
    items = [body(25) for _ in range(5)]
    rows = [(i, body(draw.randrange(1, 150))) for i in range(60)]
    rows += [(100 + i, rows[i][1].replace(" ", "  ")) for i in range(8)]
    rows += [(120 + i, f"{body(80)} {items[i % 5]} {body(20)}") for i in range(6)]
    rows += [(140 + i, f"{body(90)} {rows[i][1]} {body(60)}") for i in range(10)]
    rows += [(160, None), (161, ""), (162, "12 34 |")]
    docs = spark.createDataFrame([(i, t, "en" if i % 3 else None, "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return docs, items


def test_stages_against_brute_force(spark, tmp_path):
    docs, items = fixture(spark)
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    now, tables = docs, []
    for name, stage in cp.STAGES:
        now = common.stage(stage(spark, now, str(tmp_path)), name)
        tables.append({r["doc_id"]: r for r in now.collect()})
    told, unique, cut, clean, coded = tables
    source = {r["doc_id"]: r for r in docs.collect()}
    assert set(told) == set(source) - {160, 161, 162} and all(r["lang"] == "en" for r in told.values())
    kept = near.brute([(i, r["text"]) for i, r in told.items()])
    assert set(unique) == {i for i, v in kept.items() if v[2]} and len(unique) < len(told)
    want = cut_by_hand([(i, r["text"]) for i, r in unique.items()])
    assert {i: r["text"] for i, r in cut.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in cut.values())
    assert sum(len(t) for t in want.values()) < sum(len(r["text"]) for r in unique.values())
    leaked = {i for i, t in want.items() for x in items if leaks.distance(leaks.plain(x), leaks.plain(t)) <= 0.25 * len(leaks.plain(x))}
    assert set(clean) == set(cut) - leaked and leaked
    v = pd.vocabulary(pd.MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=pd.MODEL)
    assert set(coded) == set(clean)
    for i, r in coded.items():
        keyed = pd.encode_texts(v, [r["text"]], [pd.document_key(i, pd.SEED)], pd.DROPOUT)[0].tolist()
        assert r["pieces"] == keyed and model.decode(r["pieces"]) == r["text"]
    assert [list(now.columns)] == [COLUMNS + ["pieces"]]
    assert cp.run(spark, str(tmp_path)).count() == len(coded)


def test_no_documents(spark, tmp_path):
    docs, items = fixture(spark)
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0
    assert suffix.SCHEMA.startswith("doc_id")
