import zlib

from ebbtide.llm import common, language_id as li


def test_held_out_accuracy(spark, sf_dir):
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in common.table(spark, sf_dir, "documents").collect()}
    got = li.op8_language_id(spark, sf_dir).collect()
    assert len(got) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]][0] for r in held) / len(held) > 0.97
    assert {r["lang_pred"] for r in got} <= {v[0] for v in truth.values()} | {li.UNKNOWN}


def trained():
    words = {
        "en": "the of and that with this from were which have their been would",
        "de": "der und die nicht mit sich auch werden eine nach schon über für",
        "fr": "les des une dans pour avec sont cette leurs était façon même où",
        "es": "los las una para con están esta pero también más según año qué",
    }
    texts, langs = [], []
    for lang, w in words.items():
        w = w.split()
        for i in range(60):
            texts.append(" ".join(w[(i * 7 + j * 5) % len(w)] for j in range(30)))
            langs.append(lang)
    return li.Model(texts, langs)


def test_families_then_pairs():
    model = trained()
    assert [model.languages[i] for i in model.by_family[model.families.index("romance")]] == ["es", "fr"]
    assert set(model.pairs) == {(0, 1), (2, 3)}
    assert li.family("pt-BR") == "romance" and li.family("qq") == "only qq"


def test_nulls_letters_repeats_clashes_and_no_rows(spark):
    schema = "doc_id long, text string, lang string, lang_pred string, score double"
    rows = [(1, None), (2, ""), (3, "12 | 34 !?"), (4, "the of and that"), (4, "the of and that"), (None, "über für nicht"), (5, "les dans pour " * 20_000), (6, "漢字")]
    df = spark.createDataFrame([(*r, None, "x", 2.0) for r in rows], schema)
    got = li.predict(df.drop("lang_pred", "score"), trained(), keep=("lang",)).collect()
    pred = [(r["doc_id"], r["lang_pred"]) for r in got]
    assert pred[:6] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (None, "de")]
    assert pred[6] == (5, "fr") and pred[7][1] != "und"
    assert all((r["score"] == 0) == (r["lang_pred"] == "und") for r in got)
    assert li.fit(df) is None
    assert {r["lang_pred"] for r in li.predict(df.drop("lang_pred", "score"), None).collect()} == {"und"}
    assert li.predict(df.drop("lang_pred", "score").limit(0), trained()).count() == 0
    one = spark.createDataFrame([(1, "only this", "aa", "", 0.0)], schema)
    assert li.predict(one, li.fit(one)).first()["lang_pred"] == "aa"
