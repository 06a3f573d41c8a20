import zlib

import numpy as np
import pyarrow as pa
import pytest

from ebbtide.llm import common, token_files as tf

ODD = ["", " ", "  ", "a   b  c", " lead", "x \n y", "é'll <|endoftext|> ok  b", "\n\n a", "tab\t b\r\n c", "don't we're 12 34.5", "  x", "𝔘 字漢 ok"]


def whole(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [tf.END_ID]


def test_query_against_the_library(spark, sf_dir):
    encoder = tf.Encoder(tf.TOKENIZER)
    want, start = {}, 0
    for i, t in sorted(tuple(r) for r in common.table(spark, sf_dir, "documents").select("doc_id", "text").collect()):
        ids = whole(encoder, t)
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r["doc_id"]: tuple(r)[1:] for r in tf.op7_token_files(spark, sf_dir).collect()} == want


def test_pieces_between_spaces_are_what_the_library_makes(monkeypatch):
    encoder = tf.Encoder(tf.TOKENIZER)
    monkeypatch.setattr(tf, "KEPT", 5)
    for text in ODD + [" ".join(ODD), "word " * 500]:
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == whole(encoder, text)[:-1]


@pytest.mark.parametrize("kind", ["one", "repeats", "random", "short", "all"])
def test_segment_round_trip(kind):
    draw = np.random.default_rng(3)
    ids = {
        "one": np.full(5000, 7),
        "repeats": np.tile(draw.integers(0, 50_257, 300), 30),
        "random": draw.integers(0, 50_257, 20_000),
        "short": np.array([0]),
        "all": np.concatenate((np.arange(50_257), draw.integers(0, 40, 30_000))),
    }[kind].astype(np.int32)
    body = tf.pack_segment([5, 9], [len(ids) - 1, 1], ids)
    names, lengths, back = tf.unpack_segment(body)
    assert (back == ids).all() and names.tolist() == [5, 9] and lengths.sum() == len(ids)
    if kind == "repeats":
        assert 8 * len(body) / len(ids) < 7
    broken = bytearray(body)
    broken[-1] ^= 1
    with pytest.raises(ValueError, match="broken"):
        tf.unpack_segment(bytes(broken))


def test_nulls_ties_small_segments_and_no_rows(spark, monkeypatch, tmp_path):
    schema = "doc_id long, text string, start long, file string"
    rows = [(5, "five"), (None, "none"), (2, None), (5, "five"), (1, "one " * 3000), (9, "▁ é")]
    df = spark.createDataFrame([(*r, 1, "f") for r in rows], schema)
    tf.write(df, str(tmp_path / "t"))
    got = sorted((tuple(r) for r in tf.read(spark, str(tmp_path / "t")).collect()), key=lambda r: r[1])
    encoder = tf.Encoder(tf.TOKENIZER)
    order = [(None, "none"), (1, "one " * 3000), (2, None), (5, "five"), (5, "five"), (9, "▁ é")]
    start = 0
    for (i, t), r in zip(order, got, strict=True):
        ids = whole(encoder, t)
        assert r == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    tf.write(df.limit(0), str(tmp_path / "e"))
    assert tf.read(spark, str(tmp_path / "e")).count() == 0


def test_added_tokens_are_what_the_library_makes_of_them():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tf.TOKENIZER)
    encoder = tf.Encoder(tf.TOKENIZER)
    for text in ("ab <|endoftext|> cd", "<|endoftext|>", "a<|endoftext|>b", "x <|endoftext |> y"):
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_batch_encodes_each_different_word_once():
    encoder = tf.Encoder(tf.TOKENIZER)
    asked = []
    made = encoder._made
    encoder._made = lambda part: asked.append(part) or made(part)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    texts = [" ".join(["Head", *words[i:], *(w + "," for w in words[:i])]) for i in range(0, 300, 3)]
    for rows in (texts, [None, "", " ", *ODD, *texts[::-1]], texts[50:]):
        ids, count = encoder.encode_all(pa.array(rows, pa.string()), b"\0\0")
        want = [whole(encoder, t) for t in rows]
        assert count.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
    again = [w for w in asked if w[1:] in words]
    assert len(again) <= 2 * len(words)
    sliced = pa.array(["no", *texts], pa.string())[1:]
    assert encoder.encode_all(sliced)[0].tolist() == [i for t in texts for i in whole(encoder, t)[:-1]]
    assert encoder.encode_all(pa.array([], pa.string()))[0].tolist() == []


def test_a_small_batch_does_not_go_through_all_that_is_known(monkeypatch):
    encoder = tf.Encoder(tf.TOKENIZER)
    encoder.encode_all(pa.array([" ".join(f"k{i}" for i in range(3000))]))
    hashed, hash_array = [], tf.pd.util.hash_array
    monkeypatch.setattr(pa.compute, "index_in", lambda *a, **k: pytest.fail("a table of all known chunks"))
    monkeypatch.setattr(tf.pd.util, "hash_array", lambda x, **k: hashed.append(len(x)) or hash_array(x, **k))
    for text in ("a k5 k2999, new", "b new k6", "c"):
        assert encoder.encode_all(pa.array([text]))[0].tolist() == whole(encoder, text)[:-1]
    assert sum(hashed) < 20 and len(encoder.keys) == len(encoder.known) and (np.diff(encoder.keys.astype(float)) >= 0).all()


def test_equal_hashes_do_not_mix_chunks_up(monkeypatch):
    monkeypatch.setattr(tf.pd.util, "hash_array", lambda x, **k: np.array([len(t) for t in x], np.uint64))
    encoder = tf.Encoder(tf.TOKENIZER)
    for text in ("x aa bb aa cc dd", "y bb cc aa, bb. ee f", "z ee, dd bb", *ODD):
        assert encoder.encode_all(pa.array([text]))[0].tolist() == whole(encoder, text)[:-1]


def test_shares_of_the_guesses_are_those_of_the_segment():
    draw = np.random.default_rng(5)
    word = draw.integers(0, 50_257, (40, 3))
    ids = np.concatenate([np.tile(word[draw.permutation(40)].ravel(), 17) for _ in range(10)]).astype(np.int32)
    body = tf.pack_segment([1], [len(ids)], ids)
    assert (tf.unpack_segment(body)[2] == ids).all()
    assert 8 * len(body) / len(ids) < 0.93


@pytest.mark.parametrize("block", [1, 3, 50, 2048])
def test_words_carry_and_last_places_hold(monkeypatch, block):
    monkeypatch.setattr(tf, "BLOCK", block)
    draw = np.random.default_rng(7)
    for ids in (
        np.sort(draw.integers(0, 1 << 16, 5_001))[::-1],
        np.where(draw.random(20_003) < 0.999, 65_535, draw.integers(0, 65_536, 20_003)),
        np.where(draw.random(9_999) < 0.5, 65_535, 65_534),
        draw.integers(0, 3, 1),
    ):
        ids = ids.astype(np.int32)
        blocks, *tables = tf.encode_blocks(ids)
        assert (tf.decode_blocks(blocks, len(ids), *tables) == ids).all()
