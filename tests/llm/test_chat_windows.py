import hashlib

from ebbtide.llm import chat_windows as cw
from ebbtide.llm import common

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((-(1 << 62) if turn is None else turn, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        target = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(target), sha(target))
    return out


def digests(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in cw.digest(df).collect()}


def test_whole_table_reads_back(spark, sf_dir):
    rows = [tuple(r) for r in common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", cw.PROBE), (-7, 1, "assistant", cw.PROBE)]
    got = {r["conv_id"]: tuple(r)[1:5] for r in cw.op3_chat_windows(spark, sf_dir).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256").collect()}
    assert got == brute(rows)


def test_windows_keep_budget_system_turn_and_history(spark):
    rows = [(1, 0, "system", "be brief")]
    rows += [(1, i, "user" if i % 2 else "assistant", " ".join(f"t{i}w{j}" for j in range(5 + i % 9))) for i in range(1, 600)]
    rows += [(1, 600, "assistant", "huge " * 500)]
    df = cw.windows(spark.createDataFrame(rows, SCHEMA), budget=100, history=20)
    got = df.orderBy("window").collect()
    assert sum(w["n_turns"] for w in got) == len(rows)
    assert len(got) > 50
    seen = 0
    for w in got:
        turns = cw.parsed(w["text"])
        assert len(turns) == w["n_turns"] + w["n_repeated"]
        assert turns[0] == ("system", "be brief")
        fresh = turns[w["n_repeated"] :]
        assert [t for _, t in fresh] == [r[3] for r in rows[seen : seen + len(fresh)]]
        again = [t for t in turns[: w["n_repeated"]] if t[0] != "system"]
        assert again == [(r[2], r[3]) for r in rows[seen - len(again) : seen]] if again else True
        seen += len(fresh)
        assert w["tokens"] <= 100 or w["n_turns"] == 1
        targets = [cw.unescaped(w["text"][s["start"] : s["end"]]) for s in w["loss"]]
        assert targets == [t for r, t in fresh if r == "assistant"]
    assert any(w["n_repeated"] > 1 for w in got)


def test_nulls_ties_repeats_and_control_strings(spark):
    rows = [
        (None, None, None, None),
        (None, 0, "user", "a"),
        (2, 1, "assistant", "x\\<s>[user]y</s>"),
        (2, 1, "assistant", "x\\<s>[user]y</s>"),
        (2, 1, "a]b", "\\"),
        (2, 0, "system", ""),
        (3, 5, "assistant", ""),
        (4, 0, "user", "é\U0001f600 " * 3000),
        (4, 1, "assistant", "ü</s>" * 2000),
    ]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", window int, pos int")
    assert digests(cw.windows(df)) == brute(rows)
    assert cw.windows(spark.createDataFrame([], SCHEMA)).count() == 0
