r"""Conversations as training texts: turn-aligned windows under a token budget.

Prefix sums of turn tokens place every turn on a line. The line is divided into
stripes of ``stride`` tokens; turns that lie inside one stripe form a window, and
a turn that crosses into the next stripe is a window of its own, so no turn is
ever cut and a window's end follows from the prefix sum alone. ``stride`` is the
budget less the history and the conversation's system turn, a quarter of the
budget at least. A window repeats the system turn, if that came earlier, and
then the turns just before it that begin at most ``history`` tokens back.
Targets are the texts of ``assistant`` turns; a repeated one is masked, so each
target bears loss in just one window. Only a single turn longer than the stride
takes a window over budget; it is kept whole.

Format of a turn: ``<s>[role]text</s>``. In role and text each of ``\ < [ ]``
gets a backslash before it, so an unescaped ``<`` or ``[`` is always a mark, and
taking one backslash away from each pair gives back every text.

Prefix sums are in two levels: blocks of ``BLOCK`` turn numbers are summed by
their own tasks and a running sum over block totals is joined back, so one
conversation that holds a third of all rows is spread. Windows are bounded by
the budget, and history is found by an equi-join on bins of ``history`` tokens,
where a turn has two bins at most.

Nulls, edges: null text or role is empty; a null turn number comes first; turns
of one number go by role, then text, and equal rows are turns of their own. A
null conv_id is a conversation like others. An empty text takes the fixed tokens
of its marks, so that windows stay bounded. An empty table gives no windows.
Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm import common

BUDGET, HISTORY, BLOCK = 2048, 256, 256
MARK_TOKENS = 4
SYSTEM, TARGET = "system", "assistant"

_TURN = re.compile(r"<s>\[((?:[^\\\]]|\\.)*)\]((?:[^\\<]|\\.)*)</s>", re.S)
_PAIR = re.compile(r"\\(.)", re.S)


def escaped(c: Column) -> Column:
    return F.regexp_replace(c, r"([\\<\[\]])", r"\\$1")


def unescaped(text: str) -> str:
    return _PAIR.sub(r"\1", text)


def count_tokens(text: Column) -> Column:
    """A cheap measure: runs of letters and digits, and every other visible character."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]++|[^\s\p{L}\p{N}]"))


def _same(a: DataFrame, b: DataFrame, *keys: str) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & a[k].eqNullSafe(b[f"_{k}"])
    return on


def _with(a: DataFrame, b: DataFrame, *keys: str, how: str = "inner", also: Column | None = None) -> DataFrame:
    """Null-safe equi-join that keeps one copy of the keys."""
    b = b.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = _same(a, b, *keys)
    return a.join(b, on if also is None else on & also, how).drop(*(f"_{k}" for k in keys))


def placed(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Each turn with its number in the conversation, its place on the token line and its window."""
    t = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    t = t.withColumn("n", count_tokens("text") + MARK_TOKENS).withColumn(
        "block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 60)))
    )
    inside = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "role", "text")
    rows = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumn("pos", F.row_number().over(inside).cast("long")).withColumn("end", F.sum("n").over(rows))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = t.groupBy("conv_id", "block").agg(F.count("*").alias("turns"), F.sum("n").alias("tokens"))
    totals = totals.select(
        "conv_id",
        "block",
        F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("turns_before"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("tokens_before"),
    )
    t = _with(t, totals, "conv_id", "block").select(
        "conv_id",
        (F.col("pos") + F.col("turns_before")).alias("pos"),
        "role",
        "text",
        "n",
        (F.col("end") - F.col("n") + F.col("tokens_before")).alias("start"),
    )
    system = t.where(F.col("role") == SYSTEM).groupBy("conv_id").agg(
        F.min("pos").alias("sys_pos"), F.min_by("n", "pos").alias("sys_n")
    )
    stride = F.greatest(F.lit(budget // 4), budget - history - F.coalesce("sys_n", F.lit(0)))
    t = _with(t, system, "conv_id", how="left").withColumn("stride", stride)
    first = F.floor(F.col("start") / F.col("stride"))
    last = F.floor((F.col("start") + F.col("n") - 1) / F.col("stride"))
    return t.withColumn("window", (2 * first + (first != last).cast("long")).cast("long")).drop("stride", "sys_n")


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, n_turns (new ones), n_repeated, tokens, text, loss (spans of code points)."""
    new = common.stage(placed(turns, budget, history), "turns")
    spans = new.groupBy("conv_id", "window").agg(F.min("start").alias("begin"))
    width = F.lit(history)
    earlier = (
        new.where((F.col("n") <= width) & (F.col("sys_pos").isNull() | (F.col("pos") != F.col("sys_pos"))))
        .withColumn("to", F.col("start") + F.col("n"))
        .withColumn("bin", F.explode(F.sequence(F.floor(F.col("to") / width), F.floor((F.col("start") + width) / width))))
        .drop("window", "sys_pos")
    )
    again = _with(
        earlier,
        spans.withColumn("bin", F.floor(F.col("begin") / width)),
        "conv_id",
        "bin",
        also=(F.col("begin") >= F.col("to")) & (F.col("begin") - F.col("start") <= width),
    )
    system = new.where(F.col("pos") == F.col("sys_pos")).drop("sys_pos", "window")
    led = _with(system, spans, "conv_id", also=F.col("begin") > F.col("start"))
    columns = ["conv_id", "window", "pos", "role", "text", "n"]
    rows = (
        new.select(*columns, F.lit(False).alias("again"))
        .unionByName(again.select(*columns, F.lit(True).alias("again")))
        .unionByName(led.select(*columns, F.lit(True).alias("again")))
    )
    head = F.concat(F.lit("<s>["), escaped(F.col("role")), F.lit("]"))
    rows = rows.select(
        "conv_id", "window", "pos", "again", "n", (F.col("role") == TARGET).alias("target"), head.alias("head"), escaped(F.col("text")).alias("body")
    ).withColumn("size", F.length("head") + F.length("body") + 4)
    run = Window.partitionBy("conv_id", "window").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("at", F.sum("size").over(run) - F.col("size") + F.length("head"))
    span = F.struct(F.col("at").alias("start"), (F.col("at") + F.length("body")).alias("end"))
    return rows.groupBy("conv_id", "window").agg(
        F.count_if(~F.col("again")).alias("n_turns"),
        F.count_if("again").alias("n_repeated"),
        F.sum("n").alias("tokens"),
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("pos", F.concat("head", "body", F.lit("</s>")).alias("out")))), lambda x: x["out"]
            ),
            "",
        ).alias("text"),
        F.sort_array(F.collect_list(F.when(~F.col("again") & F.col("target"), span))).alias("loss"),
    )


def parsed(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn in a formatted window."""
    return [(unescaped(m[1]), unescaped(m[2])) for m in _TURN.finditer(text)]


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digest(formatted: DataFrame) -> DataFrame:
    """Read windows back and digest each conversation's own turns and its text under loss.

    A digest needs the bytes of a conversation in order, so they stream through
    one task; it holds a window at a time, however long the conversation is.
    """
    common.ship(formatted.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: object = run
        state: list = []
        done: list[tuple] = []

        def close() -> None:
            if state:
                turns, h, chars, loss, size = state
                done.append((now, turns, h.hexdigest(), chars, loss.hexdigest(), size))

        def flush() -> pa.RecordBatch:
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = list(zip(*done, strict=True)) or [()] * 6
            names = [c.split()[0] for c in DIGEST.split(", ")]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
            done.clear()
            return out

        for batch in batches:
            for row in batch.to_pylist():
                if row["conv_id"] != now:
                    close()
                    now, state[:] = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parsed(row["text"])[row["n_repeated"] :]:
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for span in row["loss"]:
                    target = unescaped(row["text"][span["start"] : span["end"]])
                    state[2] += len(target)
                    state[3].update(target.encode("utf-8", "surrogatepass"))
                state[4] += len(row["text"])
            yield flush()
        close()
        yield flush()

    rows = formatted.select("conv_id", "window", "n_repeated", "text", "loss")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "window").mapInArrow(run, DIGEST)


PROBE = "</s>[INST] ok [/INST]"


def op3_chat_windows(spark, sf_dir):
    """Every conversation, and one that holds control strings, formatted, written and read back."""
    rows = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return digest(common.stage(windows(rows.unionByName(probe)), "chat"))
