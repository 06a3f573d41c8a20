"""Exact deduplication of lines or paragraphs across all documents.

A text is cut into units with their offsets: its lines (or paragraphs), and a
line of more than ``long_words`` words further at its sentence ends, so that a
passage pasted into a long line is a unit of its own. Every unit is normalised
(A-Z lower-cased, ASCII white space folded and trimmed) and digested. All places
of a digest are ranked by (document id, offset); the first stays, the others are
removed. Units of fewer than ``min_words`` words stay, by default only those
without any word. Only digests and places are exchanged. The first place of
a digest is found with a combine before the shuffle, so a line that a third of
all documents hold is one row of each task; the join back to the places is a
plain equi-join that adaptive execution splits where a digest is hot.

Nulls, edges: a null text has no unit and stays null, an empty one stays empty.
A null id ranks after all others. Rows that share an id are told apart by their
texts; rows equal in both are one document written twice and get one result
each, the same. Very long texts are cut whole. Offsets are code points of the
original text, end not included. An empty table gives no rows; columns other
than the two named are not read and cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm import common

# What ends a unit.
BREAKS = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n[ \t\r]*\n\s*")}
SENTENCE_END = re.compile(r"(?<=[.!?]) ")
MIN_WORDS, LONG_WORDS = 1, 50

PLACE = "doc_id long, text_key long, start int, end int, after int, digest binary"


def cut(text: str, unit: str = "line", long_words: int = LONG_WORDS) -> Iterator[tuple[int, int, int]]:
    """(start, end, end of the separator behind) of every unit of a text, in order."""

    def parts(pattern: re.Pattern, a: int, b: int) -> Iterator[tuple[int, int, int]]:
        for m in pattern.finditer(text, a, b):
            yield a, m.start(), m.end()
            a = m.end()
        yield a, b, b

    for start, end, after in parts(BREAKS[unit], 0, len(text)):
        if len(text[start:end].split()) <= long_words:
            yield start, end, after
            continue
        for a, b, c in parts(SENTENCE_END, start, end):
            yield a, b, (after if c == end else c)


def normal(unit: str) -> tuple[bytes, int]:
    words = unit.encode("utf-8", "surrogatepass").lower().split()
    return b" ".join(words), len(words)


def places(docs: DataFrame, unit: str, min_words: int, long_words: int) -> DataFrame:
    """The place and digest of every unit that is long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.pieces(batches, "text", 4 << 20):
            ids, keys, texts = (batch.column(i).to_pylist() for i in range(3))
            out: list[list] = [[] for _ in range(6)]
            for i, k, t in zip(ids, keys, texts, strict=True):
                for start, end, after in cut(t, unit, long_words) if t else ():
                    body, n = normal(t[start:end])
                    if n >= min_words:
                        row = (i, k, start, end, after, hashlib.blake2b(body, digest_size=16).digest())
                        for column, v in zip(out, row, strict=True):
                            column.append(v)
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)],
                ["doc_id", "text_key", "start", "end", "after", "digest"],
            )

    return docs.select("doc_id", "text_key", "text").mapInArrow(run, PLACE)


def dedup(
    docs: DataFrame,
    unit: str = "line",
    min_words: int = MIN_WORDS,
    long_words: int = LONG_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, text with repeated units removed, the removed offsets, their number."""
    common.ship(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text")
    )
    found = common.stage(places(rows, unit, min_words, long_words), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "start")
    first = found.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    removed = (
        found.join(first, "digest")
        .where(~F.col("first").eqNullSafe(rank))
        .distinct()
        .groupBy("doc_id", "text_key")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "after"))).alias("removed"))
        .select(F.col("doc_id").alias("r_id"), F.col("text_key").alias("r_key"), "removed")
    )
    at = F.coalesce("removed", F.expr("array()"))
    # The kept text runs from the end of each removed unit to the start of the next.
    kept = F.expr(
        "array_join(transform(sequence(0, size(removed)), i -> substring(text, "
        "if(i = 0, 0, removed[greatest(i, 1) - 1].after) + 1, "
        "if(i = size(removed), length(text), removed[least(i, size(removed) - 1)].start)"
        " - if(i = 0, 0, removed[greatest(i, 1) - 1].after))), '')"
    )
    return (
        rows.join(removed, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_key") == F.col("r_key")), "left")
        .select(
            "doc_id",
            F.when(F.col("removed").isNull(), F.col("text")).otherwise(kept).alias("text"),
            F.size(at).alias("n_removed"),
            F.transform(at, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"))).alias("removed"),
        )
    )


def op9_line_dedup(spark, sf_dir):
    """Every document without the units seen in an earlier one."""
    out = dedup(common.table(spark, sf_dir, "documents"))
    span = F.transform("removed", lambda r: F.concat_ws("-", r["start"], r["end"]))
    return out.select(
        "doc_id", F.col("n_removed").cast("long").alias("n_removed"), F.concat_ws(",", span).alias("removed"), "text"
    )


ORACLE_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ln
  FROM documents
), shaped AS (
  SELECT doc_id, ln,
    CASE WHEN len(string_split(trim(regexp_replace(line, '[\\t-\\r ]+', ' ', 'g')), ' ')) > 50
         THEN regexp_replace(line, '([.!?]) ', '\\1' || chr(30), 'g') ELSE line END AS line
  FROM lines
), units AS (
  SELECT doc_id, ln, unnest(string_split(line, chr(30))) AS unit, generate_subscripts(string_split(line, chr(30)), 1) AS un
  FROM shaped
), placed AS (
  SELECT doc_id, unit, ln, un,
    sum(length(unit) + 1) OVER (PARTITION BY doc_id ORDER BY ln, un) - length(unit) - 1 AS start,
    trim(regexp_replace(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\t-\\r ]+', ' ', 'g')) AS body,
    lead(ln) OVER (PARTITION BY doc_id ORDER BY ln, un) AS next_ln
  FROM units
), ranked AS (
  SELECT *, body <> ''
    AND row_number() OVER (PARTITION BY body ORDER BY doc_id, start) > 1 AS gone
  FROM placed
), whole AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(CAST(start AS BIGINT) || '-' || CAST(start + length(unit) AS BIGINT), ',' ORDER BY start) FILTER (gone), '') AS removed,
    coalesce(string_agg(unit || CASE WHEN next_ln IS NULL THEN '' WHEN next_ln > ln THEN chr(10) ELSE ' ' END, '' ORDER BY start) FILTER (NOT gone), '') AS text
  FROM ranked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(w.n_removed, 0) AS n_removed, coalesce(w.removed, '') AS removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(w.text, '') END AS text
FROM documents d LEFT JOIN whole w USING (doc_id)
"""
