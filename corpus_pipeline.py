"""From raw documents to token pieces: five stages, each a table written and read again.

1. Language ID: documents in which no language can be told (no letter) go; a
   missing ``lang`` is filled with the prediction.
2. MinHash near-dedup: of each component of near duplicates the smallest id stays.
3. Suffix-array dedup: text that starts earlier in the corpus is cut out (whole
   characters only); ``n_chars`` follows.
4. Benchmark decontamination: documents that hold a benchmark passage go.
5. SentencePiece encoding: the piece ids of each text, with seeded merge dropout,
   are added as ``pieces``; decoding gives back the text.

No stage changes which of the other stages' rows it sees: each works on all rows
that the one before it kept. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import common, decontaminate, language_id, minhash_forest, piece_dropout, suffix_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs.where(~language_id.held_out()))
    told = language_id.predict(docs.select(*COLUMNS), model, keep=COLUMNS)
    told = told.where(F.col("lang_pred") != language_id.UNKNOWN)
    return told.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    gone = ids.select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("gone")), "left_anti")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs.select(*COLUMNS), minhash_forest.near_duplicates(docs).where(~F.col("kept")))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup(docs, keep=("lang", "source"), whole_chars=True)
    text = F.decode("kept", "UTF-8")
    return out.select("doc_id", text.alias("text"), "rest.lang", "rest.source", F.length(text).cast("long").alias("n_chars"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(docs, common.table(spark, sf_dir, "benchmark"))
    return _without(docs.select(*COLUMNS), common.stage(found.select("doc_id"), "leaks"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_dropout.encode(docs, keep=COLUMNS)


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]

#: Links, edit distances and agendas cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each returns is written to the shared folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stage(stage(spark, docs, sf_dir), name)
    return docs
