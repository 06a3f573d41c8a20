"""Document fingerprints by I-Match over nested random subsets of a lexicon.

The lexicon holds the terms whose inverse document frequency lies in a band:
they stand in at most one document of ``COMMON`` and at least one of ``RARE``.
A text's distinct lexicon terms are sorted by a hash, and a digest of the sorted
terms is taken for each of ``CHAINS`` x ``LEVELS`` random subsets of the lexicon:
a chain holds one term in CHAINS, level l of it one term in 2 ** l of those. Two
texts agree in a subset if all their terms of it are the same; the small subsets
tell a half-kept text from a foreign one, the large ones a changed word from none.
The likeness of two fingerprints is the share of subsets that agree among those
in which either text has a term.

Everything is a DataFrame operation. Documents are dealt into blocks of adjacent
ones by cut points (the first keys of sampled ranges), each block also gets the
first document of the one after it, and from there the next document, the terms,
the digests and the likeness need no further exchange: texts move once. The
lexicon is at most RARE times the mean number of distinct terms of a document,
whatever the number of documents, and is broadcast where it has no more than
``SENT`` terms; a larger one is joined by a shuffle.

Nulls, edges: a null text is empty. A text without a lexicon term has the digest
of the whole text as its fingerprint, like only its equals. Documents ascend by
id, null first, rows of one id by a hash of their texts; rows equal in both are
alike. The last document's next is the first, also where it is the only one.
Texts are read whole. An empty table gives no rows. Only the two named columns
are read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm import common

COMMON, RARE = 10, 2000
CHAINS, LEVELS = 16, 12
#: Terms of a lexicon that is broadcast; some 100 bytes each.
SENT = 1 << 20
#: Cut points looked through at once.
STRIDE = 32
#: What parts terms: ASCII but letters and digits.
APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ABOUT = "struct<doc_id: bigint, n_chars: bigint, edited_sha256: string, whole: string, edited_whole: string>"
CUTS = "array<array<struct<known: boolean, id: bigint, h: bigint>>>"


def terms(text: Column) -> Column:
    """Distinct lower-case terms; the empty string may be among them."""
    return F.array_distinct(F.split(F.lower(text), APART))


def lexicon(texts: DataFrame, text_col: str, common_share: int = COMMON, rare_share: int = RARE) -> DataFrame:
    """term, df, h of the terms in the band. ``h`` is a hash of the term: its low
    bits name the chain, the next ones the level that the term reaches."""
    n = texts.count()
    df = texts.select(F.explode(terms(F.col(text_col))).alias("term")).where("term <> ''").groupBy("term").agg(F.count("*").alias("df"))
    band = df.where((F.col("df") * common_share <= n) & (F.col("df") * rare_share >= n))
    return band.withColumn("h", F.conv(F.substring(F.md5(F.col("term").cast("binary")), 1, 15), 16, 10).cast("long"))


def digests(sorted_terms: Column) -> Column:
    """The digest of each subset in turn; null where the text has no term of it."""

    def chain(k: Column) -> Column:
        return F.filter(sorted_terms, lambda h: h.bitwiseAND(CHAINS - 1) == k)

    def level(held: Column, n: Column) -> Column:
        kept = F.filter(held, lambda h: F.shiftrightunsigned(h, 4) % n == 0)
        return F.when(F.size(kept) > 0, F.substring(F.md5(F.array_join(kept.cast("array<string>"), ",").cast("binary")), 1, 6))

    steps = F.array(*[F.lit(1 << n).cast("long") for n in range(LEVELS)])
    chains = F.array(*[F.lit(k).cast("long") for k in range(CHAINS)])
    return F.flatten(F.transform(F.transform(chains, chain), lambda held: F.transform(steps, lambda n: level(held, n))))


def as_text(found: Column, whole: Column) -> Column:
    """A fingerprint as one string; ``whole`` is the digest of the text itself."""
    known = F.exists(found, lambda d: d.isNotNull())
    return F.when(known, F.array_join(found, ".", "")).otherwise(F.concat(F.lit("="), whole))


def likeness(a: Column, whole_a: Column, b: Column, whole_b: Column) -> Column:
    """Share of the subsets that agree among those with a term in either."""
    seen = F.size(F.filter(F.zip_with(a, b, lambda x, y: F.coalesce(x, y)), lambda d: d.isNotNull()))
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e))
    return F.when(seen > 0, same / seen).otherwise((whole_a == whole_b).cast("double"))


def _key() -> Column:
    return F.struct(
        F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), F.xxhash64("text").alias("h")
    )


def neighbours(docs: DataFrame) -> DataFrame:
    """block, at, guest, doc_id, text, next_text: documents in blocks of adjacent ones, in their order.

    A guest is the first document of the next block, there to be the next of the last one.
    """
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.withColumn("key", _key())
    ranges = keyed.select("key.*").repartitionByRange(parts, "known", "id", "h").groupBy(F.spark_partition_id())
    firsts = ranges.agg(F.min(F.struct("known", "id", "h")).alias("first")).select("first.*")
    cuts = sorted((r.known, r.id, r.h) for r in firsts.collect()) or [(False, 0, 0)]
    lists = [[dict(zip(("known", "id", "h"), c)) for c in cuts[i : i + STRIDE]] for i in range(0, len(cuts), STRIDE)]
    held = F.from_json(F.lit(json.dumps(lists)), CUTS)
    heads = F.from_json(F.lit(json.dumps([part[:1] for part in lists])), CUTS)
    group = F.greatest(F.size(F.filter(heads, lambda part: part[0] <= F.col("key"))), F.lit(1))
    inner = F.size(F.filter(F.element_at(held, F.col("group")), lambda c: c <= F.col("key")))
    placed = keyed.withColumn("group", group).withColumn("inner", F.greatest(inner, F.lit(1)))
    first = F.element_at(F.element_at(held, F.col("group")), F.col("inner")) == F.col("key")
    block = (F.col("group") - 1) * STRIDE + F.col("inner") - 1
    before = F.when(block == 0, F.lit(len(cuts) - 1)).otherwise(block - 1)
    own = F.struct(block.alias("block"), F.lit(False).alias("guest"))
    guest = F.struct(before.alias("block"), F.lit(True).alias("guest"))
    dealt = placed.withColumn("to", F.explode(F.when(first, F.array(own, guest)).otherwise(F.array(own))))
    dealt = dealt.select("to.block", "to.guest", "key", "doc_id", "text")
    order = Window.partitionBy("block").orderBy("guest", "key")
    return dealt.select(
        "block", "guest", "doc_id", "text", F.row_number().over(order).alias("at"), F.lead("text").over(order).alias("next_text")
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", common_share: int = COMMON, rare_share: int = RARE) -> DataFrame:
    """Each document and its edited text (the second half replaced by the start of
    the next document) with their fingerprints, and their likeness to each other
    and to the next document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = common.stage(lexicon(rows, "text", common_share, rare_share), "lexicon")
    # The empty term stands for the document itself.
    table = words.select("term", "h").unionByName(docs.sparkSession.createDataFrame([("", None)], "term string, h long"))
    table = F.broadcast(table) if words.count() <= SENT else table
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - half)"), F.coalesce(F.expr("substring(next_text, 1, half)"), F.lit("")))
    pairs = neighbours(rows).withColumn("half", half).withColumn("edited", edited)
    about = F.struct(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.md5(F.col("text").cast("binary")).alias("whole"),
        F.md5(F.col("edited").cast("binary")).alias("edited_whole"),
    ).alias("about")
    made = pairs.select("block", "at", "guest", about, terms(F.col("text")).alias("a"), terms(F.col("edited")).alias("b"))

    def cells(column: str, kind: int) -> Column:
        return F.transform(column, lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("term"), F.lit(None).cast(ABOUT).alias("about")))

    itself = F.array(F.struct(F.lit(2).alias("kind"), F.lit("").alias("term"), F.col("about")))
    spread = made.select("block", "at", "guest", F.explode(F.concat(cells("a", 0), cells("b", 1), itself)).alias("x"))
    known = spread.select("block", "at", "guest", "x.kind", "x.term", "x.about").join(table, "term")

    def sorted_terms(kind: int) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.col("h"))))

    grouped = known.groupBy("block", "at").agg(
        F.max("guest").alias("guest"),
        F.max("about").alias("about"),
        digests(sorted_terms(0)).alias("mine"),
        digests(sorted_terms(1)).alias("theirs"),
    )
    order = Window.partitionBy("block").orderBy("at")
    told = grouped.select(
        "guest", "about", "mine", "theirs", F.lead("mine").over(order).alias("next"), F.lead("about.whole").over(order).alias("next_whole")
    ).where(~F.col("guest"))
    whole, other = F.col("about.whole"), F.col("about.edited_whole")
    return told.select(
        "about.doc_id",
        "about.n_chars",
        "about.edited_sha256",
        as_text(F.col("mine"), whole).alias("fingerprint"),
        as_text(F.col("theirs"), other).alias("edited_fingerprint"),
        likeness(F.col("mine"), whole, F.col("theirs"), other).alias("near_edited"),
        likeness(F.col("mine"), whole, F.col("next"), F.col("next_whole")).alias("near_next"),
    )


def op12_imatch(spark, sf_dir):
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints(common.table(spark, sf_dir, "documents"))


_SQL_TERMS = r"list_distinct(string_split_regex(lower({}), '" + APART + "'))"

ORACLE_SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id NULLS FIRST) AS r, count(*) OVER () AS n FROM documents
), pairs AS (
  SELECT a.r, a.n, a.doc_id, a.text,
    left(a.text, length(a.text) - length(a.text) // 2) || left(b.text, length(a.text) // 2) AS edited
  FROM docs a JOIN docs b ON b.r = a.r % a.n + 1
), lexicon AS (
  SELECT term, CAST('0x' || substr(md5(term), 1, 15) AS BIGINT) AS h
  FROM (SELECT unnest({_SQL_TERMS.format("text")}) AS term, n FROM docs) WHERE term <> ''
  GROUP BY term, n HAVING count(*) * {COMMON} <= n AND count(*) * {RARE} >= n
), cells AS (
  SELECT r, 0 AS kind, unnest({_SQL_TERMS.format("text")}) AS term FROM pairs
  UNION ALL
  SELECT r, 1 AS kind, unnest({_SQL_TERMS.format("edited")}) AS term FROM pairs
), leveled AS (
  SELECT r, kind, h & {CHAINS - 1} AS chain, unnest(list_filter(range({LEVELS}), lambda l: ((h >> 4) & ((1 << l) - 1)) = 0)) AS lvl, h
  FROM cells JOIN lexicon USING (term)
), digests AS (
  SELECT r, kind, chain * {LEVELS} + lvl AS slot, substr(md5(string_agg(CAST(h AS VARCHAR), ',' ORDER BY h)), 1, 6) AS d
  FROM leveled GROUP BY r, kind, chain, lvl
), slots AS (
  SELECT r, kind, slot, d FROM (SELECT r, kind FROM digests GROUP BY r, kind) CROSS JOIN range({CHAINS * LEVELS}) t(slot)
  LEFT JOIN digests USING (r, kind, slot)
), prints AS (
  SELECT r, kind, string_agg(coalesce(d, ''), '.' ORDER BY slot) AS fp FROM slots GROUP BY r, kind
), near AS (
  SELECT coalesce(a.r, b.r) AS r, coalesce(a.to_kind, b.to_kind) AS to_kind,
    count(*) FILTER (a.d = b.d) / CAST(count(*) AS DOUBLE) AS share
  FROM (SELECT r, slot, d, unnest([1, 0]) AS to_kind FROM digests WHERE kind = 0) a
  FULL JOIN (
    SELECT r, slot, d, 1 AS to_kind FROM digests WHERE kind = 1
    UNION ALL
    SELECT (g.r - 2 + p.n) % p.n + 1 AS r, g.slot, g.d, 0 AS to_kind FROM digests g JOIN pairs p USING (r) WHERE g.kind = 0
  ) b ON a.r = b.r AND a.slot = b.slot AND a.to_kind = b.to_kind
  GROUP BY ALL
)
SELECT p.doc_id, length(p.text) AS n_chars, sha256(p.edited) AS edited_sha256,
  coalesce(f.fp, '=' || md5(p.text)) AS fingerprint, coalesce(e.fp, '=' || md5(p.edited)) AS edited_fingerprint,
  coalesce(x.share, CAST(p.text = p.edited AS INTEGER)) AS near_edited,
  coalesce(y.share, CAST(p.text = q.text AS INTEGER)) AS near_next
FROM pairs p JOIN pairs q ON q.r = p.r % p.n + 1
LEFT JOIN prints f ON f.r = p.r AND f.kind = 0
LEFT JOIN prints e ON e.r = p.r AND e.kind = 1
LEFT JOIN near x ON x.r = p.r AND x.to_kind = 1
LEFT JOIN near y ON y.r = p.r AND y.to_kind = 0
"""
