"""Language identification in two steps: family first, then pairwise linear SVMs inside it.

Texts become hashed counts of one to three bytes over their letters. A linear
one-versus-rest SVM picks the language family; inside the family one linear SVM
for each pair of languages votes. The models are fitted on the driver from a
bounded sample (``PER_LANGUAGE`` documents of each language, ``SAMPLE`` in all, of
each one stretch of 4,000 characters; beyond SAMPLE languages the most frequent);
every document is then scored by its task, as a whole.

Nulls, edges: a null text, or one without any letter, is ``und`` with score 0.
Rows without ``lang`` never teach. Equal margins and equal votes go to the name
that comes first. With one learned language every text with a
letter gets it; with none, everything is ``und``. Repeated rows give repeated
results, very long texts are read whole in pieces of the batch, an empty table
gives no rows. Only the columns named by the arguments are read, so further
columns cannot clash.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm import common

#: The training sample: documents of one language, documents in all.
PER_LANGUAGE, SAMPLE = 250, 2000
BUCKETS = 4096
UNKNOWN = "und"

# Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "semitic": ("ar", "he", "mt"),
    "indo_aryan": ("hi", "ur", "bn", "mr", "ne", "pa", "gu"),
    "celtic": ("ga", "cy", "br"),
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}

_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
for _c in range(97, 123):
    _FOLD[_c] = _FOLD[_c - 32] = _c


def family(lang: str) -> str:
    """A language without an entry is a family of its own."""
    return _FAMILY.get(lang.lower().partition("-")[0], f"only {lang}")


def features(texts: pa.Array) -> np.ndarray:
    """One row of unit length for each text: hashed 1- to 3-byte counts of its letters."""
    lowered = pa.array([(t or "").lower() for t in texts.to_pylist()], pa.large_string())
    data, at = common.as_bytes(lowered)
    n = len(lowered)
    out = np.zeros((n, BUCKETS), np.float32)
    if not len(data):
        return out
    b = _FOLD[data].astype(np.uint32)
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(at))
    keep = ~((b == 32) & np.concatenate(([True], (b[:-1] == 32) & (doc[1:] == doc[:-1]))))
    b, doc = b[keep], doc[keep]
    step = np.int64(BUCKETS)
    total = np.zeros(n * BUCKETS, np.int64)
    total += np.bincount(doc * step + b, minlength=n * BUCKETS)
    for width, start, room in ((2, 256, 1280), (3, 1536, BUCKETS - 1536)):
        if len(b) < width:
            break
        m = len(b) - width + 1
        h = np.zeros(m, np.uint32)
        for i in range(width):
            h = h * np.uint32(0x01000193) + b[i : i + m]
        h = (h * np.uint32(0x9E3779B1)) >> np.uint32(12)
        same = doc[:m] == doc[width - 1 :]
        total += np.bincount((doc[:m] * step + start + h % np.uint32(room))[same], minlength=n * BUCKETS)
    out[:] = np.sqrt(total.reshape(n, BUCKETS))
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.maximum(norm, 1e-9)


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 30.0, rounds: int = 150) -> np.ndarray:
    """Weights and bias of a squared-hinge SVM (y in -1, 1), by accelerated gradient steps."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = np.zeros(x.shape[1] + 1, np.float32)
    ahead, t = w.copy(), 1.0
    step = 1.0 / (1.0 / c + 4.0)
    for _ in range(rounds):
        slack = weight * y * np.maximum(0, 1 - y * (x @ ahead[:-1] + ahead[-1]))
        pull = np.append(slack @ x, slack.sum())
        new = ahead - step * (ahead / c - 2 * pull)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead, w, t = new + ((t - 1) / t_new) * (new - w), new, t_new
    return w


def _snippets(texts: list[str], langs: list[str]) -> tuple[list[str], list[str]]:
    """Each text, and three short pieces of it: short documents look like those."""
    more, labels = list(texts), list(langs)
    for t, lang in zip(texts, langs, strict=True):
        for share, size in ((0.15, 24), (0.45, 60), (0.75, 150)):
            if len(t) > 2 * size:
                at = int(len(t) * share)
                more.append(t[at : at + size])
                labels.append(lang)
    return more, labels


class Model:
    """Families, the languages of each, and the weights of every decision."""

    def __init__(self, texts: list[str], langs: list[str]):
        self.languages = sorted(set(langs))
        self.families = sorted({family(x) for x in self.languages})
        self.by_family = [[i for i, x in enumerate(self.languages) if family(x) == f] for f in self.families]
        texts, langs = _snippets(texts, langs)
        x = np.empty((len(texts), BUCKETS), np.float32)
        for i in range(0, len(texts), 200):
            x[i : i + 200] = features(pa.array(texts[i : i + 200], pa.large_string()))
        code = np.array([self.languages.index(v) for v in langs], np.int64)
        of = np.zeros(len(self.languages), np.int64)
        for k, members in enumerate(self.by_family):
            of[members] = k
        sign = lambda hit: np.where(hit, 1, -1).astype(np.float32)
        self.coarse = [linear_svm(x, sign(of[code] == k)) for k in range(len(self.families))] if len(self.families) > 1 else []
        self.pairs = {}
        for members in self.by_family:
            for a, b in itertools.combinations(members, 2):
                rows = (code == a) | (code == b)
                self.pairs[a, b] = linear_svm(x[rows], sign(code[rows] == a))

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        x = features(texts)
        n = len(x)
        sure = np.ones(n)
        chosen = np.zeros(n, np.int64)
        if self.coarse:
            margins = np.stack([x @ w[:-1] + w[-1] for w in self.coarse], axis=1)
            chosen = margins.argmax(axis=1)
            power = np.exp(4 * (margins - margins.max(axis=1, keepdims=True)))
            sure = 1 / power.sum(axis=1)
        lang = np.zeros(n, np.int64)
        for k, members in enumerate(self.by_family):
            rows = np.flatnonzero(chosen == k)
            if not len(rows):
                continue
            if len(members) == 1:
                lang[rows] = members[0]
                continue
            votes, belief = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            for (i, a), (j, b) in itertools.combinations(enumerate(members), 2):
                w = self.pairs[a, b]
                p = 1 / (1 + np.exp(-4 * np.clip(x[rows] @ w[:-1] + w[-1], -20, 20)))
                votes[:, i] += p >= 0.5
                votes[:, j] += p < 0.5
                belief[:, i] += p
                belief[:, j] += 1 - p
            best = (votes + belief / (len(members) + 1)).argmax(axis=1)
            lang[rows] = np.array(members)[best]
            sure[rows] *= belief[np.arange(len(rows)), best] / (len(members) - 1)
        known = [bool(t) and self._letters(t) for t in texts.to_pylist()]
        names = [self.languages[v] if ok else UNKNOWN for v, ok in zip(lang, known, strict=True)]
        return names, np.where(known, np.clip(sure, 0, 1), 0.0)

    @staticmethod
    def _letters(text: str) -> bool:
        return any(map(str.isalpha, text))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Learn from the rows given: a sample spread by a hash of the id, bounded for each language."""
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l")).where(
        "t is not null and l is not null"
    )
    counts = {r["l"]: r["count"] for r in rows.groupBy("l").count().orderBy(F.desc("count"), "l").limit(SAMPLE).collect()}
    if not counts:
        return None
    each = max(1, min(PER_LANGUAGE, SAMPLE // len(counts)))
    # 1.3 times what is wanted, then the exact bound: a hash never gives just the share asked for.
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, 1.3 * each / n + 20 / n)))])
    point = (F.xxhash64("i", F.lit("language sample")).bitwiseAND(F.lit((1 << 30) - 1))) / float(1 << 30)
    drawn = (
        rows.withColumn("p", point)
        .where(F.col("p") < F.try_element_at(share, F.col("l")))
        .select("l", "p", F.expr("substring(t, 1 + cast(p * 1e6 as int) % greatest(1, length(t) - 4000), 4000)").alias("t"))
        .orderBy("p", "t")
        .limit(2 * SAMPLE)
        .collect()
    )
    texts: list[str] = []
    langs: list[str] = []
    seen: dict[str, int] = {}
    for r in drawn:
        if seen.setdefault(r["l"], 0) < each and any(map(str.isalpha, r["t"])):
            seen[r["l"]] += 1
            texts.append(r["t"])
            langs.append(r["l"])
    return Model(texts, langs) if texts else None


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The given columns, ``lang_pred`` and ``score`` for every row."""
    spark = docs.sparkSession
    common.ship(spark)
    wanted = list(dict.fromkeys((id_col, text_col, *keep)))
    source = docs.select(*wanted)
    out_names = [c for c in wanted if c != text_col or text_col in keep]
    schema = source.select(*out_names).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.pieces(batches, text_col):
            texts = batch.column(wanted.index(text_col))
            if model is None:
                names, sure = [UNKNOWN] * len(texts), np.zeros(len(texts))
            else:
                names, sure = model.predict(texts)
            kept = [batch.column(wanted.index(c)) for c in out_names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names, pa.string()), pa.array(sure, pa.float64())], [*out_names, "lang_pred", "score"]
            )

    return source.mapInArrow(run, schema)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op8_language_id(spark, sf_dir):
    """Predicted language of every document; a quarter is never learned from."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = fit(docs.where(~F.col("held_out")))
    return predict(docs, model, keep=("held_out",)).select("doc_id", "held_out", "lang_pred", "score")
