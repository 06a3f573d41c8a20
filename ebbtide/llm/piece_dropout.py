"""SentencePiece BPE encoding with seeded merge dropout, and decoding.

The vocabulary file of a public BPE model is read, never trained. A text becomes
characters (a space is the mark U+2581, one mark stands before the text), cut
where no piece of the vocabulary reaches across. Each stretch has an agenda of
adjacent symbols whose union is a piece; the best-ranked candidate, leftmost
among equals, is merged until none is left. A candidate is skipped when a hash
of (seed, document, place of its left symbol, piece) is below ``dropout``, so a
run with the same seed repeats and another seed segments anew. With dropout 0
the result is that of the model itself.

Stretches of a batch go through their agendas in lockstep: one NumPy step takes
the best candidate of every stretch. Stretches over ``LOCKSTEP`` characters use a
heap. Characters without a piece become byte pieces; so does a U+2581 of the text
itself, which is why decoding gives back every text exactly.

Nulls, edges: a null text has null pieces and decodes to null, an empty one has
none and decodes to an empty one. A null id counts as its own document key.
Repeated rows give equal results, whole texts are encoded however long, an empty
table gives no rows, and only the two named columns are read.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from ebbtide.llm import common

MODEL = os.environ.get("EBBTIDE_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
DROPOUT, SEED, LOCKSTEP = 0.1, 20240311, 64
MARK = 0x2581
_NONE = np.int32(2**31 - 1)
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Vocabulary:
    """Tables of a BPE model with byte pieces: characters, pairs, ranks and the bytes of pieces."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        usable = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(n)]
        score = np.array([model.get_score(i) for i in range(n)])
        # Equal scores share a rank: the leftmost candidate then goes first.
        self.rank = np.unique(-score, return_inverse=True)[1].astype(np.int32)
        ids = {names[i]: i for i in range(n) if usable[i]}
        self.char = np.full(0x110000, -1, np.int32)
        for name, i in ids.items():
            if len(name) == 1:
                self.char[ord(name)] = i
        self.byte = np.zeros(256, np.int32)
        for i in range(n):
            if model.is_byte(i):
                self.byte[int(names[i][3:-1], 16)] = i
        pairs = {}
        inner = set()
        for name, i in ids.items():
            for k in range(1, len(name)):
                inner.add((ord(name[k - 1]), ord(name[k])))
                a, b = ids.get(name[:k]), ids.get(name[k:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = i
        self.pairs = pairs
        self.inner = np.sort(np.array([a << 21 | b for a, b in inner], np.int64))
        self.close = np.zeros((512, 512), bool)
        for a, b in inner:
            if (a < 511 or a == MARK) and (b < 511 or b == MARK):
                self.close[min(a, 511), min(b, 511)] = True
        self.bits = max(16, (4 * len(pairs)).bit_length())
        size = 1 << self.bits
        self.slot_key = np.full(size, -1, np.int64)
        self.slot_piece = np.full(size, -1, np.int32)
        for key, piece in pairs.items():
            at = self._slot(np.array([key], np.int64))[0]
            while self.slot_key[at] >= 0:
                at = (at + 1) & (size - 1)
            self.slot_key[at], self.slot_piece[at] = key, piece
        spelled = []
        for i, name in enumerate(names):
            if model.is_byte(i):
                spelled.append(bytes([int(name[3:-1], 16)]))
            else:
                spelled.append(name.replace("▁", " ").encode() if usable[i] else b"")
        self.spell_at = np.concatenate(([0], np.cumsum([len(s) for s in spelled])))
        self.spell = np.frombuffer(b"".join(spelled), np.uint8)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * _C1) >> np.uint64(64 - self.bits)).astype(np.int64)

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that two adjacent symbols make, -1 if none."""
        key = a.astype(np.int64) << 20 | b
        key[(a < 0) | (b < 0)] = -2
        at = self._slot(key)
        held = self.slot_key[at]
        out = np.where(held == key, self.slot_piece[at], np.int32(-1))
        todo = np.flatnonzero((held != key) & (held >= 0) & (key >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.slot_key) - 1)
            held = self.slot_key[at[todo]]
            hit = held == key[todo]
            out[todo[hit]] = self.slot_piece[at[todo[hit]]]
            todo = todo[~hit & (held >= 0)]
        return out


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def document_key(doc_id: int | None, seed: int) -> int:
    return zlib.crc32(str(doc_id).encode()) << 32 ^ (seed * 0x9E3779B1 & 0xFFFFFFFFFFFFFFFF)


def _skipped(key: np.ndarray, place: np.ndarray, piece: np.ndarray, limit: np.uint64) -> np.ndarray:
    return common.mix(key + place.astype(np.uint64) * _C1 + piece.astype(np.uint64) * _C2) < limit


def _lockstep(v: Vocabulary, symbols: np.ndarray, key: np.ndarray, place: np.ndarray, limit: np.uint64) -> np.ndarray:
    """Merge every row of ``symbols`` (padded with -1); merged-away cells become -2."""
    m, n = symbols.shape
    width = n + 1
    cell = np.full((m, width), -1, np.int32)
    cell[:, :n] = symbols
    piece = np.full((m, width), -1, np.int32)
    piece[:, : n - 1] = v.merge(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(m, n - 1)
    rank = np.where(piece >= 0, v.rank[piece], _NONE)
    if limit:
        r, c = np.nonzero(piece >= 0)
        rank[r, c] = np.where(_skipped(key[r], place[r] + c, piece[r, c], limit), _NONE, rank[r, c])
    after = np.tile(np.arange(1, width + 1, dtype=np.int64), (m, 1))
    before = np.tile(np.arange(-1, n, dtype=np.int64), (m, 1))
    after[:, n - 1 :] = n
    before[:, 0] = n
    base = np.arange(m, dtype=np.int64) * width
    cell_f, piece_f, rank_f, after_f, before_f = (x.ravel() for x in (cell, piece, rank, after, before))
    rows = np.arange(m)
    while len(rows):
        j = rank[rows].argmin(axis=1) if len(rows) < m else rank.argmin(axis=1)
        a = base[rows] + j
        live = rank_f[a] != _NONE
        rows, a = rows[live], a[live]
        if not len(rows):
            break
        off = base[rows]
        b = off + after_f[a]
        c = off + after_f[b]
        p = off + before_f[a]
        joined = piece_f[a]
        cell_f[a] = joined
        cell_f[b] = -2
        rank_f[b] = _NONE
        after_f[a] = after_f[b]
        before_f[c] = a - off
        # Cell n of a row stands for "nothing" on both sides; it never holds a symbol.
        both = v.merge(np.concatenate((joined, cell_f[p])), np.concatenate((cell_f[c], joined)))
        at = np.concatenate((a, p))
        ranks = np.where(both >= 0, v.rank[both], _NONE)
        if limit:
            some = np.flatnonzero(both >= 0)
            who = np.concatenate((rows, rows))[some]
            spot = at[some]
            ranks[some[_skipped(key[who], place[who] + (spot - base[who]), both[some], limit)]] = _NONE
        piece_f[at] = both
        rank_f[at] = ranks
        rank_f[off + n] = _NONE
    return cell[:, :n]


def _agenda(v: Vocabulary, symbols: np.ndarray, key: int, place: int, limit: int) -> np.ndarray:
    """The same for one long stretch, by a heap."""
    s = symbols.tolist()
    n = len(s)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(a: int, b: int) -> None:
        if a < 0 or b >= n or s[a] < 0 or s[b] < 0:
            return
        piece = v.pairs.get(s[a] << 20 | s[b])
        if piece is None:
            return
        if limit and bool(_skipped(np.array([key], np.uint64), np.array([place + a]), np.array([piece]), np.uint64(limit))[0]):
            return
        heapq.heappush(heap, (int(v.rank[piece]), a, b, piece))

    for i in range(n - 1):
        offer(i, i + 1)
    held = {}
    while heap:
        _, a, b, piece = heapq.heappop(heap)
        if s[a] < 0 or s[b] < 0 or after[a] != b or v.pairs.get(s[a] << 20 | s[b]) != piece:
            continue
        s[a], s[b] = piece, -2
        after[a] = after[b]
        if after[b] < n:
            before[after[b]] = a
        held[a] = piece
        offer(a, after[a])
        offer(before[a], a)
    return np.array(s, np.int32)


def encode_texts(v: Vocabulary, texts: list[str], keys: list[int], dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts end to end, and where each text's begin."""
    limit = np.uint64(min(int(dropout * 2**64), 2**64 - 1))
    coded = [("▁" + t).encode("utf-32-le") if t else b"" for t in texts]
    at = np.concatenate(([0], np.cumsum([len(c) // 4 for c in coded])))
    chars = np.frombuffer(b"".join(coded), np.uint32).astype(np.int64)
    n = len(chars)
    if not n:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    heads = at[:-1][np.diff(at) > 0]
    own_mark = chars == MARK
    own_mark[heads] = False
    chars = np.where(chars == 32, MARK, chars)
    symbol = v.char[chars]
    symbol[own_mark] = -1
    # Cut where no piece reaches across.
    low = np.where(chars == MARK, 511, np.minimum(chars, 510 + 2))
    small = low < 512
    low = np.where(small, low, 0)
    tied = v.close[low[:-1], low[1:]] & small[:-1] & small[1:]
    odd = np.flatnonzero(~(small[:-1] & small[1:]))
    if len(odd):
        pair = chars[odd] << 21 | chars[odd + 1]
        where = np.minimum(np.searchsorted(v.inner, pair), len(v.inner) - 1)
        tied[odd] = v.inner[where] == pair
    tied &= (symbol[:-1] >= 0) & (symbol[1:] >= 0)
    start = np.ones(n, bool)
    start[1:] = ~tied
    start[heads] = True
    first = np.flatnonzero(start)
    size = np.diff(np.append(first, n))
    doc = np.searchsorted(at, first, "right") - 1
    key = np.array(keys, np.uint64)[doc]
    place = first - at[doc]
    out = symbol.copy()
    edges = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, LOCKSTEP)
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        some = np.flatnonzero((size > lo) & (size <= hi))
        step = max(1, (1 << 18) // hi)
        for a in range(0, len(some), step):
            u = some[a : a + step]
            where = first[u, None] + np.arange(hi)
            inside = np.arange(hi) < size[u, None]
            grid = np.where(inside, symbol[np.minimum(where, n - 1)], np.int32(-1))
            done = _lockstep(v, grid, key[u], place[u], limit)
            out[where[inside]] = done[inside]
    for u in np.flatnonzero(size > LOCKSTEP):
        a, b = first[u], first[u] + size[u]
        out[a:b] = _agenda(v, symbol[a:b], int(key[u]), int(place[u]), int(limit))
    # A character without a piece takes its UTF-8 bytes, a merged one nothing.
    lost = np.flatnonzero(out == -1)
    width = (out >= 0).astype(np.int64)
    code = chars[lost]
    code[own_mark[lost]] = MARK
    width[lost] = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
    to = np.concatenate(([0], np.cumsum(width)))
    ids = np.empty(to[-1], np.int32)
    ids[to[:-1][out >= 0]] = out[out >= 0]
    for length in (1, 2, 3, 4):
        pick = width[lost] == length
        c, spot = code[pick], to[lost[pick]]
        if length == 1:
            ids[spot] = v.byte[c]
            continue
        lead = {2: 0xC0, 3: 0xE0, 4: 0xF0}[length]
        ids[spot] = v.byte[lead | c >> 6 * (length - 1)]
        for k in range(1, length):
            ids[spot + k] = v.byte[0x80 | c >> 6 * (length - 1 - k) & 0x3F]
    return ids, to[at]


def decode_ids(v: Vocabulary, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
    """UTF-8 bytes of every text; the mark before it goes."""
    size = (v.spell_at[1:] - v.spell_at[:-1])[ids]
    to = np.concatenate(([0], np.cumsum(size)))
    step = np.repeat(v.spell_at[ids] - to[:-1], size)
    data = v.spell[np.arange(to[-1]) + step].tobytes()
    return [data[to[a] + 1 : to[b]] if b > a else b"" for a, b in zip(at[:-1], at[1:], strict=True)]


def encode(
    docs: DataFrame,
    model_file: str = MODEL,
    dropout: float = DROPOUT,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    out_col: str = "pieces",
) -> DataFrame:
    """The given columns and the piece ids of the text."""
    common.ship(docs.sparkSession)
    wanted = list(dict.fromkeys((id_col, *keep, text_col)))
    kept = [c for c in wanted if c != text_col or text_col in keep]
    source = docs.select(*wanted)
    schema = source.select(*kept).schema.add(out_col, ArrayType(IntegerType()))
    where = wanted.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model_file)
        for batch in common.pieces(batches, text_col, 1 << 19):
            texts = batch.column(where).to_pylist()
            keys = [document_key(i, seed) for i in batch.column(0).to_pylist()]
            ids, at = encode_texts(v, texts, keys, dropout)
            pieces = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
            if batch.column(where).null_count:
                pieces = pa.compute.if_else(batch.column(where).is_valid(), pieces, pa.scalar(None, pieces.type))
            yield pa.RecordBatch.from_arrays([*(batch.column(wanted.index(c)) for c in kept), pieces], [*kept, out_col])

    return source.mapInArrow(run, schema)


def decode(encoded: DataFrame, model_file: str = MODEL, pieces_col: str = "pieces", keep: tuple[str, ...] = ("doc_id",), out_col: str = "text") -> DataFrame:
    """The given columns and the text that the pieces spell."""
    common.ship(encoded.sparkSession)
    source = encoded.select(*keep, pieces_col)
    schema = source.select(*keep).schema.add(out_col, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model_file)
        for batch in batches:
            for a in range(0, batch.num_rows, 100):
                part = batch.slice(a, 100)
                lists = part.column(len(keep))
                at = np.concatenate(([0], np.cumsum(pa.compute.list_value_length(lists).fill_null(0).to_numpy()))).astype(np.int64)
                texts = decode_ids(v, np.asarray(lists.flatten()), at)
                valid = lists.is_valid().to_pylist()
                out = pa.array([t if ok else None for t, ok in zip(texts, valid, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), out.cast(pa.string())], [*keep, out_col])

    return source.mapInArrow(run, schema)


def op5_piece_dropout(spark, sf_dir):
    """Every document encoded with dropout and decoded: pieces, their digest, and that of the decoded text."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("source_sha256"))
    encoded = encode(docs, keep=("source_sha256",))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(MODEL)
        for batch in batches:
            lists = batch.column(2)
            length = pa.compute.list_value_length(lists).fill_null(0).to_numpy()
            at = np.concatenate(([0], np.cumsum(length))).astype(np.int64)
            ids = np.asarray(lists.flatten())
            out = [hashlib.sha256(t).hexdigest() for a in range(0, len(length), 100) for t in decode_ids(v, ids[at[a] : at[min(a + 100, len(length))]], at[a : a + 101] - at[a])]
            crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            source = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(length.astype(np.int64)),
                    pa.array(crc, pa.int64()),
                    pa.array(out),
                    pa.array([a == b for a, b in zip(out, source, strict=True)]),
                ],
                ["doc_id", "n_pieces", "pieces_crc32", "decoded_sha256", "lossless"],
            )

    return encoded.mapInArrow(digest, "doc_id long, n_pieces long, pieces_crc32 long, decoded_sha256 string, lossless boolean")
