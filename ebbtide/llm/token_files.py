"""Token ids of all documents in compressed binary files, in ascending order of document id.

Ids come from the installed tokenizer library; a document ends with id 0. A text
is cut at single spaces (which always begin a token), and of a batch of texts each
different piece between them is encoded once and kept by each worker, as is what
the library makes of a word (pieces are found again by hash and compared);
where white space stands beside a space, or the text holds the string of an added
token, the library encodes the whole text.

A file is one segment of whole documents:

    magic, sizes            fixed struct
    documents               ids and lengths, zlib
    shares                  ids that no guess hit and their shares of 2**16, shares of the guesses, zlib
    blocks                  byte size and crc32 of each
    payload                 the blocks, end to end

A block is ``BLOCK`` ids, coded on its own: all adaptive state starts anew. Each
id is one interval of a range coder. Order 2 predicts the id that last followed
the two before it, order 1 the one that last followed the one before, each with
a count of hits. Both counts, and whether the guesses agree, choose how the order-2
guess, the order-1 guess and, for all other ids, order 0 are mixed; the shares are
those of the whole segment. All numbers are whole and below 2**53, so every machine
decodes alike. All blocks of a segment advance together, one NumPy step for each
id place.

Files are written by Spark's own writer (raw bytes of one row, and the line end),
so task commits, retries and every file system work as for any table, and read
back with the binary-file source. A broken block fails its checksum.

Nulls, edges: a null text is empty and has the end id only. Null ids come first;
rows of one id go by a hash of the text, equal rows follow each other. A document
longer than a segment makes its own. An empty table gives no rows (and no files).
Only the two named columns are read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm import common
from ebbtide.session import scratch_path

TOKENIZER = os.environ.get("EBBTIDE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")
END_ID = 0
BLOCK, SEGMENT = 2048, 4_000_000
#: Chunks and words that a worker keeps, some 40 and 200 bytes each; texts that are encoded at once.
KEPT, KEPT_WORDS, AT_ONCE = 2_000_000, 200_000, 8 << 20
MAGIC = b"EBTK0002"
NO_ID = -(1 << 63)

# How the tokenizer parts a text before its merges, and its names of bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MARKS = ",.;:!?"
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]


class Encoder:
    """The library's tokenizer, with what it made of earlier words."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        other = [b for b in range(256) if b not in PLAIN_BYTES]
        self.names = {b: b for b in PLAIN_BYTES} | {b: 256 + k for k, b in enumerate(other)}
        self.space = chr(self.names[32])
        self.two_bytes = [i.to_bytes(2, "little") for i in range(1 << 16)]
        self.parts = regex.compile(PATTERN).findall
        self._forget()
        self.words: dict[str, bytes] = {}
        self.marks = {x: self._made(x) for x in MARKS}

    def _made(self, part: str) -> bytes:
        """What the library makes of one word."""
        plain = part.isascii() and part.isprintable()
        named = part.replace(" ", self.space) if plain else part.encode().decode("latin-1").translate(self.names)
        return b"".join([self.two_bytes[t.id] for t in self.model.tokenize(named)])

    def _ids(self, part: str) -> bytes:
        got = self.words.get(part)
        if got is None:
            if len(self.words) > KEPT_WORDS:
                self.words.clear()
            got = self.words[part] = self._made(part)
        return got

    def _chunk(self, chunk: str, lead: str) -> bytes | bool:
        """Ids of what stands between two spaces, False if white space makes it depend on more."""
        if chunk.isalpha():
            return self._made(lead + chunk)
        if not chunk or chunk[0].isspace():
            return False
        return b"".join(map(self._ids, self.parts(lead + chunk)))

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def _forget(self) -> None:
        """Known chunks, their hashes in order with the number of each, the ids of each after
        a space, end to end, and if the chunk is clear by itself."""
        self.known = pa.array([], pa.large_string())
        self.keys, self.key_of = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, "<u2")
        self.size = np.zeros(0, np.int32)
        self.clear = np.zeros(0, bool)

    def _find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of each text among the known chunks, -1 where it is none, and its hash.

        The known chunks are kept in order of their hashes, so a batch costs by its own size;
        a hash alone decides nothing, the strings are compared.
        """
        keys = pd.util.hash_array(texts.to_numpy(zero_copy_only=False), categorize=False)
        found = np.full(len(keys), -1, np.int64)
        if len(self.keys):
            order = np.argsort(keys)
            at = np.empty(len(keys), np.int64)
            at[order] = np.searchsorted(self.keys, keys[order])
            at = np.minimum(at, len(self.keys) - 1)
            like = np.flatnonzero(self.keys[at] == keys)
            number = self.key_of[at[like]]
            same = pa.compute.equal(self.known.take(pa.array(number)), texts.take(pa.array(like))).to_numpy(zero_copy_only=False)
            found[like[same]] = number[same]
        return found, keys

    def _keep(self, chunks: pa.Array, keys: np.ndarray) -> None:
        order = np.argsort(keys)
        keys = keys[order]
        at = np.searchsorted(self.keys, keys)
        self.key_of = np.insert(self.key_of, at, len(self.known) + order)
        self.keys = np.insert(self.keys, at, keys)
        self.known = pa.concat_arrays([self.known, chunks])

    def _numbers(self, chunks: pa.Array) -> np.ndarray:
        """Number of each chunk among the known ones; new ones are encoded and known from now on."""
        coded = chunks.dictionary_encode()
        if len(self.known) > KEPT:
            self._forget()
        found, keys = self._find(coded.dictionary)
        new = np.flatnonzero(found < 0)
        if len(new):
            each = coded.dictionary.take(pa.array(new))
            # A mark after a word is a token of its own, so what is known of the word serves.
            stems, _ = self._find(pa.compute.utf8_rtrim(each, characters=MARKS))
            to = np.cumsum(self.size, dtype=np.int64)
            raw = self.ids.tobytes()
            made: list[bytes | bool] = []
            for x, k in zip(each.to_numpy(zero_copy_only=False).tolist(), stems.tolist(), strict=True):
                if x[-1:] in self.marks and x[:-1].isalpha():
                    word = raw[2 * int(to[k] - self.size[k]) : 2 * int(to[k])] if k >= 0 else self._ids(" " + x[:-1])
                    made.append(word + self.marks[x[-1]])
                else:
                    made.append(self._chunk(x, " "))
            found[new] = len(self.known) + np.arange(len(new))
            self.clear = np.concatenate((self.clear, np.array([m is not False for m in made], bool)))
            self.size = np.concatenate((self.size, np.array([len(m or b"") // 2 for m in made], np.int32)))
            self.ids = np.concatenate((self.ids, np.frombuffer(b"".join(m or b"" for m in made), "<u2")))
            self._keep(each, keys[new])
        return found[np.asarray(coded.indices)]

    def encode_all(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (a null is empty) one after the other, 16 bits each, and the number of each text's.

        Ids are gathered by chunk number, so a chunk is encoded once. ``end`` follows every text.
        """
        texts = pa.compute.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        if not n:
            return np.zeros(0, "<u2"), np.zeros(0, np.int64)
        parted = pa.compute.split_pattern(texts, " ")
        first = np.asarray(parted.offsets).astype(np.int64)
        chunks = parted.flatten()
        first -= first[0]
        heads = first[:-1]
        number = self._numbers(chunks)
        alone = np.zeros(n, bool)
        for x in self.added:
            alone |= pa.compute.match_substring(texts, x).to_numpy(zero_copy_only=False)
        unclear = ~self.clear[number]
        unclear[heads] = False
        alone |= np.add.reduceat(unclear, heads, dtype=np.int64) > 0
        # Beside the known chunks: nothing, the end, and the first chunk of each text, which for
        # a text that the library encodes as a whole is all of it.
        own = []
        for i, head in enumerate(chunks.take(pa.array(heads)).to_pylist()):
            got = False if alone[i] else self._chunk(head, "") if head else b""
            if got is False:
                alone[i], got = True, self._whole(texts[i].as_py())
            own.append(got)
        none = len(self.size)
        number[np.repeat(alone, np.diff(first))] = none
        number[heads] = none + 2 + np.arange(n)
        number = np.insert(number, first[1:], none + 1)
        ids = np.concatenate((self.ids, np.frombuffer(end + b"".join(own), "<u2")))
        size = np.concatenate((self.size, np.array([0, len(end) // 2, *(len(x) // 2 for x in own)], np.int32)))
        each = size[number].astype(np.int64)
        shift = (np.cumsum(size, dtype=np.int64) - size)[number] - (np.cumsum(each) - each)
        at = np.repeat(shift, each)
        at += np.arange(len(at))
        return ids[at], np.add.reduceat(each, heads + np.arange(n))

    def encode(self, text: str) -> bytes:
        """Ids of a text, 16 bits each."""
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# Range coder over all blocks of a segment -----------------------------------

_H2, _H1 = 2048, 1024
#: Shares of the guesses are of 2**10, those of order 0 of 2**16. A coder's width lies between 2**32 and
#: 2**48: whole numbers below 2**53 are exact in doubles, and so are their floors and quotients cut down.
_MIX, _ORDER0 = 1 << 10, 1 << 16
_UNIT, _LEAST, _WORD, _FULL = 2.0**-26, 2.0**32, 2.0**16, 2.0**48
_CONTEXTS = 8 * 8 * 2


class _Model:
    """Adaptive state of each block (lane), and what it guesses of the next id.

    Both orders are the two rows of one array. An entry holds the guess and twice
    the count of hits (``id << 4 | 2 * count``); the context of the shares is both
    counts and whether both orders guess the same.
    """

    def __init__(self, lanes: int):
        self.entries = np.zeros(lanes * (_H2 + _H1), np.int32)
        lane = np.arange(lanes, dtype=np.int64)
        self.entry_at = np.stack((lane * _H2, lanes * _H2 + lane * _H1))
        self.mask = np.array([[_H2 - 1], [_H1 - 1]])
        self.last = np.zeros(lanes, np.int64)
        self.hashed = np.zeros((2, lanes), np.int64)
        self.place = np.zeros((2, lanes), np.int64)

    def ahead(self) -> None:
        """``guess`` of both orders, and the ``context`` of their shares."""
        hashed, place = self.hashed, self.place
        np.multiply(self.last, 30011, out=hashed[0])
        hashed[0] += hashed[1]
        np.multiply(self.last, 40503, out=hashed[1])
        np.right_shift(hashed, 5, out=place)
        place &= self.mask
        place += self.entry_at
        entry = self.entries.take(place)
        self.guess = entry >> 4
        entry &= 14
        self.count = entry
        self.context = entry[0] << 3
        self.context += entry[1]
        self.context += self.guess[0] == self.guess[1]

    def learn(self, ids: np.ndarray) -> np.ndarray:
        """Which orders were right."""
        right = self.guess == ids
        entry = self.count
        entry += 2
        np.minimum(entry, 14, out=entry)
        entry *= right
        entry += ids << 4
        self.entries[self.place] = entry
        self.last[:] = ids
        return right


def _shares(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids that are counted, ascending, and their shares of 2**16, one at least."""
    used = np.flatnonzero(count)
    count = count[used]
    share = np.maximum(1, count * (_ORDER0 - len(used)) // max(1, count.sum()))
    if len(share):
        share[count.argmax()] += _ORDER0 - share.sum()
    return used, share


def _tables(used: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = 1 << 16
    shares, below = np.zeros(size), np.zeros(size)
    shares[used] = share
    below[used] = np.cumsum(share) - share
    return shares, below, np.resize(np.repeat(used, share), size).astype(np.int32)


def _mix(seen: np.ndarray) -> np.ndarray:
    """Shares of 2**10 of the order-2 and the order-1 guess in each context, from how often each was right.

    ``seen`` has a column for neither, order 1 alone, order 2 alone, both. All that is
    left goes to order 0; nothing that can come has a share of 0.
    """
    total = np.maximum(1, seen.sum(1))
    a = np.clip(_MIX * (seen[:, 2] + seen[:, 3]) // total, 1, _MIX - 2)
    b = np.clip(_MIX * seen[:, 1] // total, 1, _MIX - 1 - a)
    b[1::2] = 0  # both guess the same
    return np.stack((a, b))


def encode_blocks(ids: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """The blocks, the ids of order 0 and their shares, and the shares of the guesses."""
    lanes = -(-len(ids) // BLOCK)
    grid = np.full(lanes * BLOCK, ids[-1], np.int32)
    grid[: len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, BLOCK).T[: len(ids)])
    model = _Model(lanes)
    # What was right at each place decides all shares: four cases for each context.
    case = np.empty(grid.shape, np.uint16)
    for row, at in zip(grid, case, strict=True):
        model.ahead()
        right = model.learn(row)
        np.left_shift(model.context, 2, out=at, casting="unsafe")
        at += right[0] * np.uint16(2)
        at += right[1]
    del model
    mix = _mix(np.bincount(case.ravel(), minlength=4 * _CONTEXTS).reshape(-1, 4))
    used, share = _shares(np.bincount(grid[case & 3 == 0], minlength=1))
    shares, below, _ = _tables(used, share)
    # Place and width of a guess (of 2**26); for others the place of order 0 and the width of each of its shares.
    a, b = mix * float(_ORDER0)
    none = np.zeros_like(a)
    first = np.stack((a + b, a, none, none), 1).ravel()
    wide = np.stack((_MIX - (a + b) / _ORDER0, b, a, a), 1).ravel()
    shares, below = np.append(shares, 1.0), np.append(below, 0.0)

    low, width = np.zeros(lanes), np.full(lanes, _FULL)
    room = 2 * len(grid) + 1
    # Words may be above 16 bits until what is carried is added to the ones before them.
    out = np.zeros(lanes * room, np.uint32)
    begin = np.arange(lanes, dtype=np.int64) * room
    at = begin.copy()
    for k in range(0, len(grid), 32):
        part = case[k : k + 32]
        size = wide.take(part)
        by_id = np.where(part & 3, len(shares) - 1, grid[k : k + 32])
        start = below.take(by_id)
        start *= size
        start += first.take(part)
        size *= shares.take(by_id)
        for begins, sizes in zip(start, size, strict=True):
            width *= _UNIT
            np.floor(width, out=width)
            begins *= width
            low += begins
            width *= sizes
            short = (width < _LEAST).nonzero()[0]
            while len(short):
                rest = low[short]
                word = np.floor(rest / _LEAST)
                to = at[short]
                out[to] = word
                at[short] = to + 1
                word *= _LEAST
                rest -= word
                low[short] = rest * _WORD
                rest = width[short] * _WORD
                width[short] = rest
                short = short[rest < _LEAST]
    out[at] = np.ceil(low / _LEAST)
    size = at + 1 - begin
    to = np.cumsum(size)
    word = out[np.repeat(begin - (to - size), size) + np.arange(to[-1])]
    over = np.flatnonzero(word >> 16)
    while len(over):
        carried = word[over] >> 16
        word[over] &= 0xFFFF
        over = over - 1
        word[over] += carried
        over = over[word[over] > 0xFFFF]
    word = word.astype("<u2")
    return [word[x:y].tobytes() for x, y in zip((to - size).tolist(), to.tolist(), strict=True)], used, share, mix


def decode_blocks(blocks: list[bytes], n: int, used: np.ndarray, share: np.ndarray, mix: np.ndarray) -> np.ndarray:
    lanes = len(blocks)
    size = np.array([len(b) // 2 for b in blocks])
    at = np.concatenate(([0], np.cumsum(size)))[:-1].astype(np.int64)
    end = at + size
    word = np.concatenate((np.frombuffer(b"".join(blocks), "<u2"), np.zeros(1, "<u2"))).astype(np.float64)
    last = len(word) - 1
    shares, below, inverse = _tables(used, share)
    of_2, of_1 = mix * float(_ORDER0)
    of_both, left = of_2 + of_1, _MIX - mix.sum(0).astype(np.float64)
    model = _Model(lanes)
    width, code = np.full(lanes, _FULL), np.zeros(lanes)
    for _ in range(3):
        code = code * _WORD + word[np.where(at < end, at, last)]
        at += 1
    out = np.empty((min(BLOCK, n), lanes), np.int32)
    for row in out:
        model.ahead()
        context = model.context
        width *= _UNIT
        np.floor(width, out=width)
        place = code / width
        np.floor(place, out=place)
        start, size = of_both.take(context), left.take(context)
        guessed = (place < start).nonzero()[0]
        spot = place - start
        spot /= size
        inverse.take(spot.astype(np.int32), out=row, mode="clip")
        start += size * below.take(row)
        size *= shares.take(row)
        if len(guessed):
            which = context[guessed]
            a = of_2[which]
            second = place[guessed] >= a
            row[guessed] = model.guess[second.astype(np.int8), guessed]
            start[guessed] = a * second
            size[guessed] = np.where(second, of_1[which], a)
        model.learn(row)
        start *= width
        code -= start
        width *= size
        more = (width < _LEAST).nonzero()[0]
        while len(more):
            spot = at[more]
            code[more] = code[more] * _WORD + word[np.where(spot < end[more], spot, last)]
            at[more] = spot + 1
            wider = width[more] * _WORD
            width[more] = wider
            more = more[wider < _LEAST]
    return np.ascontiguousarray(out.T).ravel()[:n]


# Segments -------------------------------------------------------------------

_SIZES = struct.Struct("<8sqqqqq")


def pack_segment(doc_ids: list[int], lengths: list[int], ids: np.ndarray) -> bytes:
    blocks, used, share, mix = encode_blocks(ids)
    docs = zlib.compress(np.array(doc_ids, "<i8").tobytes() + np.array(lengths, "<i8").tobytes(), 6)
    order0 = zlib.compress(used.astype("<u4").tobytes() + share.astype("<u4").tobytes() + mix.astype("<u4").tobytes(), 6)
    table = np.array([[len(b), zlib.crc32(b)] for b in blocks], "<u4").tobytes()
    return b"".join((_SIZES.pack(MAGIC, len(doc_ids), len(ids), len(docs), len(order0), len(used)), docs, order0, table, *blocks))


def unpack_segment(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, lengths, and all ids; raises where a checksum fails."""
    magic, n_docs, n, docs_size, order_size, n_used = _SIZES.unpack_from(content)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = _SIZES.size
    docs = np.frombuffer(zlib.decompress(content[at : at + docs_size]), "<i8")
    at += docs_size
    order0 = np.frombuffer(zlib.decompress(content[at : at + order_size]), "<u4").astype(np.int64)
    at += order_size
    n_blocks = -(-n // BLOCK)
    table = np.frombuffer(content, "<u4", 2 * n_blocks, at).reshape(-1, 2)
    at += 8 * n_blocks
    blocks = []
    for k, (size, crc) in enumerate(table.tolist()):
        block = content[at : at + size]
        if len(block) != size or zlib.crc32(block) != crc:
            raise ValueError(f"block {k} is broken")
        blocks.append(block)
        at += size
    used, share, mix = np.split(order0, (n_used, 2 * n_used))
    return docs[:n_docs], docs[n_docs:], decode_blocks(blocks, n, used, share, mix.reshape(2, _CONTEXTS))


def write(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode all texts and write the segments under ``path``, ordered by name."""
    spark = docs.sparkSession
    common.ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("tie"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        names: list[int] = []
        lengths: list[int] = []
        held: list[np.ndarray] = []
        size = 0
        end = np.array([END_ID], "<u2").tobytes()

        def flush() -> pa.RecordBatch:
            body = pack_segment(names, lengths, np.concatenate(held).astype(np.int32))
            names.clear(), lengths.clear(), held.clear()
            return pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], ["segment"])

        def gathered() -> Iterator[pa.Table]:
            waiting: list[pa.RecordBatch] = []
            for batch in common.pieces(batches, "text", AT_ONCE):
                waiting.append(batch)
                if sum(b.nbytes for b in waiting) >= AT_ONCE:
                    yield pa.Table.from_batches(waiting)
                    waiting.clear()
            if waiting:
                yield pa.Table.from_batches(waiting)

        for batch in gathered():
            ids, count = enc.encode_all(batch.column(1).combine_chunks(), end)
            at = 0
            for i, n in zip(batch.column(0).to_pylist(), count.tolist(), strict=True):
                names.append(NO_ID if i is None else i)
                lengths.append(n)
                held.append(ids[at : at + n])
                at += n
                size += n
                if size >= SEGMENT:
                    yield flush()
                    size = 0
        if names:
            yield flush()

    rows = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    segments = rows.mapInArrow(run, "segment binary")
    # A string column takes any bytes; the writer puts them out as they are, a file for each row.
    segments.select(F.col("segment").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    common.ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                names, lengths, ids = unpack_segment(batch.column(1)[k].as_py()[:-1])
                to = np.cumsum(lengths)
                four = ids.astype("<u4")
                crc = [zlib.crc32(four[a:b].tobytes()) for a, b in zip((to - lengths).tolist(), to.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column(0)[k].as_py()] * len(names), pa.string()),
                        pa.array(names.astype(np.int64)),
                        pa.array(to - lengths, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["file", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    docs = common.stage(
        files.select(name.alias("file"), "content").mapInArrow(run, "file string, doc_id long, inside long, n_tokens long, ids_crc32 long"), "tokens"
    )
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    totals = docs.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    totals = totals.select(F.col("file").alias("in_file"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return docs.join(totals, F.col("file") == F.col("in_file")).select(
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"),
        (F.col("before") + F.col("inside")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def op7_token_files(spark, sf_dir):
    """All documents as token files, written, and read back."""
    path = scratch_path(spark, "token-files")
    write(common.table(spark, sf_dir, "documents"), path)
    return read(spark, path)
