"""Words and word shingles of many texts at once, as 64-bit hashes.

A word is a maximal run of bytes other than ASCII white space (0x09-0x0D, 0x20);
A-Z are lower-cased first. Everything works on the bytes of all texts of a batch
in one pass of NumPy.
"""

from __future__ import annotations

import numpy as np

from ebbtide.llm.common import mix

_WIDE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes that part words when punctuation does not count: all ASCII but letters and digits.
NOT_LETTERS = np.ones(256, bool)
NOT_LETTERS[128:] = NOT_LETTERS[48:58] = NOT_LETTERS[65:91] = NOT_LETTERS[97:123] = False
#: A random value for each byte, the same everywhere.
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _WIDE)
_BASE, _INVERSE = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)
#: Bytes that one pass works on.
CHUNK = 1 << 20
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse, n of each at least; those of a
    chunk are kept."""
    if not _powers or n > len(_powers[0]):
        room = max(n, CHUNK + 1)
        ups = []
        for b in (_BASE, _INVERSE):
            p = np.full(room, b, np.uint64)
            p[0] = 1
            ups.append(np.multiply.accumulate(p))
        if room > CHUNK + 1:
            return ups[0], ups[1]
        _powers[:] = ups
    return _powers[0], _powers[1]


def _cut(data: np.ndarray, at: np.ndarray, space: np.ndarray, end: int) -> int:
    """The first place from ``end`` on where no word is cut: a space, or where a text begins."""
    border = int(at[np.searchsorted(at, end)])
    while end < border:
        ahead = space[data[end : min(border, end + CHUNK)]]
        if ahead.any():
            return end + int(ahead.argmax())
        end += len(ahead)
    return end


def words(data: np.ndarray, at: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end byte of every word, and for each text where its words begin (n + 1).

    Works on ``CHUNK`` bytes at a time (or one word, if that is longer), so that its
    memory is that of the words found, however long the texts are.
    """
    parts = []
    begin = 0
    while begin < len(data):
        end = begin + CHUNK
        end = len(data) if end >= len(data) else _cut(data, at, space, end)
        inner = at[np.searchsorted(at, begin, "right") : np.searchsorted(at, end)] - begin
        h, start, stop = _words(data[begin:end], inner, space)
        parts.append((h, start + begin, stop + begin))
        begin = end
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    h, start, stop = parts[0] if len(parts) == 1 else (np.concatenate(x) for x in zip(*parts, strict=True))
    return h, start, stop, np.searchsorted(start, at)


def _words(data: np.ndarray, inner: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word; texts begin at 0 and at ``inner``."""
    solid = ~space[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    begins[inner] = solid[inner]
    ends[inner - 1] = solid[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[_LOWER[data]] * up[: len(data)], out=total[1:])
    h = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * _WIDE)
    return h, start, end


def sequence_keys(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit keys of each text's word sequence."""
    out = []
    n = np.diff(first).astype(np.uint64)
    up, down = _power(len(h) + 1)
    for salt in (np.uint64(0x1B873593CC9E2D51), np.uint64(0x52DCE729DA3ED7A5)):
        total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(mix(h ^ salt) * up[: len(h)], out=total[1:])
        out.append(mix((total[first[1:]] - total[first[:-1]]) * down[first[:-1]] + n * salt))
    return out[0], out[1]


def shingles(h: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text in ascending order, and where each text's begin.

    A text of fewer words than ``width`` has its whole sequence as the one
    shingle; a text without words has none.
    """
    n = len(first) - 1
    count = np.diff(first)
    doc = np.repeat(np.arange(n), count)
    m = max(0, len(h) - width + 1)
    s = np.zeros(m, np.uint64)
    for i in range(width):
        s = s * np.uint64(0xA0761D6478BD642F) + h[i : i + m]
    whole = doc[:m] == doc[width - 1 :] if m else np.zeros(0, bool)
    s, owner = mix(s[whole]), doc[:m][whole]
    few = np.flatnonzero((count > 0) & (count < width))
    if len(few):
        one, _ = sequence_keys(h, first)
        s, owner = np.concatenate((s, one[few])), np.concatenate((owner, few))
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])
    s, owner = s[new], owner[new]
    return s, np.searchsorted(owner, np.arange(n + 1))
