"""Words of Arrow text columns as 64-bit hashes, vectorised over many documents at once.

A word is a maximal run of word bytes of the UTF-8 text after A-Z became a-z.  Every word separator
used here is ASCII, so working on bytes gives exactly the words of the text.
The hash of a word is a polynomial over random byte values, taken from prefix sums modulo 2**64, so a
buffer costs a handful of numpy passes instead of a Python step per word.
Memory: documents are handled in groups of about ``GROUP_BYTES``; a longer document is cut at
separators, so only its word hashes (not the per-byte arrays) are held whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# [^\x20\x09-\x0D]+
SPACE_WORDS = np.ones(256, dtype=bool)
SPACE_WORDS[[32, 9, 10, 11, 12, 13]] = False

# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM_WORDS = np.zeros(256, dtype=bool)
ALNUM_WORDS[48:58] = ALNUM_WORDS[97:123] = ALNUM_WORDS[128:] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.default_rng(20240601).integers(1, 2**63, size=256, dtype=np.uint64)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, GROUP_BYTES * 2)
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        for name, step in (("up", _BASE), ("down", inverse)):
            p = np.full(size, step, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


@dataclass
class Words:
    """Words of rows ``first .. first + len(bounds) - 2``: row ``i`` has words ``bounds[i]:bounds[i + 1]``."""

    first: int
    bounds: np.ndarray
    hashes: np.ndarray  # uint64
    endings: np.ndarray | None = None  # uint16: the last two bytes of each word

    def rows(self) -> Iterator[tuple[int, np.ndarray]]:
        for i in range(len(self.bounds) - 1):
            yield self.first + i, self.hashes[self.bounds[i] : self.bounds[i + 1]]

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def _hash_buffer(data: np.ndarray, cuts: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and endings of the words of ``data`` and the word count before each of ``cuts`` (row borders)."""
    starts, ends, hashes = word_spans(data, cuts, table)
    last = _LOWER[data[ends - 1]].astype(np.uint16)
    before = np.where(ends - starts > 1, _LOWER[data[np.maximum(ends - 2, 0)]], 0).astype(np.uint16)
    return hashes, before * np.uint16(256) + last, np.searchsorted(starts, cuts)


def word_spans(data: np.ndarray, cuts: np.ndarray, table: np.ndarray = SPACE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of the words of ``data``; each of ``cuts`` ends a word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    data = _LOWER[data]
    word = table[data]
    up, down = _powers(len(data))
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_RANDOM[data] * up[: len(data)], out=sums[1:])
    before = np.empty(len(data), dtype=bool)
    before[0] = False
    before[1:] = word[:-1]
    inner = cuts[(cuts > 0) & (cuts < len(data))]
    before[inner] = False  # a row border ends a word
    starts = np.flatnonzero(word & ~before)
    after = np.empty(len(data), dtype=bool)
    after[-1] = False
    after[:-1] = word[1:]
    after[inner - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, mix((sums[ends] - sums[starts]) * down[starts])


def _long_text(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts, at = [(np.zeros(0, np.uint64), np.zeros(0, np.uint16))], 0
    while at < len(data):
        end = min(len(data), at + GROUP_BYTES)
        while end < len(data):  # move on to a separator; a single enormous word is taken whole
            gap = np.flatnonzero(~table[_LOWER[data[end : end + GROUP_BYTES]]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(data), end + GROUP_BYTES)
        parts.append(_hash_buffer(data[at:end], np.array([0]), table)[:2])
        at = end
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    return offsets, np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)


def groups(offsets: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row stands alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def words_of(column: pa.Array, table: np.ndarray = SPACE_WORDS) -> Iterator[Words]:
    """Word hashes of a string column, in groups of rows."""
    offsets, data = text_bytes(column)
    for first, last in groups(offsets):
        part = data[offsets[first] : offsets[last]]
        if last - first == 1 and len(part) > GROUP_BYTES:
            hashes, endings = _long_text(part, table)
            yield Words(first, np.array([0, len(hashes)]), hashes, endings)
        else:
            cuts = (offsets[first : last + 1] - offsets[first]).astype(np.int64)
            hashes, endings, bounds = _hash_buffer(part, cuts, table)
            bounds = bounds.copy()
            bounds[-1] = len(hashes)
            yield Words(first, bounds, hashes, endings)


def hash_words(words: list[str], table: np.ndarray = SPACE_WORDS) -> np.ndarray:
    """The hashes that ``words_of`` gives for single words."""
    out = [w.hashes[0] if len(w.hashes) else np.uint64(0) for x in words for w in words_of(pa.array([x]), table)]
    return np.array(out, dtype=np.uint64)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words; a shorter text is one shingle, no words are none."""
    n = len(words)
    if n == 0:
        return words
    width = min(n, k)
    out = np.full(n - width + 1, 0x1234567 + width, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            out = (out ^ words[j : n - width + 1 + j]) * np.uint64(0x9E3779B185EBCA87)
            out ^= out >> np.uint64(29)
    return mix(out)
