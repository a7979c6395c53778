"""Word arrays over batches of whole texts, with numpy.

A batch of texts becomes one byte array with a line feed between documents;
words are runs of word bytes, each with a 64-bit hash, its document and its
place. Texts are worked on ``CHUNK`` bytes at a time (a longer text alone), so
memory is a small multiple of that or of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash

#: Bytes of texts worked on at a time.
CHUNK = 1 << 19
#: Longer words are hashed one by one.
LONG_WORD = 128
_MASK = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def chunks(texts: list[bytes], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` whose bytes stay under ``limit`` (one text at least)."""
    lo = size = 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def texts_of(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null becomes empty."""
    return [b"" if v is None else v for v in column.cast("binary").to_pylist()]


@dataclass
class Words:
    """Words of a batch in reading order."""
    buf: np.ndarray      # bytes of the texts, case-folded, with separators
    start: np.ndarray    # first byte of each word in buf
    end: np.ndarray      # one past its last byte
    doc: np.ndarray      # index of the word's text in the batch
    hash: np.ndarray     # uint64

    def per_doc(self, n: int) -> np.ndarray:
        """Offsets of the n documents' words: document i has [o[i], o[i+1])."""
        return np.searchsorted(self.doc, np.arange(n + 1))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def join(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes, each followed by a line feed, and where each starts."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    starts = np.zeros(len(texts), np.int64)
    np.cumsum([len(t) + 1 for t in texts[:-1]], out=starts[1:])
    return raw, starts


def fold(raw: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and for the Latin-1 letters of two UTF-8 bytes."""
    low = _LOWER[raw]
    second = np.flatnonzero(raw[:-1] == 0xC3) + 1
    second = second[(raw[second] >= 0x80) & (raw[second] <= 0x9E) & (raw[second] != 0x97)]
    low[second] += 0x20
    return low


def _words(buf: np.ndarray, mask: np.ndarray, starts: np.ndarray) -> Words:
    # the last byte of buf is a separator, so every word ends inside
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if mask[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[::2], edge[1::2]
    first = np.searchsorted(start, starts)
    doc = np.repeat(np.arange(len(starts)), np.diff(first, append=len(start)))
    return Words(buf, start, end, doc, hash_words(buf, start, end))


def space_words(texts: list[bytes]) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased."""
    raw, starts = join(texts)
    return _words(_LOWER[raw], ~_SPACE[raw], starts)


def alnum_words(texts: list[bytes]) -> tuple[Words, np.ndarray]:
    """Runs of letters, digits and non-ASCII bytes, case-folded, and the raw
    bytes. A point or comma between two digits belongs to the number."""
    raw, starts = join(texts)
    mask = _ALNUM[raw]
    dig = DIGIT[raw]
    sep = ((raw == 46) | (raw == 44))
    sep[1:-1] &= dig[:-2] & dig[2:]
    sep[0] = sep[-1] = False
    return _words(fold(raw), mask | sep, starts), raw


def hash_words(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes, eight at a time."""
    if not len(start):
        return np.empty(0, np.uint64)
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    lanes = np.ndarray((len(buf),), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    length = end - start
    out = mix64((lanes[start] & _MASK[np.minimum(length, 8)]) + length.astype(np.uint64) * _BASE)
    at = 8
    rest = np.flatnonzero((length > 8) & (length <= LONG_WORD))
    while len(rest):
        out[rest] = mix64(out[rest] * _M1 + (lanes[start[rest] + at] & _MASK[np.minimum(length[rest] - at, 8)]))
        at += 8
        rest = rest[length[rest] > at]
    for i in np.flatnonzero(length > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(buf[start[i]:end[i]].tobytes())
    return out


def windows(h: np.ndarray, doc: np.ndarray, offsets: tuple[int, ...], salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the words at ``i + offset`` for every i whose words all lie in
    one document; the hashes and the indexes i."""
    span = offsets[-1]
    n = len(h) - span
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.full(n, salt * 2 + 1, np.uint64)
    for j, o in enumerate(offsets):
        factor = mix64(np.array([salt * 1000 + j + 1], np.uint64))[0] | np.uint64(1)
        total += h[o:o + n] * factor
    at = np.flatnonzero(doc[:n] == doc[span:])
    return mix64(total[at]), at
