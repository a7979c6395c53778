"""Runs of periodically repeated words, found by block convolution.

The words of a batch of texts become one sequence of numbers, a number of its
own between two texts. At every dyadic scale B the sequence is cut into blocks
of B numbers; an exact integer transform gives, for each block, the sums of
squared differences to every window that starts B .. 2B-1 numbers later, and a
sum of zero is an occurrence. A stretch of period q (B <= q < 2B) that is at
least 4q long holds a whole block with its occurrence q numbers later, so every
run is met. Each (block, distance) is a seed: it is extended to the longest
stretch that keeps the distance as period, and stretches of at least
``REPEATS`` periods and ``SHORTEST`` words are runs.

The transform works modulo the prime 65537 with balanced residues in double
precision, where every sum is an exact integer; sums that are zero only modulo
the prime give seeds that the extension, on the words themselves, turns down.
Blocks longer than ``PROBE`` are looked for by their first ``PROBE`` numbers, so
memory is a small multiple of the text whatever the scale.

Defined results: a null or empty text has no words and no runs; a null doc_id
leaves its text as it is in :func:`planted`; every input row gives one row,
repeated rows included; an empty table gives none. Extra columns are ignored by
the digest and kept by :func:`collapse`.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean
from .tokens import chunks, mix64, texts_of

#: A run repeats its period at least so often and has at least so many words.
REPEATS, SHORTEST = 4, 6
#: Prime modulus of the transform, and an element of order 2^16 modulo it.
PRIME, ROOT = 65_537, 3
#: Most numbers of a block that one transform reads, and sizes done as one product.
PROBE, DIRECT = 512, 64
#: Numbers transformed at a time.
SLAB = 1 << 17
#: Moduli and bases of the two prefix hashes that extend seeds.
HASHES = ((2_147_483_647, 1_000_003), (2_013_265_921, 69_069))


def _reduce(x: np.ndarray) -> np.ndarray:
    """Balanced residues; exact for integers below 2^52."""
    return x - np.rint(x * (1.0 / PRIME)) * PRIME


@lru_cache(maxsize=None)
def _powers(size: int) -> np.ndarray:
    """Powers of a root of unity of order ``size``."""
    w = pow(ROOT, (PRIME - 1) // size, PRIME)
    out = [1]
    for _ in range(size - 1):
        out.append(out[-1] * w % PRIME)
    return np.array(out, np.int64)


@lru_cache(maxsize=None)
def _matrix(size: int, sign: int) -> np.ndarray:
    grid = np.outer(np.arange(size), np.arange(size)) * sign % size
    return _reduce(_powers(size)[grid].astype(np.float64))


class Transform:
    """The number-theoretic transform of rows of ``size`` numbers.

    Long rows are read as a matrix: a transform of its columns, twiddle factors,
    a transform of its rows. Frequencies stay in the order this gives (``freq``);
    the inverse reads them in the same order."""

    def __init__(self, size: int):
        self.size = size
        self.a = min(size, DIRECT)
        self.b = size // self.a
        k = np.arange(self.a)[:, None] + self.a * np.arange(self.b)[None, :]
        self.freq = k.reshape(-1)
        place = np.empty(size, np.int64)
        place[self.freq] = np.arange(size)
        self.negative = place[-self.freq % size]
        self.sign = np.where(self.freq % 2 == 0, 1.0, -1.0)
        twiddle = np.outer(np.arange(self.a), np.arange(self.b)) % size
        self.twiddle = _reduce(_powers(size)[twiddle].astype(np.float64))
        self.back = _reduce(_powers(size)[-twiddle % size].astype(np.float64))
        self.scale = float(pow(size, PRIME - 2, PRIME))

    def forward(self, x: np.ndarray) -> np.ndarray:
        """Transforms of rows of size / 2 numbers, zeros behind them."""
        if self.b == 1:
            return _reduce(x @ _matrix(self.a, 1)[:self.size // 2])
        n, half = len(x), self.a // 2
        y = x.reshape(n, half, self.b).transpose(0, 2, 1).reshape(-1, half)
        y = _reduce(y @ _matrix(self.a, 1)[:half]).reshape(n, self.b, self.a)
        y = _reduce(y * self.twiddle.T).transpose(0, 2, 1).reshape(-1, self.b)
        return _reduce(y @ _matrix(self.b, 1)).reshape(n, self.size)

    def inverse(self, t: np.ndarray) -> np.ndarray:
        """The first size / 2 numbers of each row."""
        n, half = len(t), self.a // 2
        if self.b == 1:
            y = _reduce(t @ _matrix(self.a, -1)[:, :self.size // 2])
        else:
            y = _reduce(t.reshape(-1, self.b) @ _matrix(self.b, -1)).reshape(n, self.a, self.b)
            y = _reduce(y * self.back).transpose(0, 2, 1).reshape(-1, self.a)
            y = _reduce(y @ _matrix(self.a, -1)[:, :half]).reshape(n, self.b, half)
            y = y.transpose(0, 2, 1).reshape(n, self.size // 2)
        return _reduce(y * self.scale)


@lru_cache(maxsize=None)
def _transform(size: int) -> Transform:
    return Transform(size)


class _Grid:
    """A sequence cut into blocks of ``probe`` numbers, with their transforms."""

    def __init__(self, values: np.ndarray, probe: int):
        self.probe, self.t = probe, _transform(2 * probe)
        blocks = -(-len(values) // probe)
        x = np.zeros((blocks + 2) * probe)
        x[:len(values)] = values
        self.n = blocks
        rows = x.reshape(-1, probe)
        self.spectrum = np.empty((len(rows), 2 * probe), np.float32)  # residues under 2^15 in size are exact
        step = max(1, SLAB // probe)
        for lo in range(0, len(rows), step):
            self.spectrum[lo:lo + step] = self.t.forward(rows[lo:lo + step])
        total = np.concatenate(([0], np.cumsum(x.astype(np.int64) ** 2)))
        self.own = total[probe::probe] - total[:-probe:probe]
        ends = total[probe:] - total[:-probe]
        self.window = ends[:(len(rows) - 1) * probe].reshape(-1, probe)

    def zeros(self, block: np.ndarray, ahead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (i, lag): the numbers of ``block[i]`` occur ``lag`` behind the
        start of the grid's block ``ahead[i]``."""
        rows, lags = [], []
        step = max(1, SLAB // self.probe)
        for lo in range(0, len(block), step):
            i, g = block[lo:lo + step], ahead[lo:lo + step]
            there = self.spectrum[g] + self.t.sign * self.spectrum[g + 1]
            here = self.spectrum[i][:, self.t.negative].astype(np.float64)
            cross = self.t.inverse(_reduce(here * _reduce(there)))
            gap = _reduce((self.own[i][:, None] + self.window[g]).astype(np.float64)) - 2 * cross
            r, lag = np.nonzero(_reduce(gap) == 0)
            rows.append(r + lo)
            lags.append(lag)
        return (np.concatenate(rows), np.concatenate(lags)) if rows else (np.empty(0, np.int64),) * 2


class _Prefixes:
    """Hashes of all prefixes modulo two primes, to compare long stretches."""

    def __init__(self, ids: np.ndarray):
        self.sums, self.powers = [], []
        for p, base in HASHES:
            power = np.ones(1, np.uint64)
            while len(power) <= len(ids):
                power = np.concatenate((power, power * np.uint64(pow(base, len(power), p)) % np.uint64(p)))
            power = power[:len(ids) + 1]
            term = mix64(ids.astype(np.uint64)) % np.uint64(p) * power[:-1] % np.uint64(p)
            self.sums.append(np.concatenate((np.zeros(1, np.uint64), np.cumsum(term) % np.uint64(p))))
            self.powers.append(power)

    def same(self, at: np.ndarray, d: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether ``length`` numbers from ``at`` on equal those ``d`` further."""
        out = np.ones(len(at), bool)
        for (p, _), s, w in zip(HASHES, self.sums, self.powers, strict=True):
            p = np.uint64(p)
            out &= (s[at + length] + p - s[at]) % p * w[d] % p == (s[at + d + length] + p - s[at + d]) % p
        return out


def _longest(ok, most: np.ndarray) -> np.ndarray:
    """Per entry the greatest length up to ``most`` for which ``ok`` holds."""
    low, high = np.zeros(len(most), np.int64), most.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_] + 1) // 2
        good = ok(open_, mid)
        low[open_[good]] = mid[good]
        high[open_[~good]] = mid[~good] - 1


def _extend(ids: np.ndarray, prefixes: _Prefixes, at: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past last number of the longest stretch of period ``d``
    around the seeds."""
    forth = _longest(lambda i, n: prefixes.same(at[i], d[i], n), len(ids) - at - d)
    back = _longest(lambda i, n: prefixes.same(at[i] - n, d[i], n), at.copy())
    return at - back, at + d + forth


def _checked(ids: np.ndarray, a: int, b: int, d: int, at: int) -> tuple[int, int]:
    """The stretch as the words themselves have it: hashes that meet by chance
    can only make it too long, then it is measured again from its seed."""
    if np.array_equal(ids[a:b - d], ids[a + d:b]):
        return a, b
    equal = ids[a:b - d] == ids[a + d:b]
    wrong = np.flatnonzero(~equal) + a
    lower, upper = wrong[wrong < at], wrong[wrong >= at]
    return (int(lower[-1]) + 1 if len(lower) else a), (int(upper[0]) + d if len(upper) else b)


def find_runs(ids: np.ndarray, parts: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period), by start and period, of a sequence made
    of parts of the given lengths. Parts must not share numbers across a border:
    what lies between them is the caller's (a number of its own per border), and
    parts come with the longest first, so that a scale reads a prefix only."""
    if not len(ids):
        return []
    values = _reduce((mix64(ids.astype(np.uint64)) % np.uint64(PRIME)).astype(np.float64))
    ends = np.cumsum(parts + 1)
    prefixes = None
    found: dict[tuple[int, int], int] = {}
    scale = 1
    while True:
        long_enough = np.flatnonzero(parts >= max(SHORTEST, REPEATS * scale))
        if not len(long_enough):
            return sorted((a, b - a, q) for (a, b), q in found.items())
        n = min(len(ids), int(ends[long_enough[-1]]))
        if scale <= PROBE:
            grid = _Grid(values[:n], scale)
        probe = grid.probe
        each = scale // probe
        used = -(-n // probe)
        blocks = np.repeat(np.arange(0, max(0, used - each), each), each)
        ahead = blocks + each + np.arange(len(blocks)) % each
        inside = ahead < used
        blocks, ahead = blocks[inside], ahead[inside]
        i, lag = grid.zeros(blocks, ahead)
        at, d = blocks[i] * probe, (ahead[i] - blocks[i]) * probe + lag
        # the probe must lie in the sequence; equal ends rule out most chance seeds
        last = at + d + probe - 1
        keep = last < len(ids)
        at, d, last = at[keep], d[keep], last[keep]
        keep = (ids[at] == ids[at + d]) & (ids[at + probe - 1] == ids[last])
        at, d = at[keep], d[keep]
        if len(at) and found:  # a stretch inside a run of a period up to the probe's length adds nothing
            known = np.zeros(len(ids) + 1, np.int64)
            for (a, b), q in found.items():
                if q <= probe:
                    known[a] = max(known[a], b)
            known = np.maximum.accumulate(known)
            keep = known[at] < at + d + probe
            at, d = at[keep], d[keep]
        if len(at):
            prefixes = prefixes or _Prefixes(ids)
            a, b = _extend(ids, prefixes, at, d)
            good = np.flatnonzero(b - a >= np.maximum(SHORTEST, REPEATS * d))
            _, first = np.unique(np.stack((d[good], a[good], b[good])), axis=1, return_index=True)  # by period
            for k in good[first].tolist():
                period = int(d[k])
                stretch = _checked(ids, int(a[k]), int(b[k]), period, int(at[k]))
                if stretch[1] - stretch[0] >= max(SHORTEST, REPEATS * period):
                    found.setdefault(stretch, period)
        scale *= 2


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which original word stands at each place of a text of n words, or None
    for the text as it is: a tenth of the ids get a periodic tail."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def _batch_runs(docs: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs of each text, given as its words."""
    order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    number: dict[bytes, int] = defaultdict(count().__next__)
    pieces, border = [], []
    for i in order:
        pieces.append(np.fromiter(map(number.__getitem__, docs[i]), np.int64, len(docs[i])))
        border.append(len(docs[i]))
    parts = np.array(border, np.int64)
    starts = np.cumsum(parts + 1) - parts - 1
    ids = np.empty(int(parts.sum()) + len(parts), np.int64)
    for k, piece in enumerate(pieces):
        ids[starts[k]:starts[k] + len(piece)] = piece
        ids[starts[k] + len(piece)] = len(number) + k
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    for a, n, q in find_runs(ids, parts):
        k = int(np.searchsorted(starts, a, "right")) - 1
        out[order[k]].append((a - int(starts[k]), n, q))
    return out


def _kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """The places left when every run keeps its first period only."""
    depth = np.zeros(n + 1, np.int64)
    for a, length, q in runs:
        depth[a + q] += 1
        depth[a + length] -= 1
    return np.flatnonzero(np.cumsum(depth[:n]) == 0)


def _words(texts: list[bytes], ids: list[int | None] | None) -> list[list[bytes]]:
    """Words of the texts (bytes.split cuts at the blanks 0x20 and 0x09-0x0D)."""
    docs = [t.split() for t in texts]
    for k, i in enumerate(ids or []):
        source = planted(i, len(docs[k]))
        if source is not None:
            words = docs[k]
            docs[k] = [words[j] for j in source]
    return docs


_DIGEST = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
           "runs_sha256 string, collapsed_sha256 string, n_words long, n_kept long")


def _digest(doc_id, words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    told = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    best = (None,) * 4
    for a, n, q in runs:  # by start, then period: a later run must be strictly greater
        if best[0] is None or n * best[2] > best[1] * q:
            best = (a, n, q, 1000 * n // q)
    left = words if not runs else [words[i] for i in _kept(len(words), runs)]
    return (doc_id, len(runs), *best, hashlib.sha256(told.encode()).hexdigest(),
            hashlib.sha256(b" ".join(left)).hexdigest(), len(words), len(left))


def run_digests(docs: DataFrame, plant: bool = False) -> DataFrame:
    """doc_id with the number of runs, the run of the greatest exponent, digests
    of all runs and of the text that keeps each run's first period. With
    ``plant`` a tenth of the ids get a periodic tail first."""
    names = [f.split()[0] for f in _DIGEST.split(", ")]
    types = [pa.string() if "sha256" in c else pa.int64() for c in names]

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = texts_of(batch["text"]), batch["doc_id"].to_pylist()
            for lo, hi in chunks(texts):
                words = _words(texts[lo:hi], ids[lo:hi] if plant else None)
                rows = [_digest(*row) for row in zip(ids[lo:hi], words, _batch_runs(words), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _DIGEST)


def runs(docs: DataFrame) -> DataFrame:
    """Every run as a row: doc_id, start, length, period (words)."""
    schema = "doc_id long, start long, length long, period long"

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = texts_of(batch["text"]), batch["doc_id"].to_pylist()
            for lo, hi in chunks(texts):
                found = _batch_runs(_words(texts[lo:hi], None))
                rows = [(i, *r) for i, rs in zip(ids[lo:hi], found, strict=True) for r in rs]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "length", "period"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def collapse(docs: DataFrame) -> DataFrame:
    """The documents with every run cut to its first period; a text without a
    run stays as it is, blanks included, and so does a null."""
    schema = docs.schema
    text = docs.columns.index("text")

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(text))
            out = batch.column(text).to_pylist()
            for lo, hi in chunks(texts):
                words = _words(texts[lo:hi], None)
                for k, found in enumerate(_batch_runs(words)):
                    if found:
                        out[lo + k] = b" ".join(words[k][i] for i in _kept(len(words[k]), found)).decode()
            columns = list(batch.columns)
            columns[text] = pa.array(out, batch.column(text).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, schema)
