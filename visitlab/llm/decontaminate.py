"""Benchmark decontamination by template canonicalisation.

Words become canonical tokens: a number becomes the placeholder NUM, a
capitalised word inside a sentence NAME, and a known unit after a number UNIT;
other words stay (case-folded, without punctuation). A second template takes
capitalised words that open a sentence as NAME too. Windows of ``WINDOW`` tokens
are looked up by hash, as both templates and as plain words, among the windows of
all benchmark items. A window of equal words counts as it is. One
that is equal as a template only is checked slot by slot: along one alignment of
document and item, each item value must stand for one document value (the most
frequent one) and at most ``SHARED`` values for the same one; windows that clash
with that are left out, the others of the alignment stay. A question with other
numbers or names passes, a chance meeting of placeholders with clashing values
does not. An opening word that differs is checked like a slot; n_slots and
n_changed count the slots of the first template.

A window that stands in more than ``COMMON`` items (a preface, an instruction) is no
evidence: it is neither looked up nor counted, unless it belongs to an item that
has more common windows than others. These frequencies are counted over the whole
benchmark first.

A document is contaminated by an item if windows that count cover at least
``SHARE`` of the item's windows, or, whatever the item's length, ``RUN``
consecutive words of it along one alignment. The benchmark is read in blocks of
bounded items and bytes; the documents are scanned once per block, so what is
sent to the executors is bounded at any benchmark size.

Defined results: a null or empty text has no windows; an item shorter than
``WINDOW`` words is one window of all its words, an item without words matches
nothing; repeated item_ids are matched row by row and repeated doc_ids too, and
the best row of each (doc_id, item_id) is returned; a null doc_id is a key like any other; items with a null item_id
are not named in ``contaminated``, but ``decontaminate`` drops their documents too.
Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import lean

WINDOW = 8
#: Words of a window that must be literal for the template to count.
LITERAL = 3
#: Share of an item's windows that makes a document contaminated.
SHARE = 0.3
#: Consecutive matched words that make a document contaminated.
RUN = 13
#: Most item values that one document value may stand for.
SHARED = 2
#: Items that may share a window before it counts as common.
COMMON = 50
#: Most benchmark items in one broadcast block, and most bytes of their texts.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 16 << 20

WORD, NUM, NAME, UNIT = range(4)
#: Unit words that follow a number.
UNITS = ("mm cm m km in ft yd mi inch inches foot feet meter meters metre metres mile miles g kg mg lb lbs oz ton tons "
         "gram grams kilogram kilograms pound pounds ounce ounces l ml liter liters litre litres gallon gallons "
         "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
         "usd eur gbp dollar dollars cent cents euro euros percent degrees degree celsius fahrenheit "
         "mph kmh km/h kw w v a hz khz mhz ghz kb mb gb tb").split()
_MARK = tokens.mix64(np.arange(100, 104, dtype=np.uint64))


def _unit_hashes() -> np.ndarray:
    words, _ = tokens.alnum_words([" ".join(UNITS).encode()])
    return np.unique(words.hash)


_UNIT_HASHES = _unit_hashes()
_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[[10, 33, 46, 58, 63]] = True  # line feed ! . : ?


def canonical(texts: list[bytes]) -> tuple[tokens.Words, np.ndarray, np.ndarray]:
    """The words, and by template the kind of each word and the hash of its
    canonical token (two rows: sentence openers as words, and as names)."""
    words, raw = tokens.alnum_words(texts)
    n = len(words.start)
    kind = np.zeros(n, np.int8)
    if not n:
        return words, np.stack((kind, kind)), np.stack((words.hash, words.hash))
    start, end = words.start, words.end
    kind[tokens.DIGIT[raw[start]] & tokens.DIGIT[raw[end - 1]]] = NUM
    upper = (raw[start] >= 65) & (raw[start] <= 90) | (raw[start] == 0xC3) & (raw[np.minimum(start + 1, len(raw) - 1)] <= 0x9E) & (raw[np.minimum(start + 1, len(raw) - 1)] >= 0x80)
    inner = np.minimum(start + 1 + (raw[start] >= 0xC0), end - 1)
    lower = (raw[inner] >= 97) & (raw[inner] <= 122) | (raw[inner] >= 0x80)
    # a name does not open a sentence: no sentence end between it and the word before
    ends = np.concatenate(([0], np.cumsum(_SENTENCE_END[raw])))
    inside = np.zeros(n, bool)
    inside[1:] = (words.doc[1:] == words.doc[:-1]) & (ends[start[1:]] == ends[end[:-1]])
    name = upper & lower & (end - start > 1) & (kind == WORD)
    kind[name & inside] = NAME
    after = np.zeros(n, bool)
    after[1:] = (kind[:-1] == NUM) & (words.doc[1:] == words.doc[:-1])
    kind[after & (kind == WORD) & np.isin(words.hash, _UNIT_HASHES)] = UNIT
    kinds = np.stack((kind, np.where(name & ~inside & (kind == WORD), NAME, kind).astype(np.int8)))
    return words, kinds, np.where(kinds == WORD, words.hash, _MARK[kinds])


def _item_hashes(text: str | None) -> tuple | None:
    """(word hashes, kinds, window length, [(hashes, places)] of the plain words and
    of each template's usable windows) of one item; None without words."""
    words, kinds, token = canonical([(text or "").encode()])
    n = len(words.hash)
    if not n:
        return None
    size, one = min(WINDOW, n), np.zeros(n, np.int64)
    found = [tokens.windows(words.hash, one, tuple(range(size)), 1)]
    for kind, hashes in zip(kinds, token, strict=True):
        literal = np.convolve(kind == WORD, np.ones(size, int), "valid")
        template, at = tokens.windows(hashes, one, tuple(range(size)), 1)
        usable = literal[at] >= min(LITERAL, size)
        found.append((template[usable], at[usable]))
    return words.hash, kinds, size, found


def common_windows(benchmark: DataFrame) -> np.ndarray:
    """Sorted hashes of the windows that more than ``COMMON`` items hold: at most
    a ``COMMON``-th of all windows of the benchmark."""

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.unique(np.concatenate([h for h, _ in item[3]])) for t in batch["text"].to_pylist() if (item := _item_hashes(t))]
            hashes = np.concatenate(own) if own else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], ["h"])

    often = (benchmark.select("text").distinct().mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n"))
             .where(F.col("n") > COMMON).select("h"))
    return np.sort(np.array([r["h"] for r in often.collect()], np.int64).view(np.uint64))


def item_windows(items: list[tuple[int, str]], common: np.ndarray = np.empty(0, np.uint64)) -> dict:
    """Lookup of one block of items: window lengths, sorted template and plain
    hashes with (item, place), each item's word hashes and kinds."""
    by_item = []
    lookup: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
    for item_id, text in items:
        item = _item_hashes(text)
        if item is None:
            continue
        hashes, kinds, size, found = item
        k, count = len(by_item), len(hashes) - size + 1
        plain, at = found[0]
        shared = np.zeros(count, bool)
        shared[at] = np.isin(plain, common)
        for template, at in found[1:]:
            shared[at] |= np.isin(template, common)
        if 2 * shared.sum() > count:  # an item of common windows is known by them
            shared[:] = False
        by_item.append((item_id, hashes, kinds, int(count - shared.sum()), size))
        for found_hashes, at in found:
            for h, q in zip(found_hashes.tolist(), at.tolist(), strict=True):
                if not shared[q] and (not lookup[size].get(h) or (k, q) not in lookup[size][h]):
                    lookup[size][h].append((k, q))
    return {"items": by_item, "sizes": {s: (np.array(sorted(m), np.uint64), [m[h] for h in sorted(m)]) for s, m in lookup.items()}}


_PREFIX: dict[int, np.ndarray] = {}


def _known(hashes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``hashes`` that occur in the sorted ``known``, and where there."""
    key = hash(known.tobytes())
    if key not in _PREFIX:
        if len(_PREFIX) > 8:
            _PREFIX.clear()
        _PREFIX[key] = np.zeros(1 << 20, bool)
        _PREFIX[key][known >> np.uint64(44)] = True
    maybe = np.flatnonzero(_PREFIX[key][hashes >> np.uint64(44)])
    at = np.searchsorted(known, hashes[maybe])
    at[at == len(known)] = 0
    sure = known[at] == hashes[maybe]
    return maybe[sure], at[sure]


def _consistent(at: np.ndarray, size: int, used: np.ndarray, item: np.ndarray, doc: np.ndarray, slot: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, set[tuple[int, int]]]:
    """Of the windows at the item's places ``at`` those that count, and the slots'
    (item value, document value) in them. ``item``, ``doc``, ``slot`` and ``name``
    hold the words' hashes and whether one is a slot of the first template or of
    either, for the places ``used``."""
    differ = item != doc
    bad = np.zeros(len(used), bool)
    if differ.any():
        free = np.flatnonzero(slot | name)
        votes = Counter(zip(item[free].tolist(), doc[free].tolist(), strict=True))  # in reading order
        stands: dict[int, int] = {}
        for (x, y), _ in sorted(votes.items(), key=lambda v: (-v[1], v[0][0] != v[0][1])):
            stands.setdefault(x, y)
        load = Counter(stands.values())
        for j in free.tolist():
            x, y = int(item[j]), int(doc[j])
            bad[j] = (slot[j] or x != y) and (stands[x] != y or (x != y and load[y] > SHARED))
    first = np.searchsorted(used, at)
    inside = lambda flag: (c := np.concatenate(([0], np.cumsum(flag))))[first + size] - c[first]
    keep = (inside(differ) == 0) | (inside(bad) == 0)
    told = np.zeros(len(used) + 1, np.int64)
    np.add.at(told, first[keep], 1)
    np.add.at(told, first[keep] + size, -1)
    told = (np.cumsum(told)[:-1] > 0) & slot
    return at[keep], set(zip(item[told].tolist(), doc[told].tolist(), strict=True))


def matches(texts: list[bytes], bench: dict) -> list[tuple[int, int, int, int, int, int]]:
    """(text index, item_id, windows, matched, slots, changed) of contaminated texts."""
    out = []
    for lo, hi in tokens.chunks(texts):
        words, kinds, token = canonical(texts[lo:hi])
        hits: dict[tuple[int, int, int], set] = defaultdict(set)  # (text, item, alignment) -> item places
        for size, (known, where) in bench["sizes"].items():
            for source in (words.hash, *token):
                h, at = tokens.windows(source, words.doc, tuple(range(size)), 1)
                found, ref = _known(h, known)
                for p, r in zip(at[found].tolist(), ref.tolist(), strict=True):
                    for k, q in where[r]:
                        hits[int(words.doc[p]), k, p - q].add(q)
        covered: dict[tuple[int, int], list] = defaultdict(lambda: [set(), set(), False])
        for (doc, k, shift), places in hits.items():
            _, item_hash, item_kinds, _, size = bench["items"][k]
            at = np.array(sorted(places))
            used = np.unique(at[:, None] + np.arange(size))
            slot, name = (item_kinds[:, used] != WORD) | (kinds[:, used + shift] != WORD)
            at, pairs = _consistent(at, size, used, item_hash[used], words.hash[used + shift], slot, name)
            covered[doc, k][0].update(at.tolist())
            covered[doc, k][1].update(pairs)
            more = RUN - size  # so many places further on, a run of windows is one of RUN words
            covered[doc, k][2] |= bool((at[more:] - at[:max(len(at) - more, 0)] == more).any())
        for (doc, k), (places, pairs, run) in covered.items():
            item_id, _, _, count, _ = bench["items"][k]
            if run or len(places) >= SHARE * count:
                out.append((lo + doc, item_id, count, len(places), len(pairs), sum(a != b for a, b in pairs)))
    return out


def _blocks(benchmark: DataFrame) -> Iterator[dict]:
    """Lookups of the items, a bounded block at a time."""
    common = common_windows(benchmark)
    rows: list[tuple[int, str]] = []
    size = 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        rows.append((r["item_id"], r["text"]))
        size += len(r["text"] or "")
        if len(rows) == BLOCK_ITEMS or size > BLOCK_BYTES:
            yield item_windows(rows, common)
            rows, size = [], 0
    if rows:
        yield item_windows(rows, common)


_OUT = "doc_id long, item_id long, n_windows long, n_matched long, n_slots long, n_changed long"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, n_windows (of
    the item), n_matched, n_slots, n_changed (slots with another value)."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], _OUT)
    for block in _blocks(benchmark.where("item_id is not null")):
        sent = spark.sparkContext.broadcast(block)

        @lean()
        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = matches(tokens.texts_of(batch["text"]), sent.value)
                ids = batch["doc_id"].take(pa.array([f[0] for f in found], pa.int64()))
                cols = [pa.array([f[i] for f in found], pa.int64()) for i in range(1, 6)]
                yield pa.RecordBatch.from_arrays([ids, *cols], names=["doc_id", "item_id", "n_windows", "n_matched", "n_slots", "n_changed"])

        out = out.unionByName(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _OUT))
    best = F.max(F.struct("n_matched", "n_windows", "n_slots", "n_changed")).alias("b")
    return (out.groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", "b.n_windows", "b.n_matched", "b.n_slots", "b.n_changed"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (all columns) without the rows that an item contaminates."""
    spark = docs.sparkSession
    for block in _blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)

        @lean()
        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[f[0] for f in matches(tokens.texts_of(batch["text"]), sent.value)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
