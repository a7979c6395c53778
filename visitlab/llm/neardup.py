"""MinHash near-duplicates with sequential Bayesian verification.

1. One pass over the texts gives each document the size and a digest of its set
   of word shingles and a signature of ``BANDS * ROWS`` minima.
2. Documents with the same set form a class; its smallest doc_id stands for it,
   so a group of exact copies of any size costs one representative.
3. Representatives that agree in a band share a bucket. Every member is compared
   with the bucket's smallest member (a star: as many pairs as members), and
   linked representatives are joined to components.
4. Pairs of one bucket that lie in different components and were not compared
   through the star follow; those inside a component need no comparison, and a
   group of near copies is one component by then. They are compared in blocks:
   blocks of the members outside the leader's component meet blocks of all
   members, a pair in the first band it shares. First on signatures, and only
   members with a likely partner go on; then, with their full sets beside them,
   exactly. Only links become rows, so a bucket of unlike documents that share a
   passage is spread over many small tasks and costs no row for each pair.
5. A pair is compared batch by batch of signature places and dropped as soon as
   the posterior probability of a similarity of at least ``PERCENT`` falls under
   ``MISS``. What survives is decided on the full shingle sets.

Two documents at exactly the limit of 0.75 share no band with probability
(1 - 0.75**ROWS)**BANDS = 2e-4, at 0.8 with 3e-6, and less beyond.

Defined results: a null or empty text, or one of white space, has an empty set
and is linked with nothing; fewer than five words make one shingle of the whole
sequence; a doc_id that occurs in several rows is one document whose text is the
smallest of them (nulls count as empty), while ``keep_one_of_each`` takes each of
its texts as a document; rows with a null doc_id are left alone: they are linked with nothing and have a null component. Extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import lean, materialize
from .components import components
from .idfilter import with_ids, without_ids

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 32, 5
#: Members of a bucket in one block of the comparison in blocks, on average.
BLOCK = 192
#: Signature places compared before each pruning decision.
BATCH = 32
#: Posterior probability of a link below which a pair is dropped.
MISS = 1e-7

_RNG = np.random.default_rng(9)
_A = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    out: list[np.ndarray] = []
    for lo, hi in tokens.chunks(texts):
        words = tokens.space_words(texts[lo:hi])
        offsets = words.per_doc(hi - lo)
        h, at = tokens.windows(words.hash, words.doc, tuple(range(SHINGLE)), 9)
        cut = np.searchsorted(at, offsets)
        for i in range(hi - lo):
            n = offsets[i + 1] - offsets[i]
            if n >= SHINGLE:
                out.append(np.unique(h[cut[i]:cut[i + 1]]))
            elif n:
                seq = words.hash[offsets[i]:offsets[i + 1]].tobytes()
                out.append(np.array([xxhash.xxh64_intdigest(seq, seed=int(n))], np.uint64))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(len(_A), 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for lo in range(0, len(x), 512):
        np.minimum(low, (x[lo:lo + 512, None] * _A + _B).min(axis=0), out=low)
    return low


@functools.lru_cache(maxsize=1)
def least_matches() -> dict[int, int]:
    """For each number n of compared places, the fewest matches with which a pair
    goes on. With a uniform prior, P(J >= t | m of n) = P(Binomial(n + 1, t) <= m)."""
    t, out = PERCENT / 100, {}
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        below, m = 0.0, 0
        while (below := below + comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)) < MISS:
            m += 1
        out[n] = m
    return out


@lean()
def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = shingle_sets(tokens.texts_of(batch["text"]))
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch["doc_id"], "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "set_key": pa.array([xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
            "sig": pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())})


@lean()
def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = np.arange(BANDS, dtype=np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch["id"].to_numpy(zero_copy_only=False)
        sig = _matrix(batch["sig"]).reshape(len(ids), BANDS, ROWS).astype(np.uint64)
        key = np.broadcast_to(number, (len(ids), BANDS)).copy()
        for r in range(ROWS):
            key = tokens.mix64(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, r])
        yield pa.RecordBatch.from_pydict({"k": pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(ids))),
                                          "band": pa.array(key.ravel().view(np.int64)), "id": pa.array(np.repeat(ids, BANDS))})


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), BANDS * ROWS)


def _likely(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Which of the pairs (row i of a, row j of b) stay likely to be links."""
    alive = np.flatnonzero(100 * np.minimum(na[i], nb[j]) >= PERCENT * np.maximum(na[i], nb[j]))
    matches = np.zeros(len(alive), np.int64)
    for n, least in least_matches().items():
        part = slice(n - BATCH, n)
        matches += (a[i[alive], part] == b[j[alive], part]).sum(axis=1)
        go = matches >= least
        alive, matches = alive[go], matches[go]
    return alive


@lean()
def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequential verification of given pairs: rows (a, b, na, nb, sig_a, sig_b)."""
    for batch in batches:
        na, nb = (batch[c].to_numpy(zero_copy_only=False) for c in ("na", "nb"))
        each = np.arange(batch.num_rows)
        yield batch.select(["a", "b"]).take(pa.array(_likely(_matrix(batch["sig_a"]), _matrix(batch["sig_b"]), each, each, na, nb)))


_GROUP = ["band", "o", "m"]


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by group, cut so that every group is in one batch."""
    carry: pa.RecordBatch | None = None
    for batch in batches:
        if carry is not None:
            batch = pa.Table.from_batches([carry, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        last = np.logical_and.reduce([k == k[-1] for k in (batch[x].to_numpy() for x in _GROUP)])
        first = int(np.argmax(last))
        carry = batch.slice(first)
        if first:
            yield batch.slice(0, first)
    if carry is not None:
        yield carry


def _likely_in_groups(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (i, j) of one group, i of role 0 and j of role 1, of different
    components, that are likely links and share no earlier band."""
    band, o, m, role, ids, c, out, n, k = (batch[x].to_numpy(zero_copy_only=False) for x in (*_GROUP, "role", "id", "c", "out", "n", "k"))
    sig = _matrix(batch["sig"])
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for d in range(1, batch.num_rows):
        same = (band[:-d] == band[d:]) & (o[:-d] == o[d:]) & (m[:-d] == m[d:])
        if not same.any():
            break
        i = np.flatnonzero(same & (role[:-d] < role[d:]) & (c[:-d] != c[d:]) & (~out[:-d] | (ids[d:] < ids[:-d])))
        i = i[_likely(sig, sig, i, i + d, n, n)]
        agree = (sig[i] == sig[i + d]).reshape(len(i), BANDS, ROWS).all(axis=2)
        i = i[agree.argmax(axis=1) == k[i]]
        left.append(i)
        right.append(i + d)
    return np.concatenate(left), np.concatenate(right)


@lean()
def _likely_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _whole_groups(batches):
        yield batch.take(pa.array(np.unique(np.concatenate(_likely_in_groups(batch)))))


@lean()
def _links_in_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _whole_groups(batches):
        i, j = _likely_in_groups(batch)
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in batch["shingles"]]
        size = np.array([len(v) for v in sets])
        linked = np.zeros(len(i), bool)
        lo = 0
        while lo < len(i):
            x = sets[i[lo]]
            hi = int(np.searchsorted(i, i[lo], side="right"))
            others = j[lo:hi]
            y = np.concatenate([sets[q] for q in others])
            hit = x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y
            both = np.add.reduceat(hit.astype(np.int64), np.cumsum(size[others]) - size[others])
            linked[lo:hi] = 100 * both >= PERCENT * (len(x) + size[others] - both)
            lo = hi
        ids = batch["id"].to_numpy()
        a, b = ids[i[linked]], ids[j[linked]]
        yield pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})


@lean()
def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = shingle_sets(tokens.texts_of(batch["text"]))
        yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "shingles": pa.array([s.tobytes() for s in sets], pa.binary())})


@lean()
def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for i, (x, y) in enumerate(zip(batch["shingles_a"], batch["shingles_b"], strict=True)):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            if both and 100 * both >= PERCENT * (len(x) + len(y) - both):
                keep.append(i)
        yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))


def _repeated_ids(rows: DataFrame) -> DataFrame | None:
    """The doc_ids of several rows, None if there are none."""
    repeated = rows.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    return None if repeated.isEmpty() else materialize(repeated, "repeated-ids")


def one_row_per_id(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with every doc_id once; rows without an id are left out."""
    rows = docs.select("doc_id", "text").where("doc_id is not null")
    repeated = _repeated_ids(rows)
    if repeated is None:
        return rows
    smallest = (with_ids(rows, repeated).groupBy("doc_id")
                .agg(F.min(F.coalesce("text", F.lit(""))).alias("text")))
    return without_ids(rows, repeated).unionByName(smallest)


def _sets(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, shingles) of the documents in ``ids``."""
    ids = materialize(ids.distinct(), "likely-ids")
    return materialize(with_ids(rows, ids).mapInArrow(_set_rows, "doc_id long, shingles binary"), "shingle-sets")


def verified_links(likely: DataFrame, rows: DataFrame) -> DataFrame:
    """Those of the likely pairs (a, b) that are links on the full sets."""
    likely = materialize(likely, "likely-pairs")
    sets = _sets(rows, likely.select(F.col("a").alias("doc_id")).union(likely.select("b")))
    full = lambda x: sets.select(F.col("doc_id").alias(x), F.col("shingles").alias(f"shingles_{x}"))
    return likely.join(full("a"), "a").join(full("b"), "b").mapInArrow(_exact, "a long, b long")


def _star_pairs(members: DataFrame, signatures: DataFrame) -> DataFrame:
    """Likely links between bucket members and their leaders."""
    side = lambda x: signatures.select(F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("sig").alias(f"sig_{x}"))
    star = members.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    return star.join(side("a"), "a").join(side("b"), "b").mapInArrow(_prune, "a long, b long")


def _open_links(members: DataFrame, found: DataFrame, signatures: DataFrame, rows: DataFrame) -> DataFrame:
    """Links between bucket members of different components, none of them the
    leader. One of the two is outside the leader's component, so a large component
    is never compared with itself."""
    lead = found.select(F.col("id").alias("leader"), F.col("component").alias("lc"))
    placed = (members.where("id <> leader").join(found.withColumnRenamed("component", "c"), "id", "left").join(lead, "leader", "left")
              .select("k", "band", "id", F.coalesce("c", "id").alias("c"), F.expr("coalesce(c, id) <> coalesce(lc, leader)").alias("out")))
    placed = materialize(placed, "placed-members")
    blocks = (placed.groupBy("band").agg(F.count("*").alias("n"), F.count_if("out").alias("n_out")).where("n > 1 and n_out > 0")
              .select("band", F.ceil(F.col("n_out") / BLOCK).alias("no"), F.ceil(F.col("n") / BLOCK).alias("nm")))
    placed = placed.join(blocks, "band")
    block = lambda n: F.pmod(F.xxhash64("id", F.lit(3)), n)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    all_rows = placed.select("k", "band", every("no").alias("o"), block(F.col("nm")).alias("m"), F.lit(0).alias("role"), "id", "c", "out")
    out_rows = placed.where("out").select("k", "band", block(F.col("no")).alias("o"), every("nm").alias("m"), F.lit(1).alias("role"), "id", "c", "out")
    grouped = lambda df: df.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "role", "id")
    signed = all_rows.unionByName(out_rows).join(signatures.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sig"), "id")
    likely = materialize(grouped(signed).mapInArrow(_likely_members, signed.schema), "likely-members")
    sets = _sets(rows, likely.select(F.col("id").alias("doc_id")))
    full = likely.join(sets.withColumnRenamed("doc_id", "id"), "id")
    return grouped(full).mapInArrow(_links_in_groups, "a long, b long")


def _grouped(rows: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of rows that each have their own id."""
    signatures = materialize(rows.mapInArrow(_sign, "doc_id long, n_shingles long, set_key binary, sig binary"), "signatures")
    classes = signatures.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    classes = materialize(classes, "classes")
    copies = classes.where("n > 1").select("set_key", "rep")
    reps = signatures.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").alias("id"), "sig")
    bands = materialize(reps.mapInArrow(_band_rows, "k int, band long, id long"), "bands")
    shared = bands.groupBy("band").agg(F.min("id").alias("leader"), F.count("*").alias("n")).where("n > 1")
    members = materialize(bands.join(shared.select("band", "leader"), "band"), "bucket-members")
    found = components(verified_links(_star_pairs(members, signatures), rows))
    more = materialize(_open_links(members, found, signatures, rows), "links")
    if not more.isEmpty():
        found = components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more))

    return (signatures.select("doc_id", "n_shingles", "set_key").join(copies, "set_key", "left")
            .withColumn("id", F.coalesce("rep", "doc_id")).join(found, "id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "id").alias("component_id")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    named = _grouped(one_row_per_id(docs))
    nameless = (docs.where("doc_id is null").select(F.expr("cast(null as bigint) doc_id"), "text")
                .mapInArrow(_sign, "doc_id long, n_shingles long, set_key binary, sig binary")
                .select("doc_id", "n_shingles", F.expr("cast(null as bigint) component_id")))
    out = named.unionByName(nameless)
    return out.withColumn("kept", F.expr("doc_id is null or doc_id = component_id"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with one document of each group: the smallest
    doc_id, and of several texts with that doc_id the smallest. Each text of a
    repeated doc_id is a document of its own, rows equal in both are one."""
    repeated = _repeated_ids(docs)
    if repeated is None:
        decided = materialize(_grouped(docs.select("doc_id", "text").where("doc_id is not null")), "near-duplicates")
        return without_ids(docs, decided.where("doc_id <> component_id").select("doc_id"))
    others = [c for c in docs.columns if c != "doc_id"]
    # every text of a repeated id under a number of its own, above all ids, in order of (doc_id, text)
    texts = (with_ids(docs, repeated).groupBy("doc_id", F.coalesce("text", F.lit("")).alias("__text"))
             .agg(F.min(F.struct(*others)).alias("__row")).orderBy("doc_id", "__text"))
    top = docs.agg(F.max("doc_id")).first()[0]
    texts = materialize(texts.select("*", (F.lit(top) + 1 + F.monotonically_increasing_id()).alias("__key")), "repeated-texts")
    single = without_ids(docs, repeated)
    rows = single.select("doc_id", "text").where("doc_id is not null").unionByName(texts.select(F.col("__key").alias("doc_id"), F.col("__text").alias("text")))
    decided = materialize(_grouped(rows), "near-duplicates")
    placed = decided.join(texts.select(F.col("__key").alias("doc_id"), F.col("doc_id").alias("__id")), "doc_id", "left")
    placed = placed.select(F.struct(F.coalesce("__id", "doc_id").alias("id"), F.col("doc_id").alias("key")).alias("place"), "component_id")
    first = placed.groupBy("component_id").agg(F.min("place").alias("first"))
    dropped = materialize(placed.join(first, "component_id").where("place <> first").select(F.col("place.key").alias("doc_id")), "dropped-ids")
    kept = without_ids(texts, dropped.withColumnRenamed("doc_id", "__key"), "__key")
    kept = kept.select("doc_id", *[F.col("__row")[c].alias(c) for c in others]).select(docs.columns)
    return without_ids(single, dropped).unionByName(kept)
