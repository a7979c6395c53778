"""Centroid clustering of integer vectors with bit planes and population counts.

A vector of 64 components becomes one 64-bit word per bit of its components
(two's complement: the highest plane weighs negatively). The dot product of two
vectors is the sum over pairs of planes of weight times the number of bits set
in both, so assignment needs only AND and population count, and is exact.

Vectors are packed once and written. A round reads them with the centroids as a
constant (at most ``K`` rows of 64 integers) and returns, per task, one row of
sums for each centroid; these few rows meet in one aggregation. Component sums
come from the planes too: per plane, the number of a centroid's vectors that
have the bit set.

Defined results: a vector that is null, has another length or holds a null or
non-finite component takes no part, nor does one with a scaled component of
2^26 or more in size, whose distances could leave a long; without vectors the
result is empty; with fewer than ``k`` vectors each starts a centroid. Rows that
share a vec_id are vectors of their own and start centroids in the order of
their components; rows without an id are clustered but start a centroid only
when ids run out. Ties go to the smaller centroid number. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, materialize

#: Components of a vector, centroids, rounds.
DIMENSIONS, K, ROUNDS = 64, 16, 3
#: Scaled components are below 2 to this power in size.
BITS = 26
#: Vectors worked on at a time.
ROWS = 4096


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): floor(64 * x) of the vectors that take part."""
    fits = F.expr(f"size(embedding) = {DIMENSIONS} and forall(embedding, x -> x is not null and not isnan(x) and abs(64 * double(x)) < {1 << BITS})")
    return vectors.where(F.coalesce(fits, F.lit(False))).select(
        F.col("vec_id").cast("long"), F.expr("transform(embedding, x -> cast(floor(64 * double(x)) as bigint))").alias("v"))


def pack(x: np.ndarray, planes: int) -> np.ndarray:
    """Planes of the rows of ``x``: word [i, b] holds bit b of the 64 components
    of row i."""
    bit = (x[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bit.astype(np.uint8), axis=2, bitorder="little").view("<u8").reshape(len(x), planes)


def width(x: np.ndarray) -> int:
    """Planes that two's complement needs for all numbers of ``x``."""
    return max(int(max(x.max(initial=0), -1 - x.min(initial=0))).bit_length() + 1, 2)


def widen(planes: np.ndarray, to: int) -> np.ndarray:
    """The same numbers in more planes: the sign plane is repeated."""
    return np.concatenate((planes, np.repeat(planes[:, -1:], to - planes.shape[1], axis=1)), axis=1) if to > planes.shape[1] else planes


def weights(planes: int) -> np.ndarray:
    w = np.left_shift(np.int64(1), np.arange(planes, dtype=np.int64))
    w[-1] = -w[-1]
    return w


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of every row of planes ``a`` with every row of ``b``."""
    out = np.zeros((len(a), len(b)), np.int64)
    for i, wa in enumerate(weights(a.shape[1])):
        for j, wb in enumerate(weights(b.shape[1])):
            out += (wa * wb) * np.bitwise_count(a[:, i, None] & b[None, :, j]).astype(np.int64)
    return out


def squares(a: np.ndarray) -> np.ndarray:
    """Squared lengths of rows of planes."""
    out = np.zeros(len(a), np.int64)
    w = weights(a.shape[1])
    for i in range(a.shape[1]):
        out += w[i] * w[i] * np.bitwise_count(a[:, i]).astype(np.int64)
        for j in range(i):
            out += 2 * w[i] * w[j] * np.bitwise_count(a[:, i] & a[:, j]).astype(np.int64)
    return out


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid; ties go to the
    smaller number."""
    c = pack(centroids, width(centroids))
    distance = squares(planes)[:, None] - 2 * dots(planes, c) + squares(c)[None, :]
    best = distance.argmin(axis=1)
    return best, distance[np.arange(len(best)), best]


def component_sums(planes: np.ndarray) -> np.ndarray:
    """Sum of the vectors, component by component."""
    bits = np.unpackbits(np.ascontiguousarray(planes).astype("<u8").view(np.uint8).reshape(len(planes), planes.shape[1], 8), axis=2, bitorder="little")
    return weights(planes.shape[1]) @ bits.sum(axis=0, dtype=np.int64)


def packed(vectors: DataFrame) -> DataFrame:
    """(vec_id, planes): the bit planes of each vector that takes part."""

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch["v"].flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS)
            if len(x):
                p = pack(x, width(x))
                words = pa.Array.from_buffers(pa.binary(8 * p.shape[1]), len(p), [None, pa.py_buffer(p.astype("<u8").tobytes())])
                yield pa.RecordBatch.from_arrays([batch["vec_id"], words.cast(pa.binary())], ["vec_id", "planes"])

    return integers(vectors).mapInArrow(run, "vec_id long, planes binary")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, planes) of blocks of vectors that have the same number of planes."""
    for batch in batches:
        size = pc.binary_length(batch["planes"]).to_numpy(zero_copy_only=False)
        for n in np.unique(size):
            rows = batch.filter(pa.array(size == n))
            for lo in range(0, rows.num_rows, ROWS):
                part = rows.slice(lo, ROWS)
                yield part["vec_id"], np.frombuffer(b"".join(part["planes"].to_pylist()), "<u8").reshape(part.num_rows, -1)


def assign(planes: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance for every packed vector."""

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, p in _blocks(batches):
            best, distance = nearest(p, centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(best, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return planes.mapInArrow(run, "vec_id long, cluster int, distance long")


def moved(planes: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floor of the mean of their vectors; a
    centroid without vectors stays. A task sends one row per centroid."""

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), np.int64)
        total = np.zeros((len(centroids), DIMENSIONS), np.int64)
        for _, p in _blocks(batches):
            best, _ = nearest(p, centroids)
            for c in np.unique(best):
                mine = p[best == c]
                count[c] += len(mine)
                total[c] += component_sums(mine)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(count[used]), pa.array(total[used].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "s"])

    parts = planes.mapInArrow(run, "cluster int, n long, s array<long>")
    sums = [F.sum(F.col("s")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(DIMENSIONS)]
    out = centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():  # a row per centroid
        out[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(DIMENSIONS)]
    return out


def first_centroids(vectors: DataFrame, k: int = K, seed: int = 1) -> np.ndarray:
    """The vectors whose ``seed:vec_id`` has the smallest SHA-256."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = integers(vectors).orderBy(key.asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64).reshape(-1, DIMENSIONS)


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = 1) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, cluster_size and
    centroid_sha256 of every vector that takes part, after ``rounds`` rounds."""
    spark = vectors.sparkSession
    centroids = first_centroids(vectors, k, seed)
    planes = materialize(packed(vectors), "bit-planes")
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(planes, centroids)
    if not len(centroids):
        found = spark.createDataFrame([], "vec_id long, cluster int, distance long")
    else:
        found = materialize(assign(planes, centroids), "clusters")
    per = found.groupBy("cluster").agg(F.sum("distance").alias("d"), F.count("*").alias("n")).collect()  # a row per centroid
    inertia = sum(r["d"] for r in per)
    told = [",".join(map(str, c)) for c in centroids.tolist()]
    about = spark.createDataFrame(
        [(r["cluster"], r["d"], inertia, hashlib.sha256(told[r["cluster"]].encode()).hexdigest(), r["n"]) for r in per],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, cluster_size long")
    return found.join(F.broadcast(about), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "cluster_size")
