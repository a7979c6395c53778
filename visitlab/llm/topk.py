"""Exact top-k inner products by a three-phase uniform threshold.

A vector's components become integers floor(64 * x), and a score is the sum of
``LISTS`` partial products over ranges of dimensions: one score list per range
and cell of candidates. Candidates are packed on executors into cells of one
length, queries into blocks; a block meets every cell of its length once, by a
join on the cell's group.

1. Every cell gathers, per query, the entries that lead a local score list and
   sends the best of their totals, and beside them the highest total that it
   keeps. The k-th highest total sent is a lower bound t of the final k-th score.
2. t goes back to the pairs of query and cell that keep a total of at least t;
   all others have sent what they had, and their product is not computed again.
   An entry with a total of at least t has a local score of at least t / LISTS
   in some list; the cell collects the entries that do.
3. The remaining local scores of the collected entries are resolved, entries
   under t go, and the rest is ranked exactly.

Nothing passes through the driver but the number of cells. For a query a cell
sends ``GATHER`` * k totals over the number of cells, at least one, and in the
third phase at most k, whatever the ties.

Defined results: a vector that is null or holds a null or non-finite component
takes no part, nor does an empty one or a row without an id; a query sees
candidates of its own length only; candidates are the rows with another vec_id;
of several rows with a query's id the least vector asks, and candidate rows that
share a vec_id are ranked as they come, in vec_id order; ties go to the smaller
vec_id; with fewer than k candidates all are returned. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, materialize, scratch_path

K = 20
#: A row asks if its id is divisible by this.
EVERY = 20
LISTS = 2
#: Most queries in one block and candidates in one cell, and most bytes of either
#: (8 a component; one vector at least).
QUERIES, CANDIDATES = 4096, 8192
CELL_BYTES = 4 << 20
#: Bytes that one packing task holds open over all lengths of vectors.
OPEN_BYTES = 64 << 20
#: Totals that phase one gathers per query over all cells, in units of k.
GATHER = 3
#: Entries of a local list that are resolved for each total sent.
LEAD = 4
#: Scores of one step: queries times candidates.
STEP = 1 << 21

_LEAST = np.iinfo(np.int64).min


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) with integer components, for the rows that take part."""
    ok = F.expr("vec_id is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(double(x)) < double('infinity'))")
    return vectors.where(F.coalesce(ok, F.lit(False))).select(
        F.col("vec_id").cast("long"), F.expr("transform(embedding, x -> cast(floor(64 * double(x)) as bigint))").alias("v"))


# --- packing rows of one length ---

def _packed(name: str) -> str:
    return f"{name} long, d int, {name}_ids binary, {name}_m binary"


def _pack(name: str, most: int):
    """Rows (vec_id, v) to rows of at most ``most`` vectors of one length, numbered
    by the writing task; the numbers hold once the result is written."""

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[int, list[tuple[int, np.ndarray]]] = {}
        total = 0

        def flush(d: int) -> pa.RecordBatch:
            nonlocal number, total
            rows = held.pop(d)
            total -= len(rows) * d * 8
            number += 1
            return pa.RecordBatch.from_pydict({
                name: pa.array([number - 1], pa.int64()), "d": pa.array([d], pa.int32()),
                f"{name}_ids": pa.array([np.array([i for i, _ in rows], np.int64).tobytes()], pa.binary()),
                f"{name}_m": pa.array([np.concatenate([v for _, v in rows]).tobytes()], pa.binary())})

        for batch in batches:
            for vec_id, v in zip(batch["vec_id"].to_pylist(), batch["v"], strict=True):
                one = v.values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
                held.setdefault(len(one), []).append((vec_id, one))
                total += len(one) * 8
                n = len(held[len(one)])
                if n == most or (n + 1) * len(one) * 8 > CELL_BYTES:
                    yield flush(len(one))
                elif total > OPEN_BYTES:
                    yield flush(max(held, key=lambda d: d * len(held[d])))
        for d in list(held):
            yield flush(d)

    return run


def _write_packed(rows: DataFrame, name: str, most: int) -> DataFrame:
    """The packed rows, written in small row groups, which a reader holds whole."""
    spark = rows.sparkSession
    path = scratch_path(spark, f"top-k-{name}")
    rows.mapInArrow(_pack(name, most), _packed(name)).write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path)
    return spark.read.schema(_packed(name)).parquet(path)


def _matrix(ids: bytes, m: bytes) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, np.int64)
    return names, np.frombuffer(m, np.int64).reshape(len(names), -1)


# --- scores ---

def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; by floating point where that is exact."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if bound < 2**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def _local_scores(q: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    cut = np.linspace(0, q.shape[1], LISTS + 1).astype(int)
    return [_products(q[:, a:b], x[:, a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _steps(n_queries: int, n_candidates: int) -> Iterator[slice]:
    step = max(1, STEP // n_candidates)
    for lo in range(0, n_queries, step):
        yield slice(lo, lo + step)


# --- the phases in a cell ---

_SENT = "query_id long, block long, cell long, vec_id long, score long, kept long"
_HITS = "query_id long, vec_id long, score long"


def _gather(keep: int):
    """Phase one: per cell and query the ``keep`` best totals among the entries
    that lead a local list; ``kept``, on every row, is the highest total of the
    cell's other entries (null without any)."""

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, cell = batch["block"][row].as_py(), batch["cell"][row].as_py()
                q_ids, q = _matrix(batch["block_ids"][row].as_py(), batch["block_m"][row].as_py())
                ids, x = _matrix(batch["cell_ids"][row].as_py(), batch["cell_m"][row].as_py())
                n = min(LEAD * keep, len(ids))
                for at in _steps(len(q_ids), len(ids)):
                    local = _local_scores(q[at], x)
                    own = q_ids[at, None] == ids[None, :]
                    total = np.where(own, _LEAST, sum(local))
                    lead = np.concatenate([np.argpartition(np.where(own, _LEAST, s), len(ids) - n, axis=1)[:, len(ids) - n:] for s in local], axis=1)
                    lead.sort(axis=1)
                    again = np.concatenate((np.zeros((len(lead), 1), bool), lead[:, 1:] == lead[:, :-1]), axis=1)
                    best = np.where(again, _LEAST, np.take_along_axis(total, lead, 1))
                    order = np.argsort(best, axis=1)[:, ::-1][:, :keep]
                    score, lead = np.take_along_axis(best, order, 1), np.take_along_axis(lead, order, 1)
                    # what is not sent: the sent entries, and the query's own rows, count as least
                    r, c = np.nonzero(score > _LEAST)
                    total[r, lead[r, c]] = _LEAST
                    kept = total.max(axis=1)[r]
                    yield pa.RecordBatch.from_pydict({
                        "query_id": pa.array(q_ids[at][r], pa.int64()), "block": pa.array(np.full(len(r), block), pa.int64()),
                        "cell": pa.array(np.full(len(r), cell), pa.int64()), "vec_id": pa.array(ids[lead[r, c]], pa.int64()),
                        "score": pa.array(score[r, c], pa.int64()), "kept": pa.array(kept, pa.int64(), mask=kept == _LEAST)})

    return run


def _collect(k: int):
    """Phases two and three, for the asking queries of a block in one cell: entries
    with a local score of at least t / LISTS, resolved to totals of at least t; the
    cell sends the k best of each query, so mass ties do not leave it."""

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                q_ids, q = _matrix(batch["block_ids"][row].as_py(), batch["block_m"][row].as_py())
                ids, x = _matrix(batch["cell_ids"][row].as_py(), batch["cell_m"][row].as_py())
                asked = {a["query_id"]: a["t"] for a in batch["asked"][row].as_py()}
                here = np.isin(q_ids, np.array(list(asked), np.int64))
                q_ids, q = q_ids[here], q[here]
                # fewer than k totals so far: everything counts
                cutoff = np.array([_LEAST // 2 if asked[i] is None else asked[i] for i in q_ids.tolist()], np.int64)
                for at in _steps(len(q_ids), len(ids)):
                    t = cutoff[at, None]
                    local = _local_scores(q[at], x)
                    least = -(-t // LISTS)
                    some = np.logical_or.reduce([s >= least for s in local])
                    r, c = np.nonzero(some & (q_ids[at, None] != ids[None, :]))
                    total = sum(s[r, c] for s in local)
                    enough = total >= t[r, 0]
                    r, c, total = r[enough], c[enough], total[enough]
                    # of entries with equal scores only the k that can be in the result
                    order = np.lexsort((ids[c], -total, r))
                    r, c, total = r[order], c[order], total[order]
                    first = np.arange(len(r)) - np.searchsorted(r, r) < k
                    yield pa.RecordBatch.from_pydict({
                        "query_id": pa.array(q_ids[at][r[first]], pa.int64()), "vec_id": pa.array(ids[c[first]], pa.int64()),
                        "score": pa.array(total[first], pa.int64())})

    return run


def _best(hits: DataFrame, k: int) -> DataFrame:
    """Each query's k highest scores with rank."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, asks: Column | None = None, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest for every asking row
    (a condition on vec_id and v)."""
    asks = F.col("vec_id") % EVERY == 0 if asks is None else asks
    every = integers(vectors)
    cells = _write_packed(every, "cell", CANDIDATES)
    blocks = _write_packed(every.where(asks).groupBy("vec_id").agg(F.min("v").alias("v")), "block", QUERIES)

    n = max(1, cells.count())
    keep = min(k, max(1, -(-GATHER * k // n)))
    grouped = cells.withColumn("g", F.expr(f"pmod(xxhash64(cell), {n}L)")).repartition(n, "g", "d")
    dealt = blocks.withColumn("g", F.expr(f"explode(sequence(0L, {n - 1}L))")).repartition(n, "g", "d")
    pairs = dealt.join(grouped, ["g", "d"]).drop("g", "d")
    sent = materialize(pairs.mapInArrow(_gather(keep), _SENT), "top-k-sent")

    cutoffs = (_best(sent.select("query_id", "vec_id", "score", "block"), k).groupBy("query_id", "block")
               .agg(F.min("score").alias("least"), F.count("*").alias("n"))
               .select("query_id", "block", F.when(F.col("n") == k, F.col("least")).alias("t")))
    short = (sent.where("kept is not null").groupBy("query_id", "block", "cell").agg(F.max("kept").alias("kept"))
             .join(cutoffs, ["query_id", "block"]).where("t is null or kept >= t").select("query_id", "block", "cell", "t"))
    short = materialize(short, "top-k-cutoffs")

    # a block's queries bound the list of one pair
    again = short.groupBy("block", "cell").agg(F.collect_list(F.struct("query_id", "t")).alias("asked"))
    found = again.join(cells.drop("d"), "cell").join(blocks.drop("d"), "block").repartition(n, "block", "cell").mapInArrow(_collect(k), _HITS)
    rest = sent.join(short, ["query_id", "block", "cell"], "left_anti").select("query_id", "vec_id", "score")
    return _best(rest.unionByName(found), k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
