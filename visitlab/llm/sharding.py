"""Sharding by extendible hashing, in DataFrame functions only.

A document's hash is 60 bits of the md5 of its doc_id, followed by ``SALT_BITS``
bits that spread rows of one doc_id. The directory starts with all documents in
one bucket; a bucket over the byte limit splits on the next bit, and only such a
bucket does, until every shard fits. Instead of splitting level by level, byte
sums are taken once per hash cell a few bits finer than the shards will be and
rolled up; only cells still over the limit are looked at again, ``ROUND_BITS``
deeper. A shard is named by its bit prefix; all prefixes together are a
prefix-free code, so a key finds its shard by its bits alone.

Defined results: a null or empty text has 0 bytes; a document over the limit is a
shard of its own, named by its full hash and marked ``oversize``; a null doc_id is
hashed like the word "null"; rows of one doc_id stay together while they fit and
are spread by their salt bits if not; an empty table gives no shards. The salt
numbers the rows of the input, so for repeated rows of one doc_id the input must
be stable (a table scan). Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

LIMIT = 1 << 20
KEY_BITS, SALT_BITS = 60, 24
BITS = KEY_BITS + SALT_BITS
#: Bits that the first cells are finer than an even directory, and bits per further round.
FINER, ROUND_BITS = 6, 12


def bits_of(doc_id: Column, salt: Column) -> Column:
    """The hash as a string of ``BITS`` binary digits."""
    digits = lambda hexes, n: F.lpad(F.conv(hexes, 16, 2), n, "0")
    key = F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary"))
    more = F.md5(F.concat(key, salt.cast("string")).cast("binary"))
    return F.concat(digits(F.substring(key, 1, KEY_BITS // 4), KEY_BITS), digits(F.substring(more, 1, SALT_BITS // 4), SALT_BITS))


def hashed(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, bits) of every row."""
    return docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                       bits_of(F.col("doc_id"), F.monotonically_increasing_id()).alias("bits"))


def directory(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The shards of ``rows`` (n_bytes, bits), single oversized documents apart:
    cell (a prefix that the lookup joins on), shard, depth."""
    sums = rows.where(F.col("n_bytes") <= limit)
    total = sums.agg(F.sum("n_bytes")).first()[0] or 0
    depth = max(0, (total // limit).bit_length() - 1)
    fine, base = min(BITS, depth + FINER), 0
    parts, left = None, sums
    while True:
        cells = left.groupBy(F.substring("bits", 1, fine).alias("cell")).agg(F.sum("n_bytes").alias("n"))
        cells = materialize(cells, "cells")
        level = F.explode(F.sequence(F.lit(base), F.lit(fine))).alias("depth")
        # the shallowest prefix of a cell that fits
        prefixes = cells.select("cell", "n", level).withColumn("shard", F.expr("substring(cell, 1, depth)"))
        fit = prefixes.groupBy("shard", "depth").agg(F.sum("n").alias("n")).where(F.col("n") <= limit).select("shard", "depth")
        best = prefixes.join(fit, ["shard", "depth"]).groupBy("cell").agg(F.min("depth").alias("depth"))
        done = cells.join(best, "cell", "left")
        if fine == BITS:
            done = done.withColumn("depth", F.coalesce("depth", F.lit(BITS)))
        done = materialize(done.select("cell", "depth", F.expr("substring(cell, 1, depth)").alias("shard")), "directory")
        settled = done.where("depth is not null")
        parts = settled if parts is None else parts.unionByName(settled)
        open_cells = done.where("depth is null").select("cell")
        if fine == BITS or open_cells.isEmpty():
            return parts
        left = materialize(left.withColumn("cell", F.substring("bits", 1, fine)).join(open_cells, "cell", "left_semi").select("n_bytes", "bits"), "open-rows")
        base, fine = fine + 1, min(BITS, fine + ROUND_BITS)


def shards(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, shard (bit prefix, "" for the only
    one), depth, oversize."""
    rows = materialize(hashed(docs), "hashes")
    cells = materialize(directory(rows, limit), "cells")
    small, large = rows.where(F.col("n_bytes") <= limit), rows.where(F.col("n_bytes") > limit)
    out = large.select("doc_id", "n_bytes", F.col("bits").alias("shard"), F.lit(BITS).alias("depth"), F.lit(True).alias("oversize"))
    for r in cells.select(F.length("cell").alias("n")).distinct().toLocalIterator():  # one per round
        of = cells.where(F.length("cell") == r["n"])
        found = small.withColumn("cell", F.substring("bits", 1, r["n"])).join(of, "cell")
        out = out.unionByName(found.select("doc_id", "n_bytes", "shard", "depth", F.lit(False).alias("oversize")))
    return out


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> None:
    """Write ``docs`` (all columns) with one folder per shard under ``path``."""
    held = docs.withColumn("__bits", bits_of(F.col("doc_id"), F.monotonically_increasing_id())).withColumn(
        "__n", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    cells = materialize(directory(hashed(docs), limit), "cells").select("cell", F.col("shard").alias("shard_prefix"))
    out = held.where(F.col("__n") > limit).withColumn("shard_prefix", F.col("__bits"))
    for r in cells.select(F.length("cell").alias("n")).distinct().toLocalIterator():  # one per round
        part = held.where(F.col("__n") <= limit).withColumn("cell", F.substring("__bits", 1, r["n"]))
        out = out.unionByName(part.join(cells.where(F.length("cell") == r["n"]), "cell").drop("cell"))
    out.drop("__bits", "__n").repartition("shard_prefix").write.partitionBy("shard_prefix").parquet(path)
