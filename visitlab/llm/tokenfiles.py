"""Token-id files with a minimal perfect hash index.

``write`` encodes the texts in ascending doc_id order and writes two Parquet
folders that any Spark file system can hold:

* ``payload``: one row per shard of about ``SHARD_IDS`` ids: the raw ids of its
  documents as little-endian unsigned 32-bit integers, where each document
  begins, and how many ids it has (with the end id). (part, seq) is the order.
* ``index``: one row per key bucket of about ``BUCKET_KEYS`` keys. A minimal
  perfect hash (levels of bit arrays; a key's value is the rank of its bit) maps
  a doc_id to a slot that stores a 32-bit fingerprint and the document's place:
  part, seq, begin, n, start (ids of all documents before it), ordinal, and how
  many rows have that doc_id.

``read_one`` answers by key in constant time: the key's bucket names the one folder
of the index to open (``GROUP_BUCKETS`` buckets, sorted, of which the bucket's row
group is read), a few bit probes and one slot name the payload folder (one per
written partition) and shard, of which one slice is returned. ``lookup`` does the
same for a table of keys. A foreign key is refused by its fingerprint (a wrong hit
has probability 2**-32).

Defined results: a null or empty text is the end id alone; rows of one doc_id
(and copies of one row) follow each other by the text's hash, the index names the
first and their number; rows with a null doc_id come first in the files and have
no key; extra columns are ignored; an empty table gives no shards and no buckets.
A document is never cut, so a shard is as long as its longest document at least.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lean
from .encode import encoder
from .tokens import mix64

END_ID = 0
SHARD_IDS = 1 << 18
BUCKET_KEYS = 1024
#: Buckets in one folder of the index, and bytes of its row groups.
GROUP_BUCKETS, GROUP_BYTES = 1024, 1 << 20
#: Bits per remaining key in each level of the hash.
GAMMA = 1.7
#: Keys left after so many levels are kept in a sorted list.
MOST_LEVELS = 40

_PAYLOAD = "part int, seq int, n_ids long, payload binary, doc_ids array<long>, begins array<long>, lens array<long>"
_PLACE = ["part", "seq", "begin", "n", "start", "ordinal", "n_rows"]
_INDEX = "bucket long, n_buckets long, n_keys long, levels array<long>, bits binary, rest binary, fingerprints binary, " + ", ".join(f"{c} binary" for c in _PLACE)


# --- minimal perfect hash over distinct 64-bit integers ---

def _key_hash(keys: np.ndarray) -> np.ndarray:
    return mix64(keys.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def _level_places(h: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix64(h ^ np.uint64((level + 1) * 0xD6E8FEB86659FD93 % 2**64)) % np.uint64(size)).astype(np.int64)


def build_hash(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(level sizes, bits of all levels, keys left) for distinct keys."""
    left = _key_hash(keys)
    sizes, bits = [], []
    while len(left) and len(sizes) < MOST_LEVELS:
        size = max(8, int(GAMMA * len(left)))
        at = _level_places(left, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        bits.append(alone)
        sizes.append(size)
        left = left[~alone[at]]
    return sizes, np.concatenate([np.empty(0, bool), *bits]), np.sort(left)


def evaluate(keys: np.ndarray, sizes: list[int], bits: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Slot of each key; for foreign keys some slot or -1."""
    h = _key_hash(keys)
    rank = np.concatenate(([0], np.cumsum(bits)))
    slot = np.full(len(keys), -1, np.int64)
    todo, base = np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        at = _level_places(h[todo], level, size) + base
        hit = bits[at]
        slot[todo[hit]] = rank[at[hit]]
        todo, base = todo[~hit], base + size
    if len(todo) and len(rest):
        at = np.minimum(np.searchsorted(rest, h[todo]), len(rest) - 1)
        known = rest[at] == h[todo]
        slot[todo[known]] = rank[-1] + at[known]
    return slot


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix64(_key_hash(keys) + np.uint64(0xA24BAED4963EE407)) >> np.uint64(32)).astype(np.uint32)


def _build_bucket(frame: pd.DataFrame) -> pd.DataFrame:
    keys = frame["doc_id"].to_numpy(np.int64)
    sizes, bits, rest = build_hash(keys)
    slot = evaluate(keys, sizes, bits, rest)
    order = np.argsort(slot)
    row = {"bucket": int(frame["bucket"].iloc[0]), "n_buckets": int(frame["n_buckets"].iloc[0]), "n_keys": len(keys), "levels": sizes, "bits": np.packbits(bits).tobytes(),
           "rest": rest.tobytes(), "fingerprints": fingerprint(keys)[order].tobytes()}
    row |= {c: frame[c].to_numpy(np.int64)[order].tobytes() for c in _PLACE}
    return pd.DataFrame([row])


def _find(index: pd.Series, keys: np.ndarray) -> pd.DataFrame:
    """Places of the keys that a bucket's index row knows."""
    sizes = [int(x) for x in index["levels"]]
    bits = np.unpackbits(np.frombuffer(index["bits"], np.uint8), count=sum(sizes)).astype(bool)
    slot = evaluate(keys, sizes, bits, np.frombuffer(index["rest"], np.uint64))
    known = slot >= 0
    stored = np.frombuffer(index["fingerprints"], np.uint32)
    known[known] = stored[slot[known]] == fingerprint(keys[known])
    out = pd.DataFrame({"doc_id": keys[known]})
    for c in _PLACE:
        out[c] = np.frombuffer(index[c], np.int64)[slot[known]]
    return out


# --- writing ---

def _encode_shards(tokenizer: str):
    @lean("encoder")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        names: list[int | None] = []
        total = 0

        def shard() -> pa.RecordBatch:
            lens = np.array([len(x) for x in ids], np.int64)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_ids": pa.array([total], pa.int64()),
                "payload": pa.array([np.concatenate(ids).astype("<u4").tobytes()], pa.binary()),
                "doc_ids": pa.array([names], pa.list_(pa.int64())), "begins": pa.array([np.cumsum(lens) - lens], pa.list_(pa.int64())),
                "lens": pa.array([lens], pa.list_(pa.int64()))})

        encode = encoder(tokenizer)
        end = np.array([END_ID], np.uint32)
        for batch in batches:
            for name, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                one = np.concatenate((encode.ids(text.as_py()), end))
                ids.append(one)
                names.append(name)
                total += len(one)
                if total >= SHARD_IDS:
                    yield shard()
                    ids, names, total, seq = [], [], 0, seq + 1
        if ids:
            yield shard()

    return run


def payload(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_PAYLOAD).parquet(f"{path}/payload")


def index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_INDEX).parquet(f"{path}/index").drop("group")


def _with_bucket(rows: DataFrame, n_buckets: int) -> DataFrame:
    return rows.withColumn("n_buckets", F.lit(n_buckets).cast("long")).withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit(2)), "n_buckets"))


def n_buckets(n_keys: int) -> int:
    return max(1, -(-n_keys // BUCKET_KEYS))


def shard_starts(shards: DataFrame) -> DataFrame:
    """Shards with the ids and the documents before each (first_id, first_doc).
    Sums per part come first, so no task orders all shards."""
    size = shards.withColumn("n_docs", F.size("lens").cast("long"))
    parts = size.groupBy("part").agg(F.sum("n_ids").alias("p_ids"), F.sum("n_docs").alias("p_docs"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per written partition
    before = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    parts = parts.select("part", before("p_ids", over).alias("p_ids"), before("p_docs", over).alias("p_docs"))
    inner = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (size.join(parts, "part").withColumn("first_id", F.col("p_ids") + before("n_ids", inner))
            .withColumn("first_doc", F.col("p_docs") + before("n_docs", inner)).drop("p_ids", "p_docs", "n_docs"))


def _documents(starts: DataFrame) -> DataFrame:
    """One row per document from shards with their starts."""
    zipped = F.arrays_zip("doc_ids", "begins", "lens")
    return (starts.select("part", "seq", "first_id", "first_doc", F.posexplode(zipped).alias("i", "x"))
            .select("part", "seq", "x.*", (F.col("first_id") + F.col("x.begins")).alias("start"), (F.col("first_doc") + F.col("i")).alias("ordinal")))


def write(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Encode ``docs`` (doc_id, text) and write payload and index under ``path``."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    shards = (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
              .mapInArrow(_encode_shards(tokenizer), _PAYLOAD))
    shards.write.option("compression", "zstd").option("parquet.block.size", 16 << 20).partitionBy("part").parquet(f"{path}/payload")

    entries = _documents(shard_starts(payload(spark, path).drop("payload"))).where("doc_ids is not null")
    place = F.struct("ordinal", "start", "part", "seq", F.col("begins").alias("begin"), F.col("lens").alias("n"))
    keys = (entries.groupBy(F.col("doc_ids").alias("doc_id")).agg(F.min(place).alias("p"), F.count("*").alias("n_rows"))
            .select("doc_id", "p.*", "n_rows"))
    n = docs.where("doc_id is not null").count()
    built = _with_bucket(keys, n_buckets(n)).groupBy("bucket").applyInPandas(_build_bucket, _INDEX)
    grouped = built.withColumn("group", F.floor(F.col("bucket") / GROUP_BUCKETS)).repartition("group").sortWithinPartitions("group", "bucket")
    grouped.write.option("compression", "zstd").option("parquet.block.size", GROUP_BYTES).partitionBy("group").parquet(f"{path}/index")


# --- reading ---

def lookup(keys: DataFrame, path: str) -> DataFrame:
    """Places of the doc_ids in ``keys`` that the files hold, by the index."""
    spark = keys.sparkSession
    idx = index(spark, path)
    buckets = idx.agg(F.max("n_buckets")).first()[0]
    if buckets is None:
        return spark.createDataFrame([], "doc_id long, " + ", ".join(f"{c} long" for c in _PLACE))
    asked = _with_bucket(keys.select(F.col("doc_id").cast("long")).where("doc_id is not null").distinct(), buckets)

    def find(asked: pd.DataFrame, row: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or row.empty:
            return pd.DataFrame(columns=["doc_id", *_PLACE]).astype("int64")
        return _find(row.iloc[0], asked["doc_id"].to_numpy(np.int64))

    return (asked.groupBy("bucket").cogroup(idx.groupBy("bucket"))
            .applyInPandas(find, "doc_id long, " + ", ".join(f"{c} long" for c in _PLACE)))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, start, n, crc) of every document, from the payload slices.

    The documents are exploded beside their payload, where generated code holds
    the bytes once a shard; a lambda would copy the whole payload for each slice."""
    shards = payload(spark, path)
    slices = (shards.select("part", "seq", "payload", F.posexplode(F.arrays_zip("begins", "lens")).alias("i", "x"))
              .select("part", "seq", "i", "x.*", F.expr("crc32(substring(payload, cast(4 * x.begins + 1 as int), cast(4 * x.lens as int)))").alias("crc")))
    starts = shard_starts(shards.select("part", "seq", "n_ids", "lens")).select("part", "seq", "first_id", "first_doc")
    return (slices.join(starts, ["part", "seq"])
            .select((F.col("first_doc") + F.col("i")).alias("ordinal"), (F.col("first_id") + F.col("begins")).alias("start"),
                    F.col("lens").alias("n"), "crc"))


def index_row(spark: SparkSession, path: str, group: int) -> DataFrame:
    """The index rows of one folder; empty if it has none."""
    try:
        return spark.read.schema(_INDEX).parquet(f"{path}/index/group={group}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], _INDEX)
        raise


def shard(spark: SparkSession, path: str, part: int, seq: int) -> DataFrame:
    """One shard's row."""
    return spark.read.schema(_PAYLOAD).parquet(f"{path}/payload/part={part}").where(F.col("seq") == seq)


def find_one(spark: SparkSession, path: str, doc_id: int) -> dict | None:
    """Place of the first row of that doc_id, or None; opens one bucket."""
    first = index_row(spark, path, 0).select("n_buckets").first()  # the number of buckets stands in every row
    if first is None:
        return None
    key = spark.range(1).select(F.lit(doc_id).cast("long").alias("doc_id"))
    bucket = _with_bucket(key, first["n_buckets"]).first()["bucket"]
    row = index_row(spark, path, bucket // GROUP_BUCKETS).where(F.col("bucket") == bucket).first()
    found = [] if row is None else _find(pd.Series(row.asDict()), np.array([doc_id], np.int64)).to_dict("records")
    return found[0] if found else None


def read_one(spark: SparkSession, path: str, doc_id: int) -> np.ndarray | None:
    """Ids of one document (the first row of that doc_id), or None; opens one
    bucket of the index and one shard."""
    at = find_one(spark, path, doc_id)
    if at is None:
        return None
    raw = shard(spark, path, at["part"], at["seq"]).select(
        F.expr(f"substring(payload, {4 * at['begin'] + 1}, {4 * at['n']})").alias("p")).first()
    return np.frombuffer(bytes(raw["p"]), "<u4")


def read_back(docs: DataFrame, path: str) -> DataFrame:
    """One row per written row of ``docs``: doc_id, start, n_tokens, ids_crc32.
    Keyed rows are found through the index, rows without a key by their place."""
    spark = docs.sparkSession
    found = lookup(docs, path)
    keyed = (found.select("doc_id", "ordinal", F.expr("explode(sequence(0L, n_rows - 1))").alias("k"))
             .withColumn("ordinal", F.col("ordinal") + F.col("k")))
    nameless = docs.where("doc_id is null").groupBy().count().select(
        F.expr("cast(null as bigint) doc_id"), F.expr("explode(if(count > 0, sequence(0L, count - 1), cast(array() as array<bigint>)))").alias("ordinal"))
    places = keyed.select("doc_id", "ordinal").unionByName(nameless)
    return (places.join(digests(spark, path), "ordinal")
            .select("doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32")))
