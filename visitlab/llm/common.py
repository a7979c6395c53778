"""Reading tables, the shared scratch folder and materialised intermediates."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of one Arrow batch sent to a Python worker, and its most rows.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 1000

_LOCAL_SCRATCH: dict[str, str] = {}


def configure(spark: SparkSession) -> None:
    """Session settings that bound the memory of a Python worker's batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def scratch_root(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir.

    Where it is unset, a local[N] session (tests) gets a temporary folder; any
    other master raises, as its executors would not see the driver's folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by driver and executors")
    return _LOCAL_SCRATCH.setdefault("dir", tempfile.mkdtemp(prefix="visitlab-llm-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared scratch folder."""
    return f"{scratch_root(spark)}/visitlab-llm/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage, and a lost executor's work is read again, not computed again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: What a worker process keeps between tasks: owner and how to drop it.
_KEPT: dict[str, Callable[[], None]] = {}


def keeps(owner: str, drop: Callable[[], None]) -> None:
    """Say that this process keeps something for ``owner``'s next task."""
    _KEPT[owner] = drop


def lean(owner: str = ""):
    """Decorator of a function over Arrow batches: before it starts, drop what
    other operators keep in the worker; afterwards, return freed memory to the
    system. Spark reuses workers, and several share an executor's memory."""

    def wrap(fn):
        @functools.wraps(fn)
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for other in [k for k in _KEPT if k != owner]:
                _KEPT.pop(other)()
            _trim()
            yield from fn(batches)
            _trim()

        return run

    return wrap


def _trim() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # a C library without it
        pass
