"""SparkSession construction and session-level helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every analysis relies on. AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is under the threshold), coalesces
# small shuffle partitions and splits skewed join partitions; with
# forceOptimizeSkewedJoin the split is made even where it costs an extra
# shuffle further up, instead of leaving a hot key in one task. An aggregate
# whose input is sorted by its keys runs as a sort aggregate, which holds one
# group at a time (the session lists).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "visitlab", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the settings above.

    On a cluster the master, memory and ``spark.checkpoint.dir`` come from
    the submit configuration; locally ``master`` defaults to ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf already fixed by the running session
                pass
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from ``spark.checkpoint.dir``. Only a local master (tests, local
    runs) may fall back to a scratch folder; on a cluster an unset value is an
    error, because a machine-local folder would not survive a lost executor.
    """
    sc = _context(spark)
    path = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not path:
        master = sc.master if sc else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store)")
        path = tempfile.mkdtemp(prefix="visitlab-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    Used where one intermediate result feeds several reports: it is computed
    once, and the lineage is cut at a reliable, shared location, so a lost
    executor re-reads the written table instead of recomputing the upstream
    shuffles.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
