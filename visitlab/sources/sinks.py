"""Output sinks of the reports and of the visit log.

* :func:`overwrite_table` replaces a folder (the visit log is written
  ``partitionBy("date")`` so later date ranges prune partitions);
* :func:`write_bucketed_log` stores the visit log as a catalog table, bucketed by
  session inside its dates, so that session jobs need no shuffle of actions;
* :func:`replace_table` replaces a table in one step: readers see the old
  version until the new one is complete, also when the write fails;
* :func:`overwrite_dates` replaces only the dates that the new rows have;
* :func:`append_parquet` appends a report (the default sink);
* :func:`append_jdbc` appends a report to a relational table through Spark's
  JDBC writer; connection settings come from the caller, never from files in
  this repository.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_task_id() -> str:
    return str(uuid.uuid4())


def with_task_id(df: DataFrame, task_id: str) -> DataFrame:
    """Tag every row with the run id (first column)."""
    rest = [c for c in df.columns if c != "task_id"]
    return df.select(F.lit(task_id).alias("task_id"), *rest)


def overwrite_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the table at ``path`` (parquet), optionally partitioned."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_bucketed_log(actions: DataFrame, table: str, path: str, buckets: int) -> None:
    """Store visit actions as the catalog table ``table`` (files under ``path``),
    partitioned by ``date`` and bucketed and sorted by ``session_id``.

    Rows are dealt by (date, bucket) first, so each bucket of a date is one file
    and a session that holds a large share of the log is written date by date. A
    bucket is what one task of a later session job reads: choose ``buckets`` so
    that all dates' rows of one are a few hundred MB
    (:func:`visitlab.sources.tables.bucket_bytes` shows what came out). The table
    must not exist yet."""
    rows = actions.repartition(F.col("date"), F.expr(f"pmod(hash(session_id), {int(buckets)})"))
    (rows.write.format("parquet").option("path", path).partitionBy("date")
     .bucketBy(int(buckets), "session_id").sortBy("session_id").saveAsTable(table))


def overwrite_dates(df: DataFrame, path: str, partition_by: str = "date") -> None:
    """Replace the partitions that ``df`` has rows of and leave all others as they
    are. The new files are staged and moved in when the whole job has succeeded,
    so a failing write changes nothing."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_by).parquet(path))


#: Folder of a replaceable table that lists its versions.
VERSIONS = "versions"


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Replace the table at ``path`` in one step and return the new version.

    The rows are written aside, to a folder of their own, and the switch is one
    row appended to the list of versions (a single task's file, which appears as
    a whole). Until then :func:`visitlab.sources.tables.read_replaced` gives the
    old version, and a write that fails never becomes one. Old versions stay
    readable for jobs that hold them; :func:`old_versions` names the folders that
    may be deleted."""
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(f"{path}/{version}")
    known = versions(spark, path)
    last = known.agg(F.max("n")).first()[0] if known is not None else None
    row = spark.createDataFrame([((last or 0) + 1, version)], "n long, version string")
    row.coalesce(1).write.mode("append").parquet(f"{path}/{VERSIONS}")
    return version


def versions(spark: SparkSession, path: str) -> DataFrame | None:
    """(n, version) of a replaceable table; None when it has no version yet."""
    try:
        return spark.read.schema("n long, version string").parquet(f"{path}/{VERSIONS}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def current_version(spark: SparkSession, path: str) -> str | None:
    """The version readers see. Of two that were written at the same time under
    one number the greater name counts, for every reader alike."""
    known = versions(spark, path)
    row = known.orderBy(F.desc("n"), F.desc("version")).first() if known is not None else None
    return row["version"] if row else None


def old_versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of versions that have been replaced."""
    known, now = versions(spark, path), current_version(spark, path)
    return [] if known is None else [f"{path}/{r['version']}" for r in known.orderBy("n", "version").collect()
                                     if r["version"] != now]


def append_parquet(df: DataFrame, path: str) -> None:
    """Append a report to the parquet table at ``path``."""
    df.write.mode("append").parquet(path)


def jdbc_writer(df: DataFrame, url: str, table: str, properties: dict | None = None,
                num_partitions: int | None = None):
    """Configured JDBC writer (append). ``num_partitions`` caps concurrent
    connections through the writer's own ``numPartitions`` option."""
    w = df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
    if num_partitions:
        w = w.option("numPartitions", str(int(num_partitions)))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    return w


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
                num_partitions: int | None = None) -> None:
    """Append a report to a relational table through Spark's JDBC writer."""
    jdbc_writer(df, url, table, properties, num_partitions).save()
