"""Scans of the visit log, user and product tables.

Two kinds of input are supported:

* a stored visit log (``user_visit_action`` layout, parquet, ideally written
  ``partitionBy("date")`` by :func:`visitlab.sources.sinks.overwrite_table`),
  where the date range prunes partitions;
* the driver's generic tables (``events``, ``customer``, ``part``), mapped
  onto the same model by pure column expressions (no shuffle). The date range
  becomes a predicate on ``events.ts`` so it reaches the parquet scan.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlab.functions.time import parse_time_sql
from visitlab.schema import VISIT_ACTION
from visitlab.sources import sinks


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet`` with the files that are there now."""
    return spark.read.parquet(table_path(sf_dir, name))


def _ts_bounds(ts_type: T.DataType, start_date: str | None, end_date: str | None):
    """Half-open [start 00:00, end+1 00:00) literals of the column's own type,
    so the comparison needs no cast on the column and is pushed to parquet."""
    lo = hi = None
    if start_date:
        lo = F.lit(start_date + " 00:00:00").cast(ts_type)
    if end_date:
        nxt = _dt.date.fromisoformat(end_date) + _dt.timedelta(days=1)
        hi = F.lit(nxt.isoformat() + " 00:00:00").cast(ts_type)
    return lo, hi


# ---------------------------------------------------------------------------
# events -> visit actions
# ---------------------------------------------------------------------------
# Helper values per event: u = user_id div 15, k = props.k, d = date(ts),
# sod = (seconds of day) div 24, slot from event_id % 32. A session is
# (u, d, slot); all its actions share the hour h.

_ID_LIST = ("CASE WHEN event_id % 3 = 0 THEN concat(CAST(k AS STRING), ',', "
            "CAST((k * 7 + 3) % 100 AS STRING)) ELSE CAST(k AS STRING) END")

_EVENT_HELPERS = [
    "event_id",
    "event_type",
    "CAST(user_id AS BIGINT) div 15 AS u",
    # props.k: documents of exactly the form {"k": <int>} are read by an
    # anchored pattern (cheap); any other JSON goes through the JSON parser
    "coalesce(try_cast(regexp_extract(props, '^\\\\{\\\\s*\"k\"\\\\s*:\\\\s*(-?[0-9]+)\\\\s*\\\\}$', 1)"
    " AS BIGINT), try_cast(get_json_object(props, '$.k') AS BIGINT)) AS k",
    "to_date(ts) AS d",
    "(hour(ts) * 3600 + minute(ts) * 60 + second(ts)) div 24 AS sod",
    "CASE WHEN event_id % 32 < 24 THEN 0 WHEN event_id % 32 < 28 THEN 1 "
    "WHEN event_id % 32 < 30 THEN 2 WHEN event_id % 32 = 30 THEN 3 ELSE 4 END AS slot",
]

_VISIT_ACTION_EXPRS = [
    "event_id",
    "CAST(d AS STRING) AS date",
    "u AS user_id",
    "concat_ws('-', CAST(u AS STRING),"
    " CAST(year(d) * 10000 + month(d) * 100 + dayofmonth(d) AS STRING), CAST(slot AS STRING))"
    " AS session_id",
    "event_id % 10 AS page_id",
    "concat(CAST(d AS STRING), ' ', CAST((u * 7 + dayofmonth(d) * 3 + slot * 5) % 23 AS STRING),"
    " ':', lpad(CAST(sod div 60 AS STRING), 2, '0'), ':', lpad(CAST(sod % 60 AS STRING), 2, '0'))"
    " AS action_time",
    "CASE WHEN event_type = 'view' THEN concat('kw', CAST(k % 10 AS STRING)) END AS search_keyword",
    "CASE WHEN event_type = 'click' THEN k ELSE CAST(-1 AS BIGINT) END AS click_category_id",
    "CASE WHEN event_type = 'click' THEN event_id % 100 ELSE CAST(-1 AS BIGINT) END"
    " AS click_product_id",
    f"CASE WHEN event_type = 'signup' THEN {_ID_LIST} END AS order_category_ids",
    "CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS STRING) END AS order_product_ids",
    f"CASE WHEN event_type = 'purchase' THEN {_ID_LIST} END AS pay_category_ids",
    "CASE WHEN event_type = 'purchase' THEN CAST(event_id % 100 AS STRING) END AS pay_product_ids",
    "u % 10 AS city_id",
    # typed time of the action (the text above, without re-parsing it)
    "timestamp_seconds(CAST(unix_date(d) AS BIGINT) * 86400"
    " + CAST((u * 7 + dayofmonth(d) * 3 + slot * 5) % 23 AS BIGINT) * 3600 + sod) AS action_ts",
]

# Columns of the visit log as stored (``action_ts`` is derived at scan time).
VISIT_COLUMNS = [
    "event_id", "date", "user_id", "session_id", "page_id", "action_time", "search_keyword",
    "click_category_id", "click_product_id", "order_category_ids", "order_product_ids",
    "pay_category_ids", "pay_product_ids", "city_id",
]


def visit_actions_from_events(events: DataFrame) -> DataFrame:
    """Map ``events`` rows onto the visit-log model (FIXTURES.md section 2),
    plus the typed ``action_ts``.

    Pure projections (SQL expressions, one analysis pass each); Catalyst
    prunes the ones a query does not use, down to the parquet ReadSchema.
    """
    return events.selectExpr(*_EVENT_HELPERS).selectExpr(*_VISIT_ACTION_EXPRS)


def visit_actions(spark: SparkSession, sf_dir: str, start_date: str | None = None,
                  end_date: str | None = None) -> DataFrame:
    """Visit actions of an inclusive date range, from the driver's ``events``.

    The range is applied to ``events.ts`` before the mapping, so parquet
    row-group statistics skip data outside it (``PushedFilters`` on ``ts``).
    """
    events = read_table(spark, sf_dir, "events")
    lo, hi = _ts_bounds(events.schema["ts"].dataType, start_date, end_date)
    if lo is not None:
        events = events.where(F.col("ts") >= lo)
    if hi is not None:
        events = events.where(F.col("ts") < hi)
    return visit_actions_from_events(events)


def read_visit_log(spark: SparkSession, path: str, start_date: str | None = None,
                   end_date: str | None = None) -> DataFrame:
    """A stored ``user_visit_action`` table; ``date`` is ``yyyy-MM-dd`` text, so
    the inclusive range is a string range (partition pruning when the table
    is partitioned by ``date``). The action-time text is parsed once here
    into ``action_ts`` (null when unparseable)."""
    # the declared schema keeps ``date`` as text (partition values would
    # otherwise be inferred as dates)
    return _date_range(spark.read.schema(VISIT_ACTION).parquet(path), start_date, end_date)


def _date_range(df: DataFrame, start_date: str | None, end_date: str | None) -> DataFrame:
    if start_date:
        df = df.where(F.col("date") >= F.lit(start_date))
    if end_date:
        df = df.where(F.col("date") <= F.lit(end_date))
    return df.withColumn("action_ts", F.expr(parse_time_sql("action_time")))


def read_bucketed_log(spark: SparkSession, table: str, start_date: str | None = None,
                      end_date: str | None = None) -> DataFrame:
    """A visit log stored by :func:`visitlab.sources.sinks.write_bucketed_log`.

    Columns and range as :func:`read_visit_log`. Its rows are already dealt by
    ``session_id``: the session profile and page flow run without an exchange, a
    semi join moves the session ids only. One task reads one bucket, so a session
    that holds a large share of the log is one task's work; with such a session
    read the same files by :func:`read_visit_log` (their folder), where scans are
    split and partial aggregates spread it. Results are the same either way."""
    # columns in the order of the model: the catalog puts the partition column last
    df = spark.table(table).select(*[f.name for f in VISIT_ACTION.fields])
    return _date_range(df, start_date, end_date)


def bucket_bytes(spark: SparkSession, table: str) -> DataFrame:
    """(bucket, n_files, bytes) of a bucketed log over all dates, from the files'
    names and sizes: what one task of a session job will read."""
    files = spark.table(table).selectExpr("_metadata.file_path AS f", "_metadata.file_size AS s").distinct()
    return (files.selectExpr("CAST(regexp_extract(f, '_([0-9]+)[.]c[0-9]+', 1) AS INT) AS bucket", "s")
            .groupBy("bucket").agg(F.count("*").alias("n_files"), F.sum("s").alias("bytes")))


def read_replaced(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table kept by
    :func:`visitlab.sources.sinks.replace_table`."""
    version = sinks.current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no version of a table at {path}")
    return spark.read.parquet(f"{path}/{version}")


# ---------------------------------------------------------------------------
# customer -> user_info, part -> product_info
# ---------------------------------------------------------------------------

def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users from ``customer``."""
    c = read_table(spark, sf_dir, "customer")
    return c.selectExpr(
        "CAST(c_custkey AS BIGINT) AS user_id",
        "concat('user', CAST(c_custkey AS STRING)) AS username",
        "c_name AS name",
        "CAST((c_custkey * 7 + 25) % 60 AS INT) AS age",
        "c_mktsegment AS professional",
        "concat('city', CAST(c_nationkey AS STRING)) AS city",
        "CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex")


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products from ``part``; ``extend_info`` is JSON text with a 0/1 status."""
    p = read_table(spark, sf_dir, "part")
    return p.selectExpr(
        "CAST(p_partkey AS BIGINT) AS product_id",
        "p_name AS product_name",
        "concat('{\"product_status\": ', CAST(p_size % 2 AS STRING), '}') AS extend_info")


def ad_click_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-click text records ``epoch_ms province city userid adid`` made from
    ``events``; one column ``value`` like a text source yields."""
    ev = read_table(spark, sf_dir, "events")
    return ev.selectExpr(
        "concat_ws(' ', CAST(unix_millis(CAST(ts AS TIMESTAMP)) AS STRING),"
        " CAST(user_id % 10 AS STRING), CAST(user_id % 10 AS STRING),"
        " CAST(user_id % 100 AS STRING), CAST(event_id % 20 AS STRING)) AS value")


__all__ = [
    "VISIT_COLUMNS", "table_path", "read_table",
    "visit_actions", "visit_actions_from_events", "read_visit_log", "user_info",
    "product_info", "ad_click_lines", "read_bucketed_log", "bucket_bytes", "read_replaced",
]
