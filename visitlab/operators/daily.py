"""Session statistics from mergeable daily states.

A day's log is reduced to one state per session of that day, and the states are
stored by date. A report over any range merges the states of its days; the log is
not read again, and a new day is added without reading the others.

States form a monoid per (date, session): a missing day is the zero, and
:func:`combine` adds states of the same day (for instance of a log that arrives
in parts). A session seen on two days has a state in each; the merge over the
range joins them before anything is counted, so it is one session with the steps
and the length of both days, exactly as over the log itself.

States of a task hold the flags of that task's keywords and categories, so its
filters work on merged sessions. Rows without a session id are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlab.operators import sessions
from visitlab.params import TaskParams
from visitlab.sources import sinks

STATE_SCHEMA = ("session_id string, user_id bigint, step_length bigint, start_time timestamp,"
                " end_time timestamp, keyword_hit boolean, category_hit boolean, date string")

_MERGE = ["min(user_id) AS user_id", "sum(step_length) AS step_length", "min(start_time) AS start_time",
          "max(end_time) AS end_time", "bool_or(keyword_hit) AS keyword_hit",
          "bool_or(category_hit) AS category_hit"]
_COLUMNS = [f.strip().split(" ")[0] for f in STATE_SCHEMA.split(",")]


def day_states(actions: DataFrame, params: TaskParams | None = None) -> DataFrame:
    """One state per (date, session) of visit actions."""
    aggs = ["min(CASE WHEN user_id <> -1 THEN user_id END) AS user_id", "count(1) AS step_length",
            "min(action_ts) AS start_time", "max(action_ts) AS end_time", *sessions.flag_aggs(params)]
    out = actions.where("session_id IS NOT NULL").groupBy("date", "session_id").agg(*[F.expr(a) for a in aggs])
    unused = [c for c in ("keyword_hit", "category_hit") if c not in out.columns]
    return out.withColumns({c: F.lit(None).cast("boolean") for c in unused}).select(*_COLUMNS)


def combine(states: DataFrame) -> DataFrame:
    """States of the same date and session added up."""
    return states.groupBy("date", "session_id").agg(*[F.expr(m) for m in _MERGE]).select(*_COLUMNS)


def write_days(states: DataFrame, path: str) -> None:
    """Store the states of the dates that ``states`` has, replacing these dates'
    earlier states; other dates are neither read nor touched."""
    sinks.overwrite_dates(states, path)


def read_days(spark: SparkSession, path: str, start_date: str, end_date: str) -> DataFrame:
    """The stored states of an inclusive range of dates (partitions are pruned)."""
    return (spark.read.schema(STATE_SCHEMA).parquet(path)
            .where(F.col("date").between(start_date, end_date)))


def merged_sessions(states: DataFrame) -> DataFrame:
    """One row per session over all days of ``states``, as the session aggregate
    of the log gives it (without the lists)."""
    out = states.groupBy("session_id").agg(*[F.expr(m) for m in _MERGE])
    return out.withColumn("visit_length", F.expr("unix_timestamp(end_time) - unix_timestamp(start_time)"))


def merged_profile(states: DataFrame, users: DataFrame) -> DataFrame:
    """Merged sessions with their user's attributes; ``users`` unique by ``user_id``
    as for the session profile."""
    return merged_sessions(states).join(users.select(*sessions.USER_COLUMNS), "user_id", "inner")


def filtered(states: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """Merged sessions that pass every parameter check. The states must have been
    made with the same keywords and categories."""
    return sessions.apply_filters(merged_profile(states, users), params)
