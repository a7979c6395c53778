"""Hour-proportional, reproducible sample of sessions.

Sessions are counted per (date, hour of session start). Every cell gets a
quota ``n * min(K, total) div total + 1`` and contributes ``min(quota, n)``
sessions, chosen by the order of ``md5(seed || ':' || session_id)``.

Scale notes: the cell table has at most 24 rows per day of the date range,
whatever the data volume, so broadcasting it is safe. The draw is a ``row_number`` per cell; the redundant literal bound
``rn <= K + 1`` (a quota never exceeds K + 1, as n <= total) lets Spark
insert a partial ``WindowGroupLimit`` before the shuffle, so a busy hour
sends at most K + 1 rows per map task instead of all of its sessions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlab.functions.text import sql_str
from visitlab.functions.time import format_date_sql, format_time_sql
from visitlab.operators.sessions import session_lists

DEFAULT_SEED = "visitlab"


def with_cell(sessions: DataFrame) -> DataFrame:
    """Add the (date, hour) cell of the session start."""
    return sessions.withColumns({"date": F.expr(format_date_sql("start_time")),
                                 "hour": F.expr("hour(start_time)")})


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    """(date, hour, session_count) over the sessions' start times."""
    return (with_cell(sessions.where("start_time IS NOT NULL"))
            .groupBy("date", "hour").agg(F.expr("count(1) AS session_count")))


def extract_quota(per_hour: DataFrame, k: int) -> DataFrame:
    """Quota per cell, ``n * min(K, total) div total + 1``.

    The total is a scalar subquery over the cell table (partial sums per
    task, one merged value); the cell table itself is computed once and its
    shuffle is shared with the subquery.
    """
    total = per_hour.select(F.sum("session_count")).scalar()
    return (per_hour.withColumn("total", total)
            .selectExpr("date", "hour", "session_count",
                        f"(session_count * least({int(k)}L, total)) div total + 1 AS quota"))


def random_extract(sessions: DataFrame, k: int, seed: str = DEFAULT_SEED,
                   task_id: str = "", actions: DataFrame | None = None) -> DataFrame:
    """The sampled sessions with start time, keywords and categories.

    Counting and drawing read only (session_id, start_time), so both use the
    same session aggregation (its shuffle is reused). The keyword and
    category lists are then fetched for the sampled sessions only: from
    ``actions`` when given (aggregating just those sessions' actions), else
    from the list columns of ``sessions`` (e.g. a written profile table).
    """
    base = sessions.select("session_id", "start_time")
    cells = with_cell(base.where("start_time IS NOT NULL"))
    quota = extract_quota(sessions_per_hour(base), k).select("date", "hour", "quota")
    w = Window.partitionBy("date", "hour").orderBy(
        F.expr(f"md5(concat({sql_str(seed + ':')}, session_id))"), F.col("session_id"))
    ranked = (cells.join(F.broadcast(quota), ["date", "hour"])
              .withColumn("rn", F.row_number().over(w)))
    # rn <= K + 1 is implied by rn <= quota; as a literal bound it enables the
    # partial per-cell limit before the shuffle.
    picked = ranked.where(f"rn <= {int(k) + 1} AND rn <= quota").select("session_id", "start_time")
    if actions is not None:
        lists = session_lists(actions, picked)
    else:
        lists = sessions.select("session_id", "search_keywords", "click_category_ids")
    return picked.join(lists, "session_id", "left").selectExpr(
        f"{sql_str(task_id)} AS task_id", "session_id",
        format_time_sql("start_time") + " AS start_time",
        "nullif(search_keywords, '') AS search_keywords",
        "nullif(click_category_ids, '') AS click_category_ids")


def extract_detail(actions: DataFrame, extracted: DataFrame, task_id: str = "") -> DataFrame:
    """All actions of the sampled sessions, tagged with the task id.

    K is the caller's, so there is no hint: AQE broadcasts the ids if their
    measured size is under the threshold.
    """
    ids = extracted.select("session_id")
    return actions.join(ids, "session_id", "left_semi").selectExpr(
        f"{sql_str(task_id)} AS task_id", "user_id", "session_id", "page_id", "action_time",
        "search_keyword", "click_category_id", "click_product_id", "order_category_ids",
        "order_product_ids", "pay_category_ids", "pay_product_ids")
