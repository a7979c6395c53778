"""Category counts, the ten most popular categories and, for each of them,
the ten sessions that clicked it most.

The original built a distinct category list, three separate counts and
three outer joins. Here every action is exploded once into tagged
(kind, category_id) pairs and one aggregation by category counts all three
kinds; categories seen in any kind appear, missing kinds count 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlab.functions.text import sql_str


def category_events(actions: DataFrame) -> DataFrame:
    """One row per (action, category touched): ``session_id, kind, category_id``.

    Clicks carry one id (``-1`` = no click); order and pay lists are split,
    repeated ids count each time, empty or unparseable parts are dropped.
    Built from generators only (``stack``, ``explode``), so the whole step
    stays in generated code.
    """
    return (actions.selectExpr(
                "session_id",
                "stack(3, 'click', CASE WHEN click_category_id <> -1"
                " THEN CAST(click_category_id AS STRING) END,"
                " 'order', order_category_ids, 'pay', pay_category_ids) AS (kind, ids)")
            .selectExpr("session_id", "kind", "explode(split(ids, ',')) AS id_text")
            .selectExpr("session_id", "kind", "try_cast(trim(id_text) AS BIGINT) AS category_id")
            .where("category_id IS NOT NULL AND session_id IS NOT NULL"))


def category_session_counts(actions: DataFrame) -> DataFrame:
    """(category_id, session_id, click_count, order_count, pay_count).

    One aggregate that serves both rankings: summed by category it gives the
    category counts, filtered to the top categories it gives the sessions'
    clicks. After a shuffled semi join on session_id it needs no exchange of
    its own. The report jobs write it once and read it for both rankings.
    """
    return category_events(actions).groupBy("category_id", "session_id").agg(
        F.expr("count_if(kind = 'click') AS click_count"),
        F.expr("count_if(kind = 'order') AS order_count"),
        F.expr("count_if(kind = 'pay') AS pay_count"))


def full_count_from_sessions(cs: DataFrame) -> DataFrame:
    """Category totals from :func:`category_session_counts` (partial sums)."""
    return cs.groupBy("category_id").agg(
        F.expr("sum(click_count) AS click_count"),
        F.expr("sum(order_count) AS order_count"),
        F.expr("sum(pay_count) AS pay_count"))


def top_category_sessions(cs: DataFrame, task_id: str = "",
                          n: int = 10) -> tuple[DataFrame, DataFrame]:
    """(top-n categories, clicks per (category, session) for those categories)
    from :func:`category_session_counts`."""
    top = top10_category(full_count_from_sessions(cs), task_id, n)
    clicks = (cs.where("click_count > 0")
              .join(F.broadcast(top.select("category_id")), "category_id", "left_semi")
              .select("category_id", "session_id", "click_count"))
    return top, clicks


def category_full_count(actions: DataFrame) -> DataFrame:
    """(category_id, click_count, order_count, pay_count) for every category
    seen in a click, order or payment."""
    return category_events(actions).groupBy("category_id").agg(
        F.expr("count_if(kind = 'click') AS click_count"),
        F.expr("count_if(kind = 'order') AS order_count"),
        F.expr("count_if(kind = 'pay') AS pay_count"))


def category_kind_count(actions: DataFrame, kind: str) -> DataFrame:
    """(category_id, <kind>_count) for categories with at least one ``kind``.

    Reads the one column of that kind: clicks are counted as they are, only
    order and pay lists are exploded."""
    rows = actions.where("session_id IS NOT NULL")
    if kind == "click":
        rows = rows.where("click_category_id <> -1").selectExpr("click_category_id AS category_id")
    else:
        rows = (rows.selectExpr(f"explode(split({kind}_category_ids, ',')) AS id_text")
                .selectExpr("try_cast(trim(id_text) AS BIGINT) AS category_id")
                .where("category_id IS NOT NULL"))
    return rows.groupBy("category_id").agg(F.expr(f"count(1) AS {kind}_count"))


def category_ids(actions: DataFrame) -> DataFrame:
    """Distinct categories clicked, ordered or paid."""
    return category_events(actions).select("category_id").distinct()


def top10_category(full_count: DataFrame, task_id: str = "", n: int = 10) -> DataFrame:
    """Top categories by click, then order, then pay count; ties by id.
    ``orderBy().limit()`` plans as ``TakeOrderedAndProject``: each task keeps
    its own top n, no global sort."""
    return (full_count
            .orderBy(F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"),
                     F.asc("category_id"))
            .limit(n)
            .selectExpr(f"{sql_str(task_id)} AS task_id", "category_id", "click_count", "order_count",
                        "pay_count"))


def top_sessions(session_clicks: DataFrame, task_id: str = "", n: int = 10) -> DataFrame:
    """Top n sessions per category by clicks, ties by session id.

    The literal bound on ``row_number`` lets Spark place a partial
    ``WindowGroupLimit`` before the shuffle by category, so a category
    clicked by very many sessions ships only n rows per map task.
    """
    w = Window.partitionBy("category_id").orderBy(F.desc("click_count"), F.asc("session_id"))
    return (session_clicks.withColumn("rn", F.row_number().over(w))
            .where(f"rn <= {int(n)}")
            .selectExpr(f"{sql_str(task_id)} AS task_id", "category_id", "session_id", "click_count"))
