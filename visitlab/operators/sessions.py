"""Session profile and session filters.

One aggregation by ``session_id`` turns the visit log into one typed row per
session. Without the keyword and category lists all its aggregates (min, max,
count, bool_or) are plain hash aggregates with partial forms, so each map task
combines its rows of a session before the shuffle and a very large session
arrives at its reducer as one partial row per map task.

With the lists the log is first reduced to its distinct (session, keyword,
category) combinations, which spreads a large session over tasks, and only
these meet by session, in order. A session's lists are then built by a sort
aggregate, one session in memory at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlab.functions.text import sql_str
from visitlab.params import TaskParams

USER_COLUMNS = ["user_id", "age", "professional", "sex", "city"]


def _sql_list(values) -> str:
    return ", ".join(sql_str(v) if isinstance(v, str) else str(int(v)) for v in values)


def flag_aggs(params: TaskParams | None) -> list[str]:
    """Flags ``keyword_hit`` / ``category_hit`` that the parameters ask for."""
    aggs = []
    if params is not None and params.keywords:
        aggs.append(f"coalesce(bool_or(search_keyword IN ({_sql_list(params.keywords)})), false)"
                    " AS keyword_hit")
    if params is not None and params.category_ids:
        aggs.append("coalesce(bool_or(click_category_id IN "
                    f"({_sql_list(params.category_ids)})), false) AS category_hit")
    return aggs


def _in_order(combinations: DataFrame) -> DataFrame:
    """Distinct (session, keyword, category) rows, by session and keyword, with
    ``new_keyword`` at the first row of each keyword. The window brings the rows
    of a session together (a log bucketed by session has them together) and
    leaves them sorted by session, so the list aggregate need not hash."""
    by_keyword = Window.partitionBy("session_id").orderBy("search_keyword", "click_category_id")
    seen = F.lag("search_keyword").over(by_keyword)
    return combinations.withColumn("new_keyword", ~F.col("search_keyword").eqNullSafe(seen))


# Distinct searched keywords and clicked categories of a session as comma text,
# sorted (ids as numbers); null when there are none. Over the rows of _in_order.
LIST_AGGS = [
    "nullif(array_join(array_sort(collect_list(CASE WHEN new_keyword AND search_keyword <> ''"
    " THEN search_keyword END)), ','), '') AS search_keywords",
    "nullif(array_join(CAST(array_sort(collect_set(CASE WHEN click_category_id <> -1"
    " THEN click_category_id END)) AS ARRAY<STRING>), ','), '') AS click_category_ids",
]


def session_aggregate(actions: DataFrame, params: TaskParams | None = None,
                      lists: bool = True) -> DataFrame:
    """Per-session aggregates of the visit log (before the user join).

    Rows without a session id belong to no session and are left out.

    Expects the typed ``action_ts`` of the scan (null for unparseable text).
    Columns: session_id, user_id (smallest id other than -1), search_keywords,
    click_category_ids (both only with ``lists``), step_length, start_time,
    end_time, visit_length (whole seconds) and, when the parameters ask for them,
    the flags ``keyword_hit`` / ``category_hit`` used by :func:`session_predicate`.
    """
    rows = actions.where("session_id IS NOT NULL")
    parts = ["min(CASE WHEN user_id <> -1 THEN user_id END) AS user_id", "count(1) AS step_length",
             "min(action_ts) AS start_time", "max(action_ts) AS end_time"]
    if lists:
        combinations = rows.groupBy("session_id", "search_keyword", "click_category_id").agg(
            *[F.expr(a) for a in parts])
        aggs = ["min(user_id) AS user_id", *LIST_AGGS, "sum(step_length) AS step_length",
                "min(start_time) AS start_time", "max(end_time) AS end_time"]
        out = _in_order(combinations).groupBy("session_id").agg(
            *[F.expr(a) for a in aggs + flag_aggs(params)])
    else:
        out = rows.groupBy("session_id").agg(*[F.expr(a) for a in parts + flag_aggs(params)])
    return out.withColumn(
        "visit_length", F.expr("unix_timestamp(end_time) - unix_timestamp(start_time)"))


def session_lists(actions: DataFrame, session_ids: DataFrame) -> DataFrame:
    """Keyword and category lists of some sessions, aggregated from their
    actions only. AQE broadcasts the ids if their measured size allows it."""
    acts = actions.join(session_ids.select("session_id"), "session_id", "left_semi")
    combinations = acts.select("session_id", "search_keyword", "click_category_id").distinct()
    return _in_order(combinations).groupBy("session_id").agg(*[F.expr(a) for a in LIST_AGGS])


def one_row_per_user(users: DataFrame) -> DataFrame:
    """The user attributes with unique, non-null ``user_id``.

    A repeated id would multiply the sessions of its user in every join. Of
    several rows of one id the greatest by (age, professional, sex, city) is
    taken, nulls being smallest, so the choice does not depend on row order. On
    the shuffled path the join needs the users by ``user_id`` anyway, so this
    adds no exchange there.
    """
    attributes = ", ".join(USER_COLUMNS[1:])
    return (users.where("user_id IS NOT NULL").groupBy("user_id")
            .agg(F.expr(f"max(struct({attributes})) AS u")).select("user_id", "u.*"))


def repeated_users(users: DataFrame) -> DataFrame:
    """(user_id, n_rows) of the ids that have several rows, for a report or a
    check before a run."""
    return (users.where("user_id IS NOT NULL").groupBy("user_id")
            .agg(F.count("*").alias("n_rows")).where("n_rows > 1"))


def session_profile(actions: DataFrame, users: DataFrame,
                    params: TaskParams | None = None, lists: bool = True) -> DataFrame:
    """Session aggregates joined (inner) with the user attributes.

    Sessions whose user is unknown drop out. ``users`` should be unique by
    ``user_id``: this is the plain join, in which a repeated user row repeats its
    sessions, and the queries and reports pass :func:`one_row_per_user`. The join
    strategy is left to AQE: the user table is broadcast only when its measured
    size is under ``spark.sql.autoBroadcastJoinThreshold``, otherwise both sides
    shuffle.
    """
    agg = session_aggregate(actions, params, lists)
    return agg.join(users.select(*USER_COLUMNS), "user_id", "inner")


def session_predicate(params: TaskParams) -> Column | None:
    """AND of the parameter checks; None when nothing is restricted.

    * age: only when both bounds are given; unknown age fails.
    * professionals, cities: membership; an unknown value fails, and so does
      the value ``-1`` (the log's mark for "none"), even if it is listed.
    * sex: equality.
    * keywords: the session searched any listed keyword.
    * category ids: the session clicked any listed category.
    """
    preds: list[str] = []
    if params.age_restricted:
        preds.append(f"age BETWEEN {int(params.start_age)} AND {int(params.end_age)}")
    if params.professionals:
        preds.append(f"professional <> '-1' AND professional IN ({_sql_list(params.professionals)})")
    if params.cities:
        preds.append(f"city <> '-1' AND city IN ({_sql_list(params.cities)})")
    if params.sex:
        preds.append(f"sex = {_sql_list([params.sex])}")
    if params.keywords:
        preds.append("keyword_hit")
    if params.category_ids:
        preds.append("category_hit")
    if not preds:
        return None
    return F.expr(" AND ".join(f"coalesce({p}, false)" for p in preds))


def apply_filters(profile: DataFrame, params: TaskParams) -> DataFrame:
    """Profiles passing :func:`session_predicate`, without the helper flags."""
    pred = session_predicate(params)
    out = profile if pred is None else profile.where(pred)
    return out.drop("keyword_hit", "category_hit")


def filtered_sessions(actions: DataFrame, users: DataFrame, params: TaskParams,
                      lists: bool = True) -> DataFrame:
    """Profiles of the sessions that pass every parameter check."""
    return apply_filters(session_profile(actions, users, params, lists), params)


def filtered_actions(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Actions of the given sessions (left semi join on session_id).

    Session ids are unique on the right, so this equals the inner join of
    the original without carrying the right side. No hint: AQE broadcasts the
    kept ids if their measured size is under the threshold, else both sides
    shuffle on session_id, and a session holding a large share of the actions
    sits on the left side, which AQE's skew-join handling splits.
    """
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")
