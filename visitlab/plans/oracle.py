"""Plain-SQL (DuckDB dialect) forms of the registered queries.

Each string is self-contained: the mapping of the driver tables onto the
visit-log model is inlined as CTEs. Used by the correctness check only;
nothing here runs on Spark.
"""

from __future__ import annotations

import datetime as _dt

from visitlab.operators.metrics import (STEP_BUCKETS, VISIT_BUCKETS,
                                        VISIT_BUCKETS_CONTIGUOUS)
from visitlab.params import TaskParams
from visitlab.plans.defaults import (ALL_PARAMS, DEFAULT, IN_RANGE, K_EXTRACT,
                                     K_EXTRACT_LARGE, SEED, TASK_ID)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(values) -> str:
    return ", ".join(_q(str(v)) if isinstance(v, str) else str(v) for v in values)


def actions_cte(p: TaskParams | None = None) -> str:
    """CTEs ``ev`` and ``visit_actions``: the events mapping of FIXTURES.md section 2;
    without parameters over the whole log."""
    window = ""
    if p is not None:
        end = (_dt.date.fromisoformat(p.end_date) + _dt.timedelta(days=1)).isoformat()
        window = f"WHERE ts >= TIMESTAMP '{p.start_date} 00:00:00' AND ts < TIMESTAMP '{end} 00:00:00'"
    id_list = ("CASE WHEN event_id % 3 = 0 THEN CAST(k AS VARCHAR) || ',' || "
               "CAST((k * 7 + 3) % 100 AS VARCHAR) ELSE CAST(k AS VARCHAR) END")
    return f"""
ev AS (
  SELECT event_id, event_type,
         user_id // 15 AS u,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(ts AS DATE) AS d,
         (hour(ts) * 3600 + minute(ts) * 60 + second(ts)) // 24 AS sod,
         CASE WHEN event_id % 32 < 24 THEN 0 WHEN event_id % 32 < 28 THEN 1
              WHEN event_id % 32 < 30 THEN 2 WHEN event_id % 32 = 30 THEN 3 ELSE 4 END AS slot
  FROM events
  {window}
),
visit_actions AS (
  SELECT event_id,
         strftime(d, '%Y-%m-%d') AS date,
         u AS user_id,
         CAST(u AS VARCHAR) || '-' || strftime(d, '%Y%m%d') || '-' || CAST(slot AS VARCHAR) AS session_id,
         event_id % 10 AS page_id,
         strftime(d, '%Y-%m-%d') || ' ' || CAST((u * 7 + day(d) * 3 + slot * 5) % 23 AS VARCHAR)
           || ':' || lpad(CAST(sod // 60 AS VARCHAR), 2, '0')
           || ':' || lpad(CAST(sod % 60 AS VARCHAR), 2, '0') AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 10 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k ELSE -1 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN event_id % 100 ELSE -1 END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN {id_list} END AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN {id_list} END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(event_id % 100 AS VARCHAR) END AS pay_product_ids,
         u % 10 AS city_id
  FROM ev
)"""


USER_CTE = """
user_info AS (
  SELECT c_custkey AS user_id, 'user' || CAST(c_custkey AS VARCHAR) AS username, c_name AS name,
         CAST((c_custkey * 7 + 25) % 60 AS INTEGER) AS age, c_mktsegment AS professional,
         'city' || CAST(c_nationkey AS VARCHAR) AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer
)"""


def profile_ctes(p: TaskParams) -> str:
    """CTEs visit_actions, user_info, session_agg, session_profile, filtered."""
    flags = ""
    if p.keywords:
        flags += (f",\n         coalesce(bool_or(search_keyword IN ({_in_list(p.keywords)})), false)"
                  " AS keyword_hit")
    if p.category_ids:
        flags += (f",\n         coalesce(bool_or(click_category_id IN ({_in_list(p.category_ids)})),"
                  " false) AS category_hit")
    preds = []
    if p.age_restricted:
        preds.append(f"age BETWEEN {p.start_age} AND {p.end_age}")
    if p.professionals:
        preds.append(f"professional IN ({_in_list(p.professionals)})")
    if p.cities:
        preds.append(f"city IN ({_in_list(p.cities)})")
    if p.sex:
        preds.append(f"sex = {_q(p.sex)}")
    if p.keywords:
        preds.append("keyword_hit")
    if p.category_ids:
        preds.append("category_hit")
    where = " AND ".join(f"coalesce({x}, false)" for x in preds) or "true"
    return f"""WITH {actions_cte(p)},{USER_CTE},
session_agg AS (
  SELECT session_id,
         min(CASE WHEN user_id <> -1 THEN user_id END) AS user_id,
         nullif(array_to_string(list_sort(list_distinct(
             list(search_keyword) FILTER (WHERE search_keyword <> ''))), ','), '') AS search_keywords,
         nullif(array_to_string(list_sort(list_distinct(
             list(click_category_id) FILTER (WHERE click_category_id <> -1))), ','), '') AS click_category_ids,
         count(*) AS step_length,
         min(try_strptime(action_time, '%Y-%m-%d %H:%M:%S')) AS start_time,
         max(try_strptime(action_time, '%Y-%m-%d %H:%M:%S')) AS end_time{flags}
  FROM visit_actions GROUP BY session_id
),
session_profile AS (
  SELECT s.*, date_diff('second', s.start_time, s.end_time) AS visit_length,
         u.age, u.professional, u.sex, u.city
  FROM session_agg s JOIN user_info u ON s.user_id = u.user_id
),
filtered AS (
  SELECT * FROM session_profile WHERE {where}
)"""


PROFILE_SELECT = """session_id, user_id, search_keywords, click_category_ids, visit_length,
       step_length, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
       strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time, age, professional, sex, city"""


def _bucket_case(col: str, buckets) -> str:
    parts = []
    for b in buckets:
        if b.open_ended:
            cond = f"{col} > {b.lo}"
        elif b.lo is None:
            continue
        else:
            cond = f"{col} BETWEEN {b.lo} AND {b.hi}"
        parts.append(f"WHEN {cond} THEN '{b.label}'")
    return "CASE " + " ".join(parts) + " END"


def _ratio(count_expr: str, n: str = "greatest(count(*), 1)") -> str:
    return f"CAST((200 * ({count_expr}) + {n}) // (2 * {n}) AS DOUBLE) / 100"


def _length_stats(p: TaskParams, visit_buckets) -> str:
    cols = [f"{_q(TASK_ID)} AS task_id", "count(*) AS session_count"]
    for b in visit_buckets:
        cols.append(_ratio(f"count(*) FILTER (WHERE vb = '{b.label}')")
                    + f" AS visit_length_{b.label}_ratio")
    for b in STEP_BUCKETS:
        cols.append(_ratio(f"count(*) FILTER (WHERE sb = '{b.label}')")
                    + f" AS step_length_{b.label}_ratio")
    return f"""{profile_ctes(p)},
labelled AS (
  SELECT {_bucket_case('visit_length', visit_buckets)} AS vb,
         {_bucket_case('step_length', STEP_BUCKETS)} AS sb
  FROM filtered
)
SELECT {', '.join(cols)} FROM labelled"""


def ranking_ctes(p: TaskParams) -> str:
    """Adds filtered_actions, cat_events, full_count, top10, top10_clicks."""
    def split(kind, col):
        return (f"SELECT session_id, '{kind}' AS kind, TRY_CAST(trim(x) AS BIGINT) AS category_id"
                f" FROM filtered_actions, unnest(string_split({col}, ',')) AS t(x)"
                f" WHERE {col} IS NOT NULL")
    return f"""{profile_ctes(p)},
filtered_actions AS (
  SELECT * FROM visit_actions WHERE session_id IN (SELECT session_id FROM filtered)
),
cat_events AS (
  SELECT * FROM (
    SELECT session_id, 'click' AS kind, click_category_id AS category_id
    FROM filtered_actions WHERE click_category_id <> -1
    UNION ALL {split('order', 'order_category_ids')}
    UNION ALL {split('pay', 'pay_category_ids')}
  ) WHERE category_id IS NOT NULL
),
full_count AS (
  SELECT category_id,
         count(*) FILTER (WHERE kind = 'click') AS click_count,
         count(*) FILTER (WHERE kind = 'order') AS order_count,
         count(*) FILTER (WHERE kind = 'pay') AS pay_count
  FROM cat_events GROUP BY category_id
),
top10 AS (
  SELECT {_q(TASK_ID)} AS task_id, category_id, click_count, order_count, pay_count
  FROM full_count
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10
),
top10_clicks AS (
  SELECT click_category_id AS category_id, session_id, count(*) AS click_count
  FROM filtered_actions WHERE click_category_id IN (SELECT category_id FROM top10)
  GROUP BY click_category_id, session_id
)"""


def sampling_ctes(p: TaskParams, k: int, population: str = "session_profile") -> str:
    """Adds cells, per_hour, quota, picked (the sessions sampled from ``population``)."""
    return f"""{profile_ctes(p)},
cells AS (
  SELECT *, strftime(start_time, '%Y-%m-%d') AS date, CAST(hour(start_time) AS INTEGER) AS hour
  FROM {population} WHERE start_time IS NOT NULL
),
per_hour AS (
  SELECT date, hour, count(*) AS session_count FROM cells GROUP BY date, hour
),
quota AS (
  SELECT date, hour, session_count,
         CAST((session_count * least({int(k)}, total)) // total + 1 AS BIGINT) AS quota
  FROM per_hour, (SELECT CAST(sum(session_count) AS BIGINT) AS total FROM per_hour)
),
ranked AS (
  SELECT c.*, q.quota,
         row_number() OVER (PARTITION BY c.date, c.hour
                            ORDER BY md5({_q(SEED + ':')} || c.session_id), c.session_id) AS rn
  FROM cells c JOIN quota q ON c.date = q.date AND c.hour = q.hour
),
picked AS (
  SELECT {_q(TASK_ID)} AS task_id, session_id,
         strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
         nullif(search_keywords, '') AS search_keywords,
         nullif(click_category_ids, '') AS click_category_ids
  FROM ranked WHERE rn <= quota
)"""


REFERENCE_TIME = "2024-01-15 12:00:00"
RUN_DATE = "2024-02-01"
PROFILE_PACK_FIELDS = [("sessionid", "session_id"), ("searchKeywords", "search_keywords"),
                       ("clickCategoryIds", "click_category_ids"), ("visitLength", "visit_length"),
                       ("stepLength", "step_length"), ("startTime", "start_time"), ("age", "age"),
                       ("professional", "professional"), ("sex", "sex"), ("city", "city")]


def _packed_field(text: str, key: str) -> str:
    return (f"list_filter(list_transform(string_split({text}, '|'), lambda p: string_split(p, '=')),"
            f" lambda p: len(p) = 2 AND p[1] = '{key}' AND p[2] <> '')[1][2]")


def _packed_cte() -> str:
    parts = []
    for name, col in PROFILE_PACK_FIELDS:
        v = "strftime(start_time, '%Y-%m-%d %H:%M:%S')" if col == "start_time" else col
        parts.append(f"'{name}=' || coalesce(CAST({v} AS VARCHAR), '')")
    return f"""{profile_ctes(DEFAULT)},
packed AS (
  SELECT session_id, {" || '|' || ".join(parts)} AS packed FROM session_profile
)"""


def _page_flow(flow) -> str:
    cols = [f"count(*) FILTER (WHERE page_id = {flow[0]}) AS visits"]
    for i in range(len(flow) - 1):
        cols.append(f"count(*) FILTER (WHERE page_id = {flow[i]} AND next_page = {flow[i + 1]}) AS c{i}")
    sel = []
    for i in range(len(flow) - 1):
        den = "visits" if i == 0 else f"c{i - 1}"
        rate = f"CASE WHEN {den} = 0 THEN NULL ELSE {_ratio(f'c{i}', den)} END"
        sel.append(f"SELECT {i + 1} AS step, '{flow[i]}_{flow[i + 1]}' AS page_pair,"
                   f" c{i} AS pair_count, {rate} AS convert_rate FROM counts")
    union = "\nUNION ALL ".join(sel)
    return f"""WITH {actions_cte()},
seq AS (
  SELECT page_id, lead(page_id) OVER (PARTITION BY session_id
      ORDER BY try_strptime(action_time, '%Y-%m-%d %H:%M:%S'), event_id) AS next_page
  FROM visit_actions
),
counts AS (SELECT {", ".join(cols)} FROM seq)
{union}"""


def build() -> dict[str, str]:
    """The SQL text of every registered query, by query name."""
    q: dict[str, str] = {}
    q["visit_actions_in_range"] = f"WITH {actions_cte(IN_RANGE)}\nSELECT * FROM visit_actions"
    q["session_profile"] = f"{profile_ctes(DEFAULT)}\nSELECT {PROFILE_SELECT} FROM session_profile"
    q["session_filtered"] = f"{profile_ctes(DEFAULT)}\nSELECT {PROFILE_SELECT} FROM filtered"
    q["session_filtered_all_params"] = (f"{profile_ctes(ALL_PARAMS)}\n"
                                        f"SELECT {PROFILE_SELECT} FROM filtered")
    q["session_buckets"] = f"""{profile_ctes(DEFAULT)}
SELECT session_id, visit_length, step_length,
       {_bucket_case('visit_length', VISIT_BUCKETS)} AS visit_bucket,
       {_bucket_case('step_length', STEP_BUCKETS)} AS step_bucket
FROM filtered"""
    q["session_length_stats"] = _length_stats(DEFAULT, VISIT_BUCKETS)
    q["session_length_stats_contiguous"] = _length_stats(DEFAULT, VISIT_BUCKETS_CONTIGUOUS)
    rk = ranking_ctes(DEFAULT)
    q["filtered_actions"] = f"{rk}\nSELECT * FROM filtered_actions"
    q["category_ids"] = f"{rk}\nSELECT DISTINCT category_id FROM cat_events"
    for kind in ("click", "order", "pay"):
        q[f"category_{kind}_count"] = (f"{rk}\nSELECT category_id, count(*) AS {kind}_count"
                                       f" FROM cat_events WHERE kind = '{kind}' GROUP BY category_id")
    q["category_full_count"] = f"{rk}\nSELECT * FROM full_count"
    q["top10_category"] = f"{rk}\nSELECT * FROM top10"
    q["category_session_clicks"] = f"{rk}\nSELECT * FROM top10_clicks"
    q["top10_session"] = f"""{rk}
SELECT {_q(TASK_ID)} AS task_id, category_id, session_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY category_id
                               ORDER BY click_count DESC, session_id) AS rn
  FROM top10_clicks) WHERE rn <= 10"""
    sp = sampling_ctes(DEFAULT, K_EXTRACT)
    q["sessions_per_hour"] = f"{sp}\nSELECT * FROM per_hour"
    q["session_extract_quota"] = f"{sp}\nSELECT * FROM quota"
    q["session_random_extract"] = f"{sp}\nSELECT * FROM picked"
    q["session_random_extract_large"] = (f"{sampling_ctes(DEFAULT, K_EXTRACT_LARGE)}\n"
                                         "SELECT * FROM picked")
    q["session_random_extract_filtered"] = (
        f"{sampling_ctes(DEFAULT, K_EXTRACT, 'filtered')}\nSELECT * FROM picked")
    q["session_extract_detail"] = f"""{sp}
SELECT {_q(TASK_ID)} AS task_id, user_id, session_id, page_id, action_time, search_keyword,
       click_category_id, click_product_id, order_category_ids, order_product_ids,
       pay_category_ids, pay_product_ids
FROM visit_actions WHERE session_id IN (SELECT session_id FROM picked)"""
    # stored forms of the log answer as the log itself does
    q["bucketed_session_profile"] = q["session_profile"]
    q["bucketed_filtered_actions"] = q["filtered_actions"]
    q["bucketed_page_convert_rate"] = _page_flow(list(DEFAULT.target_page_flow))
    q["daily_length_stats"] = q["session_length_stats"]
    q["daily_sessions_per_hour"] = q["sessions_per_hour"]

    def bad(col):
        return (f"coalesce(len(list_filter(string_split({col}, ','),"
                " lambda p: trim(p) <> '' AND TRY_CAST(trim(p) AS BIGINT) IS NULL)), 0)")
    q["visit_log_rejects"] = f"""WITH {actions_cte()}
SELECT date, count(*) AS actions,
       count(*) FILTER (WHERE session_id IS NULL) AS without_session,
       count(*) FILTER (WHERE user_id IS NULL OR user_id = -1) AS without_user,
       count(*) FILTER (WHERE coalesce(action_time, '') = '') AS without_time,
       count(*) FILTER (WHERE action_time <> ''
                        AND try_strptime(action_time, '%Y-%m-%d %H:%M:%S') IS NULL) AS bad_time,
       CAST(sum({bad('order_category_ids')}) AS BIGINT) AS bad_order_ids,
       CAST(sum({bad('pay_category_ids')}) AS BIGINT) AS bad_pay_ids,
       count(*) FILTER (WHERE {bad('order_category_ids')} + {bad('pay_category_ids')} > 0) AS actions_with_bad_ids
FROM visit_actions GROUP BY date"""
    ts = "try_strptime(action_time, '%Y-%m-%d %H:%M:%S')"
    ref = f"TIMESTAMP '{REFERENCE_TIME}'"
    q["time_keys"] = f"""WITH {actions_cte()},
t AS (SELECT event_id, action_time, date, {ts} AS ts FROM visit_actions)
SELECT event_id, action_time,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time_padded,
       strftime(ts, '%Y-%m-%d') AS action_date,
       strftime(ts, '%Y%m%d') AS date_key,
       CAST(CAST(strptime(strftime(ts, '%Y%m%d'), '%Y%m%d') AS DATE) AS VARCHAR) AS date_from_key,
       strftime(ts, '%Y%m%d%H%M') AS minute_key,
       split_part(action_time, ' ', 1) || '_' || split_part(split_part(action_time, ' ', 2), ':', 1)
         AS date_hour,
       ts < {ref} AS before_reference,
       ts > {ref} AS after_reference,
       CAST(epoch(ts) AS BIGINT) - CAST(epoch({ref}) AS BIGINT) AS seconds_from_reference,
       CAST(date_diff('day', CAST(date AS DATE), DATE '{RUN_DATE}') AS INTEGER) AS days_before_run,
       CAST(date AS DATE) = DATE '{RUN_DATE}' - INTERVAL 1 DAY AS is_day_before_run
FROM t"""
    hour = "split_part(split_part(action_time, ' ', 2), ':', 1)"
    ids = ("list_filter(list_transform(string_split(order_category_ids, ','),"
           " lambda p: TRY_CAST(trim(p) AS BIGINT)), lambda v: v IS NOT NULL)")
    q["text_hygiene"] = f"""WITH {actions_cte()}
SELECT event_id,
       (search_keyword IS NULL OR search_keyword = '') AS keyword_is_empty,
       (order_category_ids IS NOT NULL AND order_category_ids <> '') AS order_ids_present,
       regexp_replace(coalesce(order_category_ids, '') || ',' || coalesce(pay_category_ids, ''),
                      '^,|,$', '', 'g') AS category_id_text,
       {hour} AS hour_text,
       CASE WHEN length({hour}) = 2 THEN {hour} ELSE '0' || {hour} END AS hour_two_digits,
       {ids}[1] AS first_order_category,
       CAST(coalesce(len({ids}), 0) AS INTEGER) AS order_category_count
FROM visit_actions"""
    pk = _packed_cte()
    q["packed_profile"] = f"{pk}\nSELECT session_id, packed FROM packed"
    f = _packed_field
    q["packed_profile_fields"] = f"""{pk}
SELECT {f('packed', 'sessionid')} AS session_id,
       {f('packed', 'searchKeywords')} AS search_keywords,
       {f('packed', 'clickCategoryIds')} AS click_category_ids,
       TRY_CAST({f('packed', 'visitLength')} AS BIGINT) AS visit_length,
       TRY_CAST({f('packed', 'stepLength')} AS BIGINT) AS step_length,
       {f('packed', 'startTime')} AS start_time,
       TRY_CAST({f('packed', 'age')} AS INTEGER) AS age,
       {f('packed', 'professional')} AS professional,
       {f('packed', 'sex')} AS sex,
       {f('packed', 'city')} AS city
FROM packed"""
    label = _bucket_case(f"TRY_CAST({f('packed', 'visitLength')} AS BIGINT)", VISIT_BUCKETS)
    q["packed_profile_rewrite"] = f"""{pk}
SELECT session_id,
       array_to_string(list_transform(string_split(packed, '|'),
         lambda p: CASE WHEN split_part(p, '=', 1) = 'visitLength'
                        THEN 'visitLength=' || coalesce({label}, '') ELSE p END), '|') AS packed
FROM packed"""
    q["product_status"] = """WITH product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         '{"product_status": ' || CAST(p_size % 2 AS VARCHAR) || '}' AS extend_info
  FROM part
)
SELECT product_id, product_name,
       TRY_CAST(json_extract_string(extend_info, '$.product_status') AS INTEGER) AS product_status
FROM product_info"""
    q["page_convert_rate"] = _page_flow(list(DEFAULT.target_page_flow))
    q["ad_click_parse"] = """WITH lines AS (
  SELECT CAST(epoch_us(ts) // 1000 AS VARCHAR) || ' ' || CAST(user_id % 10 AS VARCHAR) || ' '
         || CAST(user_id % 10 AS VARCHAR) || ' ' || CAST(user_id % 100 AS VARCHAR) || ' '
         || CAST(event_id % 20 AS VARCHAR) AS value
  FROM events
), parts AS (
  SELECT string_split(value, ' ') AS p FROM lines
)
SELECT TRY_CAST(p[1] AS BIGINT) AS click_ms,
       strftime(epoch_ms(TRY_CAST(p[1] AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS click_time,
       TRY_CAST(p[2] AS BIGINT) AS province, TRY_CAST(p[3] AS BIGINT) AS city,
       TRY_CAST(p[4] AS BIGINT) AS user_id, TRY_CAST(p[5] AS BIGINT) AS ad_id
FROM parts
WHERE len(p) = 5 AND TRY_CAST(p[1] AS BIGINT) IS NOT NULL AND TRY_CAST(p[2] AS BIGINT) IS NOT NULL
  AND TRY_CAST(p[3] AS BIGINT) IS NOT NULL AND TRY_CAST(p[4] AS BIGINT) IS NOT NULL
  AND TRY_CAST(p[5] AS BIGINT) IS NOT NULL"""
    q["ad_click_format"] = """SELECT CAST(epoch_us(ts) // 1000 AS VARCHAR) || ' ' || CAST(user_id % 10 AS VARCHAR) || ' '
       || CAST(user_id % 10 AS VARCHAR) || ' ' || CAST(user_id % 100 AS VARCHAR) || ' '
       || CAST(event_id % 20 AS VARCHAR) AS value
FROM events"""
    return q
