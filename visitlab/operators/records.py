"""Row-level column jobs over the visit log and session profiles: time keys,
text hygiene and the packed ``k=v|...`` session record.

All are projections (no shuffle beyond the one of their input), built from
the expression helpers in :mod:`visitlab.functions`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from visitlab.functions import packed as P
from visitlab.functions import text as X
from visitlab.functions import time as D
from visitlab.operators.metrics import VISIT_BUCKETS, bucket_label_sql


def time_keys(actions: DataFrame, reference_time: str, as_of: str) -> DataFrame:
    """Per action: parsed and re-formatted time, date and minute keys, the
    ``date_hour`` text key, comparisons with ``reference_time`` and day
    distances to ``as_of`` (the run date)."""
    ts = D.parse_time_sql("action_time")
    ref = f"TIMESTAMP{X.sql_str(reference_time)}"
    with_ts = actions.selectExpr("event_id", "action_time", "date", f"{ts} AS ts")
    return with_ts.selectExpr(
        "event_id",
        "action_time",
        D.format_time_sql("ts") + " AS action_time_padded",
        D.format_date_sql("ts") + " AS action_date",
        D.date_key_sql("ts") + " AS date_key",
        f"CAST({D.parse_date_key_sql(D.date_key_sql('ts'))} AS STRING) AS date_from_key",
        D.minute_key_sql("ts") + " AS minute_key",
        D.date_hour_sql("action_time") + " AS date_hour",
        D.is_before_sql("ts", ref) + " AS before_reference",
        D.is_after_sql("ts", ref) + " AS after_reference",
        D.seconds_between_sql("ts", ref) + " AS seconds_from_reference",
        f"datediff({D.today_sql(as_of)}, to_date(try_to_timestamp(date))) AS days_before_run",
        f"to_date(try_to_timestamp(date)) = {D.yesterday_sql(as_of)} AS is_day_before_run",
    )


def text_hygiene(actions: DataFrame) -> DataFrame:
    """Emptiness checks, comma trimming, two-digit hour and id-list parsing."""
    hour = "try_element_at(split(try_element_at(split(action_time, ' '), 2), ':'), 1)"
    ids = "concat(coalesce(order_category_ids, ''), ',', coalesce(pay_category_ids, ''))"
    return actions.selectExpr(
        "event_id",
        X.is_empty_sql("search_keyword") + " AS keyword_is_empty",
        X.is_not_empty_sql("order_category_ids") + " AS order_ids_present",
        X.trim_comma_sql(ids) + " AS category_id_text",
        f"{hour} AS hour_text",
        X.fill_two_digits_sql(hour) + " AS hour_two_digits",
        f"try_element_at({X.split_ids_sql('order_category_ids')}, 1) AS first_order_category",
        f"coalesce(size({X.split_ids_sql('order_category_ids')}), 0) AS order_category_count",
    )


def packed_profile(profile: DataFrame) -> DataFrame:
    """``session_id`` and the ``k=v|...`` record of each session profile."""
    pairs = [(name, D.format_time_sql(col) if col == "start_time" else col)
             for name, col in P.PROFILE_FIELDS]
    return profile.selectExpr("session_id", P.pack_sql(pairs) + " AS packed")


def packed_profile_fields(packed: DataFrame) -> DataFrame:
    """Read typed fields back out of the packed record, which is scanned once."""
    def f(name):
        return P.entry_value_sql("entries", name)

    return packed.selectExpr(P.packed_entries_sql("packed") + " AS entries").selectExpr(
        f(P.F_SESSION_ID) + " AS session_id",
        f(P.F_SEARCH_KEYWORDS) + " AS search_keywords",
        f(P.F_CLICK_CATEGORY_IDS) + " AS click_category_ids",
        f"try_cast({f(P.F_VISIT_LENGTH)} AS BIGINT) AS visit_length",
        f"try_cast({f(P.F_STEP_LENGTH)} AS BIGINT) AS step_length",
        f(P.F_START_TIME) + " AS start_time",
        f"try_cast({f(P.F_AGE)} AS INT) AS age",
        f(P.F_PROFESSIONAL) + " AS professional",
        f(P.F_SEX) + " AS sex",
        f(P.F_CITY) + " AS city",
    )


def packed_profile_rewrite(packed: DataFrame) -> DataFrame:
    """Replace the ``visitLength`` value with its bucket label (empty when
    the length falls in no bucket)."""
    length = f"try_cast({P.packed_field_sql('packed', P.F_VISIT_LENGTH)} AS BIGINT)"
    with_len = packed.selectExpr("session_id", "packed", f"{length} AS visit_length")
    label = bucket_label_sql("visit_length", VISIT_BUCKETS)
    return with_len.selectExpr(
        "session_id", P.set_packed_field_sql("packed", P.F_VISIT_LENGTH, label) + " AS packed")


def product_status(products: DataFrame) -> DataFrame:
    """Integer ``product_status`` from the JSON ``extend_info``; null when
    absent or not a number."""
    return products.selectExpr(
        "product_id", "product_name",
        "try_cast(get_json_object(extend_info, '$.product_status') AS INT) AS product_status")
