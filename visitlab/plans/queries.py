"""Named queries: each takes ``(spark, sf_dir)`` and returns a lazy DataFrame.

Every query reads the whole driver tables of ``sf_dir`` (``events``,
``customer``, ``part``) through :mod:`visitlab.sources.tables`; output
columns use plain types (bigint, int, double, string, boolean) and times are
formatted text, so results compare one to one with the SQL oracle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlab.functions.time import format_time
from visitlab.operators import (daily, metrics, pageflow, ranking, records, rejects, sampling,
                                sessions)
from visitlab.params import TaskParams
from visitlab.plans.defaults import (ALL_PARAMS, DEFAULT, IN_RANGE, K_EXTRACT,
                                     K_EXTRACT_LARGE, SEED, TASK_ID)
from visitlab.session import checkpoint_dir, materialize
from visitlab.sources import sinks, tables
from visitlab.streaming import adclick

Query = Callable[[SparkSession, str], DataFrame]

PROFILE_COLUMNS = ["session_id", "user_id", "search_keywords", "click_category_ids",
                   "visit_length", "step_length", "start_time", "end_time", "age",
                   "professional", "sex", "city"]


# ---------------------------------------------------------------------------
# shared building blocks
# ---------------------------------------------------------------------------

def _actions(spark: SparkSession, sf_dir: str, p: TaskParams = DEFAULT) -> DataFrame:
    return tables.visit_actions(spark, sf_dir, p.start_date, p.end_date)


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users, one row each, so that no session is repeated by the join."""
    return sessions.one_row_per_user(tables.user_info(spark, sf_dir))


def _profile(spark: SparkSession, sf_dir: str, p: TaskParams = DEFAULT,
             lists: bool = False) -> DataFrame:
    """Session profiles; the keyword and category lists only where they are asked for."""
    return sessions.session_profile(_actions(spark, sf_dir, p), _users(spark, sf_dir), p,
                                    lists)


def _filtered(spark: SparkSession, sf_dir: str, p: TaskParams = DEFAULT,
              lists: bool = False) -> DataFrame:
    return sessions.apply_filters(_profile(spark, sf_dir, p, lists), p)


def _formatted(df: DataFrame) -> DataFrame:
    return df.select(*[format_time(c).alias(c) if c in ("start_time", "end_time") else F.col(c)
                       for c in PROFILE_COLUMNS])


def _filtered_actions(spark: SparkSession, sf_dir: str, p: TaskParams = DEFAULT) -> DataFrame:
    return sessions.filtered_actions(_actions(spark, sf_dir, p), _filtered(spark, sf_dir, p))


# ---------------------------------------------------------------------------
# scans, profile, filters, buckets
# ---------------------------------------------------------------------------

def visit_actions_in_range(spark, sf_dir):
    return _actions(spark, sf_dir, IN_RANGE).select(*tables.VISIT_COLUMNS)


def session_profile(spark, sf_dir):
    return _formatted(_profile(spark, sf_dir, lists=True))


def session_filtered(spark, sf_dir):
    return _formatted(_filtered(spark, sf_dir, DEFAULT, lists=True))


def session_filtered_all_params(spark, sf_dir):
    return _formatted(_filtered(spark, sf_dir, ALL_PARAMS, lists=True))


def session_buckets(spark, sf_dir):
    return metrics.session_buckets(_filtered(spark, sf_dir))


def session_length_stats(spark, sf_dir):
    return metrics.length_stats(_filtered(spark, sf_dir), TASK_ID)


def session_length_stats_contiguous(spark, sf_dir):
    return metrics.length_stats(_filtered(spark, sf_dir), TASK_ID,
                                visit_buckets=metrics.VISIT_BUCKETS_CONTIGUOUS)


# ---------------------------------------------------------------------------
# categories and top-10s
# ---------------------------------------------------------------------------

def filtered_actions(spark, sf_dir):
    return _filtered_actions(spark, sf_dir).select(*tables.VISIT_COLUMNS)


def category_ids(spark, sf_dir):
    return ranking.category_ids(_filtered_actions(spark, sf_dir))


def category_click_count(spark, sf_dir):
    return ranking.category_kind_count(_filtered_actions(spark, sf_dir), "click")


def category_order_count(spark, sf_dir):
    return ranking.category_kind_count(_filtered_actions(spark, sf_dir), "order")


def category_pay_count(spark, sf_dir):
    return ranking.category_kind_count(_filtered_actions(spark, sf_dir), "pay")


def category_full_count(spark, sf_dir):
    return ranking.category_full_count(_filtered_actions(spark, sf_dir))


def top10_category(spark, sf_dir):
    return ranking.top10_category(ranking.category_full_count(_filtered_actions(spark, sf_dir)),
                                  TASK_ID)


def _top10_clicks(spark, sf_dir):
    """Clicks per (category, session) of the top categories. The counts feed both
    the category totals and the clicks, so they are written once: the log is read
    and joined once, whatever the join strategy."""
    fa = _filtered_actions(spark, sf_dir)
    cs = materialize(ranking.category_session_counts(fa), "category-session-counts")
    return ranking.top_category_sessions(cs, TASK_ID)[1]


def category_session_clicks(spark, sf_dir):
    return _top10_clicks(spark, sf_dir)


def top10_session(spark, sf_dir):
    return ranking.top_sessions(_top10_clicks(spark, sf_dir), TASK_ID)


# ---------------------------------------------------------------------------
# hourly sampling (population: sessions of the date range with a known user)
# ---------------------------------------------------------------------------

def sessions_per_hour(spark, sf_dir):
    return sampling.sessions_per_hour(_profile(spark, sf_dir))


def session_extract_quota(spark, sf_dir):
    return sampling.extract_quota(sampling.sessions_per_hour(_profile(spark, sf_dir)), K_EXTRACT)


def _extract(spark, sf_dir, k):
    return sampling.random_extract(_profile(spark, sf_dir), k, SEED, TASK_ID,
                                   actions=_actions(spark, sf_dir))


def session_random_extract(spark, sf_dir):
    return _extract(spark, sf_dir, K_EXTRACT)


def session_random_extract_large(spark, sf_dir):
    return _extract(spark, sf_dir, K_EXTRACT_LARGE)


def session_random_extract_filtered(spark, sf_dir):
    """The sample drawn from the sessions that pass the shipped parameters."""
    return sampling.random_extract(_filtered(spark, sf_dir), K_EXTRACT, SEED, TASK_ID,
                                   actions=_actions(spark, sf_dir))


def session_extract_detail(spark, sf_dir):
    return sampling.extract_detail(_actions(spark, sf_dir), _extract(spark, sf_dir, K_EXTRACT),
                                   TASK_ID)


# ---------------------------------------------------------------------------
# stored forms of the log: bucketed by session, and daily states
# ---------------------------------------------------------------------------

BUCKETS = 4


def _bucketed_log(spark, sf_dir) -> str:
    """The whole visit log as a bucketed table of its own; its name."""
    name = f"visit_log_{uuid.uuid4().hex}"
    sinks.write_bucketed_log(tables.visit_actions(spark, sf_dir).select(*tables.VISIT_COLUMNS), name,
                             f"{checkpoint_dir(spark).rstrip('/')}/{name}", BUCKETS)
    return name


def _bucketed_actions(spark, sf_dir):
    return tables.read_bucketed_log(spark, _bucketed_log(spark, sf_dir), DEFAULT.start_date,
                                    DEFAULT.end_date)


def bucketed_session_profile(spark, sf_dir):
    return _formatted(sessions.session_profile(_bucketed_actions(spark, sf_dir),
                                               _users(spark, sf_dir), DEFAULT))


def bucketed_filtered_actions(spark, sf_dir):
    actions = _bucketed_actions(spark, sf_dir)
    kept = sessions.filtered_sessions(actions, _users(spark, sf_dir), DEFAULT, lists=False)
    return sessions.filtered_actions(actions, kept).select(*tables.VISIT_COLUMNS)


def bucketed_page_convert_rate(spark, sf_dir):
    actions = tables.read_bucketed_log(spark, _bucketed_log(spark, sf_dir))
    return pageflow.page_convert_rate(actions, DEFAULT.target_page_flow)


def _stored_states(spark, sf_dir):
    path = f"{checkpoint_dir(spark).rstrip('/')}/daily-states-{uuid.uuid4().hex}"
    daily.write_days(daily.day_states(_actions(spark, sf_dir), DEFAULT), path)
    return daily.read_days(spark, path, DEFAULT.start_date, DEFAULT.end_date)


def daily_length_stats(spark, sf_dir):
    """session_length_stats from stored daily states."""
    kept = daily.filtered(_stored_states(spark, sf_dir), _users(spark, sf_dir), DEFAULT)
    return metrics.length_stats(kept, TASK_ID)


def daily_sessions_per_hour(spark, sf_dir):
    """sessions_per_hour from stored daily states."""
    return sampling.sessions_per_hour(daily.merged_profile(_stored_states(spark, sf_dir),
                                                           _users(spark, sf_dir)))


def visit_log_rejects(spark, sf_dir):
    return rejects.rejects(tables.visit_actions(spark, sf_dir))


# ---------------------------------------------------------------------------
# column jobs and extensions
# ---------------------------------------------------------------------------

REFERENCE_TIME = "2024-01-15 12:00:00"
RUN_DATE = "2024-02-01"


def time_keys(spark, sf_dir):
    return records.time_keys(tables.visit_actions(spark, sf_dir), REFERENCE_TIME, RUN_DATE)


def text_hygiene(spark, sf_dir):
    return records.text_hygiene(tables.visit_actions(spark, sf_dir))


def packed_profile(spark, sf_dir):
    return records.packed_profile(_profile(spark, sf_dir, lists=True))


def packed_profile_fields(spark, sf_dir):
    return records.packed_profile_fields(records.packed_profile(_profile(spark, sf_dir, lists=True)))


def packed_profile_rewrite(spark, sf_dir):
    return records.packed_profile_rewrite(records.packed_profile(_profile(spark, sf_dir, lists=True)))


def product_status(spark, sf_dir):
    return records.product_status(tables.product_info(spark, sf_dir))


def page_convert_rate(spark, sf_dir):
    return pageflow.page_convert_rate(tables.visit_actions(spark, sf_dir), DEFAULT.target_page_flow)


def ad_click_parse(spark, sf_dir):
    return adclick.parse_ad_clicks(tables.ad_click_lines(spark, sf_dir))


def ad_click_format(spark, sf_dir):
    return adclick.format_ad_clicks(
        adclick.ad_clicks_from_events(tables.read_table(spark, sf_dir, "events")))


REGISTRY: dict[str, Query] = {
    "visit_actions_in_range": visit_actions_in_range,
    "session_profile": session_profile,
    "session_filtered": session_filtered,
    "session_filtered_all_params": session_filtered_all_params,
    "session_buckets": session_buckets,
    "session_length_stats": session_length_stats,
    "session_length_stats_contiguous": session_length_stats_contiguous,
    "filtered_actions": filtered_actions,
    "category_ids": category_ids,
    "category_click_count": category_click_count,
    "category_order_count": category_order_count,
    "category_pay_count": category_pay_count,
    "category_full_count": category_full_count,
    "top10_category": top10_category,
    "category_session_clicks": category_session_clicks,
    "top10_session": top10_session,
    "sessions_per_hour": sessions_per_hour,
    "session_extract_quota": session_extract_quota,
    "session_random_extract": session_random_extract,
    "session_random_extract_large": session_random_extract_large,
    "session_random_extract_filtered": session_random_extract_filtered,
    "session_extract_detail": session_extract_detail,
    "bucketed_session_profile": bucketed_session_profile,
    "bucketed_filtered_actions": bucketed_filtered_actions,
    "bucketed_page_convert_rate": bucketed_page_convert_rate,
    "daily_length_stats": daily_length_stats,
    "daily_sessions_per_hour": daily_sessions_per_hour,
    "visit_log_rejects": visit_log_rejects,
    "time_keys": time_keys,
    "text_hygiene": text_hygiene,
    "packed_profile": packed_profile,
    "packed_profile_fields": packed_profile_fields,
    "packed_profile_rewrite": packed_profile_rewrite,
    "product_status": product_status,
    "page_convert_rate": page_convert_rate,
    "ad_click_parse": ad_click_parse,
    "ad_click_format": ad_click_format,
}
