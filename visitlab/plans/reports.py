"""Report jobs: the analyses of the original application's entry points,
each ending in one write to a sink.

* :func:`session_stat_report`    session count and length-bucket ratios
* :func:`random_extract_report`  hour-proportional session sample (+ detail)
* :func:`top10_report`           top-10 categories and their top-10 sessions
* :func:`page_flow_report`       page-flow one-step conversion rates
* :func:`rejects_report`         what of the log could not be read
* :func:`run_all`                all of the above for one task run

A frame that feeds several outputs (session profiles, the per-(category,
session) counts) is written once under ``spark.checkpoint.dir`` and read
back, so each is computed once, and a lost executor re-reads the shared
copy instead of recomputing the upstream shuffles.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from visitlab.functions.text import sql_str
from visitlab.operators import metrics, pageflow, ranking, rejects, sampling, sessions
from visitlab.params import TaskParams
from visitlab.session import materialize
from visitlab.sources import sinks


@dataclass
class Sink:
    """Where reports go: parquet folders under ``path`` (default) or, when
    ``jdbc_url`` is set, tables of that database (append)."""
    path: str | None = None
    jdbc_url: str | None = None
    jdbc_properties: dict | None = None
    jdbc_partitions: int | None = 8

    def write(self, df: DataFrame, table: str) -> None:
        if self.jdbc_url:
            sinks.append_jdbc(df, self.jdbc_url, table, self.jdbc_properties,
                              self.jdbc_partitions)
        else:
            if not self.path:
                raise ValueError("sink needs a path or a jdbc_url")
            sinks.append_parquet(df, os.path.join(self.path, table))


def session_stat_report(profile: DataFrame, params: TaskParams, sink: Sink) -> DataFrame:
    """Session count and length ratios of the filtered sessions -> session_aggr_stat."""
    stats = metrics.length_stats(sessions.apply_filters(profile, params), params.task_id)
    sink.write(stats, "session_aggr_stat")
    return stats


def random_extract_report(actions: DataFrame, profile: DataFrame, params: TaskParams, sink: Sink,
                          k: int = 150, seed: str = sampling.DEFAULT_SEED,
                          apply_filters: bool = False) -> DataFrame:
    """The original sampled sessions filtered by date only; ``apply_filters``
    samples the fully filtered sessions instead."""
    population = sessions.apply_filters(profile, params) if apply_filters else profile
    picked = materialize(sampling.random_extract(population, k, seed, params.task_id),
                         "random-extract")
    sink.write(picked, "session_random_extract")
    sink.write(sampling.extract_detail(actions, picked, params.task_id), "session_detail")
    return picked


def top10_report(actions: DataFrame, profile: DataFrame, params: TaskParams,
                 sink: Sink) -> tuple[DataFrame, DataFrame]:
    """Top-10 categories and their top-10 sessions -> top10_category, top10_session.
    The per-(category, session) counts are written once and feed both."""
    kept = sessions.apply_filters(profile, params)
    cs = materialize(ranking.category_session_counts(sessions.filtered_actions(actions, kept)),
                     "category-session-counts")
    top = materialize(ranking.top10_category(ranking.full_count_from_sessions(cs), params.task_id),
                      "top10-category")
    sink.write(top, "top10_category")
    sessions_top = ranking.top_sessions(
        cs.where("click_count > 0").join(top.select("category_id"), "category_id", "left_semi")
        .select("category_id", "session_id", "click_count"), params.task_id)
    sink.write(sessions_top, "top10_session")
    return top, sessions_top


def page_flow_report(actions: DataFrame, params: TaskParams, sink: Sink) -> DataFrame:
    """One-step conversion rates of the task's page flow -> page_convert_rate."""
    if not params.target_page_flow:
        raise ValueError("target_page_flow is not set")
    rates = pageflow.page_convert_rate(actions, params.target_page_flow)
    sink.write(rates.selectExpr(f"{sql_str(params.task_id)} AS task_id", "*"), "page_convert_rate")
    return rates


def rejects_report(spark: SparkSession, counts: dict, params: TaskParams, sink: Sink) -> DataFrame:
    """Reject counts seen in another job's pass -> visit_log_rejects."""
    row = [(params.task_id, *[int(counts[c]) for c in rejects.COUNTS])]
    out = spark.createDataFrame(row, "task_id string, " + ", ".join(f"{c} long" for c in rejects.COUNTS))
    sink.write(out, "visit_log_rejects")
    return out


def run_all(spark: SparkSession, actions: DataFrame, users: DataFrame, params: TaskParams,
            sink: Sink) -> dict[str, DataFrame]:
    """Every report of one task run. The session profiles (with the filter
    flags the parameters need) are computed once and shared; the same pass over
    the log counts what could not be read. Repeated user rows are reduced to one."""
    watched, seen = rejects.observed(actions)
    users = sessions.one_row_per_user(users)
    profile = materialize(sessions.session_profile(watched, users, params), "session-profile")
    out = {"visit_log_rejects": rejects_report(spark, seen.get, params, sink),
           "session_aggr_stat": session_stat_report(profile, params, sink),
           "session_random_extract": random_extract_report(actions, profile, params, sink)}
    out["top10_category"], out["top10_session"] = top10_report(actions, profile, params, sink)
    if params.target_page_flow:
        out["page_convert_rate"] = page_flow_report(actions, params, sink)
    return out


def main(argv: list[str] | None = None) -> None:
    """Run every report of one task.

    ``--tables DIR`` reads the driver-style tables (events, customer) of DIR;
    ``--visit-log PATH --users PATH`` reads a stored ``user_visit_action``
    table (ideally partitioned by date) and a ``user_info`` table instead.
    Reports are appended under ``--out``. ``--params`` holds task parameters
    with the original names (startDate, endDate, startAge, ...).
    """
    import argparse
    import json

    from visitlab.session import get_spark
    from visitlab.sources import tables

    ap = argparse.ArgumentParser(prog="visitlab-reports")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="folder with events.parquet and customer.parquet")
    src.add_argument("--visit-log", help="stored user_visit_action table (parquet)")
    ap.add_argument("--users", help="user_info table (parquet), with --visit-log")
    ap.add_argument("--out", required=True, help="folder the reports are appended under")
    ap.add_argument("--params", default="{}",
                    help='task parameters as JSON, e.g. {"startDate": "2024-01-01", "startAge": 20}')
    ap.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    a = ap.parse_args(argv)
    if a.visit_log and not a.users:
        ap.error("--visit-log needs --users")
    params = TaskParams.from_dict({"startDate": "2024-01-01", "endDate": "2024-01-31",
                                   **json.loads(a.params)})
    spark = get_spark(master=a.master, app_name="visitlab-reports")
    if a.tables:
        acts = tables.visit_actions(spark, a.tables, params.start_date, params.end_date)
        users = tables.user_info(spark, a.tables)
    else:
        acts = tables.read_visit_log(spark, a.visit_log, params.start_date, params.end_date)
        users = spark.read.parquet(a.users)
    run_all(spark, acts, users, params, Sink(path=a.out))


if __name__ == "__main__":
    main()
