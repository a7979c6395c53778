"""Stored forms of the visit log: the bucketed table, replaceable tables and
dates, daily states, and intermediates that are written once."""

import contextlib
import os
import re
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F
from visitlog_rows import SF_SMALL, action, make_actions, make_users, plan_text, user

from visitlab.operators import daily, metrics, pageflow, ranking, sampling, sessions
from visitlab.params import TaskParams
from visitlab.plans import queries
from visitlab.plans.defaults import DEFAULT
from visitlab.sources import sinks, tables


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(cols).collect()), key=lambda t: [(v is None, str(v)) for v in t])


def new_path(name):
    return os.path.join(tempfile.mkdtemp(prefix="stored-"), name)


@contextlib.contextmanager
def settings(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
# a session on two dates, one with a third of all rows, one without an id, bad text
HOT = ([action(i, "hot", f"2024-01-0{1 + i % 3} 5:{i // 60 % 60:02d}:{i % 60:02d}", user_id=1, page_id=i % 9,
               keyword=f"k{i % 40}" if i % 2 else None, click=i % 50 if i % 3 else -1, order=str(i % 5)) for i in range(400)]
       + [action(1000 + i, f"s{i % 90}", f"2024-01-0{1 + i % 2} 23:59:{i % 60:02d}", user_id=1 + i % 4, page_id=i % 9,
                 keyword="é" if i % 7 == 0 else None, click=i % 12) for i in range(700)]
       + [action(5000 + i, None, "2024-01-02 1:00:00", page_id=1, keyword="x") for i in range(30)]
       + [action(6000, "bad", "2024-01-03 xx", user_id=2), action(6001, "bad", "2024-01-03 1:00:00", user_id=2, keyword="")])
USERS = [user(1), user(2, age=45), user(3, age=70), user(4, sex="female")]


@pytest.fixture(scope="module")
def stored(spark):
    name, path = f"log_{uuid.uuid4().hex}", new_path("log")
    sinks.write_bucketed_log(make_actions(spark, HOT).drop("action_ts"), name, path, 4)
    return name, path


def final_plan(df):
    df.collect()
    text = plan_text(df)
    return text.split("== Final Plan ==")[1].split("== Initial Plan ==")[0] if "== Final Plan ==" in text else text


def exchanges(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


@pytest.mark.parametrize("broadcasts", [True, False])
def test_bucketed_log_needs_no_exchange_of_actions(spark, stored, broadcasts):
    with settings(spark, {} if broadcasts else NO_BROADCAST):
        acts = tables.read_bucketed_log(spark, stored[0], "2024-01-01", "2024-01-03")
        users = make_users(spark, USERS)
        profile = final_plan(sessions.session_aggregate(acts))
        assert "Bucketed: true" in profile and "Exchange" not in profile
        assert "ObjectHashAggregate" not in profile and "SortAggregate" in profile
        kept = sessions.filtered_sessions(acts, users, DEFAULT, lists=False)
        semi = final_plan(sessions.filtered_actions(acts, kept))
        # the first scan is the joined log itself: no exchange between it and the join
        assert "LeftSemi" in semi and "Bucketed: true" in semi
        log_side = semi[semi.index("LeftSemi"):semi.index("FileScan")]
        assert "Exchange hashpartitioning" not in log_side
        for keys in exchanges(semi):  # sessions or users, one row each
            assert re.fullmatch(r"(session_id|user_id)#\d+L?, \d+", keys), keys
        flow = final_plan(pageflow.page_convert_rate(acts, DEFAULT.target_page_flow))
        assert "Bucketed: true" in flow and not exchanges(flow)


def test_bucketed_log_equals_the_plain_log(spark, stored):
    name, path = stored
    plain = make_actions(spark, HOT)
    users = make_users(spark, USERS)
    for first, last in ((None, None), ("2024-01-02", "2024-01-03")):
        log = plain
        if first:
            log = log.where(F.col("date").between(first, last))
        for read in (tables.read_bucketed_log(spark, name, first, last), tables.read_visit_log(spark, path, first, last)):
            assert rows(read) == rows(log)
            assert rows(sessions.session_profile(read, users)) == rows(sessions.session_profile(log, users))
            kept = sessions.filtered_sessions(read, users, DEFAULT, lists=False)
            assert rows(sessions.filtered_actions(read, kept)) == rows(
                sessions.filtered_actions(log, sessions.filtered_sessions(log, users, DEFAULT)))
            assert rows(pageflow.page_convert_rate(read, [1, 2, 3])) == rows(pageflow.page_convert_rate(log, [1, 2, 3]))
    plan = plan_text(tables.read_bucketed_log(spark, name, "2024-01-02", "2024-01-02"))
    assert re.search(r"PartitionFilters: \[[^\]]*date", plan)


def test_buckets_are_one_file_a_date(spark, stored):
    got = tables.bucket_bytes(spark, stored[0]).collect()
    assert {r["bucket"] for r in got} <= set(range(4)) and all(0 < r["n_files"] <= 3 and r["bytes"] > 0 for r in got)
    empty = f"log_{uuid.uuid4().hex}"
    sinks.write_bucketed_log(make_actions(spark, HOT).drop("action_ts").limit(0), empty, new_path("empty"), 4)
    assert tables.read_bucketed_log(spark, empty).count() == 0 and tables.bucket_bytes(spark, empty).count() == 0


# --- lists -----------------------------------------------------------------

@pytest.mark.parametrize("name", ["session_profile", "session_filtered", "session_filtered_all_params", "packed_profile",
                                  "packed_profile_fields", "packed_profile_rewrite", "session_random_extract"])
def test_lists_without_object_aggregates(spark, name):
    df = queries.REGISTRY[name](spark, SF_SMALL)
    assert "ObjectHashAggregate" not in plan_text(df) and "ObjectHashAggregate" not in final_plan(df)


def test_lists_of_a_hot_session(spark):
    got = {r["session_id"]: r for r in sessions.session_profile(make_actions(spark, HOT).repartition(5), make_users(spark, USERS)).collect()}
    hot = [r for r in HOT if r[3] == "hot"]
    assert got["hot"]["search_keywords"] == ",".join(sorted({r[6] for r in hot if r[6]}))
    assert got["hot"]["click_category_ids"] == ",".join(map(str, sorted({r[7] for r in hot if r[7] != -1})))
    assert got["hot"]["step_length"] == len(hot) and got["bad"]["search_keywords"] is None
    assert got["bad"]["step_length"] == 2 and got["bad"]["click_category_ids"] is None
    slim = sessions.session_profile(make_actions(spark, HOT), make_users(spark, USERS), lists=False)
    assert rows(slim) == rows(sessions.session_profile(make_actions(spark, HOT), make_users(spark, USERS)).select(slim.columns))


def test_repeated_users_do_not_repeat_sessions(spark):
    acts = make_actions(spark, HOT)
    again = [*USERS, user(1), user(1, age=31), user(2, age=None), (None, "x", "x", 30, "p", "c", "male")]
    once = rows(sessions.session_profile(acts, make_users(spark, [user(1, age=31), *USERS[1:]])))
    for order in (again, again[::-1]):
        unique = sessions.one_row_per_user(make_users(spark, order))
        assert rows(sessions.session_profile(acts, unique)) == once
    assert {tuple(r) for r in sessions.repeated_users(make_users(spark, again)).collect()} == {(1, 3), (2, 2)}


def test_queries_and_reports_guard_the_users(spark, monkeypatch, tmp_path):
    from visitlab.plans import reports
    guarded = {n: rows(queries.REGISTRY[n](spark, SF_SMALL)) for n in ("session_filtered", "daily_length_stats")}
    real = tables.user_info
    monkeypatch.setattr(tables, "user_info", lambda spark, sf: real(spark, sf).union(real(spark, sf)))
    for name, want in guarded.items():
        assert rows(queries.REGISTRY[name](spark, SF_SMALL)) == want
    acts = tables.visit_actions(spark, SF_SMALL, DEFAULT.start_date, DEFAULT.end_date)
    reports.run_all(spark, acts, tables.user_info(spark, SF_SMALL), DEFAULT, reports.Sink(path=str(tmp_path)))
    assert rows(spark.read.parquet(f"{tmp_path}/session_aggr_stat")) == rows(queries.REGISTRY["session_length_stats"](spark, SF_SMALL))


def test_unique_users_add_no_exchange_on_the_shuffled_path(spark):
    with settings(spark, NO_BROADCAST):
        users = sessions.one_row_per_user(make_users(spark, USERS))
        plan = final_plan(sessions.session_profile(make_actions(spark, HOT), users, lists=False))
    assert sum("user_id" in k for k in exchanges(plan)) == 2  # sessions and users, once each


# --- intermediates written once --------------------------------------------

@pytest.mark.parametrize("broadcasts", [True, False])
def test_ranking_reads_the_log_once(spark, broadcasts, monkeypatch):
    made = []

    def watched(df, name):
        made.append(df)
        return real(df, name)

    real = queries.materialize
    monkeypatch.setattr(queries, "materialize", watched)
    with settings(spark, {} if broadcasts else NO_BROADCAST):
        got = queries.REGISTRY["top10_session"](spark, SF_SMALL)
        lazy = ranking.category_session_counts(queries._filtered_actions(spark, SF_SMALL))
        want = ranking.top_sessions(ranking.top_category_sessions(lazy)[1], queries.TASK_ID)
        assert rows(got) == rows(want)
    assert len(made) == 1
    assert "events.parquet" not in plan_text(got)              # the report reads the written counts only
    assert plan_text(made[0]).count("LeftSemi") == 1
    assert plan_text(made[0]).count("events.parquet") == 2     # the actions, and the sessions they are kept by


# --- replaceable tables ----------------------------------------------------

FAIL = "CAST(raise_error('stop') AS BIGINT)"


def test_failing_replacement_leaves_the_old_table(spark):
    path = new_path("t")
    with pytest.raises(FileNotFoundError):
        tables.read_replaced(spark, path)
    first = sinks.replace_table(spark.range(5), path)
    assert tables.read_replaced(spark, path).count() == 5
    held = tables.read_replaced(spark, path)
    with pytest.raises(Exception, match="stop"):
        sinks.replace_table(spark.range(100, numPartitions=4).selectExpr(f"CASE WHEN id = 99 THEN {FAIL} ELSE id END AS id"), path)
    assert sorted(r["id"] for r in tables.read_replaced(spark, path).collect()) == list(range(5))
    second = sinks.replace_table(spark.range(2), path)
    assert tables.read_replaced(spark, path).count() == 2 and held.count() == 5
    assert sinks.current_version(spark, path) == second and sinks.old_versions(spark, path) == [f"{path}/{first}"]


def test_dates_are_replaced_alone_and_only_as_a_whole(spark):
    path = new_path("t")
    day = lambda d, n: spark.range(n).select("id", F.lit(d).alias("date"))
    sinks.overwrite_dates(day("2024-01-01", 3).union(day("2024-01-02", 4)), path)
    sinks.overwrite_dates(day("2024-01-02", 1), path)
    counts = lambda: {str(r["date"]): r["count"] for r in spark.read.parquet(path).groupBy("date").count().collect()}
    assert counts() == {"2024-01-01": 3, "2024-01-02": 1}
    bad = spark.range(100, numPartitions=4).selectExpr(f"CASE WHEN id = 99 THEN {FAIL} ELSE id END AS id", "'2024-01-01' AS date")
    with pytest.raises(Exception, match="stop"):
        sinks.overwrite_dates(bad, path)
    assert counts() == {"2024-01-01": 3, "2024-01-02": 1}


# --- daily states ----------------------------------------------------------

PARAMS = TaskParams(start_date="2024-01-01", end_date="2024-01-03", start_age=20, end_age=50, task_id="t", keywords="é,k3",
                    category_ids="1,2,3")


@pytest.mark.parametrize("first,last", [("2024-01-01", "2024-01-03"), ("2024-01-02", "2024-01-02"), ("2025-01-01", "2025-01-02")])
@pytest.mark.parametrize("params", [DEFAULT, PARAMS])
def test_merged_days_equal_the_log(spark, first, last, params):
    acts, users, path = make_actions(spark, HOT), make_users(spark, USERS), new_path("states")
    for d in ("2024-01-01", "2024-01-02", "2024-01-03"):
        daily.write_days(daily.day_states(acts.where(F.col("date") == d), params), path)
    states = daily.read_days(spark, path, first, last)
    log = acts.where(F.col("date").between(first, last))
    kept = sessions.filtered_sessions(log, users, params, lists=False)
    merged = daily.filtered(states, users, params)
    assert rows(merged) == rows(kept)
    assert rows(metrics.length_stats(merged, "t")) == rows(metrics.length_stats(kept, "t"))
    assert rows(sampling.sessions_per_hour(merged)) == rows(sampling.sessions_per_hour(kept))


def test_states_add_up(spark):
    acts = make_actions(spark, HOT)
    halves = [daily.day_states(acts.where(f"event_id % 2 = {k}"), PARAMS) for k in (0, 1)]
    whole = daily.day_states(acts, PARAMS)
    assert rows(daily.combine(halves[0].union(halves[1]))) == rows(whole)
    assert rows(daily.combine(halves[1].union(halves[0]))) == rows(whole)
    assert rows(daily.combine(whole.union(daily.day_states(acts.limit(0), PARAMS)))) == rows(whole)  # zero


def test_a_day_is_added_without_reading_the_others(spark):
    acts, path = make_actions(spark, HOT), new_path("states")
    daily.write_days(daily.day_states(acts.where("date < '2024-01-03'"), DEFAULT), path)
    before = {f: os.stat(f).st_mtime_ns for f in _files(path)}
    day = daily.day_states(acts.where("date = '2024-01-03'"), DEFAULT)
    assert path not in plan_text(day)
    daily.write_days(day, path)
    after = {f: os.stat(f).st_mtime_ns for f in _files(path)}
    assert before.items() <= after.items() and len(after) > len(before)
    plan = plan_text(daily.read_days(spark, path, "2024-01-03", "2024-01-03"))
    assert re.search(r"PartitionFilters: \[[^\]]*date", plan)


def _files(path):
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
