from visitlog_rows import make_actions, action, make_users, user

from pyspark.sql import types as T

from visitlab.operators import metrics

SESSION_SCHEMA = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("visit_length", T.LongType()),
    T.StructField("step_length", T.LongType()),
])


def _labels(spark, values, buckets, col):
    rows = [(f"s{i}", v if col == "visit_length" else 0, v if col == "step_length" else 0)
            for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, SESSION_SCHEMA)
    out = metrics.session_buckets(df, step_buckets=metrics.STEP_BUCKETS)
    key = "visit_bucket" if col == "visit_length" else "step_bucket"
    got = {r["session_id"]: r[key] for r in out.collect()}
    return [got[f"s{i}"] for i in range(len(values))]


def test_step_edges(spark):
    steps = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]
    assert _labels(spark, steps, metrics.STEP_BUCKETS, "step_length") == [
        "1_3", "1_3", "4_6", "4_6", "7_9", "7_9", "10_30", "10_30", "30_60", "30_60", "60"]


def test_visit_edges_keep_gaps(spark):
    secs = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 59, 60, 180, 181, 600, 601, 609, 610, 1800, 1801]
    assert _labels(spark, secs, metrics.VISIT_BUCKETS, "visit_length") == [
        None, "1s_3s", "1s_3s", "4s_6s", "4s_6s", "7s_9s", "7s_9s", "10s_30s", "10s_30s",
        None, None, "1m_3m", "1m_3m", "3m_10m", "3m_10m", None, None, "10m_30m", "10m_30m", "30m"]


def test_contiguous_preset_has_no_gaps(spark):
    secs = [31, 59, 601, 609]
    rows = [(f"s{i}", v, 1) for i, v in enumerate(secs)]
    df = spark.createDataFrame(rows, SESSION_SCHEMA)
    out = metrics.session_buckets(df, visit_buckets=metrics.VISIT_BUCKETS_CONTIGUOUS)
    got = sorted((r["visit_length"], r["visit_bucket"]) for r in out.collect())
    assert got == [(31, "30s_60s"), (59, "30s_60s"), (601, "10m_30m"), (609, "10m_30m")]


def test_ratios_round_half_up(spark):
    # 57/200 = 0.285 -> 0.29, 1/200 = 0.005 -> 0.01, 25/200 = 0.125 -> 0.13
    rows = [(f"s{i}", 2 if i < 57 else 0, 1 if i < 1 else (4 if i < 26 else 12))
            for i in range(200)]
    df = spark.createDataFrame(rows, SESSION_SCHEMA)
    r = metrics.length_stats(df, "t").collect()[0]
    assert r["session_count"] == 200
    assert r["visit_length_1s_3s_ratio"] == 0.29
    assert r["step_length_1_3_ratio"] == 0.01
    assert r["step_length_4_6_ratio"] == 0.13
    assert r["visit_length_30s_60s_ratio"] == 0.0


def test_empty_input_reports_zero(spark):
    df = spark.createDataFrame([], SESSION_SCHEMA)
    r = metrics.length_stats(df, "t").collect()[0]
    assert r["session_count"] == 0
    assert all(r[c] == 0.0 for c in r.asDict() if c.endswith("_ratio"))


def test_step_buckets_sum_to_session_count(spark):
    rows = [(f"s{i}", i % 2000, 1 + (i * 7) % 90) for i in range(500)]
    df = spark.createDataFrame(rows, SESSION_SCHEMA)
    b = metrics.session_buckets(df)
    assert b.where("step_bucket IS NULL").count() == 0
    r = metrics.length_stats(df, "t").collect()[0]
    step_total = sum(r[c] for c in r.asDict() if c.startswith("step_length_"))
    assert abs(step_total - 1.0) < 0.05


def test_stats_end_to_end_on_hand_rows(spark):
    from visitlab.operators.sessions import filtered_sessions
    from visitlab.params import TaskParams
    rows = [action(1, "a", "2024-01-01 3:00:00"), action(2, "a", "2024-01-01 3:00:05"),
            action(3, "b", "2024-01-01 4:00:00", user_id=2)]
    acts = make_actions(spark, rows)
    users = make_users(spark, [user(1, age=30), user(2, age=60)])
    p = TaskParams(start_age=20, end_age=50, task_id="t")
    r = metrics.length_stats(filtered_sessions(acts, users, p), "t").collect()[0]
    assert r["session_count"] == 1
    assert r["visit_length_4s_6s_ratio"] == 1.0
    assert r["step_length_1_3_ratio"] == 1.0
