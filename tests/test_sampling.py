import datetime as dt

from visitlog_rows import plan_text
from pyspark.sql import types as T

from visitlab.operators import sampling

PROFILE = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("search_keywords", T.StringType()),
    T.StructField("click_category_ids", T.StringType()),
])


def _sessions(spark, cells):
    """cells: {(day, hour): n} -> one profile row per session."""
    rows = []
    for (day, hour), n in cells.items():
        for i in range(n):
            rows.append((f"d{day}h{hour}s{i:03d}", dt.datetime(2024, 1, day, hour, 1, 2), "", "1,2"))
    return spark.createDataFrame(rows, PROFILE)


def test_quota_formula_and_rows_per_cell(spark):
    cells = {(1, 0): 1, (1, 5): 2, (2, 7): 200}
    s = _sessions(spark, cells)
    q = {(r["date"], r["hour"]): (r["session_count"], r["quota"])
         for r in sampling.extract_quota(sampling.sessions_per_hour(s), 150).collect()}
    total = 203
    for (day, hour), n in cells.items():
        assert q[(f"2024-01-0{day}", hour)] == (n, n * min(150, total) // total + 1)
    out = sampling.random_extract(s, 150, "seed", "t")
    per_cell = {}
    for r in out.collect():
        key = r["start_time"][:13]
        per_cell[key] = per_cell.get(key, 0) + 1
    assert per_cell == {"2024-01-01 00": 1, "2024-01-01 05": 2, "2024-01-02 07": 148}
    assert all(r["search_keywords"] is None for r in out.collect())


def test_k_larger_than_total(spark):
    s = _sessions(spark, {(1, 1): 3, (1, 2): 4})
    out = sampling.random_extract(s, 1000, "seed", "t")
    assert out.count() == 7          # quota n + 1 but never more than n


def test_same_seed_same_sample_other_seed_differs(spark):
    s = _sessions(spark, {(3, 4): 200})
    a = sorted(r["session_id"] for r in sampling.random_extract(s, 150, "x").collect())
    b = sorted(r["session_id"] for r in sampling.random_extract(s.repartition(5), 150, "x").collect())
    c = sorted(r["session_id"] for r in sampling.random_extract(s, 150, "y").collect())
    assert a == b and len(a) == 151   # 200 * 150 div 200 + 1
    assert a != c


def test_plan_limits_each_cell_before_shuffle(spark):
    s = _sessions(spark, {(1, 1): 5})
    plan = plan_text(sampling.random_extract(s, 150, "x"))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "Python" not in plan


def test_detail_returns_all_actions_of_picked_sessions(spark):
    from visitlog_rows import action, make_actions
    acts = make_actions(spark, [action(1, "a", "2024-01-01 1:00:00"),
                                action(2, "a", "2024-01-01 1:00:03"),
                                action(3, "b", "2024-01-01 1:00:00")])
    picked = spark.createDataFrame([("a",)], "session_id string")
    out = sampling.extract_detail(acts, picked, "t")
    assert sorted(r["action_time"] for r in out.collect()) == ["2024-01-01 1:00:00",
                                                               "2024-01-01 1:00:03"]
    assert out.columns[0] == "task_id" and len(out.columns) == 12
