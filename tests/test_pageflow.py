import random

from visitlog_rows import action, make_actions

from pyspark.sql import Window
from pyspark.sql import functions as F

from visitlab.operators import pageflow


def _by_window(actions):
    """The same pairs from one ``lead`` per session."""
    w = Window.partitionBy("session_id").orderBy("action_ts", "event_id")
    return actions.select("page_id", F.lead("page_id").over(w).alias("next_page"), F.lit(True).alias("is_action"))


def _rates(df):
    return [(r["step"], r["page_pair"], r["pair_count"], r["convert_rate"])
            for r in df.orderBy("step").collect()]


def _session(sid, pages, start=0, eid0=0):
    return [action(eid0 + i, sid, f"2024-01-01 1:{(start + i) // 60:02d}:{(start + i) % 60:02d}",
                   page_id=p) for i, p in enumerate(pages)]


def test_full_broken_repeated_and_absent_flows(spark):
    rows = (_session("full", [1, 2, 3], eid0=0)
            + _session("broken", [1, 2, 9, 3], eid0=10)
            + _session("repeat", [1, 1, 2, 2, 3], eid0=20)
            + _session("nofirst", [2, 3], eid0=30))
    out = pageflow.page_convert_rate(make_actions(spark, rows), [1, 2, 3], step=2)
    # visits of 1: 1 + 1 + 2 = 4; (1,2): full, broken, repeat = 3; (2,3): full, repeat, nofirst = 3
    assert _rates(out) == [(1, "1_2", 3, 0.75), (2, "2_3", 3, 1.0)]


def test_zero_denominator_gives_null(spark):
    rows = _session("s", [5, 6])
    out = pageflow.page_convert_rate(make_actions(spark, rows), [1, 2, 3])
    assert _rates(out) == [(1, "1_2", 0, None), (2, "2_3", 0, None)]


def test_order_uses_time_then_event_id(spark):
    # event ids out of time order; equal times fall back to the event id
    rows = [action(5, "s", "2024-01-01 1:00:00", page_id=1),
            action(1, "s", "2024-01-01 1:00:01", page_id=2),
            action(9, "s", "2024-01-01 1:00:02", page_id=3),
            action(8, "s", "2024-01-01 1:00:02", page_id=4)]
    out = pageflow.page_convert_rate(make_actions(spark, rows), [1, 2, 4, 3])
    assert [r[2] for r in _rates(out)] == [1, 1, 1]


def test_range_split_equals_one_window_per_session(spark):
    rnd = random.Random(7)
    rows = []
    eid = 0
    for s in range(12):
        n = 300 if s == 0 else rnd.randint(1, 40)     # one session much larger
        for i in range(n):
            rows.append(action(eid, f"s{s:02d}", f"2024-01-01 2:{i // 60 % 60:02d}:{i % 60:02d}",
                               page_id=rnd.randint(0, 4)))
            eid += 1
    acts = make_actions(spark, rows)
    flow = [0, 1, 2, 3, 4, 0]
    expected = _rates(pageflow.convert_rate(_by_window(acts), flow))
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            for step in (1, 7, 60, 600, 86400):
                assert _rates(pageflow.page_convert_rate(acts, flow, step=step)) == expected
        finally:
            spark.conf.set("spark.sql.exchange.reuse", "true")


def test_one_plan_and_rows_without_a_session(spark):
    from visitlog_rows import plan_text
    rows = _session("s", [1, 2, 3]) + _session(None, [1, 2], eid0=50)
    out = pageflow.page_convert_rate(make_actions(spark, rows), [1, 2, 3])
    assert _rates(out) == [(1, "1_2", 1, 1.0), (2, "2_3", 1, 1.0)]
    assert "rangepartitioning" not in plan_text(out)


def test_piece_ends_do_not_depend_on_event_ids(spark):
    rows = _session("s", [1, 2, 3, 1, 2, 3], eid0=0) + _session("t", [1, 2, 3], start=30, eid0=10)
    acts = make_actions(spark, rows)
    no_ids = acts.withColumn("event_id", F.lit(None).cast("bigint"))
    expected = _rates(pageflow.convert_rate(_by_window(acts), [1, 2, 3]))
    for step in (2, 4):
        assert _rates(pageflow.page_convert_rate(no_ids, [1, 2, 3], step=step)) == expected
