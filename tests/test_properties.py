
from visitlog_rows import action, make_actions, make_users, user
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from visitlab.operators import metrics, sampling, sessions
from visitlab.params import TaskParams

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@st.composite
def visit_logs(draw):
    n_sessions = draw(st.integers(1, 12))
    rows = []
    eid = 0
    for s in range(n_sessions):
        hour = draw(st.integers(0, 23))
        day = draw(st.integers(1, 3))
        steps = draw(st.integers(1, 70))
        for _ in range(steps):
            sec = draw(st.integers(0, 3599))
            rows.append(action(eid, f"s{s}", f"2024-01-0{day} {hour}:{sec // 60:02d}:{sec % 60:02d}",
                               user_id=s % 4,
                               keyword=draw(st.sampled_from([None, "kw1", "kw2", ""])),
                               click=draw(st.sampled_from([-1, 1, 2, 3]))))
            eid += 1
    return rows


USERS = [user(0, age=25), user(1, age=45), user(2, age=55), user(3, age=35)]


def _stats(df):
    return tuple(metrics.length_stats(df, "t").collect()[0])


@SETTINGS
@given(rows=visit_logs(), parts=st.integers(1, 7))
def test_stats_independent_of_row_order_and_partitions(spark, rows, parts):
    users = make_users(spark, USERS)
    p = TaskParams(start_age=20, end_age=50)
    a = sessions.filtered_sessions(make_actions(spark, rows), users, p)
    b = sessions.filtered_sessions(make_actions(spark, list(reversed(rows))).repartition(parts),
                                   users, p)
    assert _stats(a) == _stats(b)


@SETTINGS
@given(rows=visit_logs())
def test_steps_cover_every_session_and_sum_to_actions(spark, rows):
    prof = sessions.session_profile(make_actions(spark, rows), make_users(spark, USERS))
    b = metrics.session_buckets(prof).collect()
    assert all(r["step_bucket"] is not None for r in b)
    assert sum(r["step_length"] for r in b) == len(rows)


@SETTINGS
@given(rows=visit_logs(), k=st.integers(1, 40), seed=st.text(min_size=1, max_size=5))
def test_sample_takes_min_of_quota_and_cell_size(spark, rows, k, seed):
    prof = sessions.session_profile(make_actions(spark, rows), make_users(spark, USERS))
    quota = {(r["date"], r["hour"]): (r["session_count"], r["quota"]) for r in
             sampling.extract_quota(sampling.sessions_per_hour(prof), k).collect()}
    picked = sampling.random_extract(prof, k, seed).collect()
    per_cell = {}
    for r in picked:
        key = (r["start_time"][:10], int(r["start_time"][11:13]))
        per_cell[key] = per_cell.get(key, 0) + 1
    assert per_cell == {c: min(n, q) for c, (n, q) in quota.items()}
    again = sampling.random_extract(prof.repartition(3), k, seed).collect()
    assert sorted(r["session_id"] for r in again) == sorted(r["session_id"] for r in picked)


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.text(alphabet="abc,; 0123", max_size=6)),
                       min_size=1, max_size=6))
def test_packed_round_trip(spark, values):
    from visitlab.functions import packed as P
    names = [f"f{i}" for i in range(len(values))]
    df = spark.createDataFrame([tuple(values)], ", ".join(f"{n} string" for n in names))
    packed = df.selectExpr(P.pack_sql([(n, n) for n in names]) + " AS p")
    back = packed.selectExpr(*[P.packed_field_sql("p", n) + f" AS {n}" for n in names]).collect()[0]
    assert [back[n] for n in names] == [v if v else None for v in values]
