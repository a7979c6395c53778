from visitlog_rows import action, make_actions, make_users, user

from visitlab.operators import sessions
from visitlab.params import TaskParams


def _profiles(spark, rows, users, params=None):
    acts = make_actions(spark, rows)
    prof = sessions.session_profile(acts, make_users(spark, users), params)
    return {r["session_id"]: r for r in prof.collect()}


def test_profile_mixed_clock_text_and_bad_time(spark):
    rows = [
        action(1, "s", "2024-01-01 3:30:57"),
        action(2, "s", "2024-01-01 13:30:57"),
        action(3, "s", "2024-01-01 09:00:00"),
        action(4, "s", "2024-01-01 xx:00:00"),   # bad text: no time, still a step
        action(5, "s", None),
    ]
    p = _profiles(spark, rows, [user(1)])["s"]
    assert p["step_length"] == 5
    assert str(p["start_time"]) == "2024-01-01 03:30:57"
    assert str(p["end_time"]) == "2024-01-01 13:30:57"
    assert p["visit_length"] == 10 * 3600


def test_keywords_and_categories_distinct_sorted(spark):
    rows = [
        action(1, "s", "2024-01-01 1:00:00", keyword="火锅"),
        action(2, "s", "2024-01-01 1:00:01", keyword="火锅"),
        action(3, "s", "2024-01-01 1:00:02", keyword="lamer"),
        action(4, "s", "2024-01-01 1:00:03", keyword="la"),      # substring of another
        action(5, "s", "2024-01-01 1:00:04", keyword=""),
        action(6, "s", "2024-01-01 1:00:05", click=12),
        action(7, "s", "2024-01-01 1:00:06", click=3),
        action(8, "s", "2024-01-01 1:00:07", click=12),
        action(9, "t", "2024-01-01 1:00:00"),
    ]
    p = _profiles(spark, rows, [user(1)])
    assert p["s"]["search_keywords"] == "la,lamer,火锅"
    assert p["s"]["click_category_ids"] == "3,12"
    assert p["t"]["search_keywords"] is None
    assert p["t"]["click_category_ids"] is None


def test_user_is_smallest_known_id_and_missing_user_drops(spark):
    rows = [action(1, "s", "2024-01-01 1:00:00", user_id=-1),
            action(2, "s", "2024-01-01 1:00:01", user_id=5),
            action(3, "s", "2024-01-01 1:00:02", user_id=4),
            action(4, "nouser", "2024-01-01 1:00:00", user_id=99)]
    p = _profiles(spark, rows, [user(4, age=41), user(5)])
    assert set(p) == {"s"}
    assert p["s"]["user_id"] == 4 and p["s"]["age"] == 41


def test_duplicate_user_rows_multiply_sessions(spark):
    acts = make_actions(spark, [action(1, "s", "2024-01-01 1:00:00")])
    users = make_users(spark, [user(1), user(1)])
    assert sessions.session_profile(acts, users).count() == 2


def _filtered_ids(spark, rows, users, params):
    acts = make_actions(spark, rows)
    out = sessions.filtered_sessions(acts, make_users(spark, users), params)
    return sorted(r["session_id"] for r in out.collect())


ROWS = [
    action(1, "a", "2024-01-01 1:00:00", user_id=1, keyword="kw1", click=5),
    action(2, "b", "2024-01-01 1:00:00", user_id=2, keyword="kw2", click=7),
    action(3, "c", "2024-01-01 1:00:00", user_id=3),
    action(4, "d", "2024-01-01 1:00:00", user_id=4, click=5),
]
USERS = [user(1, age=20, professional="A", city="city1", sex="male"),
         user(2, age=50, professional="B", city="city2", sex="female"),
         user(3, age=51, professional="A", city="city1", sex="male"),
         user(4, age=None, professional=None, city=None, sex=None)]


def test_one_sided_age_means_no_restriction(spark):
    assert _filtered_ids(spark, ROWS, USERS, TaskParams(start_age=20)) == ["a", "b", "c", "d"]


def test_age_bounds_inclusive_and_unknown_fails(spark):
    assert _filtered_ids(spark, ROWS, USERS, TaskParams(start_age=20, end_age=50)) == ["a", "b"]


def test_empty_strings_mean_no_restriction(spark):
    p = TaskParams(professionals="", cities="", sex="", keywords="", category_ids="")
    assert _filtered_ids(spark, ROWS, USERS, p) == ["a", "b", "c", "d"]


def test_membership_and_equality(spark):
    assert _filtered_ids(spark, ROWS, USERS, TaskParams(professionals="A,Z")) == ["a", "c"]
    assert _filtered_ids(spark, ROWS, USERS, TaskParams(cities="city2")) == ["b"]
    assert _filtered_ids(spark, ROWS, USERS, TaskParams(sex="male")) == ["a", "c"]


def test_keyword_filter_matches_any_keyword(spark):
    assert _filtered_ids(spark, ROWS, USERS, TaskParams(keywords="kw2,kw9")) == ["b"]


def test_category_filter_matches_clicked_categories(spark):
    assert _filtered_ids(spark, ROWS, USERS, TaskParams(category_ids="5")) == ["a", "d"]


def test_all_filters_together(spark):
    p = TaskParams(start_age=10, end_age=60, professionals="A", cities="city1", sex="male",
                   keywords="kw1", category_ids="5,6")
    assert _filtered_ids(spark, ROWS, USERS, p) == ["a"]


def test_params_from_dict_uses_original_names():
    p = TaskParams.from_dict({"startDate": "2024-01-01", "endDate": "2024-01-02",
                              "startAge": 20, "endAge": "", "categoryIds": "1, 2,,3"})
    assert p.category_ids == (1, 2, 3)
    assert not p.age_restricted


def test_visit_actions_scan_pushes_date_range(spark):
    from visitlog_rows import SF_SMALL, plan_text
    from visitlab.sources import tables
    df = tables.visit_actions(spark, SF_SMALL, "2024-01-05", "2024-01-20").select("session_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "props" not in plan.split("ReadSchema:")[1].split("\n")[0]
    assert plan_text(df)


def test_props_k_fast_path_equals_json_parser(spark):
    from visitlab.sources import tables
    docs = ['{"k": 69}', '{"k":-3}', '{"a": {"k": 1}, "k": 2}', '{"k": "7"}', "junk",
            ' {"k" : 5 } ', '{"k": 1.5}', None]
    df = spark.createDataFrame(list(enumerate(docs)), "event_id bigint, props string")
    k = [e for e in tables._EVENT_HELPERS if e.endswith(" AS k")][0]
    got = df.selectExpr("event_id", k, "try_cast(get_json_object(props, '$.k') AS BIGINT) AS j")
    assert all(r["k"] == r["j"] for r in got.collect())


def test_params_validation_and_replace():
    import pytest
    with pytest.raises(KeyError):
        TaskParams.from_dict({"startDate": "2024-01-01", "endDate": "2024-01-02", "colour": "red"})
    with pytest.raises(ValueError):
        TaskParams(start_date="", end_date="2024-01-02")
    p = TaskParams(keywords="a, b,,", task_id="t")
    q = p.replace(sex=" female ", category_ids=[3, "4"])
    assert (q.keywords, q.sex, q.category_ids, q.task_id) == (("a", "b"), "female", (3, 4), "t")
    assert hash(q) == hash(p.replace(sex="female", category_ids="3,4"))


def test_the_value_minus_one_fails_membership_and_null_sessions_are_no_session(spark):
    rows = [action(1, "s", "2024-01-01 1:00:00", user_id=1), action(2, "t", "2024-01-01 1:00:00", user_id=2),
            action(3, None, "2024-01-01 1:00:00", user_id=2)]
    users = make_users(spark, [user(1, city="-1", professional="-1"), user(2)])
    acts = make_actions(spark, rows)
    for p in (TaskParams(cities=("-1", "city0")), TaskParams(professionals=("-1", "p0"))):
        assert [r["session_id"] for r in sessions.filtered_sessions(acts, users, p).collect()] == ["t"]


def test_a_scan_sees_files_added_below_a_subfolder(spark, tmp_path):
    from visitlab.sources import tables
    part = f"{tmp_path}/events.parquet/p=1"
    one = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(100)
    one.write.parquet(part)
    assert tables.visit_actions(spark, str(tmp_path)).count() == 100
    one.write.mode("append").parquet(part)
    assert tables.visit_actions(spark, str(tmp_path)).count() == 200


def test_bad_date_text_does_not_fail_the_time_keys(spark):
    from visitlab.operators import records
    acts = make_actions(spark, [action(1, "s", "xx yy")])
    row = records.time_keys(acts, "2024-01-15 12:00:00", "2024-02-01").first()
    assert row["days_before_run"] is None and row["is_day_before_run"] is None
