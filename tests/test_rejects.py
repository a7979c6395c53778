"""What of the visit log could not be read, counted by date and in another job's pass."""

from visitlog_rows import SF_SMALL, action, make_actions, make_users, user

from visitlab.operators import rejects, sessions
from visitlab.sources import tables


def log(spark):
    return make_actions(spark, [
        action(1, "a", "2024-01-01 1:00:00", order="1,2,x", pay="3,,4"),
        action(2, "a", "2024-01-01 25:00:00", order="x1, 7 ,y", pay="z"),
        action(3, None, "2024-01-01 3:00:00", user_id=-1),
        action(4, "b", "2024-01-02 soon", user_id=None, order="", pay="99999999999999999999"),
        (5, "2024-01-02", 1, "b", 0, None, None, -1, -1, None, None, None, None, 0),
        (6, "2024-01-02", 1, "b", 0, "", None, -1, -1, ",", None, " ", None, 0),
        (7, None, 1, "b", 0, "2024-01-02 1:00:00", None, -1, -1, None, None, None, None, 0)])


WANT = {"2024-01-01": (3, 1, 1, 0, 1, 3, 1, 2), "2024-01-02": (3, 0, 1, 2, 1, 0, 1, 1), None: (1, 0, 0, 0, 0, 0, 0, 0)}


def test_counts_by_date(spark):
    got = rejects.rejects(log(spark))
    assert got.columns == ["date", *rejects.COUNTS]
    assert {r["date"]: tuple(r)[1:] for r in got.collect()} == WANT
    assert tuple(rejects.total(got).first()) == tuple(map(sum, zip(*WANT.values())))
    assert rejects.rejects(log(spark).limit(0)).count() == 0
    assert tuple(rejects.total(rejects.rejects(log(spark).limit(0))).first()) == (0,) * len(rejects.COUNTS)


def test_counts_in_the_pass_of_another_job(spark):
    watched, seen = rejects.observed(log(spark))
    profile = sessions.session_profile(watched, make_users(spark, [user(1)]))
    assert {r["session_id"]: r["step_length"] for r in profile.collect()} == {"a": 2, "b": 4}
    assert tuple(seen.get[c] for c in rejects.COUNTS) == tuple(map(sum, zip(*WANT.values())))


def test_reports_write_the_counts(spark, tmp_path):
    from visitlab.plans import reports
    from visitlab.plans.defaults import DEFAULT
    acts = tables.visit_actions(spark, SF_SMALL, DEFAULT.start_date, DEFAULT.end_date)
    reports.run_all(spark, acts, tables.user_info(spark, SF_SMALL), DEFAULT, reports.Sink(path=str(tmp_path)))
    row = spark.read.parquet(f"{tmp_path}/visit_log_rejects").first()
    assert row["task_id"] == DEFAULT.task_id and row["actions"] == acts.count() and row["bad_time"] == 0
