import os
import tempfile

from visitlog_rows import SF_SMALL, action, make_actions

from visitlab.sources import sinks, tables


def test_overwrite_partitioned_log_prunes_dates(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="visitlog-"), "user_visit_action")
    acts = make_actions(spark, [action(1, "a", "2024-01-01 1:00:00"),
                                action(2, "b", "2024-01-02 1:00:00"),
                                action(3, "c", "2024-01-03 1:00:00")]).drop("action_ts")
    sinks.overwrite_table(acts, out, partition_by=["date"])
    sinks.overwrite_table(acts, out, partition_by=["date"])     # replace, not add
    df = tables.read_visit_log(spark, out, "2024-01-02", "2024-01-03")
    assert sorted(r["session_id"] for r in df.collect()) == ["b", "c"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert df.where("action_ts IS NULL").count() == 0


def test_append_parquet_twice(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="report-"), "session_aggr_stat")
    df = sinks.with_task_id(spark.createDataFrame([(1,)], "session_count bigint"), "t1")
    sinks.append_parquet(df, out)
    sinks.append_parquet(df, out)
    r = spark.read.parquet(out).collect()
    assert len(r) == 2 and r[0]["task_id"] == "t1"


def test_jdbc_writer_is_configured_without_connecting(spark):
    df = spark.createDataFrame([(1,)], "x int")
    w = sinks.jdbc_writer(df, "jdbc:example://host/db", "top10_session",
                          {"user": "u"}, num_partitions=2)
    assert w is not None


def test_entry_and_registry(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["task_id", "category_id", "session_id", "click_count"]
    from visitlab.plans.queries import REGISTRY
    assert set(REGISTRY) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_every_query_runs_on_smallest_tables(spark):
    from visitlab.plans.queries import REGISTRY
    for name, fn in REGISTRY.items():
        df = fn(spark, SF_SMALL)
        df.write.format("noop").mode("overwrite").save()


def test_report_jobs_write_every_output(spark):
    import __spark_entry__ as entry
    from visitlab.plans import reports
    from visitlab.plans.defaults import DEFAULT
    out = tempfile.mkdtemp(prefix="reports-")
    acts = tables.visit_actions(spark, SF_SMALL, DEFAULT.start_date, DEFAULT.end_date)
    reports.run_all(spark, acts, tables.user_info(spark, SF_SMALL), DEFAULT, reports.Sink(path=out))
    q = entry.queries()

    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    for table, query in [("session_aggr_stat", "session_length_stats"),
                         ("session_random_extract", "session_random_extract"),
                         ("session_detail", "session_extract_detail"),
                         ("top10_category", "top10_category"),
                         ("top10_session", "top10_session")]:
        written = spark.read.parquet(os.path.join(out, table))
        assert rows(written.select(*q[query](spark, SF_SMALL).columns)) == \
            rows(q[query](spark, SF_SMALL)), table
    assert spark.read.parquet(os.path.join(out, "page_convert_rate")).count() == 6


def test_stored_log_path_equals_events_path(spark):
    """Write the mapped visit log as a date-partitioned table, read it back
    with the stored-log scan (text time parsed at scan) and compare profiles."""
    from visitlab.operators import sessions
    from visitlab.plans.defaults import DEFAULT
    out = os.path.join(tempfile.mkdtemp(prefix="visitlog-"), "user_visit_action")
    direct = tables.visit_actions(spark, SF_SMALL, DEFAULT.start_date, DEFAULT.end_date)
    sinks.overwrite_table(direct.select(*tables.VISIT_COLUMNS), out, partition_by=["date"])
    stored = tables.read_visit_log(spark, out, DEFAULT.start_date, DEFAULT.end_date)
    users = tables.user_info(spark, SF_SMALL)

    def rows(acts):
        prof = sessions.session_profile(acts, users, DEFAULT)
        return sorted((tuple(r) for r in prof.select(sorted(prof.columns)).collect()),
                      key=lambda t: [(v is None, str(v)) for v in t])

    assert rows(stored) == rows(direct)


def test_stored_log_keeps_text_date(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="visitlog-"), "user_visit_action")
    acts = make_actions(spark, [action(1, "a", "2024-01-01 1:00:00")]).drop("action_ts")
    sinks.overwrite_table(acts, out, partition_by=["date"])
    df = tables.read_visit_log(spark, out)
    assert dict(df.dtypes)["date"] == "string"
    assert df.collect()[0]["date"] == "2024-01-01"


def test_extract_population_switch(spark):
    """Q9: the sample is drawn from date-filtered sessions by default, from the
    fully filtered sessions with apply_filters."""
    from visitlab.operators import sessions
    from visitlab.plans import reports
    from visitlab.plans.defaults import DEFAULT
    acts = tables.visit_actions(spark, SF_SMALL, DEFAULT.start_date, DEFAULT.end_date)
    users = tables.user_info(spark, SF_SMALL)
    p = DEFAULT.replace(keywords="kw1")
    profile = sessions.session_profile(acts, users, p)
    out = tempfile.mkdtemp(prefix="extract-")
    everyone = reports.random_extract_report(acts, profile, p, reports.Sink(path=out + "/a"), k=1000)
    kept = reports.random_extract_report(acts, profile, p, reports.Sink(path=out + "/b"), k=1000,
                                         apply_filters=True)
    all_ids = {r["session_id"] for r in everyone.collect()}
    kept_ids = {r["session_id"] for r in kept.collect()}
    searched = {r["session_id"] for r in sessions.apply_filters(profile, p).collect()}
    assert all_ids == {r["session_id"] for r in profile.collect()}   # K above total: all
    assert kept_ids == searched and kept_ids < all_ids


def test_reports_cli_on_stored_tables(spark):
    from visitlab.plans import reports
    from visitlab.plans.defaults import DEFAULT
    base = tempfile.mkdtemp(prefix="cli-")
    log, users = os.path.join(base, "user_visit_action"), os.path.join(base, "user_info")
    acts = tables.visit_actions(spark, SF_SMALL, DEFAULT.start_date, DEFAULT.end_date)
    sinks.overwrite_table(acts.select(*tables.VISIT_COLUMNS), log, partition_by=["date"])
    sinks.overwrite_table(tables.user_info(spark, SF_SMALL), users)
    reports.main(["--visit-log", log, "--users", users, "--out", os.path.join(base, "out"),
                  "--params", '{"startAge": 20, "endAge": 50, "targetPageFlow": "1,2,3"}'])
    stat = spark.read.parquet(os.path.join(base, "out", "session_aggr_stat")).collect()[0]
    assert stat["session_count"] == 147
