"""Plan guards over every registered query: no cartesian or nested-loop
joins, no Python evaluation, date range pushed into every scan of the visit
log, and no scan reading a column the query does not use."""

import re

import pytest
from visitlog_rows import SF_SMALL, plan_text

from visitlab.operators import ranking
from visitlab.plans import queries
from visitlab.plans.queries import REGISTRY as QUERIES

# queries whose feature is not a date range: they read every event
WHOLE_EVENTS = {"ad_click_parse", "ad_click_format", "time_keys", "text_hygiene", "page_convert_rate",
                "visit_log_rejects"}
# queries that end in a read of what they wrote from the log; test_stored_log.py
# looks at both halves of them
WRITTEN = {"bucketed_session_profile", "bucketed_filtered_actions", "bucketed_page_convert_rate",
           "daily_length_stats", "daily_sessions_per_hour", "category_session_clicks", "top10_session"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_guards(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, bad
    scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\].*?Location: [^\[]*\[file:([^\]]*)\]"
                       r".*?PushedFilters: \[([^\]]*)\].*?ReadSchema: (struct<[^>]*>)", plan)
    assert scans, "no parquet scan found in the plan"
    assert any(path.endswith("events.parquet") or name == "product_status" or name in WRITTEN
               for _, path, _, _ in scans)
    for cols, path, pushed, schema in scans:
        if path.endswith("events.parquet") and name not in WHOLE_EVENTS:
            assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed, (name, pushed)
        assert "value:" not in schema, (name, schema)      # events.value is never used


def test_top10_session_reuses_shuffles_on_the_shuffled_path(spark):
    """With broadcasts off (the large-input path) the two uses of the
    per-(category, session) counts read the same shuffle outputs, where a caller
    composes them without writing the counts first."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        cs = ranking.category_session_counts(queries._filtered_actions(spark, SF_SMALL))
        df = ranking.top_sessions(ranking.top_category_sessions(cs)[1])
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
        final = text.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
        assert re.search(r"SortMergeJoin \[session_id#\d+\], \[session_id#\d+\], LeftSemi", final)
        assert final.count("ReusedExchange") >= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
