"""Fixed values of the driver tables with the mapping of FIXTURES.md and all
customers as users."""

import pytest
from visitlog_rows import SF_CHECK, SF_SMALL

import __spark_entry__ as entry

Q = entry.queries()

# sessions with age 20-50: step buckets 1-3/4-6/7-9/10-30/31-60/>60 and
# visit buckets 1-3/4-6/7-9/10-30 s, 60-180/181-600 s, 610-1800/>1800 s
GOLDEN = {
    SF_SMALL: dict(n=147, steps=[88, 27, 2, 25, 5, 0], short=[1, 1, 1, 5], mid=[9, 23], long=[4, 42],
                   all_params=0, profiles=None),
    SF_CHECK: dict(n=770, steps=[451, 114, 24, 155, 26, 0], short=[0, 0, 0, 3], mid=[0, 40],
                   long=[127, 394], all_params=41, profiles=1272),
}


@pytest.mark.parametrize("sf", [SF_SMALL, SF_CHECK])
def test_bucket_counts_match_published_values(spark, sf):
    g = GOLDEN[sf]
    rows = Q["session_buckets"](spark, sf).collect()
    assert len(rows) == g["n"]
    count = lambda col, label: sum(1 for r in rows if r[col] == label)
    assert [count("step_bucket", b) for b in ["1_3", "4_6", "7_9", "10_30", "30_60", "60"]] == g["steps"]
    assert [count("visit_bucket", b) for b in ["1s_3s", "4s_6s", "7s_9s", "10s_30s"]] == g["short"]
    assert [count("visit_bucket", b) for b in ["1m_3m", "3m_10m"]] == g["mid"]
    assert [count("visit_bucket", b) for b in ["10m_30m", "30m"]] == g["long"]
    assert Q["session_filtered_all_params"](spark, sf).count() == g["all_params"]
    if g["profiles"]:
        assert Q["session_profile"](spark, sf).count() == g["profiles"]


def test_sf001_top10_and_sample_sizes(spark):
    top = {r["category_id"]: (r["click_count"], r["order_count"], r["pay_count"])
           for r in Q["top10_category"](spark, SF_CHECK).collect()}
    assert top == {96: (22, 16, 17), 58: (19, 21, 11), 22: (19, 20, 17), 42: (19, 19, 18),
                   84: (18, 20, 17), 71: (18, 18, 14), 62: (18, 17, 17), 48: (18, 14, 13),
                   9: (17, 18, 18), 26: (17, 18, 18)}
    assert Q["filtered_actions"](spark, SF_CHECK).count() == 6024
    assert Q["category_ids"](spark, SF_CHECK).count() == 100
    assert Q["sessions_per_hour"](spark, SF_CHECK).count() == 662
    assert Q["session_random_extract"](spark, SF_CHECK).count() == 662
    assert Q["session_random_extract_large"](spark, SF_CHECK).count() == 786
    assert Q["visit_actions_in_range"](spark, SF_CHECK).count() == 5320
