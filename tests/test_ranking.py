from visitlog_rows import action, make_actions, plan_text

from visitlab.operators import ranking


def _counts(spark, rows):
    acts = make_actions(spark, rows)
    return {r["category_id"]: (r["click_count"], r["order_count"], r["pay_count"])
            for r in ranking.category_full_count(acts).collect()}


def test_click_on_category_one_counts_and_no_click_ignored(spark):
    rows = [action(1, "s", "2024-01-01 1:00:00", click=1),
            action(2, "s", "2024-01-01 1:00:01", click=-1)]
    assert _counts(spark, rows) == {1: (1, 0, 0)}


def test_lists_split_trimmed_repeated_and_bad_parts(spark):
    rows = [action(1, "s", "2024-01-01 1:00:00", order="5,5"),
            action(2, "s", "2024-01-01 1:00:01", order="5, 6"),
            action(3, "s", "2024-01-01 1:00:02", pay="x,7,"),
            action(4, "s", "2024-01-01 1:00:03", click=6, order="6")]   # click and order together
    assert _counts(spark, rows) == {5: (0, 3, 0), 6: (1, 2, 0), 7: (0, 0, 1)}


def test_top10_ties_broken_by_category_id(spark):
    rows = [action(i, f"s{i}", "2024-01-01 1:00:00", click=c) for i, c in enumerate(range(20, 8, -1))]
    top = ranking.top10_category(ranking.category_full_count(make_actions(spark, rows)), "t")
    assert [r["category_id"] for r in top.collect()] == list(range(9, 19))
    assert "TakeOrderedAndProject" in plan_text(top)


def test_top10_orders_by_click_then_order_then_pay(spark):
    rows = [action(1, "s", "2024-01-01 1:00:00", click=1),
            action(2, "s", "2024-01-01 1:00:00", click=2), action(3, "s", "2024-01-01 1:00:00", order="2"),
            action(4, "s", "2024-01-01 1:00:00", click=3), action(5, "s", "2024-01-01 1:00:00", order="3"),
            action(6, "s", "2024-01-01 1:00:00", pay="3")]
    top = ranking.top10_category(ranking.category_full_count(make_actions(spark, rows)), "t")
    assert [r["category_id"] for r in top.orderBy("click_count", "order_count", "pay_count").collect()] \
        == [1, 2, 3]
    ordered = top.collect()
    assert [r["category_id"] for r in ordered][0] in (1, 2, 3)


def test_top_sessions_ties_by_session_id_and_plan_limits_before_shuffle(spark):
    rows = []
    eid = 0
    for s in range(15):
        for _ in range(2 if s < 12 else 1):
            rows.append(action(eid, f"s{s:02d}", "2024-01-01 1:00:00", click=4))
            eid += 1
    acts = make_actions(spark, rows)
    cs = ranking.category_session_counts(acts)
    top, clicks = ranking.top_category_sessions(cs, "t")
    out = ranking.top_sessions(clicks, "t")
    got = sorted((r["session_id"], r["click_count"]) for r in out.collect())
    assert got == [(f"s{s:02d}", 2) for s in range(10)]
    plan = plan_text(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "Python" not in plan


def test_category_session_counts_match_full_count(spark):
    rows = [action(i, f"s{i % 4}", "2024-01-01 1:00:00", click=i % 3,
                   order=str(i % 5) if i % 2 else None) for i in range(40)]
    acts = make_actions(spark, rows)
    direct = {r["category_id"]: tuple(r)[1:] for r in ranking.category_full_count(acts).collect()}
    via = {r["category_id"]: tuple(r)[1:] for r in
           ranking.full_count_from_sessions(ranking.category_session_counts(acts)).collect()}
    assert direct == via


def test_filtered_actions_is_semi_join(spark):
    from visitlab.operators.sessions import filtered_actions
    acts = make_actions(spark, [action(1, "a", "2024-01-01 1:00:00"),
                                action(2, "b", "2024-01-01 1:00:00")])
    keep = acts.where("session_id = 'a'").select("session_id")
    out = filtered_actions(acts, keep)
    assert [r["event_id"] for r in out.collect()] == [1]
    assert "LeftSemi" in plan_text(out)


def test_one_kind_counts_read_one_column(spark):
    rows = [action(1, "s", "2024-01-01 1:00:00", click=3), action(2, "s", "2024-01-01 1:00:01", click=-1),
            action(3, "s", "2024-01-01 1:00:02", order="5, 5,x"), action(4, "s", "2024-01-01 1:00:03", pay="7")]
    acts = make_actions(spark, rows)
    got = {k: [tuple(r) for r in ranking.category_kind_count(acts, k).collect()] for k in ("click", "order", "pay")}
    assert got == {"click": [(3, 1)], "order": [(5, 2)], "pay": [(7, 1)]}
    assert "Generate" not in plan_text(ranking.category_kind_count(acts, "click"))
    assert "click_category_ids" not in plan_text(ranking.category_kind_count(acts, "order"))
