"""Page-flow one-step conversion rate.

For a target flow p1, p2, ..., pn and the actions of each session ordered by
(action time, event id):

* c(i)    = number of consecutive action pairs (p_i, p_i+1) inside a session
* rate(1) = c(1) / visits of p1, rate(i) = c(i) / c(i-1); null when the
  denominator is 0; rounded half-up to two places.

Finding each action's successor needs the session's actions in order. A
plain ``lead`` over ``partitionBy(session_id)`` would put a very large
session into one task, so a session is cut into pieces by a fixed time step
of the action time: pieces are a function of the row alone, so every branch of
the plan sees the same ones. ``lead`` runs inside each (session, piece); the
successor of a piece's last action is the first action of the session's next
piece, found from a summary with one row per (session, piece). The plan is the
same at every size. Rows without a session id belong to no session and are left
out; actions without a time come first in their session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlab.functions.text import ratio_half_up_sql


#: Seconds of action time in one piece of a session.
STEP = 600


def page_pairs(actions: DataFrame, step: int = STEP) -> DataFrame:
    """(page_id, next_page, is_action): one row per action (``next_page`` null
    for a session's last action, or a piece's last action) plus one row per
    piece boundary inside a session (``is_action`` false)."""
    ranged = actions.where("session_id IS NOT NULL").selectExpr(
        "session_id", "event_id", "page_id", "action_ts AS ts",
        f"coalesce(floor(unix_seconds(action_ts) / {int(step)}), -9223372036854775807L) AS piece")
    in_piece = Window.partitionBy("session_id", "piece").orderBy("ts", "event_id")
    walked = ranged.select(
        "session_id", "piece", "page_id",
        F.lead("page_id").over(in_piece).alias("next_page"),
        # lag/lead of a constant is null exactly at the first/last row
        F.lag(F.lit(1)).over(in_piece).isNull().alias("is_first"),
        F.lead(F.lit(1)).over(in_piece).isNull().alias("is_last"))
    inner = walked.selectExpr("page_id", "next_page", "true AS is_action")
    # first and last page of every (session, piece); the frame is already
    # partitioned by (session, piece), so this aggregate adds no shuffle
    ends = (walked.where("is_first OR is_last").groupBy("session_id", "piece")
            .agg(F.expr("max(CASE WHEN is_first THEN page_id END) AS first_page"),
                 F.expr("max(CASE WHEN is_last THEN page_id END) AS last_page")))
    across = Window.partitionBy("session_id").orderBy("piece")
    boundary = (ends.withColumn("next_first", F.lead("first_page").over(across))
                .withColumn("has_next", F.lead("piece").over(across).isNotNull())
                .where("has_next")
                .selectExpr("last_page AS page_id", "next_first AS next_page",
                            "false AS is_action"))
    return inner.unionByName(boundary)


def convert_rate(pairs: DataFrame, flow: list[int] | tuple[int, ...]) -> DataFrame:
    """(step, page_pair, pair_count, convert_rate) for each adjacent pair of
    the flow, from the output of :func:`page_pairs`."""
    flow = [int(p) for p in flow]
    if len(flow) < 2:
        raise ValueError("a page flow needs at least two pages")
    aggs = [F.expr(f"count_if(is_action AND page_id = {flow[0]}) AS visits")]
    for i in range(len(flow) - 1):
        aggs.append(F.expr(f"count_if(page_id = {flow[i]} AND next_page = {flow[i + 1]}) AS c{i}"))
    counts = pairs.agg(*aggs)
    rows = []
    for i in range(len(flow) - 1):
        den = "visits" if i == 0 else f"c{i - 1}"
        rate = f"CASE WHEN {den} = 0 THEN NULL ELSE {ratio_half_up_sql(f'c{i}', den)} END"
        rows.append(f"{i + 1}, '{flow[i]}_{flow[i + 1]}', c{i}, {rate}")
    stack = f"stack({len(rows)}, {', '.join(rows)}) AS (step, page_pair, pair_count, convert_rate)"
    return counts.selectExpr(stack)


def page_convert_rate(actions: DataFrame, flow, step: int = STEP) -> DataFrame:
    """Conversion rates of the flow's steps."""
    return convert_rate(page_pairs(actions, step), flow)
