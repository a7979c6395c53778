"""Visit-length and step-length buckets and the session statistics report.

The counters of the original (a named accumulator incremented inside a
filter) become conditional counts of one global aggregate: partial counts
per task, one merge, no side effects, no double counting on re-execution.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlab.functions.text import ratio_half_up_sql, sql_str


@dataclass(frozen=True)
class Bucket:
    label: str
    lo: int | None        # inclusive; None together with hi=None: never matched
    hi: int | None        # inclusive; None: open ended
    open_ended: bool = False

    def condition_sql(self, x: str) -> str | None:
        if self.open_ended:
            return f"{x} > {self.lo}"
        if self.lo is None:
            return None
        return f"{x} BETWEEN {self.lo} AND {self.hi}"


# Fixed bucket edges of the original analysis (first matching bucket wins,
# so 30 steps count as 10_30; visits of 0, 31-59 and 601-609 seconds fall in
# no bucket and 30s_60s is never counted).
STEP_BUCKETS = [
    Bucket("1_3", 1, 3), Bucket("4_6", 4, 6), Bucket("7_9", 7, 9),
    Bucket("10_30", 10, 30), Bucket("30_60", 30, 60), Bucket("60", 60, None, True),
]
VISIT_BUCKETS = [
    Bucket("1s_3s", 1, 3), Bucket("4s_6s", 4, 6), Bucket("7s_9s", 7, 9),
    Bucket("10s_30s", 10, 30), Bucket("30s_60s", None, None),
    Bucket("1m_3m", 60, 180), Bucket("3m_10m", 181, 600),
    Bucket("10m_30m", 610, 1800), Bucket("30m", 1800, None, True),
]
# Same labels without gaps for every visit length of at least one second.
VISIT_BUCKETS_CONTIGUOUS = [
    Bucket("1s_3s", 1, 3), Bucket("4s_6s", 4, 6), Bucket("7s_9s", 7, 9),
    Bucket("10s_30s", 10, 30), Bucket("30s_60s", 31, 59),
    Bucket("1m_3m", 60, 180), Bucket("3m_10m", 181, 600),
    Bucket("10m_30m", 601, 1800), Bucket("30m", 1800, None, True),
]


def bucket_label_sql(x: str, buckets: list[Bucket]) -> str:
    """Label of the first bucket containing x; null when none does."""
    whens = [f"WHEN {b.condition_sql(x)} THEN '{b.label}'" for b in buckets
             if b.condition_sql(x) is not None]
    return "CASE " + " ".join(whens) + " END"


def session_buckets(sessions: DataFrame, visit_buckets: list[Bucket] = VISIT_BUCKETS,
                    step_buckets: list[Bucket] = STEP_BUCKETS) -> DataFrame:
    """Per session: lengths and the label of the bucket each falls in."""
    return sessions.selectExpr(
        "session_id", "visit_length", "step_length",
        bucket_label_sql("visit_length", visit_buckets) + " AS visit_bucket",
        bucket_label_sql("step_length", step_buckets) + " AS step_bucket")


def length_stats(sessions: DataFrame, task_id: str,
                 visit_buckets: list[Bucket] = VISIT_BUCKETS,
                 step_buckets: list[Bucket] = STEP_BUCKETS) -> DataFrame:
    """One row: session count and the share of sessions per bucket, rounded
    half-up to two places. No sessions gives count 0 and ratios 0.0."""
    # Each session is counted in its first matching bucket only; the labels
    # are computed once per session and the counts compare them.
    labelled = sessions.selectExpr(
        bucket_label_sql("visit_length", visit_buckets) + " AS vb",
        bucket_label_sql("step_length", step_buckets) + " AS sb")
    counts = ["count(1) AS session_count"]
    counts += [f"count_if(vb = '{b.label}') AS v_{b.label}" for b in visit_buckets]
    counts += [f"count_if(sb = '{b.label}') AS s_{b.label}" for b in step_buckets]
    agg = labelled.agg(*[F.expr(c) for c in counts])
    cols = [f"{sql_str(task_id)} AS task_id", "session_count"]
    cols += [ratio_half_up_sql(f"v_{b.label}", "session_count")
             + f" AS visit_length_{b.label}_ratio" for b in visit_buckets]
    cols += [ratio_half_up_sql(f"s_{b.label}", "session_count")
             + f" AS step_length_{b.label}_ratio" for b in step_buckets]
    return agg.selectExpr(*cols)
