"""Reject counts of the visit log: what text could not be read.

Bad text never fails a job: an unreadable time or id becomes null and its value
is left out. These counts say how much was left out, by date, so that a log that
suddenly holds bad text is seen. :func:`rejects` is a report of its own;
:func:`observed` counts the same in the pass of another job over the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def _bad_ids_sql(ids: str) -> str:
    """Pieces of a comma list that are neither empty nor whole numbers."""
    return (f"size(filter(split(coalesce({ids}, ''), ','),"
            " p -> trim(p) <> '' AND try_cast(trim(p) AS BIGINT) IS NULL))")


# name -> value per action that is summed
COUNTS = {
    "actions": "1",
    "without_session": "CAST(session_id IS NULL AS INT)",
    "without_user": "CAST(user_id IS NULL OR user_id = -1 AS INT)",
    "without_time": "CAST(coalesce(action_time, '') = '' AS INT)",
    # the typed time of the scan is null although there is text
    "bad_time": "CAST(coalesce(action_time, '') <> '' AND action_ts IS NULL AS INT)",
    "bad_order_ids": _bad_ids_sql("order_category_ids"),
    "bad_pay_ids": _bad_ids_sql("pay_category_ids"),
    "actions_with_bad_ids": f"CAST({_bad_ids_sql('order_category_ids')} + "
                            f"{_bad_ids_sql('pay_category_ids')} > 0 AS INT)",
}


def _sums() -> list:
    return [F.expr(f"coalesce(sum(CAST({value} AS BIGINT)), 0L) AS {name}")
            for name, value in COUNTS.items()]


def rejects(actions: DataFrame) -> DataFrame:
    """One row per date with the counts of :data:`COUNTS`: actions, those without
    session, user or time, times that cannot be read, and unreadable ids by
    column. One pass with partial sums."""
    return actions.groupBy("date").agg(*_sums())


def total(by_date: DataFrame) -> DataFrame:
    """The counts over all dates, zeros for an empty log."""
    return by_date.agg(*[F.expr(f"coalesce(sum({name}), 0L) AS {name}") for name in COUNTS])


def observed(actions: DataFrame, name: str = "visit_log_rejects") -> tuple[DataFrame, Observation]:
    """The same actions, and an observation whose ``get`` gives the counts once a
    job over them has run: no pass of their own. A stage that Spark runs again
    after a lost executor may be counted twice; :func:`rejects` is exact."""
    seen = Observation(name)
    return actions.observe(seen, *_sums()), seen
