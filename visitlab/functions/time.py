"""Date and time column expressions.

Action times are ``yyyy-MM-dd H:mm:ss`` text whose hour may be a single
digit (``3:30:57``). Pattern ``H`` accepts one or two digits; ``HH`` would
reject the short form. ``try_to_timestamp`` turns unparseable text into null
instead of failing the job.

Helpers take a column name (or SQL expression text); ``*_sql`` variants
return the expression text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed text formats of the visit log and its keys.
ACTION_TIME_PARSE = "yyyy-MM-dd H:mm:ss"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATEKEY_FORMAT = "yyyyMMdd"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"


def parse_time_sql(text: str) -> str:
    return f"try_to_timestamp({text}, '{ACTION_TIME_PARSE}')"


def format_time_sql(ts: str) -> str:
    return f"date_format({ts}, '{TIME_FORMAT}')"


def format_date_sql(ts: str) -> str:
    return f"date_format({ts}, '{DATE_FORMAT}')"


def date_key_sql(ts: str) -> str:
    return f"date_format({ts}, '{DATEKEY_FORMAT}')"


def parse_date_key_sql(text: str) -> str:
    return f"to_date(try_to_timestamp({text}, '{DATEKEY_FORMAT}'))"


def minute_key_sql(ts: str) -> str:
    return f"date_format({ts}, '{MINUTE_KEY_FORMAT}')"


def date_hour_sql(text: str) -> str:
    """``date_hour`` key cut from the text, so the hour keeps its width."""
    return (f"concat_ws('_', try_element_at(split({text}, ' '), 1),"
            f" try_element_at(split(try_element_at(split({text}, ' '), 2), ':'), 1))")


def is_before_sql(t1: str, t2: str) -> str:
    return f"({t1} < {t2})"


def is_after_sql(t1: str, t2: str) -> str:
    return f"({t1} > {t2})"


def seconds_between_sql(t1: str, t2: str) -> str:
    """Whole seconds t1 - t2."""
    return f"(unix_timestamp({t1}) - unix_timestamp({t2}))"


def today_sql(as_of: str | None = None) -> str:
    return f"DATE'{as_of}'" if as_of else "current_date()"


def yesterday_sql(as_of: str | None = None) -> str:
    return f"date_sub({today_sql(as_of)}, 1)"



def format_time(ts: str) -> Column:
    return F.expr(format_time_sql(ts))



def date_key(ts: str) -> Column:
    return F.expr(date_key_sql(ts))



def minute_key(ts: str) -> Column:
    return F.expr(minute_key_sql(ts))


def date_hour(text: str) -> Column:
    return F.expr(date_hour_sql(text))


def is_before(t1: str, t2: str) -> Column:
    return F.expr(is_before_sql(t1, t2))



def seconds_between(t1: str, t2: str) -> Column:
    return F.expr(seconds_between_sql(t1, t2))



def yesterday(as_of: str | None = None) -> Column:
    return F.expr(yesterday_sql(as_of))
