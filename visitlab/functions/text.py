"""String and number column expressions used by the analyses.

Every helper takes a column name (or any SQL expression text) and returns a
``Column`` built from one SQL expression, so building a query costs one
parse per expression rather than one JVM call per operator node. The
``*_sql`` variants return the text for use in ``selectExpr`` / ``agg``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_str(value: str) -> str:
    """Quote a Python string as a Spark SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def is_empty_sql(x: str) -> str:
    return f"({x} IS NULL OR {x} = '')"


def is_not_empty_sql(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> '')"


def trim_comma_sql(x: str) -> str:
    """Strip one comma at the start and one at the end."""
    return f"regexp_replace({x}, '^,|,$', '')"


def fill_two_digits_sql(x: str) -> str:
    """Text of length 2 is kept; anything else gets one leading ``0``."""
    return f"CASE WHEN length({x}) = 2 THEN {x} ELSE concat('0', {x}) END"


def split_ids_sql(x: str) -> str:
    """Comma list text -> array<bigint>; empty or non-numeric parts are
    dropped, a repeated id stays repeated."""
    return (f"filter(transform(split({x}, ','), p -> try_cast(trim(p) AS BIGINT)),"
            f" v -> v IS NOT NULL)")


def ratio_half_up_sql(count: str, total: str, scale: int = 2) -> str:
    """count / total rounded half-up to ``scale`` places.

    Exact integer arithmetic, ``(2*m*c + n) div (2*n) / m`` with
    ``m = 10**scale``, so it does not depend on how a double quotient happens
    to round. A zero total gives 0.0.
    """
    m = 10 ** scale
    n = f"greatest(CAST({total} AS BIGINT), 1L)"
    return f"CAST((CAST({count} AS BIGINT) * {2 * m} + {n}) div ({n} * 2) AS DOUBLE) / {m}"


def is_empty(x: str) -> Column:
    return F.expr(is_empty_sql(x))


def is_not_empty(x: str) -> Column:
    return F.expr(is_not_empty_sql(x))


def trim_comma(x: str) -> Column:
    return F.expr(trim_comma_sql(x))


def fill_two_digits(x: str) -> Column:
    return F.expr(fill_two_digits_sql(x))


def split_ids(x: str) -> Column:
    return F.expr(split_ids_sql(x))



def ratio_half_up(count: str, total: str, scale: int = 2) -> Column:
    return F.expr(ratio_half_up_sql(count, total, scale))
