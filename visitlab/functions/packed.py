"""``k=v|k=v`` packed-record expressions.

The original application moved session records around as one text field.
Here the typed columns are the primary form; these expressions build, read
and rewrite the text form for consumers that still expect it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed field names and order of the packed session record.
F_SESSION_ID = "sessionid"
F_SEARCH_KEYWORDS = "searchKeywords"
F_CLICK_CATEGORY_IDS = "clickCategoryIds"
F_VISIT_LENGTH = "visitLength"
F_STEP_LENGTH = "stepLength"
F_START_TIME = "startTime"
F_AGE = "age"
F_PROFESSIONAL = "professional"
F_SEX = "sex"
F_CITY = "city"

# packed field name -> session_profile column, in record order
PROFILE_FIELDS = [
    (F_SESSION_ID, "session_id"),
    (F_SEARCH_KEYWORDS, "search_keywords"),
    (F_CLICK_CATEGORY_IDS, "click_category_ids"),
    (F_VISIT_LENGTH, "visit_length"),
    (F_STEP_LENGTH, "step_length"),
    (F_START_TIME, "start_time"),
    (F_AGE, "age"),
    (F_PROFESSIONAL, "professional"),
    (F_SEX, "sex"),
    (F_CITY, "city"),
]

DELIMITER = "|"


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def pack_sql(pairs: list[tuple[str, str]], delimiter: str = DELIMITER) -> str:
    """``k=v`` text from (field name, SQL expression) pairs; a null value is
    written as an empty value."""
    items = [f"concat({_lit(k + '=')}, coalesce(CAST({v} AS STRING), ''))" for k, v in pairs]
    return f"concat_ws({_lit(delimiter)}, {', '.join(items)})"


def packed_field_sql(text: str, key: str, delimiter: str = DELIMITER) -> str:
    """Value of ``key`` in packed text: the first piece that is exactly
    ``key=value`` with a non-empty value and no further ``=``; null when
    there is none (so an empty value reads as null). One anchored pattern,
    no lambda, so it stays in generated code. The delimiter is one character."""
    if len(delimiter) != 1:
        raise ValueError(f"delimiter must be one character: {delimiter!r}")
    d = re.escape(delimiter)
    pattern = f"(?:^|{d})" + re.escape(key) + f"=([^{d}=]+)(?={d}|$)"
    return f"nullif(regexp_extract({text}, {_lit(pattern)}, 1), '')"


def packed_entries_sql(text: str, delimiter: str = DELIMITER) -> str:
    """All readable pieces of packed text as one array ``[k1, v1|, k2, v2|, ...]``,
    by the rules of :func:`packed_field_sql`: one scan finds the pieces that are
    exactly ``key=value`` with neither part empty, one split takes them apart.
    Values keep the delimiter behind them and keys never hold it, so a key is
    found by equality even where some value reads like it."""
    if len(delimiter) != 1:
        raise ValueError(f"delimiter must be one character: {delimiter!r}")
    d = re.escape(delimiter)
    pieces = f"regexp_extract_all({text}, {_lit(f'(?<![^{d}])([^{d}=]+=[^{d}=]+)(?![^{d}])')}, 1)"
    return f"split(concat(array_join({pieces}, {_lit(delimiter + '=')}), {_lit(delimiter)}), '=')"


def entry_value_sql(entries: str, key: str) -> str:
    """Value of the first piece with ``key`` in :func:`packed_entries_sql`."""
    found = f"try_element_at({entries}, CAST(nullif(array_position({entries}, {_lit(key)}), 0) AS INT) + 1)"
    return f"substring({found}, 1, length({found}) - 1)"


def set_packed_field_sql(text: str, key: str, value: str, delimiter: str = DELIMITER) -> str:
    """Replace the value of every part whose key is ``key``; order and the
    other parts (empty values included) are kept; an absent key is not added."""
    v = f"coalesce(CAST({value} AS STRING), '')"
    return (f"array_join(transform(split({text}, {_lit(re.escape(delimiter))}),"
            f" p -> CASE WHEN try_element_at(split(p, '=', 2), 1) = {_lit(key)}"
            f" THEN concat({_lit(key + '=')}, {v}) ELSE p END), {_lit(delimiter)})")


def pack(pairs: list[tuple[str, str]], delimiter: str = DELIMITER) -> Column:
    return F.expr(pack_sql(pairs, delimiter))


def packed_field(text: str, key: str, delimiter: str = DELIMITER) -> Column:
    return F.expr(packed_field_sql(text, key, delimiter))


def set_packed_field(text: str, key: str, value: str, delimiter: str = DELIMITER) -> Column:
    return F.expr(set_packed_field_sql(text, key, value, delimiter))
