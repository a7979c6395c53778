"""Keeping the rows whose id is in a (possibly large) id table, moving few texts.

A bit table of fixed size (one bit per hash value, so wrong only by letting
rows through) is broadcast to the scan; the rows that pass are then joined
exactly. At any data size the broadcast has at most ``BITS / 64`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name

BITS = 1 << 24


def _bits(rows: DataFrame, ids: DataFrame, id_col: str):
    """The bit table of ``ids``, and the condition under which a row of ``rows`` is
    marked; the table's column names are none of ``rows``."""
    word, bits = free_name(rows, "__word"), free_name(rows, "__bits")
    place = F.pmod(F.xxhash64(F.lit(77), F.col(id_col)), F.lit(BITS))
    words = (ids.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias(word))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias(bits)))
    bit = F.expr(f"shiftright({bits}, cast(pmod(xxhash64(77, `{id_col}`), {BITS}) & 63 as int)) & 1 = 1")
    # at most BITS / 64 rows of two numbers
    return F.broadcast(words), (F.shiftright(place, 6) == F.col(word)) & bit


def with_ids(rows: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows whose id is in ``ids`` (a table with that one column)."""
    words, marked = _bits(rows, ids, id_col)
    return rows.join(words, marked, "left_semi").join(ids, id_col, "left_semi").select(rows.columns)


def without_ids(rows: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows whose id is null or not in ``ids``."""
    words, marked = _bits(rows, ids, id_col)
    doubtful = rows.join(words, marked, "left_semi").join(ids, id_col, "left_anti").select(rows.columns)
    return rows.join(words, marked, "left_anti").unionByName(doubtful)
