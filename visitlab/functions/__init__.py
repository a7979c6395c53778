"""Column expressions. All are built-in Spark functions, so they run inside
whole-stage codegen; no Python UDF is involved."""

from visitlab.functions import packed, text, time

__all__ = ["packed", "text", "time"]
