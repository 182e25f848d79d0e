"""Time of day kept as integer milliseconds since midnight, shown as ``HH:mm:ss``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def millis_to_hms_sql(c: str) -> str:
    """SQL text for milliseconds since midnight as ``HH:mm:ss``, with no time-zone involved."""
    two = "lpad(CAST(FLOOR({}) AS STRING), 2, '0')".format
    return f"concat_ws(':', {two(f'{c} / 3600000')}, {two(f'({c} % 3600000) / 60000')}, {two(f'({c} % 60000) / 1000')})"


def hms_to_millis_sql(c: str) -> str:
    """SQL text for ``HH:mm:ss`` back to milliseconds since midnight, NULL for any other text."""
    part = lambda i: f"TRY_CAST(substring({c}, {i}, 2) AS BIGINT)"
    return f"({part(1)} * 3600000 + {part(4)} * 60000 + {part(7)} * 1000)"


def millis_to_hms(c: str) -> Column:
    return F.expr(millis_to_hms_sql(c))


def hms_to_seconds(c: str | Column) -> Column:
    """``HH:mm:ss`` text back to seconds since midnight."""
    t = F.col(c) if isinstance(c, str) else c
    part = lambda i: F.substring(t, i, 2).cast("int")
    return part(1) * 3600 + part(4) * 60 + part(7)


def unix_millis_text(c: str | Column, form: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Milliseconds since 1970 as text in the session's time zone, cut to the second (also before 1970)."""
    millis = F.col(c) if isinstance(c, str) else c
    return F.from_unixtime(F.floor(millis / 1000), form)
