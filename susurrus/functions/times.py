"""Media times: offsets in seconds, never timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import none_if_empty, stripped


def seconds_of(token: Column) -> Column:
    """Whole seconds of `H:M:S` or `M:S`; null for anything else."""
    parts = F.split(stripped(token), ":")
    n = lambda k: F.get(parts, k).try_cast("int")
    return F.when(F.size(parts) == 3, n(0) * 3600 + n(1) * 60 + n(2)).when(F.size(parts) == 2, n(0) * 60 + n(1))


LINE = r"^\s*(\d{1,3}(?::\d{1,2}){1,2})(?!\d)\s*[-–—|:]?\s*(.*)$"


def timeline_line(line: Column) -> tuple[Column, Column]:
    """(time mark, title) of a line that begins with a time mark; nulls for other lines."""
    mark = none_if_empty(F.regexp_extract(line, LINE, 1))
    return mark, F.when(mark.isNotNull(), stripped(F.regexp_extract(line, LINE, 2)))


def format_seconds(x: Column) -> Column:
    """Whole seconds without a point, else up to nine places without trailing zeros."""
    x = x.cast("double")
    return F.when(x == F.floor(x), F.floor(x).cast("string")).otherwise(F.regexp_replace(F.format_string("%.9f", x), r"\.?0+$", ""))


def hms(x: Column) -> Column:
    """`H:MM:SS.mmm` with sign."""
    ms = F.round(F.abs(x.cast("double")) * 1000).cast("bigint")
    s = F.floor(ms / 1000).cast("bigint")
    t = F.format_string("%d:%02d:%02d.%03d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60, ms % 1000)
    return F.when(x < 0, F.concat(F.lit("-"), t)).otherwise(t)


def capture_point(lo: Column, hi: Column, offset: Column) -> Column:
    """A point `offset` behind the start of a window, drawn to its middle where it would leave the window; margins of
    5 % of the span, 0.001 to 0.05 s. A window without length counts as 0.05 s long."""
    end = F.when(hi > lo, hi).otherwise(lo + 0.05)
    span = end - lo
    margin = F.greatest(F.lit(1e-3), F.least(F.lit(0.05), span * 0.05))
    near = F.when(offset < span - margin, offset).otherwise(F.greatest(margin, F.least(offset, span / 2)))
    inside = F.when(near < span - margin, near).otherwise(span / 2)
    return lo + F.least(F.greatest(inside, margin), span - margin)


def clean_window(start: Column, end: Column) -> Column:
    """struct(start, end) of a window of two numbers with end > start, else null."""
    a, b = start.try_cast("double"), end.try_cast("double")
    return F.when(b > a, F.struct(a.alias("start"), b.alias("end")))


def hms_columns(start: Column, end: Column, origin: Column | None = None) -> list[Column]:
    """start_hms, end_hms, duration_hms, and with an `origin` start_rel, start_rel_hms, end_rel, end_rel_hms; null for null."""
    out = [hms(start).alias("start_hms"), hms(end).alias("end_hms"), hms(end - start).alias("duration_hms")]
    for name, x in (("start", start), ("end", end)) if origin is not None else ():
        out += [(x - origin).alias(f"{name}_rel"), hms(x - origin).alias(f"{name}_rel_hms")]
    return out
