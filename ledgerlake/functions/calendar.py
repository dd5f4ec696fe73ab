"""Calendar functions F1-F4 and F6 as column expressions (all JVM-side, codegen'd)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, (dt.date, dt.datetime)):
        return F.lit(x)
    return F.col(x)


def month_start(d) -> Column:
    """``date_trunc('month', d)`` as a date."""
    return F.trunc(_c(d), "MM")


def month_end(d) -> Column:
    """month start + 1 month - 1 day."""
    return F.last_day(_c(d))


def prev_month_end(d) -> Column:
    """month start - 1 day (the balance date the report opens with)."""
    return F.date_sub(F.trunc(_c(d), "MM"), 1)


def next_day(d) -> Column:
    """``d + 1``."""
    return F.date_add(_c(d), 1)


def iso_date(d) -> Column:
    """``to_char(d, 'yyyy-mm-dd')``."""
    return F.date_format(_c(d), "yyyy-MM-dd")


def ntz(ts: dt.datetime) -> Column:
    """A wall-clock timestamp literal (TIMESTAMP_NTZ): compares with NTZ columns whatever the session zone."""
    return F.expr(f"TIMESTAMP_NTZ '{ts.isoformat(sep=' ')}'")


def py_month_bounds(d: dt.date) -> tuple[dt.date, dt.date]:
    """Month bounds computed once on the driver: they fold to literals in the plan."""
    start = d.replace(day=1)
    end = (start.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
    return start, end


def py_prev_month_end(d: dt.date) -> dt.date:
    return d.replace(day=1) - dt.timedelta(days=1)
