"""Calendar helpers: Monday weeks, month/quarter starts, hour differences, epoch ms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_date(col) -> Column:
    return F.to_date(_c(col))


def week_start(col) -> Column:
    """Monday of the week (weeks start on Monday)."""
    return F.trunc(F.to_date(_c(col)), "week")


def month_start(col) -> Column:
    return F.trunc(F.to_date(_c(col)), "month")


def quarter_start(col) -> Column:
    return F.trunc(F.to_date(_c(col)), "quarter")


def weekday_mon1(col) -> Column:
    """Day of week with Monday = 1 ... Sunday = 7."""
    return F.weekday(F.to_date(_c(col))) + F.lit(1)


def calendar_columns(prefix: str, col) -> dict[str, Column]:
    """The four calendar columns the marts carry for a date."""
    return {
        f"{prefix}_wday": weekday_mon1(col),
        f"{prefix}_week": week_start(col),
        f"{prefix}_month": month_start(col),
        f"{prefix}_quarter": quarter_start(col),
    }


def _seconds_between(end, start) -> Column:
    """``end - start`` in seconds; zone-less values stay zone-less (no daylight-saving gaps)."""
    d = _c(end) - _c(start)
    part = {u: F.extract(F.lit(u), d).cast("double") for u in ("DAY", "HOUR", "MINUTE", "SECOND")}
    return ((part["DAY"] * 24 + part["HOUR"]) * 60 + part["MINUTE"]) * 60 + part["SECOND"]


def hours_between(end, start, digits: int = 1) -> Column:
    """(end - start) in hours, rounded half-to-even to ``digits``."""
    return F.bround(_seconds_between(end, start) / F.lit(3600.0), digits)


def days_between(end, start, digits: int = 1) -> Column:
    return F.bround(_seconds_between(end, start) / F.lit(86400.0), digits)


def epoch_ms_to_timestamp(col) -> Column:
    """Epoch milliseconds -> zone-less timestamp, integer division by 1000 (sub-second part dropped)."""
    seconds = F.call_function("div", _c(col).cast("long"), F.lit(1000).cast("long"))
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def minute_trunc(col) -> Column:
    """``date_trunc('minute', ts)`` on a zone-less timestamp, without a detour through a time zone."""
    c = _c(col)
    return c - F.make_dt_interval(secs=F.extract(F.lit("SECOND"), c).cast("decimal(18,6)"))
