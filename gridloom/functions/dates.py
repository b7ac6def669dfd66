"""Time-axis column expressions (DT-1 .. DT-8).

All functions return Columns, so they stay inside whole-stage codegen.
Timestamps are TIMESTAMP_NTZ throughout (the archive's axis is UTC wall time).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def ntz(x) -> Column:
    return _c(x).cast("timestamp_ntz")


def trunc_ntz(unit: str, x) -> Column:
    """``date_trunc`` that keeps TIMESTAMP_NTZ (Spark returns TIMESTAMP)."""
    return F.date_trunc(unit, _c(x)).cast("timestamp_ntz")


def first_month_start(start) -> Column:
    """First month start on or after ``start`` (pandas ``MS`` frequency)."""
    d = _c(start).cast("date")
    return F.when(F.dayofmonth(d) == 1, d).otherwise(F.add_months(F.trunc(d, "MM"), 1))


def date_axis(start, end, freq: str = "D") -> Column:
    """Inclusive calendar axis as an array of DATE: daily or month starts.

    Empty (not an error) when the range holds no element, like pandas.
    """
    s, e = _c(start).cast("date"), _c(end).cast("date")
    if freq == "D":
        return F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 DAY"))) \
            .otherwise(F.array().cast("array<date>"))
    if freq == "MS":
        m = first_month_start(s)
        return F.when(m <= e, F.sequence(m, e, F.expr("INTERVAL 1 MONTH"))) \
            .otherwise(F.array().cast("array<date>"))
    raise ValueError(f"unsupported frequency {freq!r}")


def hour_axis(start, end) -> Column:
    """Every hour from ``start`` 00:00 through the *whole* end day (23:00)."""
    s = _c(start).cast("date").cast("timestamp_ntz")
    e = _c(end).cast("date").cast("timestamp_ntz") + F.expr("INTERVAL 23 HOURS")
    return F.sequence(s, e, F.expr("INTERVAL 1 HOUR"))


def time_offset_hours(init, t) -> Column:
    """Index along an hourly axis that starts at ``init`` (leap-safe)."""
    return F.timestamp_diff("HOUR", ntz(init), ntz(t))


def day_offset_hours(init, day, steps_per_day: int = 24) -> Column:
    """Offset of the first step of ``day``: whole days times steps per day."""
    return F.datediff(_c(day).cast("date"), _c(init).cast("date")) * F.lit(steps_per_day)


def offset_to_time(init, offset, hours_per_step: int = 1) -> Column:
    """Inverse of :func:`time_offset_hours`."""
    return F.timestamp_add("HOUR", _c(offset) * F.lit(hours_per_step), ntz(init))


def valid_time(base, step) -> Column:
    """Forecast valid time: base time plus ``step`` hours."""
    return F.timestamp_add("HOUR", _c(step), ntz(base))


def month_range_before(d) -> tuple[Column, Column]:
    """(first, last) day of the month before the month of ``d``."""
    last = F.date_sub(F.trunc(_c(d).cast("date"), "MM"), 1)
    return F.trunc(last, "MM"), last


def processing_window(today, mode) -> Column:
    """Date window a scheduled refresh processes, as a struct.

    daily   -> the single day ``today - 6``
    monthly -> the previous calendar month
    final   -> the calendar month before ``today - 61 days``
    """
    t = _c(today).cast("date")
    m = _c(mode)
    d6 = F.date_sub(t, 6)
    prev_first, prev_last = month_range_before(t)
    # two months of 366/12 days back (61 days), then the month before that
    fin_first, fin_last = month_range_before(F.date_sub(t, 61))
    first = F.when(m == fixed.MODE_DAILY, d6).when(m == fixed.MODE_MONTHLY, prev_first) \
        .otherwise(fin_first)
    last = F.when(m == fixed.MODE_DAILY, d6).when(m == fixed.MODE_MONTHLY, prev_last) \
        .otherwise(fin_last)
    return F.struct(first.alias("first_day"), last.alias("last_day"),
                    F.date_format(first, "yyyy").alias("sl_year"),
                    F.date_format(first, "MM").alias("sl_month"))


def parse_date(s, fmt: str = "yyyy-MM-dd", strict: bool = False) -> Column:
    """Text to DATE.  ``strict`` raises on bad text, else NULL."""
    if strict:
        return F.to_date(_c(s), fmt)
    return F.try_to_date(_c(s), fmt)
