"""Calendar helpers. Every job takes one explicit ``as_of`` date and derives its
windows from it on the driver, so that filters are plain ranges on the raw column
and reach the Parquet scan or the partition pruning."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = ("day", "month", "year")


def add_months(day: dt.date, months: int) -> dt.date:
    """Same day of month ``months`` away, clipped to the month's last day."""
    y, m = divmod(day.year * 12 + day.month - 1 + months, 12)
    return dt.date(y, m + 1, min(day.day, calendar.monthrange(y, m + 1)[1]))


def month_start(day: dt.date, months: int = 0) -> dt.date:
    return add_months(day.replace(day=1), months)


def previous_day(day: dt.date) -> dt.date:
    return day - dt.timedelta(days=1)


def unit_range(day: dt.date, unit: str) -> tuple[dt.date, dt.date]:
    """Half-open [start, end) of the day, month or year that holds ``day``."""
    if unit == "day":
        return day, day + dt.timedelta(days=1)
    if unit == "month":
        return month_start(day), month_start(day, 1)
    if unit == "year":
        return dt.date(day.year, 1, 1), dt.date(day.year + 1, 1, 1)
    raise ValueError(f"unit must be one of {UNITS}, got {unit!r}")


def in_range(ts: Column | str, bounds: tuple[dt.date, dt.date]) -> Column:
    c = _col(ts)
    return (c >= F.lit(bounds[0])) & (c < F.lit(bounds[1]))


def in_unit(ts: Column | str, day: dt.date, unit: str) -> Column:
    """Event in the same day, month or year as ``day``."""
    return in_range(ts, unit_range(day, unit))


def in_previous_month(ts: Column | str, as_of: dt.date) -> Column:
    return in_range(ts, unit_range(add_months(as_of, -1), "month"))


def months_window(ts: Column | str, as_of: dt.date, first: int, last: int | None = None) -> Column:
    """Relative month window: from month offset ``first`` up to, not including, ``last``."""
    c = _col(ts)
    cond = c >= F.lit(month_start(as_of, first))
    return cond if last is None else cond & (c < F.lit(month_start(as_of, last)))


def same_year_month(y: Column | str, m: Column | str, day: dt.date) -> Column:
    """Year and month kept in two number columns."""
    return (_col(y) == day.year) & (_col(m) == day.month)


def month_of(ts: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(_col(ts).cast("date"), "MM")


def calendar_parts(ts: Column | str, prefix: str, upto: str = "minute") -> dict[str, Column]:
    """``{prefix}_year`` … ``{prefix}_minute`` columns of a timestamp."""
    c = _col(ts)
    parts = {"year": F.year, "month": F.month, "day": F.day, "hour": F.hour, "minute": F.minute}
    names = list(parts)[: list(parts).index(upto) + 1]
    return {f"{prefix}_{n}": parts[n](c) for n in names}


def grace_month(pay_day: Column | str, as_of: dt.date) -> Column:
    """First day of the month whose payment is judged on ``as_of``.

    Payment falls due ``pay_day + 4`` days after the first of the month. Once the day
    number of ``as_of`` is past the due day's, in the same month, last month is judged;
    otherwise the month before it. A due day that falls into the next month therefore
    always judges two months back.
    """
    due = F.date_add(F.lit(month_start(as_of)), _col(pay_day).cast("int") + 4)
    passed = (F.lit(as_of.day) > F.day(due)) & (F.month(due) == as_of.month)
    return F.when(passed, F.lit(month_start(as_of, -1))).otherwise(F.lit(month_start(as_of, -2)))


def epoch_millis(text: Column | str) -> Column:
    """Milliseconds of a ``yyyy-MM-dd HH:mm:ss`` text; 0 if it does not parse."""
    parsed = F.try_to_timestamp(_col(text), F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.coalesce(F.unix_millis(parsed), F.lit(0).cast("long"))


def compact_timestamp(text: Column | str) -> Column:
    """Timestamp text to ``yyyyMMddHHmmss``; a text that does not parse counts as the epoch."""
    return F.date_format(F.timestamp_millis(epoch_millis(text)), "yyyyMMddHHmmss")


def day_of_compact(minute: Column | str) -> Column:
    return F.substring(_col(minute), 1, 8)


def hour_of_compact(minute: Column | str) -> Column:
    return F.substring(_col(minute), 9, 2)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
