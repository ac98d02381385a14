"""Schedule times and dates, as column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hhmm_to_time(hhmm: Column | str) -> Column:
    """``HHMM`` text to ``HH:MM:00Z``. Hour 24 is read as one minute to midnight."""
    c = F.col(hhmm) if isinstance(hhmm, str) else hhmm
    hours = F.substring(c, F.lit(1), F.greatest(F.length(c) - 2, F.lit(0)))
    minutes = F.right(c, F.lit(2))
    return F.when(hours == "24", F.lit("23:59:00Z")).otherwise(
        F.concat(hours, F.lit(":"), minutes, F.lit(":00Z"))
    )


def schedule_ts(date: Column | str, hhmm: Column | str) -> Column:
    """Date text and ``HHMM`` to a timestamp without zone; NULL if unreadable."""
    d = F.col(date) if isinstance(date, str) else date
    text = F.concat(d.cast("string"), F.lit(" "), hhmm_to_time(hhmm))
    return text.try_cast("timestamp_ntz")


def fix_overnight(dep: Column | str, arr: Column | str) -> Column:
    """Arrival, one day later when it lies strictly before departure."""
    d = F.col(dep) if isinstance(dep, str) else dep
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.when(a < d, a + F.expr("INTERVAL 1 DAY")).otherwise(a)


def parse_iso_date(text: Column | str) -> Column:
    """The calendar date of ISO 8601 text, with or without a time part."""
    c = F.col(text) if isinstance(text, str) else text
    return c.try_cast("date")


def date_parts(date: Column | str) -> dict[str, Column]:
    """Date parts as requests carry them: weekdays count from Monday = 0.

    Training data counts Monday = 1; see ``align_dow`` where models are applied.
    """
    d = parse_iso_date(date)
    return {
        "DayOfYear": F.dayofyear(d),
        "DayOfMonth": F.dayofmonth(d),
        "DayOfWeek": F.weekday(d),
    }
