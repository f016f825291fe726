"""Date column expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..spec import AGE_YEAR_MS, DAYS_PER_YEAR
from .text import ColumnOrName, _c


def parse_date(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to date with a pattern; bad dates (31 February, empty) are null."""
    return F.try_to_date(_c(c), fmt)


def parse_day_prefix(c: ColumnOrName, fmt: str = "yyyy-M-d") -> Column:
    """Date from the first 10 characters of an ISO timestamp text (X1 + X12)."""
    return F.try_to_date(F.substring(_c(c), 1, 10), fmt)


def format_date(c: ColumnOrName, fmt: str = "dd/MM/yyyy") -> Column:
    """Date to text."""
    return F.date_format(_c(c), fmt)


def day_literal(day: str | _dt.date) -> Column:
    return F.to_date(F.lit(str(day)))


def elapsed_years(c: ColumnOrName, as_of: str | _dt.date) -> Column:
    """Whole days from ``c`` to ``as_of`` divided by 365.25.

    ``as_of`` is a parameter, never the clock, so reruns agree (Q24).
    """
    return F.datediff(day_literal(as_of), _c(c)) / F.lit(DAYS_PER_YEAR)


def date_part_columns(c: str, as_of: str | _dt.date) -> dict[str, Column]:
    """Year, month, day and elapsed years of one date column."""
    d = F.col(c)
    return {
        f"ano_{c}": F.year(d),
        f"mes_{c}": F.month(d),
        f"dia_{c}": F.dayofmonth(d),
        f"delta_{c}": elapsed_years(d, as_of),
    }


def age_years(as_of: ColumnOrName, birth: ColumnOrName) -> Column:
    """Whole "years" of 31,540,000,000 ms between birth and ``as_of``; no birth gives 0."""
    a = _c(as_of).cast("timestamp")
    b = F.coalesce(_c(birth).cast("timestamp"), a)
    return F.floor((F.unix_millis(a) - F.unix_millis(b)) / F.lit(AGE_YEAR_MS))


def fallback_day(primary: ColumnOrName, fallback: ColumnOrName) -> Column:
    """Paid date, else due date, cut to the day as text."""
    return F.substring(F.coalesce(_c(primary), _c(fallback)), 1, 10)


def at_or_before(ts: ColumnOrName, day: str | _dt.date, inclusive_day: bool = False) -> Column:
    """As-of cutoff on a timestamp.

    The file rule compares the timestamp with midnight of ``day``, so activity
    later on that day is left out (Q5).  ``inclusive_day=True`` keeps the
    whole day.
    """
    t = _c(ts)
    if inclusive_day:
        return t < F.date_add(day_literal(day), 1)
    return t <= day_literal(day)


def on_or_after(c: ColumnOrName, day: str | _dt.date) -> Column:
    """Lower bound (F7).  Dates compare as dates, ISO texts as texts."""
    return _c(c) >= F.lit(str(day))
