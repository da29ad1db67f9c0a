"""Calendar rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _as_col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def iso_date(value) -> Column:
    """Date from text of which only the first ten characters count; bad text is NULL."""
    return F.substring(_as_col(value).cast("string"), 1, 10).try_cast("date")


def quarter_end(value) -> Column:
    """Last day of the calendar quarter that holds the date."""
    start = F.trunc(_as_col(value).cast("date"), "quarter")
    return F.date_sub(F.add_months(start, 3), 1)


def quarter_end_on_or_before(value) -> Column:
    day = _as_col(value).cast("date")
    end = quarter_end(day)
    return F.when(end == day, day).otherwise(F.date_sub(F.trunc(day, "quarter"), 1))


def filed_quarter_end(as_of, lag_days: int = 45) -> Column:
    """Latest quarter end whose reports are due (``lag_days`` later) by ``as_of``."""
    return quarter_end_on_or_before(F.date_sub(_as_col(as_of).cast("date"), lag_days))


def lookback_start(as_of, years: int) -> Column:
    """``as_of`` minus whole years (Feb 29 becomes Feb 28); zero years means no cut."""
    if years <= 0:
        return F.lit("2000-01-01").cast("date")
    return F.add_months(_as_col(as_of).cast("date"), -12 * years)


def in_window(period_end, filing_date, start) -> Column:
    start = _as_col(start)
    return F.coalesce(_as_col(period_end) >= start, F.lit(False)) | F.coalesce(
        _as_col(filing_date) >= start, F.lit(False))


def month_day_year(value) -> Column:
    """``June 30, 2026`` to a date; anything else is NULL."""
    return F.try_to_timestamp(F.trim(_as_col(value)), F.lit("MMMM d, yyyy")).cast("date")
