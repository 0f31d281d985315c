"""Dates and talk time. ``as_of`` is a date or timestamp given by the caller."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

Moment = dt.date | dt.datetime | str

BLOCK_SECONDS = 1200  # one billable block of talk time
MAX_BLOCKS = 4


def moment(as_of: Moment) -> Column:
    """``as_of`` as a timestamp; a plain date is its midnight."""
    text = as_of if isinstance(as_of, str) else as_of.isoformat()
    return F.lit(text.replace("T", " ")).cast("timestamp_ntz")


def day(as_of: Moment) -> Column:
    return moment(as_of).cast("date")


def between(col: Column, start: Moment, end: Moment) -> Column:
    """Inclusive bounds on a timestamp; a date as the end stops at its midnight."""
    return (col >= moment(start)) & (col <= moment(end))


def days_before(as_of: Moment, count: int) -> Column:
    return F.date_sub(day(as_of), count)


def month_before(as_of: Moment) -> Column:
    """Same day of the previous month, or its last day."""
    return F.add_months(day(as_of), -1)


def month_start(as_of: Moment) -> Column:
    return F.trunc(day(as_of), "MM")


def month_start_of(as_of: Moment) -> str:
    """The same outside a query."""
    text = as_of if isinstance(as_of, str) else as_of.isoformat()
    return f"{text[:7]}-01"


def last_billing_cycle(today: Column) -> tuple[Column, Column]:
    """First and last day of the month before ``today``."""
    last_month = F.add_months(today, -1)
    return F.trunc(last_month, "MM"), F.last_day(last_month)


def age_years(born: Column, as_of: Moment) -> Column:
    """Whole years, one less while the birthday is still ahead."""
    today = day(as_of)
    ahead = (F.month(born) > F.month(today)) | (
        (F.month(born) == F.month(today)) & (F.dayofmonth(born) > F.dayofmonth(today))
    )
    return F.year(today) - F.year(born) - F.when(ahead, 1).otherwise(0)


def whole_minutes(seconds: Column) -> Column:
    """Full minutes of talk time, 0 when there was none."""
    return F.coalesce(F.floor(seconds / 60).cast("bigint"), F.lit(0).cast("bigint"))


def talk_blocks(seconds: Column) -> Column:
    """Full 20-minute blocks, at most four."""
    blocks = F.floor(seconds / BLOCK_SECONDS).cast("bigint")
    return F.least(F.coalesce(blocks, F.lit(0).cast("bigint")), F.lit(MAX_BLOCKS).cast("bigint"))
