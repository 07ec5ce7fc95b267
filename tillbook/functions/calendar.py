"""Federal Reserve holiday rules as Column expressions.

Each year yields 11 observed holidays: five fixed dates moved off weekends
(Saturday -> Friday before, Sunday -> Monday after) and six floating
"n-th weekday of month" dates.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference holiday rules).
# Fixed-date holidays (month, day): New Year's Day, Juneteenth,
# Independence Day, Veterans Day, Christmas Day.
FIXED_HOLIDAYS = [(1, 1), (6, 19), (7, 4), (11, 11), (12, 25)]
# Floating holidays (month, weekday, n; n = -1 means the last one):
# MLK Day, Presidents Day, Memorial Day, Labor Day, Columbus Day, Thanksgiving.
FLOATING_HOLIDAYS = [(1, "Mon", 3), (2, "Mon", 3), (5, "Mon", -1), (9, "Mon", 1), (10, "Mon", 2), (11, "Thu", 4)]


def observed(day: Column) -> Column:
    """Saturday -> preceding Friday, Sunday -> following Monday (Spark: 1=Sun, 7=Sat)."""
    dow = F.dayofweek(day)
    return F.when(dow == 7, F.date_sub(day, 1)).when(dow == 1, F.date_add(day, 1)).otherwise(day)


def nth_weekday(year: Column, month: int, weekday: str, n: int) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    if n > 0:
        # next_day is strictly after its argument, so start from the day before the 1st
        return F.date_add(F.next_day(F.date_sub(first, 1), weekday), 7 * (n - 1))
    return F.next_day(F.date_sub(F.last_day(first), 7), weekday)


def federal_holidays(year: Column) -> Column:
    """array<date> with the observed federal holidays of ``year``."""
    fixed = [observed(F.make_date(year, F.lit(m), F.lit(d))) for m, d in FIXED_HOLIDAYS]
    floating = [nth_weekday(year, m, wd, n) for m, wd, n in FLOATING_HOLIDAYS]
    return F.array(*fixed, *floating)


def day_digits(day: Column) -> Column:
    """yyyymmdd of a date, without a date formatter."""
    return F.replace(day.cast("date").cast("string"), F.lit("-"), F.lit(""))
