"""Month arithmetic on first-of-month dates."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(value: str | dt.date | Column) -> Column:
    """A date literal from ISO text or a date; Columns pass through."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def month_index(start: Column, month: Column) -> Column:
    """Month boundaries between two dates (not whole elapsed months)."""
    return 12 * (F.year(month) - F.year(start)) + F.month(month) - F.month(start)


def first_month_from(start: Column) -> Column:
    """First first-of-month date that is not before ``start``."""
    return F.trunc(F.add_months(F.date_sub(start, 1), 1), "MM")


def last_month_before(end: Column) -> Column:
    """Last first-of-month date before ``end``."""
    return F.trunc(F.date_sub(end, 1), "MM")


def months_between_inclusive(first: Column, last: Column) -> Column:
    return F.sequence(first, last, F.expr("interval 1 month"))


def month_text(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")
