"""Business days: Monday to Friday without the days of a holiday table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _closed(holidays: DataFrame) -> DataFrame:
    """(closed): one array of the weekdays without business, no more than the calendar has."""
    day = F.col("HolidayDate")
    return holidays.agg(F.collect_set(F.when(F.weekday(day) < 5, day)).alias("closed"))


def _weekdays(first: Column, last: Column) -> Column:
    return F.filter(F.sequence(first, last), lambda day: F.weekday(day) < 5)


def _reach(n: int, closed: Column) -> Column:
    """Days back that n business days fit in, even if all closed days lie there too."""
    return ((F.ceil((F.size(closed) + n) / F.lit(5)) + 1) * 7).cast("int")


def previous_business_days(days: DataFrame, day: str, n: int, holidays: DataFrame) -> DataFrame:
    """(day, PreviousBusinessDay): the n-th business day before each distinct day.

    The day itself does not count. One calendar from the first to the last day holds the answer
    of every day in it, and a day looks itself up by equality. The work is per day of the
    calendar, and holidays are read once.
    """
    asked = days.filter(F.col(day).isNotNull()).select(day).distinct()
    span = asked.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    opened = span.select("first", "last", _closed(holidays).scalar().alias("closed")).select(
        "last",
        F.array_except(
            _weekdays(F.date_sub("first", _reach(n, F.col("closed"))), F.col("last")), "closed"
        ).alias("open"),
    )

    def answers(i: Column) -> Column:
        """The days after the business day at i - 1, up to the next one."""
        after = F.date_add(F.get("open", i - 1), 1)
        until = F.coalesce(F.get("open", i), F.col("last"))
        answer = F.get("open", i - n).alias("PreviousBusinessDay")
        found = F.transform(F.sequence(after, until), lambda d: F.struct(d.alias(day), answer))
        return F.when(after <= until, found).otherwise(F.array())

    calendar = opened.select(
        F.inline(F.flatten(F.transform(F.sequence(F.lit(n), F.size("open")), answers)))
    )
    return asked.join(calendar, day).select(day, "PreviousBusinessDay")


def nth_previous_business_day(
    spark: SparkSession, day: date, n: int, holidays: DataFrame
) -> Column:
    """The n-th business day before ``day`` as a scalar subquery column, from one read of holidays."""
    before = holidays.filter(F.col("HolidayDate") < F.lit(day))
    yesterday = F.date_sub(F.lit(day), 1)
    weekdays = F.reverse(_weekdays(F.date_sub(yesterday, _reach(n, F.col("closed"))), yesterday))
    return _closed(before).select(F.get(F.array_except(weekdays, "closed"), F.lit(n - 1))).scalar()
