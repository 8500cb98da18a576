"""Column expressions shared by the operators."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.sources.contracts import RATE

# Payment status codes.
POSTED = "posted"
SCHEDULED = "scheduled"
PAST_DUE = "past_due"

# Account and portfolio codes.
CHARGED_OFF = "97"
DEBT_SETTLEMENT = "DS"

# Reported loan status.
PAID_IN_FULL_LABEL = "Paid In Full"
CHARGED_OFF_LABEL = "Charge off"
DEBT_SETTLEMENT_LABEL = "Debt Settlement"
CURRENT_LABEL = "Current"

# First day of each delinquency band and its label.
BANDS = (
    (0, "Current"),
    (30, "Delinquent 1 Payment"),
    (60, "Seriously Delinquent 2 Payments"),
    (90, "Seriously Delinquent 3+ Payments"),
)


def as_of_cut(as_of: datetime | date | None) -> date:
    """The first day *not* before ``as_of``; now if None.

    A statement dated D is before ``as_of`` exactly when D < the returned day:
    midnight excludes its own day, any later time of day includes it.
    """
    if as_of is None:
        as_of = datetime.now()
    if not isinstance(as_of, datetime):
        return as_of
    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    return as_of.date() if as_of == midnight else as_of.date() + timedelta(days=1)


def day_of(as_of: datetime | date | None) -> date:
    """The calendar day of ``as_of``; today if None."""
    if as_of is None:
        as_of = datetime.now()
    return as_of.date() if isinstance(as_of, datetime) else as_of


def amount_if(condition: Column, amount: str) -> Column:
    """The amount where the condition is true, else (also if unknown) zero."""
    return F.when(condition, F.col(amount)).otherwise(F.lit(0))


def shown_amount(amount: str) -> Column:
    """The amount of posted and scheduled rows, zero for any other status."""
    return amount_if(F.col("Status").isin(POSTED, SCHEDULED), amount)


def tier(classification: str = "Classification") -> Column:
    return F.right(F.col(classification), F.lit(1))


def percent_to_fraction(percent: Column) -> Column:
    """A percentage as a fraction, rounded half up to four places."""
    return (percent.cast(RATE) / F.lit(Decimal("100.0"))).cast(RATE)


def reduced_rate(modified: Column | None = None) -> Column:
    """The loan carries the charge-off rate: charged off, or ``modified``.

    ``modified`` marks loans inside a rate-modification period.
    """
    charged_off = F.col("AccountStatus") == CHARGED_OFF
    return charged_off if modified is None else charged_off | modified


def effective_rate(modified: Column | None = None) -> Column:
    """The charge-off rate where it applies, else the contract rate."""
    percent = F.when(reduced_rate(modified), F.col("PAInterestRate")).otherwise(F.col("Rate"))
    return percent_to_fraction(percent)


def in_period(day: date, start: str, end: str) -> Column:
    """``day`` lies in the closed period; unknown if a bound is NULL."""
    return F.lit(day).between(F.col(start), F.col(end))


def days_past_due(day: date, earliest: str = "EarliestUnpaidBill") -> Column:
    return F.coalesce(F.datediff(F.lit(day), F.col(earliest)), F.lit(0))


def delinquency_band(days: Column) -> Column:
    """The label of the last band that starts on or before ``days``."""
    band = F.lit(BANDS[0][1])
    for first_day, label in BANDS[1:]:
        band = F.when(days >= first_day, F.lit(label)).otherwise(band)
    return band
