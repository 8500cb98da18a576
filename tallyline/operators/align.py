"""Statement periods and the placement of payments in them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.operators.scans import cuts, few, reached, with_cuts
from tallyline.sources.contracts import MONEY

# Fixed value: the end of a loan's last statement period.
OPEN_END = date(9999, 12, 31)

# Bills of a loan in order. Numbers are unique; should one repeat, its bills
# follow by date, so that the result is still the same on every run.
_SEQUENCE = ("PaymentNumber", "PaymentDate")


# Days that share a piece of the calendar.
PIECE = 512


def next_bill_date(bill: DataFrame) -> DataFrame:
    """Add ``PaymentDateNext``: the date of the loan's next bill by number.

    The last bill, and a bill whose successor has no date, get the open end.
    """
    return _followed(bill, bill_cuts(bill)).drop("_block", "_opener")


def bill_cuts(bill: DataFrame) -> DataFrame:
    """(LoanID, _cuts) of bills in their order."""
    return cuts(bill, list(_SEQUENCE))


def _followed(bill: DataFrame, cut: DataFrame) -> DataFrame:
    """Bills with ``PaymentDateNext``, the block they were ordered in and what opens the next.

    A cut is a bill, the first of its block. So what follows the last bill of a block is in the
    cuts already, and bills are read for no second time. It is looked up before the bills are
    shuffled, as a loan has many cuts and each of its bills would take them all along. ``_opener``
    is NULL for loans that are not cut, and for them alone.
    """
    opener = F.coalesce(F.get("_cuts", F.col("_block"))["PaymentDate"], F.lit(OPEN_END))
    blocked = (
        with_cuts(bill, cut)
        .withColumn("_block", reached(F.struct(*_SEQUENCE)))
        .select(
            *bill.columns,
            "_block",
            F.when(F.col("_cuts").isNotNull(), opener).alias("_opener"),
        )
    )
    within = Window.partitionBy("LoanID", "_block").orderBy(*_SEQUENCE)
    following = F.when(F.lead(F.lit(True)).over(within), F.lead("PaymentDate").over(within))
    return blocked.select(
        *bill.columns,
        "_block",
        "_opener",
        F.coalesce(following.otherwise(F.col("_opener")), F.lit(OPEN_END)).alias("PaymentDateNext"),
    )


def _spans(periods: DataFrame) -> DataFrame:
    """(LoanID, _block, _first, _end): the days between which the periods of a block lie.

    Of loans that are cut alone, so there are hardly more than cuts. That a loan is cut is told by
    the group and not by a join with the cuts, which would be moved below the shuffle of the
    bills; as it is, both readers of the periods share that shuffle.
    """
    return (
        periods.groupBy("LoanID", "_block")
        .agg(
            F.min("PaymentDate").alias("_first"),
            F.max("PaymentDateNext").alias("_end"),
            F.max("_opener").alias("_opener"),
        )
        .filter(F.col("_opener").isNotNull())
        .drop("_opener")
    )


def _place(dated: DataFrame, bill: DataFrame) -> DataFrame:
    """Add ``MonthReal``, the number of the period(s) holding ``PaymentDate``.

    Callers pass rows already collapsed to the calendar (one row per loan, day
    and at most status), so no loan brings more rows than there are days.

    Periods are divided at the borders of calendar pieces, and a day meets the
    periods of its own piece only: they are joined by loan, block of bills and piece,
    whether or not bill dates rise with the number. A loan of many bills is spread
    over its blocks and pieces; a day is given to those of its blocks whose periods span it, which
    is one or two while dates rise with the number. Empty periods hold no
    date and are left out. Days after the last bill sampled share the last piece, so that open
    periods end there.
    """
    cut = bill_cuts(bill)
    last = (date.today() - date(1970, 1, 1)).days // PIECE

    def piece(day: Column) -> Column:
        return F.least(F.floor(F.unix_date(day) / F.lit(PIECE)), F.lit(last)).cast("int")

    columns = bill.select("LoanID", *_SEQUENCE)
    periods = _followed(columns, cut).filter(F.col("PaymentDate") < F.col("PaymentDateNext"))
    pieces = F.sequence(piece(F.col("PaymentDate")), piece(F.date_sub("PaymentDateNext", 1)))
    divided = periods.select(
        "LoanID",
        "_block",
        F.explode(pieces).alias("_piece"),
        F.col("PaymentNumber").alias("MonthReal"),
        F.col("PaymentDate").alias("_from"),
        F.col("PaymentDateNext").alias("_until"),
    )
    spans = few(_spans(periods).withColumnRenamed("LoanID", "_loan"))
    spanned = (F.col("PaymentDate") >= F.col("_first")) & (F.col("PaymentDate") < F.col("_end"))
    # A day of a loan that is not cut meets no span, and neither does one outside of all periods.
    days = dated.join(spans, (F.col("LoanID") == F.col("_loan")) & spanned, "left").select(
        *dated.columns,
        F.coalesce("_block", F.lit(0)).alias("_block"),
        piece(F.col("PaymentDate")).alias("_piece"),
    )
    held = (F.col("PaymentDate") >= F.col("_from")) & (F.col("PaymentDate") < F.col("_until"))
    return (
        days.join(divided, ["LoanID", "_block", "_piece"])
        .filter(held)
        .select(*dated.columns, "MonthReal")
    )


def placed_dates(pay: DataFrame, bill: DataFrame) -> DataFrame:
    """(LoanID, PaymentDate, MonthReal) for every payment date in a period."""
    days = pay.filter(F.col("PaymentDate").isNotNull()).select("LoanID", "PaymentDate").distinct()
    return _place(days, bill).select("LoanID", "PaymentDate", "MonthReal")


def align_rows(pay: DataFrame, bill: DataFrame) -> DataFrame:
    """Every payment row with the statement number of its period, ``MonthReal``.

    Payments outside all periods disappear; where bill dates fall with the
    number, periods overlap and a payment appears once for each.
    """
    return pay.join(placed_dates(pay, bill), ["LoanID", "PaymentDate"]).select(
        *[pay[c] for c in pay.columns], "MonthReal"
    )


_LEAST = ("AmountPrincipalRemaining", "OriginalAmount")
_SUMMED = ("AmountPrincipal", "AmountInterest", "Amount", "PrincipalWaived")


def _amount(name: str) -> Column:
    return F.sum(F.coalesce(F.col(name), F.lit(0).cast("decimal(12,2)"))).cast(MONEY).alias(name)


def daily_payments(pay: DataFrame) -> DataFrame:
    """Collapse payments to one row per loan, day and status.

    All measures are minima, maxima or sums, so they can be finished later at
    statement level. The collapse runs map-side first: a loan with any number of
    payments reaches the join with at most one row per day and status.
    """
    return (
        pay.filter(F.col("PaymentDate").isNotNull())
        .groupBy("LoanID", "PaymentDate", "Status")
        .agg(
            F.max("EffectiveDate").alias("EffectiveDate"),
            *[F.min(c).alias(c) for c in _LEAST],
            *[_amount(c) for c in _SUMMED],
        )
    )


def align_payments_to_statements(pay: DataFrame, bill: DataFrame) -> DataFrame:
    """One row per (LoanID, MonthNumber, Status): payments by statement period.

    NULL amounts count as zero. ``PaymentDate`` is the earliest and
    ``EffectiveDate`` the latest of the group.
    """
    return (
        _place(daily_payments(pay), bill)
        .groupBy("LoanID", F.col("MonthReal").alias("MonthNumber"), "Status")
        .agg(
            F.min("PaymentDate").alias("PaymentDate"),
            F.max("EffectiveDate").alias("EffectiveDate"),
            *[F.min(c).alias(c) for c in _LEAST],
            *[F.sum(c).cast(MONEY).alias(c) for c in _SUMMED],
        )
    )
