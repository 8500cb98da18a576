"""Checks on the payment and bill tables.

A check that compares rows of a loan collapses them map-side first, and none forms
pairs of rows inside a loan. ``date_mismatch`` reports rows: a payment meets the bill of
its number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.operators.align import next_bill_date, placed_dates


def _duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum(F.lit(1)).alias("Rows")).filter(F.col("Rows") > 1)


def duplicate_months(pay: DataFrame) -> DataFrame:
    """(LoanID, MonthNumber, Rows) where a month has more than one payment row."""
    return _duplicates(pay, ["LoanID", "MonthNumber"])


def duplicate_month_dates(pay: DataFrame) -> DataFrame:
    """(LoanID, MonthNumber, PaymentDate, Rows) with more than one payment row."""
    return _duplicates(pay, ["LoanID", "MonthNumber", "PaymentDate"])


def conflicting_dates(pay: DataFrame) -> DataFrame:
    """Payment dates of a month that has other dates too.

    ``Rows`` payments carry the date and ``OtherRows`` of the same month another
    one; Rows x OtherRows is the number of conflicting ordered pairs, which are
    counted here and not listed.
    """
    month = Window.partitionBy("LoanID", "MonthNumber")
    return (
        pay.filter(F.col("MonthNumber").isNotNull() & F.col("PaymentDate").isNotNull())
        .groupBy("LoanID", "MonthNumber", "PaymentDate")
        .agg(F.count(F.lit(1)).alias("Rows"))
        .withColumn("OtherRows", F.sum("Rows").over(month) - F.col("Rows"))
        .filter(F.col("OtherRows") > 0)
    )


def date_mismatch(pay: DataFrame, bill: DataFrame) -> DataFrame:
    """Payments dated differently from the bill whose number is their month."""
    billed = bill.select(
        "LoanID",
        F.col("PaymentNumber").alias("MonthNumber"),
        F.col("PaymentDate").alias("BillDate"),
    )
    return (
        pay.select("LoanID", "MonthNumber", "PaymentDate")
        .join(billed, ["LoanID", "MonthNumber"])
        .filter(F.col("PaymentDate") != F.col("BillDate"))
        .select(
            "LoanID",
            "MonthNumber",
            F.col("MonthNumber").alias("PaymentNumber"),
            "PaymentDate",
            "BillDate",
        )
    )


def payment_off_statement(pay: DataFrame, bill: DataFrame) -> DataFrame:
    """Payments whose date is not among the loan's bill dates.

    Follows NOT IN: a payment of a loan without bills is listed; otherwise an
    unknown payment date, or an unknown date among the loan's bills, makes the
    answer unknown and the payment is not listed. A payment without a loan has no
    bills. The question is settled once per loan and day, and the payments then
    follow by equality on both.
    """
    bill_days = bill.select("LoanID", "PaymentDate").distinct()
    # Any bill of the loan answers for a payment without a date.
    billed = bill_days.select("LoanID").distinct().withColumn("PaymentDate", F.lit(None))
    unknown = bill_days.filter(F.col("PaymentDate").isNull()).select("LoanID")
    days = pay.select("LoanID", "PaymentDate").distinct()
    listed = _matched(days, bill_days.unionByName(billed), "left_anti").join(
        unknown, "LoanID", "left_anti"
    )
    payments = pay.select("LoanID", "MonthNumber", "PaymentDate")
    return _matched(payments, listed, "left_semi", unknown_loan=True)


def _matched(rows: DataFrame, days: DataFrame, how: str, unknown_loan: bool = False) -> DataFrame:
    """Semi or anti join on loan and day, where an unknown day equals itself.

    ``unknown_loan`` says whether an unknown loan does too.
    """
    days = days.select(F.col("LoanID").alias("_loan"), F.col("PaymentDate").alias("_day"))
    loan = F.col("LoanID")
    same_loan = loan.eqNullSafe(F.col("_loan")) if unknown_loan else loan == F.col("_loan")
    return rows.join(days, same_loan & F.col("PaymentDate").eqNullSafe(F.col("_day")), how)


def length_mismatch(pay: DataFrame, bill: DataFrame) -> DataFrame:
    """(LoanID, LastPaymentNumber, LastMonthNumber) where the two differ."""
    bills = bill.groupBy("LoanID").agg(F.max("PaymentNumber").alias("LastPaymentNumber"))
    months = pay.groupBy("LoanID").agg(F.max("MonthNumber").alias("LastMonthNumber"))
    return bills.join(months, "LoanID").filter(
        F.col("LastPaymentNumber") != F.col("LastMonthNumber")
    )


def unaligned_payments(pay: DataFrame, bill: DataFrame) -> DataFrame:
    """(LoanID, UnalignedPayments): payments that fall in no statement period."""
    days = pay.groupBy("LoanID", "PaymentDate").agg(F.count(F.lit(1)).alias("_payments"))
    placed = placed_dates(pay, bill).select("LoanID", "PaymentDate")
    return (
        days.join(placed, ["LoanID", "PaymentDate"], "left_anti")
        .groupBy("LoanID")
        .agg(F.sum("_payments").alias("UnalignedPayments"))
    )


def non_increasing_bills(bill: DataFrame) -> DataFrame:
    """Bills whose successor by number is dated on the same day or earlier.

    Same-day successors leave an empty period; earlier ones make periods overlap.
    """
    return next_bill_date(bill.select("LoanID", "PaymentNumber", "PaymentDate")).filter(
        F.col("PaymentDateNext") <= F.col("PaymentDate")
    )
