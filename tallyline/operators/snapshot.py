"""Point-in-time measures of every statement due by a date.

The measures are looked up, not joined by range. Payments are collapsed to one
row per (loan, day) or (loan, month) and cumulated there; a statement then
finds its totals by equality on its day or month. Only equality joins touch
the statements themselves, and a large loan's side of those can be split.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions import columns as c
from tallyline.operators.scans import RANGE, cuts, in_blocks, running_totals, with_cuts
from tallyline.operators.totals import billed_before
from tallyline.sources.contracts import MONEY

DUE = ("PrincipalDue", "InterestDue")
RECEIVED = ("PrincipalReceivedToDate", "InterestReceivedToDate")
BILLED = ("ScheduledPrincipalReceivedToDate", "ScheduledInterestReceivedToDate")
PAST_DUE_COUNT = "NumberOfStatementsPastDue"


def _amounts(condition: Column, names: tuple[str, str]) -> list[Column]:
    """Sums of principal and interest where the condition holds; NULL if nowhere."""
    return [
        F.sum(F.when(condition, F.col(amount))).alias(name)
        for amount, name in zip(("AmountPrincipal", "AmountInterest"), names)
    ]


def due_statements(bill: DataFrame, as_of: datetime | date | None) -> DataFrame:
    """Bills dated on or before the day of ``as_of``."""
    return bill.filter(F.col("PaymentDate") <= F.lit(c.day_of(as_of)))


def bill_days(statements: DataFrame) -> DataFrame:
    """The distinct (LoanID, PaymentDate) of statements.

    What holds for a loan, or for a day of it, is joined to these and reaches
    the statements by loan and day together, so the statements of a large loan
    do not meet in one task.
    """
    return statements.select("LoanID", "PaymentDate").distinct()


def paid_by(pay: DataFrame, as_of: datetime | date | None) -> DataFrame:
    """Payments dated on or before the day of ``as_of``: later ones precede no statement due by it."""
    return pay.filter(F.col("PaymentDate") <= F.lit(c.day_of(as_of)))


def totals_by_bill_day(pay: DataFrame, statements: DataFrame) -> DataFrame:
    """(LoanID, PaymentDate) of every statement with its state on that day.

    ``MonthNumber`` is the largest month paid on or before the day, and the
    received amounts are those posted on or before it.
    """
    return _totals_by_day(pay, bill_days(statements))


def _totals_by_day(pay: DataFrame, days: DataFrame) -> DataFrame:
    """``days``, one row per loan and day, with the state on that day and all their columns.

    The window sees at most one payment row and one row of ``days`` per day of a loan.
    """
    paid = (
        pay.filter(F.col("PaymentDate").isNotNull())
        .groupBy("LoanID", "PaymentDate")
        .agg(
            F.max("MonthNumber").alias("MonthNumber"),
            *_amounts(F.col("Status") == c.POSTED, RECEIVED),
        )
        .withColumn("_statement", F.lit(False))
    )
    billed = days.withColumn("_statement", F.lit(True))
    to_date = (
        Window.partitionBy("LoanID")
        .orderBy("PaymentDate")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        paid.unionByName(billed, allowMissingColumns=True)
        .select(
            *days.columns,
            "_statement",
            F.max("MonthNumber").over(to_date).alias("MonthNumber"),
            *[F.sum(name).over(to_date).alias(name) for name in RECEIVED],
        )
        .filter("_statement")
        .drop("_statement")
    )


def _months(pay: DataFrame) -> DataFrame:
    return (
        pay.filter(F.col("MonthNumber").isNotNull())
        .groupBy("LoanID", "MonthNumber")
        .agg(
            *_amounts(F.col("Status") != c.POSTED, DUE),
            F.sum(F.when(F.col("Status") == c.PAST_DUE, 1)).alias(PAST_DUE_COUNT),
        )
    )


def totals_by_month(pay: DataFrame) -> DataFrame:
    """(LoanID, MonthNumber) with what was due, and past due, up to that month."""
    months = _months(pay)
    measures = (*DUE, PAST_DUE_COUNT)
    totals = running_totals(
        months.select(
            "LoanID", "MonthNumber", *[F.col(name).alias(f"_{name}") for name in measures]
        ),
        {name: F.col(f"_{name}") for name in measures},
        order=["MonthNumber"],
        frame=RANGE,
    )
    return totals.select("LoanID", "MonthNumber", *measures)


def statement_spine(
    bill: DataFrame, pay: DataFrame, as_of: datetime | date | None = None, per_loan: bool = False
) -> DataFrame:
    """(LoanID, MonthNumber, PaymentNumber, PaymentDate) of due statements.

    ``MonthNumber`` is the largest month with a payment on or before the
    statement's date, or, with ``per_loan``, on or before the day of ``as_of``:
    then one value for all statements of the loan. NULL if there is none.
    """
    statements = due_statements(bill, as_of).select("LoanID", "PaymentNumber", "PaymentDate")
    if per_loan:
        days = bill_days(statements).join(last_months(pay, as_of), "LoanID", "left")
    else:
        days = totals_by_bill_day(paid_by(pay, as_of), statements).select(
            "LoanID", "PaymentDate", "MonthNumber"
        )
    return statements.join(days, ["LoanID", "PaymentDate"]).select(
        "LoanID", "MonthNumber", "PaymentNumber", "PaymentDate"
    )


def last_months(pay: DataFrame, as_of: datetime | date | None) -> DataFrame:
    """(LoanID, MonthNumber): the largest month paid by the day of ``as_of``."""
    return paid_by(pay, as_of).groupBy("LoanID").agg(F.max("MonthNumber").alias("MonthNumber"))


def principal_due(pay: DataFrame, bill: DataFrame, as_of: datetime | date | None) -> DataFrame:
    """Statements with the amounts not posted in months up to their own."""
    return _with_month_totals(pay, bill, as_of, DUE)


def past_due_count(pay: DataFrame, bill: DataFrame, as_of: datetime | date | None) -> DataFrame:
    """Statements with the past-due payments in months up to their own."""
    return _with_month_totals(pay, bill, as_of, (PAST_DUE_COUNT,))


def _with_month_totals(pay, bill, as_of, measures: tuple[str, ...]) -> DataFrame:
    totals = totals_by_month(pay).select("LoanID", "MonthNumber", *measures)
    return _typed(
        statement_spine(bill, pay, as_of).join(totals, ["LoanID", "MonthNumber"], "left"),
        ("LoanID", "PaymentNumber", "MonthNumber"),
        measures,
    )


def received_to_date(pay: DataFrame, bill: DataFrame, as_of: datetime | date | None) -> DataFrame:
    """Statements with the amounts posted on or before their date."""
    statements = due_statements(bill, as_of).select("LoanID", "PaymentNumber", "PaymentDate")
    totals = totals_by_bill_day(paid_by(pay, as_of), statements).select(
        "LoanID", "PaymentDate", *RECEIVED
    )
    return _typed(
        statements.join(totals, ["LoanID", "PaymentDate"]),
        ("LoanID", "PaymentNumber", "PaymentDate"),
        RECEIVED,
    )


def scheduled_before(bill: DataFrame, as_of: datetime | date | None) -> DataFrame:
    """Statements with the amounts billed under smaller numbers."""
    return _typed(
        due_statements(billed_before(bill), as_of),
        ("LoanID", "PaymentNumber", "PaymentDate"),
        BILLED,
    )


def _typed(rows: DataFrame, keys: tuple[str, ...], measures: tuple[str, ...]) -> DataFrame:
    return rows.select(
        *keys,
        *[
            F.col(name).cast("bigint" if name == PAST_DUE_COUNT else MONEY).alias(name)
            for name in measures
        ],
    )


MEASURES = (*DUE, *RECEIVED, *BILLED, PAST_DUE_COUNT)


def statement_measures(
    pay: DataFrame, bill: DataFrame, position: DataFrame, as_of: datetime | date | None
) -> DataFrame:
    """Due statements with all measures as of the statement and the loan's position."""
    days = (
        totals_by_bill_day(paid_by(pay, as_of), due_statements(bill, as_of))
        .join(totals_by_month(pay), ["LoanID", "MonthNumber"], "left")
        .join(position, "LoanID")
    )
    statements = due_statements(billed_before(bill), as_of).join(days, ["LoanID", "PaymentDate"])
    return _typed(
        statements, ("LoanID", "PaymentNumber", "PaymentDate", *position.columns[1:]), MEASURES
    )


def loan_measures(pay: DataFrame, bill: DataFrame, as_of: datetime | date | None) -> DataFrame:
    """One row per loan: every row counted once for each statement it precedes.

    Every statement carries the loan's last month, so the due amounts count as
    often as the loan has statements. Received and billed amounts are the
    statement measures added up.
    """
    billed = (
        due_statements(billed_before(bill), as_of)
        .groupBy("LoanID")
        .agg(*[F.sum(name).alias(name) for name in BILLED])
    )
    # The days of the statements, and the day of ``as_of`` with none: its row has the last month.
    days = F.array(
        F.struct(F.col("PaymentDate").alias("day"), F.lit(1).alias("n")),
        F.struct(F.lit(c.day_of(as_of)).alias("day"), F.lit(0).alias("n")),
    )
    per_day = (
        due_statements(bill, as_of)
        .select("LoanID", F.explode(days).alias("_day"))
        .groupBy("LoanID", F.col("_day.day").alias("PaymentDate"))
        .agg(F.sum("_day.n").alias("_statements"))
    )
    received = (
        _totals_by_day(paid_by(pay, as_of), per_day)
        .groupBy("LoanID")
        .agg(
            F.max("MonthNumber").alias("MonthNumber"),
            F.sum("_statements").alias("_statements"),
            *[
                F.sum(F.when(F.col("_statements") > 0, F.col(name) * F.col("_statements"))).alias(name)
                for name in RECEIVED
            ],
        )
    )
    loans = received.join(billed, "LoanID").join(
        totals_by_month(pay), ["LoanID", "MonthNumber"], "left"
    )
    repeated = [
        (F.col(name) * F.col("_statements")).alias(name) for name in (*DUE, PAST_DUE_COUNT)
    ]
    return _typed(
        loans.select("LoanID", *RECEIVED, *BILLED, *repeated), ("LoanID",), MEASURES
    )


def statement_loan_measures(
    pay: DataFrame, bill: DataFrame, position: DataFrame, as_of: datetime | date | None
) -> DataFrame:
    """Due statements with the measures and position of their loan.

    A loan brings its row once for each block of its bills, so that neither the statements of a
    large loan meet in one task nor its row goes along with each of their days.
    """
    cut = cuts(bill, ["PaymentNumber"])
    statements = due_statements(bill, as_of).select("LoanID", "PaymentNumber", "PaymentDate")
    loans = loan_measures(pay, bill, as_of).join(position, "LoanID")
    blocks = F.sequence(F.lit(0), F.coalesce(F.size("_cuts"), F.lit(0)))
    divided = with_cuts(loans, cut).select(*loans.columns, F.explode(blocks).alias("_block"))
    return (
        in_blocks(statements, cut, "PaymentNumber")
        .join(divided, ["LoanID", "_block"])
        .drop("_block")
    )
