"""The point-in-time ledger."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame

from tallyline.functions import columns as c
from tallyline.functions.business_days import nth_previous_business_day
from tallyline.operators import snapshot as s
from tallyline.operators.terms import loan_position

# Fixed value: a payoff is reported from the fifth business day after it.
POSTING_DAYS = 5

_COLUMNS = (
    "LoanID",
    "PayoffUID",
    "StatementNumber",
    "StatementDueDate",
    *s.MEASURES,
    "Status",
    "Tier",
    "Term",
    "LoanAmount",
    "InterestRate",
)


def ledger_snapshot(
    pay: DataFrame,
    bill: DataFrame,
    loan: DataFrame,
    loan2: DataFrame,
    cb: DataFrame,
    pastdue: DataFrame,
    holidays: DataFrame,
    as_of: datetime | date | None = None,
    per_loan: bool = False,
) -> DataFrame:
    """Every statement due by ``as_of`` with its measures, loan status and terms.

    By default the measures are those of the statement. With ``per_loan`` every
    statement of a loan shows the loan's totals, in which a payment or bill
    counts once for each statement it precedes.
    """
    day = c.day_of(as_of)
    posted_day = nth_previous_business_day(pay.sparkSession, day, POSTING_DAYS, holidays)
    position = loan_position(loan, loan2, cb, pastdue, day, posted_day)
    measures = s.statement_loan_measures if per_loan else s.statement_measures
    rows = measures(pay, bill, position, day)
    return rows.withColumnsRenamed(
        {"PaymentNumber": "StatementNumber", "PaymentDate": "StatementDueDate"}
    ).select(*_COLUMNS)
