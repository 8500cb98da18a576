"""The cumulative, statement-aligned ledger."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import columns as c
from tallyline.operators.align import align_payments_to_statements, bill_cuts
from tallyline.operators.scans import of_cut, running_totals
from tallyline.operators.terms import TERMS, with_terms
from tallyline.sources.contracts import MONEY

# The running order within a loan; unique, as (LoanID, MonthNumber, Status) is
# the key of the aligned payments. Also the order of the result.
ORDER = ("MonthNumber", "PaymentDate", "EffectiveDate", "Status")


_PAST_DUE_COUNT = "NumberOfStatementPastDue"


def _totals() -> dict[str, Column]:
    status = F.col("Status")
    return {
        "PrincipalDue": c.amount_if(status != c.POSTED, "AmountPrincipal"),
        "InterestDue": c.amount_if(status != c.POSTED, "AmountInterest"),
        "PrincipalReceivedToDate": c.amount_if(status == c.POSTED, "AmountPrincipal"),
        "InterestReceivedToDate": c.amount_if(status == c.POSTED, "AmountInterest"),
        "ScheduledPrincipalReceivedToDate": F.col("AmountPrincipal"),
        "ScheduledInterestReceivedToDate": F.col("AmountInterest"),
        _PAST_DUE_COUNT: F.when(status == c.PAST_DUE, 1).otherwise(0),
    }


def _ledger(
    align: Callable[[DataFrame], DataFrame],
    pay: DataFrame,
    bill: DataFrame,
    loan: DataFrame,
    cb: DataFrame,
    principal: Column,
    interest: Column,
    ordered: bool,
) -> DataFrame:
    """Payments as ``align`` places them, with their terms and the seven running totals.

    A loan brings one row per statement and status. The totals run in the blocks that its bills
    were placed in, so that a loan of many statements is several tasks' work. Only the payments of
    loans that are cut are aligned a second time, for the sums of their blocks; the others are
    dropped before they are collapsed.

    The terms join first, so that one shuffle by ranges of loan and block serves both the totals
    and the order of the result, where a join after it would undo its order.
    """
    totals, cut = _totals(), bill_cuts(bill)
    rows = running_totals(
        with_terms(align(pay), loan, cb),
        totals,
        list(ORDER),
        cut=cut,
        carry_from=align(of_cut(pay, cut)),
        in_range=ordered,
    )
    ledger = rows.select(
        "LoanID",
        *["_block"][: int(ordered)],
        "MonthNumber",
        F.col("PaymentDate").alias("StatementDueDate"),
        "EffectiveDate",
        principal.cast(MONEY).alias("AmountPrincipal"),
        interest.cast(MONEY).alias("AmountInterest"),
        *[
            F.col(name).cast("bigint" if name == _PAST_DUE_COUNT else MONEY).alias(name)
            for name in totals
        ],
        "Status",
        *TERMS,
    )
    if not ordered:
        return ledger
    # Blocks rise with the statement number, so this is the order of the loan's statements.
    order = ("LoanID", "_block", "MonthNumber", "StatementDueDate", "EffectiveDate", "Status")
    return ledger.orderBy(*order).drop("_block")


def cumulative_ledger(
    pay: DataFrame,
    bill: DataFrame,
    loan: DataFrame,
    cb: DataFrame,
    as_of: datetime | date | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Every (loan, statement, status) before ``as_of`` with totals to date.

    A group counts if its earliest payment lies before ``as_of`` (now if None),
    and then counts whole; the cut is after the collapse and before the totals.
    The shown amounts are zero unless posted or scheduled, while the totals use
    all amounts. ``ordered=False`` leaves the rows unsorted, after as many shuffles.
    """
    until = F.lit(c.as_of_cut(as_of))

    def align(pay: DataFrame) -> DataFrame:
        return align_payments_to_statements(pay, bill).filter(F.col("PaymentDate") < until)

    principal, interest = c.shown_amount("AmountPrincipal"), c.shown_amount("AmountInterest")
    return _ledger(align, pay, bill, loan, cb, principal, interest, ordered)


def analysis_ledger(
    pay: DataFrame,
    bill: DataFrame,
    loan: DataFrame,
    cb: DataFrame,
    loan_id: str | None = None,
    ordered: bool = True,
) -> DataFrame:
    """The ledger without as-of cut and with unmasked amounts.

    With ``loan_id`` both inputs are filtered before they are joined, so the
    filter reaches both scans and the join keeps its key.
    """
    if loan_id is not None:
        pay = pay.filter(F.col("LoanID") == loan_id)
        bill = bill.filter(F.col("LoanID") == loan_id)

    def align(pay: DataFrame) -> DataFrame:
        return align_payments_to_statements(pay, bill)

    amounts = F.col("AmountPrincipal"), F.col("AmountInterest")
    return _ledger(align, pay, bill, loan, cb, *amounts, ordered)


def masked_amounts(pay: DataFrame, bill: DataFrame) -> DataFrame:
    """Aligned amounts as the ledger shows them, for every group."""
    return align_payments_to_statements(pay, bill).select(
        "LoanID",
        "MonthNumber",
        "Status",
        c.shown_amount("AmountPrincipal").cast(MONEY).alias("AmountPrincipal"),
        c.shown_amount("AmountInterest").cast(MONEY).alias("AmountInterest"),
    )
