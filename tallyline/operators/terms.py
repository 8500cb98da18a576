"""Loan terms, effective rates, delinquency and reported status, by loan."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import columns as c
from tallyline.sources.contracts import one_row_per


TERMS = ("Tier", "Term", "LoanAmount", "InterestRate")


def _credit(cb: DataFrame) -> DataFrame:
    return one_row_per(cb.select("LoanID", "AccountStatus", "TermsDuration"), "LoanID", "cb")


def _loans(loan: DataFrame) -> DataFrame:
    columns = ("LoanID", "Classification", "OriginalAmount", "Rate", "PAInterestRate")
    return one_row_per(loan.select(*columns), "LoanID", "loan")


def loan_terms(loan: DataFrame, cb: DataFrame) -> DataFrame:
    """(LoanID, Tier, Term, LoanAmount, InterestRate) for every loan."""
    return _loans(loan).join(_credit(cb), "LoanID", "left").select("LoanID", *term_columns())


def term_columns(modified: Column | None = None) -> list[Column]:
    return [
        c.tier().alias("Tier"),
        F.col("TermsDuration").alias("Term"),
        F.col("OriginalAmount").alias("LoanAmount"),
        c.effective_rate(modified).alias("InterestRate"),
    ]


def with_terms(rows: DataFrame, loan: DataFrame, cb: DataFrame) -> DataFrame:
    """Add the terms to rows of any grain; rows of unknown loans keep NULLs.

    The credit and loan tables join one after the other, so a row whose loan is
    in only one of them still gets that one's columns. Both rates are converted
    once per loan; a row only picks one.
    """
    loans = _loans(loan).select(
        "LoanID",
        c.tier().alias("Tier"),
        F.col("OriginalAmount").alias("LoanAmount"),
        c.percent_to_fraction(F.col("PAInterestRate")).alias("_reduced"),
        c.percent_to_fraction(F.col("Rate")).alias("_contract"),
    )
    rate = F.when(c.reduced_rate(), F.col("_reduced")).otherwise(F.col("_contract"))
    return (
        rows.join(_credit(cb), "LoanID", "left")
        .join(loans, "LoanID", "left")
        .select(
            *rows.columns,
            "Tier",
            F.col("TermsDuration").alias("Term"),
            "LoanAmount",
            rate.alias("InterestRate"),
        )
    )


def effective_rates(loan: DataFrame, cb: DataFrame) -> DataFrame:
    """(LoanID, InterestRate) without regard to rate modifications."""
    return loan_terms(loan, cb).select("LoanID", "InterestRate")


def effective_rates_modified(
    loan: DataFrame, loan2: DataFrame, cb: DataFrame, as_of: datetime | date | None = None
) -> DataFrame:
    """(LoanID, InterestRate), reduced during a rate-modification period."""
    terms = loan_position(loan, loan2, cb, None, as_of, None)
    return terms.select("LoanID", "InterestRate")


def earliest_unpaid_bill(pastdue: DataFrame, as_of: datetime | date | None = None) -> DataFrame:
    """(LoanID, EarliestUnpaidBill): the first past-due date before ``as_of``."""
    return (
        pastdue.filter(F.col("PastDueDate") < F.lit(c.day_of(as_of)))
        .groupBy("LoanID")
        .agg(F.min("PastDueDate").alias("EarliestUnpaidBill"))
    )


def delinquency_bucket(
    loan: DataFrame, pastdue: DataFrame, as_of: datetime | date | None = None
) -> DataFrame:
    """(LoanID, EarliestUnpaidBill, DaysPastDue, Band); no unpaid bill is day 0."""
    day = c.day_of(as_of)
    days = c.days_past_due(day)
    return (
        loan.select("LoanID")
        .join(earliest_unpaid_bill(pastdue, day), "LoanID", "left")
        .select(
            "LoanID",
            "EarliestUnpaidBill",
            days.alias("DaysPastDue"),
            c.delinquency_band(days).alias("Band"),
        )
    )


def reported_status(day: date, posted_day: Column) -> Column:
    """The first that applies: paid off, charged off, settled, forborne, band."""
    settled = F.coalesce(F.col("U_PortMoveCode"), F.lit("")) == c.DEBT_SETTLEMENT
    forborne = c.in_period(day, "ETL_LoanModForbearEffDt", "ETL_LoanModForbearEndDt")
    return (
        F.when(F.col("PaidOffDate") <= posted_day, F.lit(c.PAID_IN_FULL_LABEL))
        .when(F.col("AccountStatus") == c.CHARGED_OFF, F.lit(c.CHARGED_OFF_LABEL))
        .when(settled, F.lit(c.DEBT_SETTLEMENT_LABEL))
        .when(forborne, F.lit(c.CURRENT_LABEL))
        .otherwise(c.delinquency_band(c.days_past_due(day)))
    )


def loan_position(
    loan: DataFrame,
    loan2: DataFrame,
    cb: DataFrame,
    pastdue: DataFrame | None,
    as_of: datetime | date | None,
    posted_day: Column | None,
) -> DataFrame:
    """One row per loan: officer, reported status and terms at ``as_of``.

    All inputs meet at loan grain, so a ledger needs only one join to this.
    Without ``pastdue`` the status is left out.
    """
    day = c.day_of(as_of)
    loans = (
        one_row_per(loan, "LoanID", "loan")
        .join(_credit(cb), "LoanID", "left")
        .join(one_row_per(loan2, "LoanID", "loan2"), "LoanID", "left")
    )
    modified = c.in_period(day, "U_LoanModRateEffDt", "ETL_LoanModRateEndDt")
    status = []
    if pastdue is not None:
        loans = loans.join(earliest_unpaid_bill(pastdue, day), "LoanID", "left")
        status = [reported_status(day, posted_day).alias("Status")]
    return loans.select(
        "LoanID", F.col("LoanOfficer").alias("PayoffUID"), *status, *term_columns(modified)
    )


def loan_status(
    loan: DataFrame,
    loan2: DataFrame,
    cb: DataFrame,
    pastdue: DataFrame,
    as_of: datetime | date | None,
    posted_day: Column,
) -> DataFrame:
    """(LoanID, Status): the reported status of every loan at ``as_of``.

    ``posted_day`` is the day by which a payoff must be dated to be reported,
    the fifth previous business day in the snapshot.
    """
    return loan_position(loan, loan2, cb, pastdue, as_of, posted_day).select("LoanID", "Status")
