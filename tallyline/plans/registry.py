"""Every operator as a query over the analogue inputs of a directory."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.business_days import (
    nth_previous_business_day,
    previous_business_days,
)
from tallyline.functions.columns import day_of
from tallyline.operators import align, lookup, quality, snapshot, terms, totals
from tallyline.operators.scans import rows_per_block
from tallyline.plans.ledger import analysis_ledger, cumulative_ledger, masked_amounts
from tallyline.plans.routines import register_functions
from tallyline.plans.snapshot import POSTING_DAYS, ledger_snapshot
from tallyline.plans.statement_table import store_statements, update_months
from tallyline.sources import tables
from tallyline.sources.analogue import AS_OF, Analogue

Query = Callable[[SparkSession, str], DataFrame]

# A loan that every scale factor has, for the lookups.
LOAN = "7"

# Inputs of another shape for the queries whose names end so.
SHAPES = {
    "large_loans": {"loans": 2},
    "disordered_bills": {"by_key": True},
    "unknown_values": {"unknown": True},
    "spelled_ids": {"spelled": True},
}

# Large loans of the smallest directories have several blocks too.
ROWS_OF_A_BLOCK = 256

_QUERIES: dict[str, tuple[Callable[[Analogue], DataFrame], dict]] = {}


def _query(function: Callable[[Analogue], DataFrame]) -> Callable[[Analogue], DataFrame]:
    _QUERIES[function.__name__] = function, {}
    return function


def _also(*shapes: str) -> Callable:
    """Register the query over inputs of other shapes too."""

    def register(function: Callable[[Analogue], DataFrame]) -> Callable[[Analogue], DataFrame]:
        for shape in shapes:
            _QUERIES[f"{function.__name__}_{shape}"] = function, SHAPES[shape]
        return function

    return register


# Queries that write a table as they are built.
STORED: set[str] = set()


def _stores(function: Callable[[Analogue], DataFrame]) -> Callable[[Analogue], DataFrame]:
    STORED.add(function.__name__)
    return function


def queries() -> dict[str, Query]:
    def bound(function: Callable[[Analogue], DataFrame], shape: dict) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            if "loans" not in shape:
                return function(Analogue(spark, sf_dir, **shape))
            with rows_per_block(ROWS_OF_A_BLOCK):
                return function(Analogue(spark, sf_dir, **shape))

        return query

    return {name: bound(*query) for name, query in _QUERIES.items()}


# Alignment


@_query
def next_bill_date(a: Analogue) -> DataFrame:
    # As text: the open end lies outside the range of nanosecond timestamps.
    return align.next_bill_date(a.bill()).withColumn(
        "PaymentDateNext", F.col("PaymentDateNext").cast("string")
    )


@_query
def interval_align_raw(a: Analogue) -> DataFrame:
    return align.align_rows(a.pay(), a.bill())


@_also("large_loans", "disordered_bills", "unknown_values")
@_query
def align_payments_to_statements(a: Analogue) -> DataFrame:
    return align.align_payments_to_statements(a.pay(months=False), a.bill())


# Cumulative ledger


@_also("spelled_ids")
def align_payments(a: Analogue) -> DataFrame:
    """Aligned over ids that only the collation of the source takes for the same."""
    spelled = F.upper(F.rtrim(F.col("LoanID").cast("string")))
    aligned = align.align_payments_to_statements(a.pay(months=False), a.bill())
    return aligned.withColumn("LoanID", F.expr("cast(LoanID as string collate UTF8_BINARY)")).withColumn(
        "LoanID", spelled
    )


@_also("large_loans", "disordered_bills", "unknown_values")
@_query
def cumulative_ledger_as_of(a: Analogue) -> DataFrame:
    return cumulative_ledger(a.pay(months=False), a.bill(), a.loan(), a.cb(), AS_OF)


@_query
def ledger_analysis(a: Analogue) -> DataFrame:
    return analysis_ledger(a.pay(months=False), a.bill(), a.loan(), a.cb())


@_query
def ledger_of_one_loan(a: Analogue) -> DataFrame:
    return analysis_ledger(a.pay(months=False), a.bill(), a.loan(), a.cb(), loan_id=LOAN)


@_query
def ledger_masked_amounts(a: Analogue) -> DataFrame:
    return masked_amounts(a.pay(months=False), a.bill())


def _with_functions(a: Analogue) -> SparkSession:
    pay = a.pay(months=False)
    register_functions(pay.sparkSession, pay, a.bill(), a.loan(), a.cb())
    return pay.sparkSession


@_query
def ledger_function(a: Analogue) -> DataFrame:
    return _with_functions(a).sql(
        f"select * from cumulative_ledger(as_of => timestamp_ntz'{AS_OF}')"
    )


@_query
def ledger_function_of_one_loan(a: Analogue) -> DataFrame:
    return _with_functions(a).sql(f"select * from ledger_analysis(loan_id => '{LOAN}')")


# Terms and status


@_query
def tier_term_amount(a: Analogue) -> DataFrame:
    return terms.loan_terms(a.loan(), a.cb()).select("LoanID", "Tier", "Term", "LoanAmount")


@_query
def effective_rate(a: Analogue) -> DataFrame:
    return terms.effective_rates(a.loan(), a.cb())


@_query
def effective_rate_modified(a: Analogue) -> DataFrame:
    return terms.effective_rates_modified(a.loan(), a.loan2(), a.cb(), AS_OF)


@_query
def earliest_unpaid_bill(a: Analogue) -> DataFrame:
    return terms.earliest_unpaid_bill(a.pastdue(), AS_OF)


@_query
def delinquency_bucket(a: Analogue) -> DataFrame:
    return terms.delinquency_bucket(a.loan(), a.pastdue(), AS_OF)


@_query
def loan_status(a: Analogue) -> DataFrame:
    holidays = a.holidays()
    posted_day = nth_previous_business_day(
        holidays.sparkSession, day_of(AS_OF), POSTING_DAYS, holidays
    )
    return terms.loan_status(a.loan(), a.loan2(), a.cb(), a.pastdue(), AS_OF, posted_day)


@_query
def nth_previous_business_day_of_bills(a: Analogue) -> DataFrame:
    return previous_business_days(a.bill(), "PaymentDate", POSTING_DAYS, a.holidays())


# Running totals


@_also("large_loans")
@_query
def bill_running_totals(a: Analogue) -> DataFrame:
    return totals.bill_running_totals(a.bill()).orderBy("LoanID", "PaymentNumber", "PaymentDate")


@_query
def bill_chain_totals(a: Analogue) -> DataFrame:
    return totals.bill_chain_totals(a.bill()).orderBy("LoanID", "PaymentNumber")


@_query
def bill_chain_of_loan(a: Analogue) -> DataFrame:
    return totals.bill_chain_of_loan(a.bill(), LOAN)


@_query
def payment_running_totals(a: Analogue) -> DataFrame:
    return totals.payment_running_totals(a.pay()).orderBy("LoanID", "MonthNumber")


# Snapshot


@_query
def statement_spine(a: Analogue) -> DataFrame:
    return snapshot.statement_spine(a.bill(), a.pay(), AS_OF).orderBy(
        "LoanID", "MonthNumber", "PaymentNumber"
    )


@_query
def statement_spine_per_loan(a: Analogue) -> DataFrame:
    return snapshot.statement_spine(a.bill(), a.pay(), AS_OF, per_loan=True).orderBy(
        "LoanID", "MonthNumber", "PaymentNumber"
    )


@_query
def principal_due_by_month(a: Analogue) -> DataFrame:
    return snapshot.principal_due(a.pay(), a.bill(), AS_OF)


@_query
def past_due_count(a: Analogue) -> DataFrame:
    return snapshot.past_due_count(a.pay(), a.bill(), AS_OF)


@_query
def received_to_date(a: Analogue) -> DataFrame:
    return snapshot.received_to_date(a.pay(), a.bill(), AS_OF)


@_query
def scheduled_before(a: Analogue) -> DataFrame:
    return snapshot.scheduled_before(a.bill(), AS_OF)


@_query
def snapshot_per_statement(a: Analogue) -> DataFrame:
    return _snapshot(a, per_loan=False)


@_query
def snapshot_per_loan(a: Analogue) -> DataFrame:
    return _snapshot(a, per_loan=True)


def _snapshot(a: Analogue, per_loan: bool) -> DataFrame:
    return ledger_snapshot(
        a.pay(),
        a.bill(),
        a.loan(),
        a.loan2(),
        a.cb(),
        a.pastdue(),
        a.holidays(),
        AS_OF,
        per_loan=per_loan,
    )


# Stored tables


@_stores
@_query
def stored_statements(a: Analogue) -> DataFrame:
    """The statement spine as a table, filled with months and then brought up to date in place."""
    pay, bill = a.pay(), a.bill()
    spark, table = pay.sparkSession, f"statements_{uuid.uuid4().hex}"
    store_statements(bill, table, AS_OF, path=tables.new_folder(spark))
    update_months(pay, table, datetime(1996, 1, 1))
    update_months(pay, table, AS_OF)
    return spark.table(table).drop(tables.BUCKET)


@_stores
@_query
def copied_payments(a: Analogue) -> DataFrame:
    """Payments copied to a table of another database, added to, and read through a view."""
    pay = a.pay()
    spark, name, folder = pay.sparkSession, uuid.uuid4().hex, tables.new_folder(pay.sparkSession)
    spark.sql(f"create database if not exists copies_{name} location '{folder}'")
    early = "PaymentDate < date'1995-06-01'"
    tables.save_new(pay.filter(early), f"copies_{name}.payments", f"{folder}/payments")
    tables.append(pay.filter(f"not coalesce({early}, false)"), f"copies_{name}.payments")
    spark.table(f"copies_{name}.payments").createOrReplaceTempView(f"payments_{name}")
    return tables.read_table(spark, "pay", f"payments_{name}")


# Checks


@_query
def dq_duplicate_months(a: Analogue) -> DataFrame:
    return quality.duplicate_months(a.pay())


@_query
def dq_duplicate_month_dates(a: Analogue) -> DataFrame:
    return quality.duplicate_month_dates(a.pay()).orderBy("LoanID", "MonthNumber", "PaymentDate")


@_query
def dq_conflicting_dates(a: Analogue) -> DataFrame:
    return quality.conflicting_dates(a.pay())


@_query
def dq_date_mismatch(a: Analogue) -> DataFrame:
    return quality.date_mismatch(a.pay(), a.bill()).orderBy(
        "LoanID", "MonthNumber", "PaymentNumber", "PaymentDate", "BillDate"
    )


@_also("unknown_values")
@_query
def dq_payment_off_statement(a: Analogue) -> DataFrame:
    return quality.payment_off_statement(a.pay(), a.bill()).orderBy(
        "LoanID", "MonthNumber", "PaymentDate"
    )


@_query
def dq_length_mismatch(a: Analogue) -> DataFrame:
    return quality.length_mismatch(a.pay(), a.bill())


@_query
def dq_unaligned_payments(a: Analogue) -> DataFrame:
    return quality.unaligned_payments(a.pay(months=False), a.bill())


@_also("disordered_bills")
@_query
def dq_non_increasing_bills(a: Analogue) -> DataFrame:
    return quality.non_increasing_bills(a.bill())


# Lookups


@_query
def waived_principal(a: Analogue) -> DataFrame:
    return lookup.waived_principal(a.waiver())


@_query
def loan_detail_bill(a: Analogue) -> DataFrame:
    return lookup.loan_detail(a.bill(), LOAN)


@_query
def loan_detail_pay(a: Analogue) -> DataFrame:
    return lookup.loan_detail(a.pay(), LOAN)


@_query
def newest_activity(a: Analogue) -> DataFrame:
    return lookup.newest_activity(a.activity())


@_query
def newest_activity_of_one_loan(a: Analogue) -> DataFrame:
    return lookup.newest_activity(a.activity(), LOAN)
