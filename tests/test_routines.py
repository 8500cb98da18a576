"""SQL table functions, the recursion limit, stored statements and the collation of ids."""

import os
import re
from datetime import date, datetime

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tallyline.operators import align, lookup, quality, scans, totals
from tallyline.plans.ledger import analysis_ledger, cumulative_ledger
from tallyline.plans.routines import register_functions
from tallyline.plans.statement_table import store_statements, update_months
from tallyline.sources import tables
from tallyline.sources.contracts import same_spelling


def inputs(table, loans=("A", "B", "C")):
    day = [date(2020, 1 + n % 12, 1 + n // 12) for n in range(24)]
    bill = [
        {"LoanID": loan, "PaymentNumber": n + 1, "PaymentDate": d, "PrincipalPayment": "5.00"}
        for loan in loans
        for n, d in enumerate(sorted(day))
    ]
    pay = [
        {
            "LoanID": loan,
            "MonthNumber": n,
            "PaymentDate": d,
            "Status": ("posted", "scheduled", "past_due", None)[n % 4],
            "AmountPrincipal": f"{n}.25",
            "AmountInterest": f"0.{n:02d}",
        }
        for loan in loans
        for n, d in enumerate(day)
    ]
    loan = [{"LoanID": i, "Classification": f"Tier{i}", "Rate": "5", "PAInterestRate": "1"} for i in loans]
    cb = [{"LoanID": loans[0], "AccountStatus": "97", "TermsDuration": 36}]
    return table("pay", pay), table("bill", bill), table("loan", loan), table("cb", cb)


@pytest.mark.parametrize("size", [4, 1 << 18])
def test_sql_functions_equal_the_calls(spark, table, size):
    given = inputs(table)
    with scans.rows_per_block(size):
        register_functions(spark, *given)
    as_of = datetime(2020, 7, 1, 12)
    for sql, expected in (
        (f"cumulative_ledger(as_of => timestamp_ntz'{as_of}')", cumulative_ledger(*given, as_of)),
        ("cumulative_ledger()", cumulative_ledger(*given)),
        ("cumulative_ledger(date'2020-07-01')", cumulative_ledger(*given, date(2020, 7, 1))),
        ("ledger_analysis()", analysis_ledger(*given)),
        ("ledger_analysis(loan_id => 'B')", analysis_ledger(*given, loan_id="B")),
    ):
        found = spark.sql(f"select * from {sql}")
        assert found.schema.simpleString() == expected.schema.simpleString()
        assert as_set(found) == as_set(expected) != []
    joined = spark.sql(
        "select count(*) from cumulative_ledger(as_of => :day) l join ledger_entries e "
        "using (LoanID, MonthNumber, Status)",
        args={"day": as_of},
    )
    assert joined.first()[0] > 0


def test_function_arguments_and_filters_reach_the_files(spark, table, tmp_path):
    stored = []
    for name, frame in zip(("pay", "bill", "loan", "cb"), inputs(table)):
        frame.write.parquet(str(tmp_path / name))
        stored.append(tables.read_path(spark, name, str(tmp_path / name)))
    register_functions(spark, *stored)
    for sql in ("ledger_analysis(loan_id => 'B')", "cumulative_ledger() where LoanID = 'B'"):
        plan = spark.sql(f"select * from {sql}")._jdf.queryExecution().executedPlan().toString()
        pay = [line for line in plan.splitlines() if "AmountPrincipal" in line and "FileScan" in line]
        assert pay and any("EqualTo(LoanID,B)" in line for line in pay)


def chain(table, n):
    rows = [
        {"LoanID": "A", "PaymentNumber": i, "PrincipalPayment": "1.50", "InterestPayment": "0.10"}
        for i in range(1, n + 1)
    ]
    return table("bill", rows + [{**rows[0], "LoanID": "B"}])


def test_chain_step_by_step_equals_the_window(table):
    bill = chain(table, 7)
    steps = totals.bill_chain_of_loan(bill, "A")
    window = totals.bill_chain_totals(bill).filter("LoanID = 'A'")
    assert as_set(steps, *window.columns) == as_set(window) != []
    assert dict(steps.dtypes) == dict(window.dtypes)


def test_a_chain_past_the_limit_is_an_error(table):
    bill = chain(table, 11)
    assert totals.bill_chain_of_loan(bill, "A", levels=11).count() == 11
    assert len(totals.bill_chain_totals(bill, levels=11).collect()) == 12
    with pytest.raises(Exception, match="RECURSION_LEVEL_LIMIT_EXCEEDED"):
        totals.bill_chain_of_loan(bill, "A", levels=10).collect()
    with pytest.raises(Exception, match="more than 10 levels in loan A"):
        totals.bill_chain_totals(bill, levels=10).collect()


@pytest.mark.parametrize("levels, passes", [(100, False), (101, True)])
def test_the_limit_of_the_source(table, levels, passes):
    bill = chain(table, 101)
    assert totals.MAX_LEVELS == 100
    result = totals.bill_chain_totals(bill, levels=levels)
    if passes:
        assert len(result.collect()) == 102
    else:
        with pytest.raises(Exception, match="more than 100 levels"):
            result.collect()


def files(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    }


def test_statements_are_updated_in_place(spark, table, tmp_path):
    loans = tuple(f"loan {i}" for i in range(12))
    pay, bill, _, _ = inputs(table, loans)
    path = str(tmp_path / "statements")
    store_statements(bill, "statements_in_place", date(2020, 12, 31), buckets=8, path=path)
    stored = spark.table("statements_in_place")
    assert stored.filter("MonthNumber is not null").isEmpty()

    update_months(pay, "statements_in_place", date(2020, 12, 31))
    first = as_set(spark.table("statements_in_place"))
    assert {row[1] for row in first} == {23}
    # Run again, as after a failure: the same table.
    update_months(pay, "statements_in_place", date(2020, 12, 31))
    assert as_set(spark.table("statements_in_place")) == first

    before = files(path)
    one = pay.filter("LoanID = 'loan 3'")
    update_months(one, "statements_in_place", date(2020, 3, 1), loans=one)
    after = files(path)
    bucket = spark.table("statements_in_place").filter("LoanID = 'loan 3'").first()[tables.BUCKET]
    kept = {f for f in before if f"{tables.BUCKET}={bucket}/" not in f}
    assert kept and all(after.get(f) == before[f] for f in kept)
    assert not {f for f in before if f not in kept} & set(after)
    months = {(r.LoanID, r.MonthNumber) for r in spark.table("statements_in_place").collect()}
    assert {m for i, m in months if i == "loan 3"} == {13}
    assert {m for i, m in months if i != "loan 3"} == {23}
    assert len(as_set(spark.table("statements_in_place"))) == len(first)


def test_only_tables_stored_by_loan_are_updated(spark, table, tmp_path):
    pay, bill, _, _ = inputs(table)
    tables.save_new(bill, "plain_bills", str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="not stored by loan"):
        tables.update_loans("plain_bills", pay, lambda rows: rows)


def test_ids_are_compared_as_the_source_does(spark, table):
    pay = table("pay", [{"LoanID": i, "PaymentDate": "2020-01-05", "Status": "posted", "Amount": "1.00"} for i in ("a", "A ", "B", "b  ", "c")])
    bill = table("bill", [{"LoanID": i, "PaymentNumber": n, "PaymentDate": d} for i, n, d in (("A", 1, "2020-01-01"), ("a  ", 2, "2020-02-01"), ("b", 1, "2020-01-05"))])
    exact = align.align_payments_to_statements(pay, bill)
    assert as_set(exact, "LoanID", "MonthNumber", "Amount") == []
    pay, bill = same_spelling(pay), same_spelling(bill)
    for size in (1, 1 << 18):
        with scans.rows_per_block(size):
            aligned = align.align_payments_to_statements(pay, bill)
            running = totals.bill_running_totals(bill)
        rows = aligned.select(F.upper(F.rtrim(F.expr("cast(LoanID as string collate UTF8_BINARY)"))).alias("i"), "MonthNumber", "Amount")
        assert as_set(rows) == [("A", 1, "2.00"), ("B", 1, "2.00")]
        assert running.count() == 3
    followed = {r.PaymentNumber: str(r.PaymentDateNext) for r in align.next_bill_date(bill).filter("LoanID = 'A'").collect()}
    assert followed == {1: "2020-02-01", 2: "9999-12-31"}
    assert lookup.loan_detail(pay, "B ").count() == 2
    assert pay.groupBy("LoanID").count().count() == 3
    off = quality.payment_off_statement(pay, bill)
    assert sorted(r.LoanID.strip().upper() for r in off.collect()) == ["A", "A", "C"]


def test_ids_are_read_as_asked(spark, table, tmp_path):
    path = str(tmp_path / "bill")
    table("bill", [{"LoanID": "A ", "PaymentNumber": 1}]).write.parquet(path)
    exact = tables.read_path(spark, "bill", path).filter("LoanID = 'a'")
    alike = tables.read_path(spark, "bill", path, as_source=True).filter("LoanID = 'a'")
    assert (exact.count(), alike.count()) == (0, 1)
    plan = exact._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(LoanID,a\)", plan)
