"""Checks on the inputs, and lookups."""

import pytest
from conftest import as_set

from tallyline.operators import lookup, quality


def pay(loan, month, day):
    return {"LoanID": loan, "MonthNumber": month, "PaymentDate": day}


def bill(loan, number, day):
    return {"LoanID": loan, "PaymentNumber": number, "PaymentDate": day}


PAY = [
    pay("A", 1, "2020-01-01"),
    pay("A", 1, "2020-01-01"),
    pay("A", 1, "2020-01-02"),
    pay("A", 1, None),
    pay("A", None, "2020-01-03"),
    pay("A", None, "2020-01-04"),
    pay("A", 2, "2020-02-01"),
    pay("B", 1, "2020-01-01"),
    pay("B", 3, None),
    pay("C", 1, "2020-01-01"),
    pay("C", 2, None),
    pay("D", 1, "2020-01-09"),
    pay("D", 2, None),
]
BILL = [
    bill("A", 1, "2020-01-01"),
    bill("A", 2, "2020-02-02"),
    bill("B", 1, "2020-01-05"),
    bill("B", 2, None),
    bill("C", 1, "2020-01-01"),
    bill("E", 1, "2020-01-01"),
]


@pytest.fixture
def inputs(table):
    return table("pay", PAY), table("bill", BILL)


def test_duplicate_months(inputs):
    assert as_set(quality.duplicate_months(inputs[0])) == sorted(
        [("A", 1, 4), ("A", None, 2)], key=repr
    )


def test_duplicate_month_dates(inputs):
    assert as_set(quality.duplicate_month_dates(inputs[0])) == [("A", 1, "2020-01-01", 2)]


def test_conflicting_dates_count_the_pairs(spark, inputs):
    found = quality.conflicting_dates(inputs[0])
    assert as_set(found) == [("A", 1, "2020-01-01", 2, 1), ("A", 1, "2020-01-02", 1, 2)]
    inputs[0].createOrReplaceTempView("p")
    pairs = spark.sql(
        """select a.LoanID from p a join p b on a.LoanID = b.LoanID
           and a.MonthNumber = b.MonthNumber and a.PaymentDate <> b.PaymentDate"""
    )
    assert pairs.count() == sum(row.Rows * row.OtherRows for row in found.collect())


def test_date_mismatch(inputs):
    assert as_set(quality.date_mismatch(*inputs)) == [
        ("A", 1, 1, "2020-01-02", "2020-01-01"),
        ("A", 2, 2, "2020-02-01", "2020-02-02"),
        ("B", 1, 1, "2020-01-01", "2020-01-05"),
    ]


def test_payment_off_statement_follows_not_in(spark, inputs):
    found = as_set(quality.payment_off_statement(*inputs))
    # Loan B has a bill without a date; loan D has no bill at all.
    assert found == sorted(
        [
            ("A", 1, "2020-01-02"),
            ("A", None, "2020-01-03"),
            ("A", None, "2020-01-04"),
            ("A", 2, "2020-02-01"),
            ("D", 1, "2020-01-09"),
            ("D", 2, None),
        ],
        key=repr,
    )
    for name, df in zip(("p", "b"), inputs):
        df.createOrReplaceTempView(name)
    direct = spark.sql(
        """select LoanID, MonthNumber, PaymentDate from p where PaymentDate not in
           (select PaymentDate from b where b.LoanID = p.LoanID)"""
    )
    assert found == as_set(direct)


@pytest.mark.parametrize("unknown", ["pay", "bill", "both"])
def test_payment_off_statement_of_unknown_loans(spark, unknown):
    pay = [("A", 1, "2020-01-02"), ("A", 2, "2020-01-01")]
    bills = [("A", "2020-01-01")]
    if unknown != "bill":
        pay += [(None, 1, "2020-01-01"), (None, 1, None), (None, None, "2020-01-01")]
    if unknown != "pay":
        bills += [(None, "2020-01-01"), (None, None)]
    p = spark.createDataFrame(pay, "LoanID string, MonthNumber int, PaymentDate string")
    b = spark.createDataFrame(bills, "LoanID string, PaymentDate string")
    p.createOrReplaceTempView("p")
    b.createOrReplaceTempView("b")
    direct = spark.sql(
        """select LoanID, MonthNumber, PaymentDate from p where PaymentDate not in
           (select PaymentDate from b where b.LoanID = p.LoanID)"""
    )
    assert as_set(quality.payment_off_statement(p, b)) == as_set(direct)


def test_length_mismatch(inputs):
    assert as_set(quality.length_mismatch(*inputs)) == [("B", 2, 3), ("C", 1, 2)]


def test_unaligned_payments(inputs):
    assert as_set(quality.unaligned_payments(*inputs)) == [
        ("A", 1),
        ("B", 2),
        ("C", 1),
        ("D", 2),
    ]


def test_non_increasing_bills(table):
    rows = [bill("A", n, d) for n, d in enumerate(["2020-01-01", "2020-01-01", "2020-03-01"])]
    rows += [bill("B", 1, "2020-02-01"), bill("B", 2, "2020-01-01"), bill("C", 1, None)]
    found = quality.non_increasing_bills(table("bill", rows))
    assert as_set(found) == [("A", 0, "2020-01-01", "2020-01-01"), ("B", 1, "2020-02-01", "2020-01-01")]


def test_waived_principal(table):
    rows = [{"LoanID": "A", "PrincipalWaived": v} for v in ("1.50", None, "2.00")]
    waived = lookup.waived_principal(table("waiver", [*rows, {"LoanID": "B"}]))
    assert as_set(waived) == [("A", "3.50"), ("B", "0.00")]


def test_detail_of_one_loan(inputs):
    assert lookup.loan_detail(inputs[1], "A").count() == 2
    assert lookup.loan_detail(inputs[1]).count() == len(BILL)


def test_newest_activity_first(spark):
    rows = [("A", d) for d in ("2020-01-01", None, "2020-03-01")] + [("B", "2021-01-01")]
    activity = spark.createDataFrame(rows, "LoanID string, ActivityDate string")
    activity = activity.withColumn("ActivityDate", activity.ActivityDate.cast("date"))
    assert [str(r.ActivityDate) for r in lookup.newest_activity(activity, "A").collect()] == [
        "2020-03-01",
        "2020-01-01",
        "None",
    ]
