"""Running totals and the blocked scans under them."""

import random
from contextvars import ContextVar
from decimal import Decimal

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tallyline.operators import scans, totals


def bill(number, principal="1.00", interest="0.10", loan="A", day="2020-01-01"):
    return {
        "LoanID": loan,
        "PaymentNumber": number,
        "PaymentDate": day,
        "PrincipalPayment": principal,
        "InterestPayment": interest,
    }


def test_bill_running_totals_follow_the_number(table):
    rows = table("bill", [bill(3, "4.00"), bill(1, "1.00"), bill(2, None)])
    result = totals.bill_running_totals(rows)
    assert as_set(result, "PaymentNumber", "SumPrincipal", "SumInterest") == [
        (1, "1.00", "0.10"),
        (2, "1.00", "0.20"),
        (3, "5.00", "0.30"),
    ]


def test_nothing_billed_before_the_first(table):
    rows = totals.billed_before(table("bill", [bill(1), bill(4), bill(9)]))
    assert as_set(rows, "PaymentNumber", "ScheduledPrincipalReceivedToDate") == [
        (1, None),
        (4, "1.00"),
        (9, "2.00"),
    ]


def test_chain_ends_at_a_gap_and_needs_number_one(table):
    rows = [bill(n) for n in (1, 2, 4, 5)] + [bill(n, loan="B") for n in (2, 3)]
    rows += [bill(n, loan="C") for n in (0, 1, 2)]
    result = totals.bill_chain_totals(table("bill", rows))
    assert as_set(result, "LoanID", "PaymentNumber", "SumPrincipal") == [
        ("A", 1, "1.00"),
        ("A", 2, "2.00"),
        ("C", 1, "1.00"),
        ("C", 2, "2.00"),
    ]


def test_chain_total_is_unknown_from_the_first_unknown_amount(table):
    rows = table("bill", [bill(1), bill(2, None), bill(3)])
    result = totals.bill_chain_totals(rows)
    assert as_set(result, "PaymentNumber", "SumPrincipal", "SumInterest") == [
        (1, "1.00", "0.10"),
        (2, None, "0.20"),
        (3, None, "0.30"),
    ]


@pytest.mark.parametrize("numbers", [(1, 1), (1, 2, 2), (1, 2, 2, 3)])
def test_chain_refuses_a_repeated_number(table, numbers):
    rows = table("bill", [bill(n) for n in numbers])
    with pytest.raises(Exception, match="PaymentNumber occurs twice in loan A"):
        totals.bill_chain_totals(rows).collect()


@pytest.mark.parametrize(
    ("numbers", "chain"), [((1, 2, 5, 5), [1, 2]), ((3, 3), []), ((2, 2), []), ((1, 3, 3), [1])]
)
def test_chain_ends_before_repeated_numbers_it_does_not_reach(table, numbers, chain):
    rows = table("bill", [bill(n) for n in numbers])
    assert [r[0] for r in as_set(totals.bill_chain_totals(rows), "PaymentNumber")] == chain


def test_chain_equals_running_totals_without_gaps(table):
    rng = random.Random(5)
    rows = [
        bill(n, f"{rng.randrange(10000) / 100:.2f}", loan=loan)
        for loan in "ABC"
        for n in range(1, 150)
    ]
    rng.shuffle(rows)
    data = table("bill", rows)
    running = totals.bill_running_totals(data)
    assert as_set(totals.bill_chain_totals(data), *running.columns) == as_set(running)


def test_payment_chain(table):
    pay = [
        {"LoanID": "A", "MonthNumber": n, "AmountPrincipal": "2.00", "AmountInterest": "0.50"}
        for n in (1, 2, 3, 3, 5, 5)
    ]
    result = totals.payment_running_totals(table("pay", pay))
    assert as_set(result, "MonthNumber", "SumPrincipal", "SumInterest") == [
        (1, "2.00", "0.50"),
        (2, "4.00", "1.00"),
        (3, "8.00", "2.00"),
    ]


def expected_total(rows, row, frame):
    same = [r for r in rows if r["LoanID"] == row["LoanID"]]
    number = row["PaymentNumber"]
    if frame == scans.BEFORE:
        same = [r for r in same if r["PaymentNumber"] < number]
    else:
        same = [r for r in same if r["PaymentNumber"] <= number]
    known = [Decimal(r["PrincipalPayment"]) for r in same if r["PrincipalPayment"]]
    return f"{sum(known):.2f}" if known else None


@pytest.mark.parametrize("size", [1, 8, 4096])
@pytest.mark.parametrize("frame", [scans.ROWS, scans.RANGE, scans.BEFORE])
def test_totals_across_blocks_equal_brute_force(table, monkeypatch, size, frame):
    monkeypatch.setattr(scans, "_ROWS_PER_BLOCK", ContextVar("rows", default=size))
    rng = random.Random(size)
    rows = []
    for loan in "ABC":
        numbers = rng.sample(range(-5, 60), 40)
        if frame == scans.RANGE:
            numbers += numbers[:10]
        for number in numbers:
            amount = None if rng.random() < 0.3 else f"{rng.randrange(10000) / 100:.2f}"
            rows.append(bill(number, amount, loan=loan))
    result = scans.running_totals(
        table("bill", rows),
        {"total": F.col("PrincipalPayment")},
        order=["PaymentNumber"],
        frame=frame,
    )
    assert as_set(result, "LoanID", "PaymentNumber", "total") == sorted(
        ((r["LoanID"], r["PaymentNumber"], expected_total(rows, r, frame)) for r in rows),
        key=repr,
    )
