"""The cumulative ledger."""

from datetime import date, datetime

import pytest
from conftest import as_set

from tallyline.functions import columns
from tallyline.plans.ledger import analysis_ledger, cumulative_ledger, masked_amounts

BILLS = [
    {"LoanID": "A", "PaymentNumber": 1, "PaymentDate": "2020-01-01"},
    {"LoanID": "A", "PaymentNumber": 2, "PaymentDate": "2020-02-01"},
]


def payment(day, status, principal, interest="1.00", loan="A", effective=None):
    return {
        "LoanID": loan,
        "PaymentDate": day,
        "EffectiveDate": effective,
        "Status": status,
        "AmountPrincipal": principal,
        "AmountInterest": interest,
    }


PAYMENTS = [
    payment("2020-01-03", "past_due", "5.00"),
    payment("2020-01-02", "posted", "10.00"),
    payment("2020-01-04", "scheduled", "20.00"),
    payment("2020-01-20", None, "40.00"),
    payment("2020-02-02", "posted", "80.00"),
    payment("2020-02-09", "past_due", "160.00"),
]


@pytest.fixture
def terms(table):
    loan = table(
        "loan",
        [
            {
                "LoanID": "A",
                "Classification": "Grade B",
                "OriginalAmount": "1000.00",
                "Rate": "5.2550",
                "PAInterestRate": "3.0000",
            }
        ],
    )
    cb = table("cb", [{"LoanID": "A", "AccountStatus": "11", "TermsDuration": 36}])
    return loan, cb


def ledger(table, terms, as_of, pay=PAYMENTS, bill=BILLS):
    return cumulative_ledger(table("pay", pay), table("bill", bill), *terms, as_of)


def test_totals_and_masked_amounts(table, terms):
    rows = ledger(table, terms, datetime(2021, 1, 1)).collect()
    shown = [
        (
            r.MonthNumber,
            r.Status,
            str(r.AmountPrincipal),
            str(r.PrincipalDue),
            str(r.PrincipalReceivedToDate),
            str(r.ScheduledPrincipalReceivedToDate),
            r.NumberOfStatementPastDue,
        )
        for r in rows
    ]
    # Within a statement by earliest payment; an unknown status counts as
    # scheduled only; a past-due amount is hidden but counted.
    assert shown == [
        (1, "posted", "10.00", "0.00", "10.00", "10.00", 0),
        (1, "past_due", "0.00", "5.00", "10.00", "15.00", 1),
        (1, "scheduled", "20.00", "25.00", "10.00", "35.00", 1),
        (1, None, "0.00", "25.00", "10.00", "75.00", 1),
        (2, "posted", "80.00", "25.00", "90.00", "155.00", 1),
        (2, "past_due", "0.00", "185.00", "90.00", "315.00", 2),
    ]
    assert {(r.Tier, r.Term, str(r.LoanAmount), str(r.InterestRate)) for r in rows} == {
        ("B", 36, "1000.00", "0.0526")
    }


def test_due_and_received_add_up_to_scheduled(table, terms):
    known = [p for p in PAYMENTS if p["Status"]]
    for row in ledger(table, terms, datetime(2021, 1, 1), pay=known).collect():
        assert row.PrincipalDue + row.PrincipalReceivedToDate == (
            row.ScheduledPrincipalReceivedToDate
        )
        assert row.InterestDue + row.InterestReceivedToDate == row.ScheduledInterestReceivedToDate


def test_cut_is_on_the_earliest_payment_and_keeps_the_group_whole(table, terms):
    pay = [payment("2020-01-02", "posted", "1.00"), payment("2020-01-30", "posted", "2.00")]
    rows = ledger(table, terms, datetime(2020, 1, 10), pay=pay)
    assert as_set(rows, "AmountPrincipal") == [("3.00",)]


@pytest.mark.parametrize(
    "as_of, kept",
    [
        (datetime(2020, 1, 2), 0),
        (datetime(2020, 1, 2, 0, 0, 1), 1),
        (date(2020, 1, 2), 0),
        (date(2020, 1, 3), 1),
        (None, 1),
    ],
)
def test_as_of_edges(table, terms, as_of, kept):
    pay = [payment("2020-01-02", "posted", "1.00")]
    assert ledger(table, terms, as_of, pay=pay).count() == kept


def test_tie_order_is_effective_date_then_status(table, terms):
    pay = [
        payment("2020-01-02", "scheduled", "1.00", effective="2020-01-09"),
        payment("2020-01-02", "posted", "2.00", effective="2020-01-09"),
        payment("2020-01-02", "past_due", "4.00", effective="2020-01-10"),
        payment("2020-01-02", None, "8.00"),
    ]
    rows = ledger(table, terms, None, pay=pay).collect()
    assert [r.Status for r in rows] == [None, "posted", "scheduled", "past_due"]
    assert [str(r.ScheduledPrincipalReceivedToDate) for r in rows] == [
        "8.00",
        "10.00",
        "11.00",
        "15.00",
    ]


def test_loans_without_terms_keep_their_rows(table, terms):
    bill = [{**row, "LoanID": "B"} for row in BILLS]
    pay = [{**row, "LoanID": "B"} for row in PAYMENTS]
    rows = ledger(table, terms, None, pay=pay, bill=bill)
    assert rows.count() == 6
    assert as_set(rows.distinct(), "Tier", "Term", "InterestRate")[0] == (None, None, None)


def test_only_one_of_credit_and_loan_known(table, terms):
    loan, cb = terms
    empty = loan.filter("false")
    rows = cumulative_ledger(table("pay", PAYMENTS), table("bill", BILLS), empty, cb)
    assert {(r.Tier, r.Term) for r in rows.collect()} == {(None, 36)}


class Clock(datetime):
    @classmethod
    def now(cls):
        return cls(2020, 2, 2, 12)


@pytest.mark.parametrize(("clock", "days"), [(Clock, 2), (datetime, 3)])
def test_the_cut_is_now_by_default(table, terms, monkeypatch, clock, days):
    """A statement counts by its earliest payment: those after the clock's day are left out."""
    monkeypatch.setattr("tallyline.functions.columns.datetime", clock)
    bills = [*BILLS, {"LoanID": "A", "PaymentNumber": 3, "PaymentDate": "2020-03-01"}]
    pay = [payment(d, "posted", "1.00") for d in ("2020-01-02", "2020-02-02", "2020-03-02")]
    assert ledger(table, terms, None, pay, bills).count() == days


def test_the_day_is_today_by_default(monkeypatch):
    monkeypatch.setattr("tallyline.functions.columns.datetime", Clock)
    assert columns.day_of(None) == date(2020, 2, 2)
    assert columns.as_of_cut(None) == date(2020, 2, 3)


@pytest.mark.parametrize("name", ["loan", "cb"])
def test_a_repeated_loan_is_an_error(table, terms, name):
    loan, cb = terms
    if name == "loan":
        loan = loan.union(loan)
    else:
        cb = cb.union(cb)
    with pytest.raises(Exception, match=f"{name}: more than one row for LoanID A"):
        cumulative_ledger(table("pay", PAYMENTS), table("bill", BILLS), loan, cb).collect()


def test_analysis_ledger_shows_all_amounts_without_cut(table, terms):
    pay = [*PAYMENTS, payment("2099-01-01", "past_due", "7.00")]
    rows = analysis_ledger(table("pay", pay), table("bill", BILLS), *terms).collect()
    assert [str(r.AmountPrincipal) for r in rows] == [
        "10.00",
        "5.00",
        "20.00",
        "40.00",
        "80.00",
        "167.00",
    ]


def test_analysis_ledger_of_one_loan_equals_its_part(table, terms):
    other = [{**row, "LoanID": "B"} for row in BILLS]
    paid = [{**row, "LoanID": "B"} for row in PAYMENTS]
    pay, bill = table("pay", PAYMENTS + paid), table("bill", BILLS + other)
    one = analysis_ledger(pay, bill, *terms, loan_id="A")
    everything = analysis_ledger(pay, bill, *terms)
    assert as_set(one) == as_set(everything.filter("LoanID = 'A'"))


def test_masked_amounts(table):
    shown = masked_amounts(table("pay", PAYMENTS), table("bill", BILLS))
    assert as_set(shown, "MonthNumber", "Status", "AmountPrincipal") == sorted(
        [
            (1, "past_due", "0.00"),
            (1, "posted", "10.00"),
            (1, "scheduled", "20.00"),
            (1, None, "0.00"),
            (2, "past_due", "0.00"),
            (2, "posted", "80.00"),
        ],
        key=repr,
    )
