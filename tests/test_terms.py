"""Rates, delinquency bands, reported status and business days."""

from datetime import date, timedelta

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tallyline.functions import columns as c
from tallyline.functions.business_days import (
    nth_previous_business_day,
    previous_business_days,
)
from tallyline.operators import terms

DAY = date(2020, 6, 30)


@pytest.mark.parametrize(
    "percent, fraction",
    [("5.2550", "0.0526"), ("-5.2550", "-0.0526"), ("5.2549", "0.0525"), (None, None)],
)
def test_percent_to_fraction_rounds_half_up(spark, percent, fraction):
    row = spark.range(1).select(
        c.percent_to_fraction(F.lit(percent).cast("decimal(9,4)")).alias("r")
    )
    assert as_set(row) == [(fraction,)]


@pytest.mark.parametrize("text, tier", [("Grade B", "B"), ("", ""), (None, None)])
def test_tier_is_the_last_character(spark, text, tier):
    rows = spark.createDataFrame([(text,)], "Classification string").select(c.tier())
    assert rows.first()[0] == tier


def loan(loan_id, **more):
    return {"LoanID": loan_id, "Rate": "10.0000", "PAInterestRate": "4.0000", **more}


def rates(table, cb, loan2):
    ids = sorted({row["LoanID"] for row in cb})
    loans = table("loan", [loan(i) for i in ids])
    result = terms.effective_rates_modified(loans, table("loan2", loan2), table("cb", cb), DAY)
    return dict(as_set(result))


def period(loan_id, start, end):
    return {"LoanID": loan_id, "U_LoanModRateEffDt": start, "ETL_LoanModRateEndDt": end}


def test_effective_rate_with_and_without_modification(table):
    cb = [
        {"LoanID": i, "AccountStatus": "97" if i == "charged" else "11"}
        for i in ("charged", "first", "last", "past", "open", "none")
    ]
    loan2 = [
        period("first", DAY, "2021-01-01"),
        period("last", "2020-01-01", DAY),
        period("past", "2020-01-01", "2020-06-29"),
        period("open", "2020-01-01", None),
    ]
    assert rates(table, cb, loan2) == {
        "charged": "0.0400",
        "first": "0.0400",
        "last": "0.0400",
        "past": "0.1000",
        "open": "0.1000",
        "none": "0.1000",
    }
    loans = table("loan", [loan(row["LoanID"]) for row in cb])
    plain = dict(as_set(terms.effective_rates(loans, table("cb", cb))))
    assert {i for i, rate in plain.items() if rate == "0.0400"} == {"charged"}


@pytest.mark.parametrize(
    "days, band",
    [
        (1, "Current"),
        (29, "Current"),
        (30, "Delinquent 1 Payment"),
        (59, "Delinquent 1 Payment"),
        (60, "Seriously Delinquent 2 Payments"),
        (89, "Seriously Delinquent 2 Payments"),
        (90, "Seriously Delinquent 3+ Payments"),
        (4000, "Seriously Delinquent 3+ Payments"),
    ],
)
def test_band_edges(table, days, band):
    unpaid = [{"LoanID": "A", "PastDueDate": DAY - timedelta(days=d)} for d in (days, 0, -10)]
    result = terms.delinquency_bucket(table("loan", [loan("A")]), table("pastdue", unpaid), DAY)
    assert as_set(result, "DaysPastDue", "Band") == [(days, band)]


def test_no_unpaid_bill_is_current(table):
    same_day = [{"LoanID": "A", "PastDueDate": DAY}]
    result = terms.delinquency_bucket(table("loan", [loan("A")]), table("pastdue", same_day), DAY)
    assert as_set(result) == [("A", None, 0, "Current")]


def status(table, loan_rows, loan2=(), cb=(), pastdue=(), posted=date(2020, 6, 23)):
    result = terms.loan_status(
        table("loan", loan_rows),
        table("loan2", list(loan2)),
        table("cb", list(cb)),
        table("pastdue", list(pastdue)),
        DAY,
        F.lit(posted),
    )
    return dict(as_set(result))


def forborne(loan_id, start="2020-01-01", end="2020-12-31", **more):
    return {
        "LoanID": loan_id,
        "ETL_LoanModForbearEffDt": start,
        "ETL_LoanModForbearEndDt": end,
        **more,
    }


def test_status_priority(table):
    late = "2020-01-01"
    names = ("paid", "early", "charged", "settled", "forborne", "expired", "late", "good")
    result = status(
        table,
        [
            loan(n, PaidOffDate={"paid": "2020-06-23", "early": "2020-06-24"}.get(n))
            for n in names
        ],
        loan2=[
            forborne("paid", U_PortMoveCode="DS"),
            forborne("charged", U_PortMoveCode="DS"),
            forborne("settled", U_PortMoveCode="ds "),
            forborne("forborne"),
            forborne("expired", end="2020-06-29"),
        ],
        cb=[
            {"LoanID": "paid", "AccountStatus": "97"},
            {"LoanID": "charged", "AccountStatus": "97"},
            {"LoanID": "late", "AccountStatus": "93"},
        ],
        pastdue=[{"LoanID": n, "PastDueDate": late} for n in names if n not in ("good", "early")],
    )
    assert result == {
        "paid": "Paid In Full",
        "early": "Current",
        "charged": "Charge off",
        "settled": "Debt Settlement",
        "forborne": "Current",
        "expired": "Seriously Delinquent 3+ Payments",
        "late": "Seriously Delinquent 3+ Payments",
        "good": "Current",
    }


def previous(spark, table, day, n, *holidays):
    closed = table("holiday", [{"HolidayDate": h} for h in holidays])
    return spark.range(1).select(nth_previous_business_day(spark, day, n, closed)).first()[0]


def test_business_days_skip_weekends_and_holidays(spark, table):
    monday = date(2020, 6, 29)
    assert previous(spark, table, monday, 1) == date(2020, 6, 26)
    assert previous(spark, table, monday, 5) == date(2020, 6, 22)
    assert previous(spark, table, monday, 5, "2020-06-24") == date(2020, 6, 19)
    # A weekend holiday, one after the day, and the day itself change nothing.
    assert previous(spark, table, monday, 5, "2020-06-27", "2020-07-01", monday) == date(
        2020, 6, 22
    )


def test_a_long_closure_is_looked_past(spark, table):
    closure = [date(2020, 3, 1) + timedelta(days=n) for n in range(110)]
    assert previous(spark, table, date(2020, 6, 20), 3, *closure) == date(2020, 2, 27)


def test_business_days_of_many_days_equal_brute_force(spark, table):
    holidays = {date(2020, 1, 1), date(2020, 5, 1), date(2020, 12, 25)}
    days = [date(2020, 1, 1) + timedelta(days=n) for n in range(0, 366)]
    data = spark.createDataFrame([(d,) for d in days * 2], "Day date")
    result = previous_business_days(
        data, "Day", 4, table("holiday", [{"HolidayDate": h} for h in holidays])
    )

    def walk(day):
        left = 4
        while left:
            day -= timedelta(days=1)
            left -= day.weekday() < 5 and day not in holidays
        return day.isoformat()

    assert as_set(result) == sorted((d.isoformat(), walk(d)) for d in days)
