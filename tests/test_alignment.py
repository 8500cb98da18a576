"""Statement periods and the placement of payments."""

import random
from contextvars import ContextVar
from datetime import date, timedelta

import pytest
from conftest import as_set

from tallyline.operators import align, scans


def bills(*dates, loan="A"):
    return [
        {"LoanID": loan, "PaymentNumber": n, "PaymentDate": d} for n, d in enumerate(dates, start=1)
    ]


def pays(*dates, loan="A", **more):
    return [{"LoanID": loan, "PaymentDate": d, "Status": "posted", **more} for d in dates]


def months(table, pay_rows, bill_rows):
    placed = align.align_rows(table("pay", pay_rows), table("bill", bill_rows))
    return as_set(placed, "PaymentDate", "MonthReal")


def test_periods_are_half_open_and_the_last_is_open_ended(table):
    bill = bills("2020-01-01", "2020-02-01")
    pay = pays("2020-01-01", "2020-01-31", "2020-02-01", "2031-05-05")
    assert months(table, pay, bill) == [
        ("2020-01-01", 1),
        ("2020-01-31", 1),
        ("2020-02-01", 2),
        ("2031-05-05", 2),
    ]


def test_payments_outside_all_periods_disappear(table):
    pay = pays("2019-12-31", None) + pays("2020-01-05", loan="no bills")
    assert months(table, pay, bills("2020-01-01")) == []


def test_next_bill_without_a_date_leaves_the_period_open(table):
    bill = bills("2020-01-01", None, "2020-03-01")
    followed = align.next_bill_date(table("bill", bill))
    assert as_set(followed, "PaymentNumber", "PaymentDateNext") == [
        (1, "9999-12-31"),
        (2, "2020-03-01"),
        (3, "9999-12-31"),
    ]
    assert months(table, pays("2020-02-01", "2020-04-01"), bill) == [
        ("2020-02-01", 1),
        ("2020-04-01", 1),
        ("2020-04-01", 3),
    ]


def test_two_bills_on_one_day_leave_the_first_empty(table):
    bill = bills("2020-01-01", "2020-01-01", "2020-02-01")
    assert months(table, pays("2020-01-01"), bill) == [("2020-01-01", 2)]


def test_falling_bill_dates_make_periods_overlap(table):
    bill = bills("2020-01-01", "2020-03-01", "2020-02-01")
    assert months(table, pays("2020-02-15"), bill) == [("2020-02-15", 1), ("2020-02-15", 3)]


def test_every_payment_column_is_kept(table):
    pay = table("pay", pays("2020-01-05", MonthNumber=7, Amount="1.50"))
    placed = align.align_rows(pay, table("bill", bills("2020-01-01")))
    assert placed.columns == [*pay.columns, "MonthReal"]
    row = placed.first()
    assert (row.MonthNumber, str(row.Amount), row.MonthReal) == (7, "1.50", 1)


def test_collapse_by_statement_and_status(table):
    rows = [
        ("2020-01-10", "2020-01-12", "posted", "10.00", "500.00"),
        ("2020-01-05", "2020-01-15", "posted", None, "400.00"),
        ("2020-01-07", None, "past_due", None, None),
        ("2020-02-07", None, None, "3.00", None),
    ]
    pay = [
        dict(
            LoanID="A",
            PaymentDate=day,
            EffectiveDate=effective,
            Status=status,
            AmountPrincipal=principal,
            AmountPrincipalRemaining=remaining,
            OriginalAmount=remaining,
        )
        for day, effective, status, principal, remaining in rows
    ]
    aligned = align.align_payments_to_statements(
        table("pay", pay), table("bill", bills("2020-01-01", "2020-02-01"))
    )
    assert as_set(
        aligned,
        "MonthNumber",
        "Status",
        "PaymentDate",
        "EffectiveDate",
        "AmountPrincipal",
        "AmountPrincipalRemaining",
        "Amount",
    ) == sorted(
        [
            (1, "posted", "2020-01-05", "2020-01-15", "10.00", "400.00", "0.00"),
            (1, "past_due", "2020-01-07", None, "0.00", None, "0.00"),
            (2, None, "2020-02-07", None, "3.00", None, "0.00"),
        ],
        key=repr,
    )


def test_codes_are_normalised(table):
    pay = pays("2020-01-05", "2020-01-06") + pays("2020-01-07", "2020-01-08")
    for row, status in zip(pay, ("Posted", "posted ", "POSTED", "posted")):
        row["Status"] = status
    aligned = align.align_payments_to_statements(
        table("pay", pay), table("bill", bills("2020-01-01"))
    )
    assert as_set(aligned, "Status") == [("posted",)]


def random_inputs(seed):
    """Bills with gaps, ties, missing and disordered dates, over many blocks."""
    rng = random.Random(seed)
    start = date(2020, 1, 1)
    bill, pay = [], []
    for loan in ("ordered", "disordered", "tied", "missing", "repeated"):
        numbers = sorted(rng.sample(range(1, 60), 30))
        if loan == "repeated":
            numbers = sorted(numbers + numbers[::2])
        days = [rng.randrange(0, 400) for _ in numbers]
        if loan not in ("disordered", "repeated"):
            days.sort()
        if loan == "tied":
            days = [d // 90 * 90 for d in days]
        for number, offset in zip(numbers, days):
            missing = loan == "missing" and rng.random() < 0.3
            bill.append(
                {
                    "LoanID": loan,
                    "PaymentNumber": number,
                    "PaymentDate": None if missing else start + timedelta(days=offset),
                }
            )
        for _ in range(60):
            day = start + timedelta(days=rng.randrange(-20, 450))
            pay.append(
                {
                    "LoanID": loan,
                    "PaymentDate": None if rng.random() < 0.05 else day,
                    "Status": rng.choice(["posted", "scheduled", "past_due", None]),
                    "AmountPrincipal": rng.choice([None, f"{rng.randrange(9999) / 100:.2f}"]),
                }
            )
    rng.shuffle(bill)
    rng.shuffle(pay)
    return pay, bill


def expected_placements(pay, bill):
    """Brute force: each payment against each period."""
    placed = []
    for loan in {row["LoanID"] for row in bill}:
        ordered = sorted(
            (row for row in bill if row["LoanID"] == loan),
            key=lambda row: (row["PaymentNumber"], row["PaymentDate"] or date.min),
        )
        ends = [row["PaymentDate"] or date(9999, 12, 31) for row in ordered[1:]]
        for row, end in zip(ordered, [*ends, date(9999, 12, 31)]):
            for payment in pay:
                day = payment["PaymentDate"]
                if payment["LoanID"] == loan and day and row["PaymentDate"]:
                    if row["PaymentDate"] <= day < end:
                        placed.append((loan, day.isoformat(), row["PaymentNumber"]))
    return sorted(placed, key=repr)


@pytest.mark.parametrize("size", [1, 4, 4096])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_placement_equals_brute_force(table, monkeypatch, size, seed):
    monkeypatch.setattr(scans, "_ROWS_PER_BLOCK", ContextVar("rows", default=size))
    pay, bill = random_inputs(seed)
    placed = align.align_rows(table("pay", pay), table("bill", bill))
    assert as_set(placed, "LoanID", "PaymentDate", "MonthReal") == expected_placements(pay, bill)


def test_order_of_the_input_does_not_matter(table):
    pay, bill = random_inputs(4)
    first = align.align_payments_to_statements(table("pay", pay), table("bill", bill))
    second = align.align_payments_to_statements(
        table("pay", pay[::-1]).repartition(7), table("bill", bill[::-1]).repartition(3)
    )
    assert as_set(first) == as_set(second, *first.columns)


def shuffled_rows(df):
    """What each shuffle of an executed plan takes, as (columns below it, rows written)."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif kind == "ShuffleExchangeExec":
            columns = [node.output().apply(i).name() for i in range(node.output().size())]
            found.append((columns, node.metrics().apply("shuffleRecordsWritten").value()))
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return found


def test_a_large_loan_is_shuffled_once_however_many_its_blocks(spark, table):
    """Neither do bills take the cuts of their loan along, nor do days go to blocks of other times."""
    start = date(2020, 1, 1)
    day = [(start + timedelta(days=n // 8)).isoformat() for n in range(2000)]
    pay = pays(*[(start + timedelta(days=n)).isoformat() for n in range(250)])
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    with scans.rows_per_block(16):
        blocks = align.bill_cuts(table("bill", bills(*day))).first()._cuts
        aligned = align.align_payments_to_statements(table("pay", pay), table("bill", bills(*day)))
    shuffles = shuffled_rows(aligned)
    spark.conf.set(key, before)
    assert len(blocks) > 50
    assert not [columns for columns, _ in shuffles if "PaymentNumber" in columns and "_cuts" in columns]
    days = [rows for columns, rows in shuffles if "_piece" in columns and "Status" in columns]
    assert len(days) == 1 and days[0] <= 3 * 250
    assert [r.MonthNumber for r in aligned.orderBy("MonthNumber").collect()] == [8 * n + 8 for n in range(250)]
