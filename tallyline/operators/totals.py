"""Running totals over bills and payments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.operators.scans import BEFORE, cuts, in_blocks, running_totals
from tallyline.sources.contracts import MONEY


def bill_running_totals(bill: DataFrame) -> DataFrame:
    """Bills with principal and interest billed up to and including each one."""
    totals = running_totals(
        bill,
        {"SumPrincipal": F.col("PrincipalPayment"), "SumInterest": F.col("InterestPayment")},
        order=["PaymentNumber", "PaymentDate"],
    )
    return totals.select(
        "LoanID",
        "PaymentNumber",
        "PaymentDate",
        "PrincipalPayment",
        F.col("SumPrincipal").cast(MONEY).alias("SumPrincipal"),
        "InterestPayment",
        F.col("SumInterest").cast(MONEY).alias("SumInterest"),
    )


def billed_before(bill: DataFrame) -> DataFrame:
    """Bills with what lower-numbered bills of the loan scheduled; NULL if none."""
    return running_totals(
        bill,
        {
            "ScheduledPrincipalReceivedToDate": F.col("PrincipalPayment"),
            "ScheduledInterestReceivedToDate": F.col("InterestPayment"),
        },
        order=["PaymentNumber"],
        frame=BEFORE,
    )


def contiguous_totals(
    rows: DataFrame, number: str, amounts: dict[str, str], levels: int | None = None
) -> DataFrame:
    """Running totals along the chain of numbers 1, 2, 3, ... of each loan.

    The chain ends at the first missing number, and rows after it are left out;
    a loan without number 1 has no chain. From the first NULL amount on the
    total is NULL. ``amounts`` maps result names to amount columns. A number
    that occurs twice is an error if the chain reaches it, and not beyond its end. So is a chain
    of more numbers than ``levels``.
    """
    # Equal numbers share a block and stand next to each other in it; the first counts.
    chained = rows.filter(F.col(number) >= 1)
    cut = cuts(chained, [number])
    blocked = in_blocks(chained, cut, number)
    previous = F.lag(number).over(Window.partitionBy("LoanID", "_block").orderBy(number))
    totals: dict[str, Column] = {"_position": F.col("_new")}
    for name, amount in amounts.items():
        totals[name] = F.col(amount)
        totals[f"_unknown_{name}"] = F.col(amount).isNull().cast("int")
    marked = blocked.withColumn("_new", F.when(previous == F.col(number), 0).otherwise(1))
    scanned = running_totals(marked, totals, order=[number], block=F.col("_block"), cut=cut)
    in_chain = F.col("_position") == F.col(number)
    # The check must not name the position: it would be inferred for all rows from the equality.
    once = F.assert_true(
        F.col("_new") == 1,
        F.concat(F.lit(f"{number} occurs twice in loan "), F.col("LoanID")),
    )
    if levels is not None:
        ended = F.assert_true(
            F.col(number) <= levels,
            F.concat(F.lit(f"more than {levels} levels in loan "), F.col("LoanID")),
        )
        once = F.coalesce(once, ended)
    return scanned.filter(F.when(in_chain, once.isNull()).otherwise(F.lit(False))).select(
        *rows.columns,
        *[
            F.when(F.col(f"_unknown_{name}") == 0, F.col(name)).cast(MONEY).alias(name)
            for name in amounts
        ],
    )


def bill_chain_totals(bill: DataFrame, levels: int | None = None) -> DataFrame:
    """Bill totals along the unbroken numbers from 1, an error past ``levels`` numbers."""
    return contiguous_totals(
        bill,
        "PaymentNumber",
        {"SumPrincipal": "PrincipalPayment", "SumInterest": "InterestPayment"},
        levels,
    )


# Fixed value: the depth at which the source gives a recursion up.
MAX_LEVELS = 100


def bill_chain_of_loan(bill: DataFrame, loan_id: str, levels: int = MAX_LEVELS) -> DataFrame:
    """The chain of one loan as the source finds it, step by step: each bill joins its predecessor.

    A check on ``bill_chain_totals``, and its meaning written down: a loan's levels run one after the
    other, and a chain of more of them is an error.
    """
    own = bill.filter(F.col("LoanID") == loan_id)
    carried = "LoanID, PaymentNumber, PaymentDate, PrincipalPayment, {}, InterestPayment, {}"
    first = carried.format(
        f"cast(PrincipalPayment as {MONEY})", f"cast(InterestPayment as {MONEY})"
    )
    following = ", ".join(
        [
            "y.LoanID, y.PaymentNumber, y.PaymentDate, y.PrincipalPayment",
            f"cast(x.SumPrincipal + y.PrincipalPayment as {MONEY}), y.InterestPayment",
            f"cast(x.SumInterest + y.InterestPayment as {MONEY})",
        ]
    )
    return bill.sparkSession.sql(
        f"""
with recursive x({carried.format("SumPrincipal", "SumInterest")}) max recursion level {levels} as (
    select {first} from {{own}} where PaymentNumber = 1
    union all
    select {following} from x join {{own}} y
        on y.LoanID = x.LoanID and y.PaymentNumber = x.PaymentNumber + 1
)
select * from x""",
        own=own,
    )


def payment_running_totals(pay: DataFrame) -> DataFrame:
    """Payment totals along the unbroken months from 1, one row per month.

    The payments of a month are added up first, under its earliest payment and latest
    effective date, so the totals stand on a key that the payment table does not have.
    """
    months = pay.groupBy("LoanID", "MonthNumber").agg(
        F.min("PaymentDate").alias("PaymentDate"),
        F.max("EffectiveDate").alias("EffectiveDate"),
        *[F.sum(a).cast(MONEY).alias(a) for a in ("AmountPrincipal", "AmountInterest")],
    )
    return contiguous_totals(
        months,
        "MonthNumber",
        {"SumPrincipal": "AmountPrincipal", "SumInterest": "AmountInterest"},
    )
