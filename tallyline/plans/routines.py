"""The ledgers as SQL table functions of a session, with named and defaulted arguments.

    register_functions(spark, pay, bill, loan, cb)
    spark.sql("select * from cumulative_ledger(as_of => timestamp_ntz'2024-01-01') where LoanID = '7'")
    spark.sql("select * from cumulative_ledger()")

A function is a plan over views, expanded where it is called: constants fold, filters on the loan reach
the files, and it can be joined like a table. As with any table, the order of its rows is the caller's to ask for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyline.functions import columns as c
from tallyline.operators.align import align_payments_to_statements, bill_cuts
from tallyline.operators.scans import in_blocks, of_cut
from tallyline.operators.terms import TERMS, with_terms
from tallyline.plans.ledger import ORDER, analysis_ledger

# The views that the functions stand on.
ENTRIES, TERMED, CUT_ENTRIES = "ledger_entries", "ledger_entries_with_terms", "ledger_entries_of_cut_loans"

_DUE, _RECEIVED = f"Status <> '{c.POSTED}'", f"Status = '{c.POSTED}'"
_TOTALS = {
    "PrincipalDue": f"if({_DUE}, AmountPrincipal, 0)",
    "InterestDue": f"if({_DUE}, AmountInterest, 0)",
    "PrincipalReceivedToDate": f"if({_RECEIVED}, AmountPrincipal, 0)",
    "InterestReceivedToDate": f"if({_RECEIVED}, AmountInterest, 0)",
    "ScheduledPrincipalReceivedToDate": "AmountPrincipal",
    "ScheduledInterestReceivedToDate": "AmountInterest",
    "NumberOfStatementPastDue": f"if(Status = '{c.PAST_DUE}', 1, 0)",
}


def _body(where: str, shown: str, types: dict[str, str]) -> str:
    """Totals in blocks: those of the block's own rows and what earlier blocks of cut loans carry."""
    local = ", ".join(f"sum({value}) over so_far as l_{name}" for name, value in _TOTALS.items())
    sums = ", ".join(f"sum({value}) as b_{name}" for name, value in _TOTALS.items())
    carried = ", ".join(f"sum(b_{name}) over earlier as c_{name}" for name in _TOTALS)
    totals = ", ".join(
        f"cast(coalesce(l_{name} + c_{name}, l_{name}) as {types[name]}) as {name}" for name in _TOTALS
    )
    amounts = ", ".join(
        f"cast({shown.format(name)} as {types[name]}) as {name}"
        for name in ("AmountPrincipal", "AmountInterest")
    )
    return f"""
with totalled as (
    select *, {local} from {TERMED} where {where}
    window so_far as (
        partition by LoanID, _block order by {", ".join(ORDER)} rows unbounded preceding
    )
), blocks as (
    select LoanID, _block, {sums} from {CUT_ENTRIES} where {where} group by LoanID, _block
), carried as (
    select LoanID, _block, {carried} from blocks
    window earlier as (
        partition by LoanID order by _block rows between unbounded preceding and 1 preceding
    )
)
select LoanID, MonthNumber, PaymentDate as StatementDueDate, EffectiveDate, {amounts}, {totals}, Status,
    {", ".join(TERMS)}
from totalled left join carried using (LoanID, _block)"""


def register_functions(
    spark: SparkSession, pay: DataFrame, bill: DataFrame, loan: DataFrame, cb: DataFrame
) -> None:
    """Make ``cumulative_ledger(as_of)`` and ``ledger_analysis(loan_id)`` known to the session's SQL.

    Without ``as_of`` the ledger is that of now, and without ``loan_id`` that of all loans. Starts no job.
    """
    cut = bill_cuts(bill)
    aligned = align_payments_to_statements(pay, bill)
    in_blocks(aligned, cut, "MonthNumber").createOrReplaceTempView(ENTRIES)
    in_blocks(with_terms(aligned, loan, cb), cut, "MonthNumber").createOrReplaceTempView(TERMED)
    # The payments of other loans are dropped before they are collapsed.
    divided = of_cut(in_blocks(align_payments_to_statements(of_cut(pay, cut), bill), cut, "MonthNumber"), cut)
    divided.createOrReplaceTempView(CUT_ENTRIES)
    schema = analysis_ledger(pay, bill, loan, cb, ordered=False).schema
    types = {field.name: field.dataType.simpleString() for field in schema}
    columns = ", ".join(f"{name} {kind}" for name, kind in types.items())
    masked = f"if(Status in ('{c.POSTED}', '{c.SCHEDULED}'), {{0}}, 0)"
    before = "cast(PaymentDate as timestamp_ntz) < coalesce(cumulative_ledger.as_of, localtimestamp())"
    asked = "(ledger_analysis.loan_id is null or LoanID = ledger_analysis.loan_id)"
    for name, argument, body in (
        ("cumulative_ledger", "as_of timestamp_ntz", _body(before, masked, types)),
        ("ledger_analysis", "loan_id string", _body(asked, "{0}", types)),
    ):
        spark.sql(
            f"create or replace temporary function {name}({argument} default null) "
            f"returns table ({columns}) return {body}"
        )
