"""The registered queries as plain SQL over the driver tables.

Written from the definitions, with the joins and recursions that the Spark code
avoids, so that agreement says something.
"""

from __future__ import annotations

from tallyline.plans import registry

# The analogue inputs. Each may use the ones before it.
_INPUTS = {
    "numbered": """
        select o_orderkey, cast(o_custkey as varchar) as LoanID, o_totalprice,
               cast(o_orderdate as date) as d,
               cast(row_number() over (partition by o_custkey
                                       order by cast(o_orderdate as date), o_orderkey) as int) as n
        from orders""",
    "bill": """
        select LoanID, n as PaymentNumber, d as PaymentDate,
               cast(o_totalprice as decimal(10,2)) as PrincipalPayment,
               cast(o_orderkey % 100 as decimal(10,2)) as InterestPayment
        from numbered""",
    "pay": """
        select LoanID, n as MonthNumber, cast(l_shipdate as date) as PaymentDate,
               case when l_linenumber % 5 <> 0 then cast(l_shipdate as date) end as EffectiveDate,
               case l_returnflag when 'A' then 'posted' when 'N' then 'scheduled'
                                 when 'R' then 'past_due' end as Status,
               case when l_linenumber <> 7
                    then cast(l_extendedprice as decimal(12,2)) end as AmountPrincipal,
               cast(l_quantity as decimal(12,2)) as AmountInterest,
               cast(cast(l_extendedprice as decimal(12,2)) + cast(l_quantity as decimal(12,2))
                    as decimal(12,2)) as Amount,
               cast(o_totalprice as decimal(12,2)) as AmountPrincipalRemaining,
               cast(o_totalprice * 2 as decimal(12,2)) as OriginalAmount,
               cast(case when l_discount <> 0 then l_discount * 100 end
                    as decimal(12,2)) as PrincipalWaived
        from lineitem join numbered on l_orderkey = o_orderkey""",
    "loan": """
        select cast(c_custkey as varchar) as LoanID, c_name as LoanOfficer,
               case c_custkey % 13 when 0 then date '1999-06-30' when 1 then date '1999-12-24'
                                   when 2 then date '1999-12-27' end as PaidOffDate,
               c_mktsegment as Classification,
               cast(c_acctbal as decimal(12,2)) as OriginalAmount,
               cast(c_custkey % 30 + (c_custkey % 100) * 0.0025 as decimal(9,4)) as Rate,
               cast(c_custkey % 7 as decimal(9,4)) as PAInterestRate
        from customer""",
    "loan2": """
        select cast(c_custkey as varchar) as LoanID,
               case when c_custkey % 17 = 0 then 'DS' end as MoveCode,
               case when c_custkey % 11 = 0 then date '1999-10-01' end as ForbearFrom,
               case when c_custkey % 11 = 0 then date '2000-01-01' end as ForbearTo,
               case when c_custkey % 19 = 0 then date '2000-01-01' end as RateFrom,
               case when c_custkey % 38 = 0 then date '2000-06-30' end as RateTo
        from customer""",
    "cb": """
        select cast(c_custkey as varchar) as LoanID,
               case c_nationkey when 0 then '97' when 1 then '93' else '11' end as AccountStatus,
               cast((c_nationkey % 5 + 1) * 12 as int) as TermsDuration
        from customer""",
    "holiday": """
        select distinct cast(o_orderdate as date) as h from orders
        where strftime(o_orderdate, '%m-%d') in ('01-01', '12-25')""",
    "unpaid": """
        select LoanID, min(PaymentDate) as EarliestUnpaidBill from pay
        where Status = 'past_due' and PaymentDate < date '2000-01-01' group by LoanID""",
    "days_late": """
        select loan.LoanID, EarliestUnpaidBill,
               coalesce(date_diff('day', EarliestUnpaidBill, date '2000-01-01'), 0) as days
        from loan left join unpaid on loan.LoanID = unpaid.LoanID""",
    "banded": """
        select LoanID, EarliestUnpaidBill, cast(days as int) as DaysPastDue,
               case when days >= 90 then 'Seriously Delinquent 3+ Payments'
                    when days >= 60 then 'Seriously Delinquent 2 Payments'
                    when days >= 30 then 'Delinquent 1 Payment' else 'Current' end as Band
        from days_late""",
    "business_day": """
        select cast(g as date) as b
        from (select unnest(generate_series(date '1990-01-01', date '2010-12-31',
                                            interval 1 day)) as g)
        where isodow(g) < 6 and cast(g as date) not in (select h from holiday)""",
    "posted_day": """
        select min(b) as p from (select b from business_day where b < date '2000-01-01'
                                 order by b desc limit 5)""",
    "status": """
        select loan.LoanID,
               case when PaidOffDate <= (select p from posted_day) then 'Paid In Full'
                    when AccountStatus = '97' then 'Charge off'
                    when MoveCode = 'DS' then 'Debt Settlement'
                    when ForbearFrom <= date '2000-01-01' and ForbearTo >= date '2000-01-01'
                         then 'Current'
                    else Band end as Status
        from loan join cb using (LoanID) join loan2 using (LoanID) join banded using (LoanID)""",
    "term": """
        select loan.LoanID, Classification[-1:] as Tier, TermsDuration as Term,
               OriginalAmount as LoanAmount,
               cast((case when AccountStatus = '97' then PAInterestRate else Rate end) * 0.01
                    as decimal(9,4)) as InterestRate,
               cast((case when AccountStatus = '97'
                            or (RateFrom <= date '2000-01-01' and RateTo >= date '2000-01-01')
                          then PAInterestRate else Rate end) * 0.01
                    as decimal(9,4)) as ModifiedRate
        from loan join cb using (LoanID) join loan2 using (LoanID)""",
    "period": """
        select LoanID, PaymentNumber, PaymentDate as s,
               coalesce(lead(PaymentDate) over (partition by LoanID order by PaymentNumber),
                        date '9999-12-31') as e
        from bill""",
    "placed": """
        select pay.*, PaymentNumber as MonthReal
        from pay join period on pay.LoanID = period.LoanID
                            and pay.PaymentDate >= s and pay.PaymentDate < e""",
    "aligned": """
        select LoanID, MonthReal as MonthNumber, Status,
               min(PaymentDate) as PaymentDate, max(EffectiveDate) as EffectiveDate,
               min(AmountPrincipalRemaining) as AmountPrincipalRemaining,
               min(OriginalAmount) as OriginalAmount,
               cast(sum(coalesce(AmountPrincipal, 0)) as decimal(38,2)) as AmountPrincipal,
               cast(sum(coalesce(AmountInterest, 0)) as decimal(38,2)) as AmountInterest,
               cast(sum(coalesce(Amount, 0)) as decimal(38,2)) as Amount,
               cast(sum(coalesce(PrincipalWaived, 0)) as decimal(38,2)) as PrincipalWaived
        from placed group by LoanID, MonthReal, Status""",
    "before": "select * from aligned where PaymentDate < timestamp '2000-01-01 00:00:00'",
    "month_pay": """
        select LoanID, MonthNumber, min(PaymentDate) as PaymentDate,
               max(EffectiveDate) as EffectiveDate,
               cast(sum(AmountPrincipal) as decimal(10,2)) as AmountPrincipal,
               cast(sum(AmountInterest) as decimal(10,2)) as AmountInterest
        from pay group by LoanID, MonthNumber""",
    "due_bill": "select * from bill where PaymentDate <= date '2000-01-01'",
    "spine": """
        select b.LoanID, max(p.MonthNumber) as MonthNumber, b.PaymentNumber, b.PaymentDate
        from due_bill b left join pay p
             on p.LoanID = b.LoanID and p.PaymentDate <= b.PaymentDate
        group by b.LoanID, b.PaymentNumber, b.PaymentDate""",
    "loan_spine": """
        select b.LoanID, m.MonthNumber, b.PaymentNumber, b.PaymentDate
        from due_bill b left join
             (select LoanID, max(MonthNumber) as MonthNumber from pay
              where PaymentDate <= date '2000-01-01' group by LoanID) m
             on m.LoanID = b.LoanID""",
}

# Measures of the statements of a spine, grouped by {keys}: each a filtered aggregate over all
# payments, or bills, of the loan.
_NOT_POSTED = "p.Status <> 'posted' and p.MonthNumber <= b.MonthNumber"
_POSTED = "p.Status = 'posted' and p.PaymentDate <= b.PaymentDate"
_LATE = "p.Status = 'past_due' and p.MonthNumber <= b.MonthNumber"
_LOWER = "p.PaymentNumber < b.PaymentNumber"
_MEASURES = {
    "paid": f"""
        select {{keys}},
               sum(AmountPrincipal) filter ({_NOT_POSTED}) as PrincipalDue,
               sum(AmountInterest) filter ({_NOT_POSTED}) as InterestDue,
               sum(AmountPrincipal) filter ({_POSTED}) as PrincipalReceivedToDate,
               sum(AmountInterest) filter ({_POSTED}) as InterestReceivedToDate,
               nullif(count(*) filter ({_LATE}), 0) as NumberOfStatementsPastDue
        from {{spine}} b join pay p using (LoanID) group by {{keys}}""",
    "scheduled": f"""
        select {{keys}},
               sum(p.PrincipalPayment) filter ({_LOWER}) as ScheduledPrincipalReceivedToDate,
               sum(p.InterestPayment) filter ({_LOWER}) as ScheduledInterestReceivedToDate
        from {{spine}} b join bill p using (LoanID) group by {{keys}}""",
}


def _with(select: str, *extra: str, recursive: bool = False) -> str:
    inputs = [f"{name} as ({sql})" for name, sql in _INPUTS.items()]
    head = "with recursive " if recursive else "with "
    return head + ",\n".join([*inputs, *extra]) + "\n" + select


def _measures(spine: str, keys: str) -> list[str]:
    return [
        f"{name} as ({sql.format(spine=spine, keys=keys)})" for name, sql in _MEASURES.items()
    ]


_STATEMENT = "b.LoanID, b.PaymentNumber"


def _by_statement(select: str) -> str:
    return _with(select, *_measures("spine", _STATEMENT))


_MEASURE_COLUMNS = """
    cast(PrincipalDue as decimal(38,2)) as PrincipalDue,
    cast(InterestDue as decimal(38,2)) as InterestDue,
    cast(PrincipalReceivedToDate as decimal(38,2)) as PrincipalReceivedToDate,
    cast(InterestReceivedToDate as decimal(38,2)) as InterestReceivedToDate,
    cast(ScheduledPrincipalReceivedToDate as decimal(38,2)) as ScheduledPrincipalReceivedToDate,
    cast(ScheduledInterestReceivedToDate as decimal(38,2)) as ScheduledInterestReceivedToDate,
    cast(NumberOfStatementsPastDue as bigint) as NumberOfStatementsPastDue"""


def _snapshot(spine: str, keys: str, on: str) -> str:
    joins = "\n".join(f"left join {name} using ({on})" for name in _MEASURES)
    return _with(
        f"""select b.LoanID, LoanOfficer as PayoffUID, b.PaymentNumber as StatementNumber,
                   b.PaymentDate as StatementDueDate, {_MEASURE_COLUMNS},
                   Status, Tier, Term, LoanAmount, ModifiedRate as InterestRate
            from {spine} b {joins}
            join loan using (LoanID) join status using (LoanID) join term using (LoanID)""",
        *_measures(spine, keys),
    )


def _running(amount: str, condition: str, name: str) -> str:
    return f"""cast(sum(case when {condition} then {amount} else 0 end)
        over (partition by LoanID
              order by MonthNumber, PaymentDate nulls first, EffectiveDate nulls first,
                       Status nulls first
              rows between unbounded preceding and current row) as decimal(38,2)) as {name}"""


def _ledger(source: str, shown: str) -> str:
    totals = ",\n".join(
        [
            _running("AmountPrincipal", "Status <> 'posted'", "PrincipalDue"),
            _running("AmountInterest", "Status <> 'posted'", "InterestDue"),
            _running("AmountPrincipal", "Status = 'posted'", "PrincipalReceivedToDate"),
            _running("AmountInterest", "Status = 'posted'", "InterestReceivedToDate"),
            _running("AmountPrincipal", "true", "ScheduledPrincipalReceivedToDate"),
            _running("AmountInterest", "true", "ScheduledInterestReceivedToDate"),
            _running("1", "Status = 'past_due'", "late_so_far"),
        ]
    )
    return _with(
        f"""select e.LoanID, MonthNumber, PaymentDate as StatementDueDate, EffectiveDate,
                   case when {shown} then AmountPrincipal else 0 end as AmountPrincipal,
                   case when {shown} then AmountInterest else 0 end as AmountInterest,
                   PrincipalDue, InterestDue, PrincipalReceivedToDate, InterestReceivedToDate,
                   ScheduledPrincipalReceivedToDate, ScheduledInterestReceivedToDate,
                   cast(late_so_far as bigint) as NumberOfStatementPastDue, Status,
                   Tier, Term, LoanAmount, InterestRate
            from entries e left join term on term.LoanID = e.LoanID
            order by e.LoanID, MonthNumber, PaymentDate, EffectiveDate nulls first,
                     Status nulls first""",
        f"entries as (select *, {totals} from {source})",
    )


def _chain(source: str, number: str, kept: str, principal: str, interest: str) -> str:
    columns = f"LoanID, {number}, {kept}, {principal}, {interest}"
    following = ", ".join(f"r.{column}" for column in columns.split(", "))
    return _with(
        f"""select {columns}, cast(p as decimal(38,2)) as SumPrincipal,
                   cast(i as decimal(38,2)) as SumInterest
            from chain order by LoanID, {number}""",
        f"""chain as (
            select {columns}, cast({principal} as decimal(38,2)) as p,
                   cast({interest} as decimal(38,2)) as i
            from {source} where {number} = 1
            union all
            select {following}, cast(c.p + r.{principal} as decimal(38,2)),
                   cast(c.i + r.{interest} as decimal(38,2))
            from chain c join {source} r
                 on r.LoanID = c.LoanID and r.{number} = c.{number} + 1)""",
        recursive=True,
    )


_ACTIVITY = """
    select cast(o_custkey as varchar) as LoanID, cast(o_orderdate as date) as ActivityDate,
           o_orderkey as ActivityID, o_orderpriority as ActivityType
    from orders order by LoanID, ActivityDate desc"""


def _one_loan(sql: str) -> str:
    return f"select * from ({sql}) where LoanID = '{registry.LOAN}'"


# What other shapes of the inputs change in them.
_SHAPES = {
    "large_loans": {
        "cast(o_custkey as varchar) as LoanID": "cast(o_custkey % 2 as varchar) as LoanID",
        "partition by o_custkey": "partition by o_custkey % 2",
    },
    "disordered_bills": {
        "order by cast(o_orderdate as date), o_orderkey": "order by o_orderkey",
    },
    "unknown_values": {
        "cast(l_shipdate as date) as PaymentDate":
            "case when l_partkey % 11 <> 0 then cast(l_shipdate as date) end as PaymentDate",
        "case l_returnflag when 'A'":
            "case case when l_partkey % 7 <> 0 then l_returnflag end when 'A'",
    },
    "spelled_ids": {"cast(o_custkey as varchar) as LoanID": "'L' || o_custkey as LoanID"},
}


def _shaped(sql: str, shape: str) -> str:
    for was, now in _SHAPES[shape].items():
        sql = " ".join(sql.split()).replace(was, now)
    return sql


def oracle_sql() -> dict[str, str]:
    found = {
        "next_bill_date": _with(
            """select b.*, cast(e as varchar) as PaymentDateNext
               from bill b join period p
                    on b.LoanID = p.LoanID and b.PaymentNumber = p.PaymentNumber"""
        ),
        "interval_align_raw": _with("select * from placed"),
        "align_payments_to_statements": _with("select * from aligned"),
        "cumulative_ledger_as_of": _ledger("before", "Status in ('posted', 'scheduled')"),
        "ledger_analysis": _ledger("aligned", "true"),
        "ledger_masked_amounts": _with(
            """select LoanID, MonthNumber, Status,
                      case when Status in ('posted', 'scheduled')
                           then AmountPrincipal else 0 end as AmountPrincipal,
                      case when Status in ('posted', 'scheduled')
                           then AmountInterest else 0 end as AmountInterest
               from aligned"""
        ),
        "tier_term_amount": _with("select LoanID, Tier, Term, LoanAmount from term"),
        "effective_rate": _with("select LoanID, InterestRate from term"),
        "effective_rate_modified": _with("select LoanID, ModifiedRate as InterestRate from term"),
        "earliest_unpaid_bill": _with("select * from unpaid"),
        "delinquency_bucket": _with("select * from banded"),
        "loan_status": _with("select LoanID, Status from status"),
        "nth_previous_business_day_of_bills": _with(
            """select PaymentDate, b as PreviousBusinessDay
               from (select PaymentDate, b,
                            row_number() over (partition by PaymentDate order by b desc) as back
                     from (select distinct PaymentDate from bill) d
                          join business_day on b < PaymentDate
                                           and b >= PaymentDate - interval 60 day)
               where back = 5"""
        ),
        "bill_running_totals": _with(
            """select LoanID, PaymentNumber, PaymentDate, PrincipalPayment,
                      cast(sum(PrincipalPayment) over w as decimal(38,2)) as SumPrincipal,
                      InterestPayment,
                      cast(sum(InterestPayment) over w as decimal(38,2)) as SumInterest
               from bill
               window w as (partition by LoanID order by PaymentNumber
                            rows between unbounded preceding and current row)
               order by LoanID, PaymentNumber, PaymentDate"""
        ),
        "bill_chain_totals": _chain(
            "bill", "PaymentNumber", "PaymentDate", "PrincipalPayment", "InterestPayment"
        ),
        "payment_running_totals": _chain(
            "month_pay",
            "MonthNumber",
            "PaymentDate, EffectiveDate",
            "AmountPrincipal",
            "AmountInterest",
        ),
        "statement_spine": _with(
            "select * from spine order by LoanID, MonthNumber nulls first, PaymentNumber"
        ),
        "statement_spine_per_loan": _with(
            "select * from loan_spine order by LoanID, MonthNumber nulls first, PaymentNumber"
        ),
        "principal_due_by_month": _by_statement(
            """select LoanID, PaymentNumber, MonthNumber,
                      cast(PrincipalDue as decimal(38,2)) as PrincipalDue,
                      cast(InterestDue as decimal(38,2)) as InterestDue
               from spine left join paid using (LoanID, PaymentNumber)"""
        ),
        "past_due_count": _by_statement(
            """select LoanID, PaymentNumber, MonthNumber,
                      cast(NumberOfStatementsPastDue as bigint) as NumberOfStatementsPastDue
               from spine left join paid using (LoanID, PaymentNumber)"""
        ),
        "received_to_date": _by_statement(
            """select LoanID, PaymentNumber, PaymentDate,
                      cast(PrincipalReceivedToDate as decimal(38,2)) as PrincipalReceivedToDate,
                      cast(InterestReceivedToDate as decimal(38,2)) as InterestReceivedToDate
               from spine left join paid using (LoanID, PaymentNumber)"""
        ),
        "scheduled_before": _by_statement(
            """select LoanID, PaymentNumber, PaymentDate,
                      cast(ScheduledPrincipalReceivedToDate as decimal(38,2))
                          as ScheduledPrincipalReceivedToDate,
                      cast(ScheduledInterestReceivedToDate as decimal(38,2))
                          as ScheduledInterestReceivedToDate
               from spine left join scheduled using (LoanID, PaymentNumber)"""
        ),
        "snapshot_per_statement": _snapshot("spine", _STATEMENT, "LoanID, PaymentNumber"),
        "snapshot_per_loan": _snapshot("loan_spine", "b.LoanID", "LoanID"),
        "dq_duplicate_months": _with(
            """select LoanID, MonthNumber, count(*) as Rows from pay
               group by all having count(*) > 1"""
        ),
        "dq_duplicate_month_dates": _with(
            """select LoanID, MonthNumber, PaymentDate, count(*) as Rows from pay
               group by all having count(*) > 1
               order by LoanID, MonthNumber, PaymentDate"""
        ),
        "dq_conflicting_dates": _with(
            """select LoanID, MonthNumber, PaymentDate, mine as Rows, pairs // mine as OtherRows
               from (select x.LoanID, x.MonthNumber, x.PaymentDate,
                            count(*) as pairs, any_value(x.mine) as mine
                     from (select *, count(*) over (partition by LoanID, MonthNumber, PaymentDate)
                                     as mine from pay) x
                          join pay y on x.LoanID = y.LoanID and x.MonthNumber = y.MonthNumber
                                    and x.PaymentDate <> y.PaymentDate
                     group by all)"""
        ),
        "dq_date_mismatch": _with(
            """select p.LoanID, p.MonthNumber, b.PaymentNumber, p.PaymentDate,
                      b.PaymentDate as BillDate
               from pay p join bill b on p.LoanID = b.LoanID and p.MonthNumber = b.PaymentNumber
               where p.PaymentDate <> b.PaymentDate
               order by all"""
        ),
        "dq_payment_off_statement": _with(
            """select LoanID, MonthNumber, PaymentDate from pay p
               where PaymentDate not in
                     (select b.PaymentDate from bill b where b.LoanID = p.LoanID)
               order by all"""
        ),
        "dq_length_mismatch": _with(
            """select LoanID, max(PaymentNumber) as LastPaymentNumber,
                      max(MonthNumber) as LastMonthNumber
               from bill join pay using (LoanID)
               group by LoanID having max(PaymentNumber) <> max(MonthNumber)"""
        ),
        "dq_unaligned_payments": _with(
            """select LoanID, count(*) as UnalignedPayments from pay p
               where not exists (select 1 from period q where q.LoanID = p.LoanID
                                 and p.PaymentDate >= s and p.PaymentDate < e)
               group by LoanID"""
        ),
        "dq_non_increasing_bills": _with(
            """select LoanID, PaymentNumber, s as PaymentDate, e as PaymentDateNext
               from period where e <= s"""
        ),
        "waived_principal": _with(
            """select LoanID, cast(sum(coalesce(PrincipalWaived, 0)) as decimal(38,2))
                      as PrincipalWaived
               from pay group by LoanID"""
        ),
        "ledger_of_one_loan": _one_loan(_ledger("aligned", "true")),
        "loan_detail_bill": _one_loan(_with("select * from bill")),
        "loan_detail_pay": _one_loan(_with("select * from pay")),
        "newest_activity": _ACTIVITY,
        "newest_activity_of_one_loan": _one_loan(_ACTIVITY),
    }
    found |= {
        "ledger_function": found["cumulative_ledger_as_of"],
        "ledger_function_of_one_loan": found["ledger_of_one_loan"],
        "bill_chain_of_loan": _one_loan(found["bill_chain_totals"]),
        "stored_statements": found["statement_spine_per_loan"],
        "copied_payments": _with("select * from pay"),
        "align_payments": found["align_payments_to_statements"],
    }
    for name in (
        "align_payments",
        "align_payments_to_statements",
        "cumulative_ledger_as_of",
        "bill_running_totals",
        "dq_payment_off_statement",
        "dq_non_increasing_bills",
    ):
        found |= {f"{name}_{shape}": _shaped(found[name], shape) for shape in _SHAPES}
    return {name: sql for name, sql in found.items() if name in registry.queries()}
