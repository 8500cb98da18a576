"""Loan inputs derived from the order tables, for queries, tests and bench.

A customer plays the loan, an order the bill and an order line the payment.
Every row of the order tables is used.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.scans import running_totals
from tallyline.sources import contracts
from tallyline.sources.contracts import Contract, conform

AS_OF = datetime(2000, 1, 1)

# Declared, so that building a query reads no file.
_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
}

_BILL = {
    "LoanID": "o_custkey",
    "PaymentNumber": "number",
    "PaymentDate": "o_orderdate",
    "PrincipalPayment": "o_totalprice",
    "InterestPayment": "o_orderkey % 100",
}
_WAIVED = "case when l_discount <> 0 then l_discount * 100 end"
_PAY = {
    "LoanID": "o_custkey",
    "MonthNumber": "number",
    "PaymentDate": "l_shipdate",
    "EffectiveDate": "case when l_linenumber % 5 <> 0 then l_shipdate end",
    # Spelled as sources do, to be normalised.
    "Status": "case l_returnflag when 'A' then 'Posted' when 'N' then 'scheduled ' "
    "when 'R' then 'past_due' end",
    "AmountPrincipal": "case when l_linenumber <> 7 then l_extendedprice end",
    "AmountInterest": "l_quantity",
    "Amount": "cast(l_extendedprice as decimal(12,2)) + cast(l_quantity as decimal(12,2))",
    "AmountPrincipalRemaining": "o_totalprice",
    "OriginalAmount": "o_totalprice * 2",
    "PrincipalWaived": _WAIVED,
}
_LOAN = {
    "LoanID": "c_custkey",
    "LoanOfficer": "c_name",
    "PaidOffDate": "case c_custkey % 13 when 0 then '1999-06-30' when 1 then '1999-12-24' "
    "when 2 then '1999-12-27' end",
    "Classification": "c_mktsegment",
    "OriginalAmount": "c_acctbal",
    # A fraction that needs rounding.
    "Rate": "c_custkey % 30 + c_custkey % 100 * 0.0025",
    "PAInterestRate": "c_custkey % 7",
}
_LOAN2 = {
    "LoanID": "c_custkey",
    "U_PortMoveCode": "case when c_custkey % 17 = 0 then 'ds' end",
    "ETL_LoanModForbearEffDt": "case when c_custkey % 11 = 0 then '1999-10-01' end",
    "ETL_LoanModForbearEndDt": "case when c_custkey % 11 = 0 then '2000-01-01' end",
    "U_LoanModRateEffDt": "case when c_custkey % 19 = 0 then '2000-01-01' end",
    "ETL_LoanModRateEndDt": "case when c_custkey % 38 = 0 then '2000-06-30' end",
}
_CB = {
    "LoanID": "c_custkey",
    "AccountStatus": "case c_nationkey when 0 then '97' when 1 then '93' else '11' end",
    "TermsDuration": "(c_nationkey % 5 + 1) * 12",
}


def _derived(rows: DataFrame, columns: dict[str, str], contract: Contract) -> DataFrame:
    named = rows.selectExpr(*[f"{value} as {name}" for name, value in columns.items()])
    return conform(named, contract, partial=True)


# Payments of which some lack a status or a date.
_UNKNOWN = {
    "PaymentDate": "case when l_partkey % 11 <> 0 then l_shipdate end",
    "Status": f"case when l_partkey % 7 <> 0 then {_PAY['Status']} end",
}


class Analogue:
    """The loan inputs of one scale-factor directory, each built on demand.

    ``loans`` deals the orders out to so many loans instead of to customers, so that each
    is large. ``by_key`` numbers the bills by order key, so that dates do not rise with the
    number. ``unknown`` leaves some statuses and payment dates out. ``spelled`` spells the ids of bills
    and payments differently, as one collation takes for the same.
    """

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        loans: int | None = None,
        by_key: bool = False,
        unknown: bool = False,
        spelled: bool = False,
    ):
        self._spark = spark
        self._dir = sf_dir
        self._loan = f"o_custkey % {loans}" if loans else "o_custkey"
        self._by_key = by_key
        self._payment = _PAY | (_UNKNOWN if unknown else {})
        self._spelled = spelled

    def _table(self, name: str) -> DataFrame:
        return self._spark.read.schema(_SCHEMAS[name]).parquet(f"{self._dir}/{name}.parquet")

    def _orders(self) -> DataFrame:
        return self._table("orders").selectExpr(
            "o_orderkey",
            f"{self._loan} as o_custkey",
            "o_totalprice",
            "cast(o_orderdate as date) as o_orderdate",
        )

    def _numbered_orders(self) -> DataFrame:
        """Orders numbered within the loan."""
        order = ["o_orderkey"] if self._by_key else ["o_orderdate", "o_orderkey"]
        return running_totals(self._orders(), {"number": F.lit(1)}, order=order, key="o_custkey")

    def _lines(self, orders: DataFrame) -> DataFrame:
        lines = self._table("lineitem")
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey)

    def bill(self) -> DataFrame:
        return self._respelled(
            _derived(self._numbered_orders(), _BILL, contracts.BILL), "concat('L', LoanID)"
        )

    def _respelled(self, rows: DataFrame, spelling: str) -> DataFrame:
        if not self._spelled:
            return rows
        return contracts.same_spelling(rows.withColumn("LoanID", F.expr(spelling)))

    def pay(self, months: bool = True) -> DataFrame:
        """Payments; ``months=False`` leaves out ``MonthNumber``."""
        orders, columns = self._numbered_orders(), self._payment
        if not months:
            orders = self._orders()
            columns = {name: value for name, value in columns.items() if name != "MonthNumber"}
        rows = _derived(self._lines(orders), columns, contracts.PAY)
        return self._respelled(rows, "concat('l', LoanID, if(day(PaymentDate) % 2 = 0, '  ', ''))")

    def loan(self) -> DataFrame:
        return _derived(self._table("customer"), _LOAN, contracts.LOAN)

    def loan2(self) -> DataFrame:
        return _derived(self._table("customer"), _LOAN2, contracts.LOAN2)

    def cb(self) -> DataFrame:
        return _derived(self._table("customer"), _CB, contracts.CB)

    def pastdue(self) -> DataFrame:
        rows = self.pay(months=False).filter("Status = 'past_due'")
        return _derived(
            rows, {"LoanID": "LoanID", "PastDueDate": "PaymentDate"}, contracts.PASTDUE
        )

    def waiver(self) -> DataFrame:
        columns = {"LoanID": "o_custkey", "PrincipalWaived": _WAIVED}
        return _derived(self._lines(self._orders()), columns, contracts.WAIVER)

    def activity(self) -> DataFrame:
        return self._table("orders").selectExpr(
            "cast(o_custkey as string) as LoanID",
            "cast(o_orderdate as date) as ActivityDate",
            "o_orderkey as ActivityID",
            "o_orderpriority as ActivityType",
        )

    def holidays(self) -> DataFrame:
        """New Year's Day and Christmas Day of every year with an order on them."""
        days = self._table("orders").filter(
            "date_format(o_orderdate, 'MM-dd') in ('01-01', '12-25')"
        )
        return _derived(days, {"HolidayDate": "o_orderdate"}, contracts.HOLIDAY).distinct()
