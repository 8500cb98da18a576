"""Input contracts: column names, types and code normalisation.

Fixed values: the column names are those of the source tables, so existing
tables can be read without renaming.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sums of money take the widest type: a single loan may hold any share of the rows.
MONEY = "decimal(38,2)"
RATE = "decimal(9,4)"

Contract = dict[str, str]

BILL: Contract = {
    "LoanID": "string",
    "PaymentNumber": "int",
    "PaymentDate": "date",
    "PrincipalPayment": "decimal(10,2)",
    "InterestPayment": "decimal(10,2)",
}
PAY: Contract = {
    "LoanID": "string",
    "MonthNumber": "int",
    "PaymentDate": "date",
    "EffectiveDate": "date",
    "Status": "string",
    "AmountPrincipal": "decimal(12,2)",
    "AmountInterest": "decimal(12,2)",
    "Amount": "decimal(12,2)",
    "AmountPrincipalRemaining": "decimal(12,2)",
    "OriginalAmount": "decimal(12,2)",
    "PrincipalWaived": "decimal(12,2)",
}
LOAN: Contract = {
    "LoanID": "string",
    "LoanOfficer": "string",
    "PaidOffDate": "date",
    "Classification": "string",
    "OriginalAmount": "decimal(12,2)",
    "Rate": RATE,
    "PAInterestRate": RATE,
}
LOAN2: Contract = {
    "LoanID": "string",
    "U_PortMoveCode": "string",
    "ETL_LoanModForbearEffDt": "date",
    "ETL_LoanModForbearEndDt": "date",
    "U_LoanModRateEffDt": "date",
    "ETL_LoanModRateEndDt": "date",
}
CB: Contract = {"LoanID": "string", "AccountStatus": "string", "TermsDuration": "int"}
PASTDUE: Contract = {"LoanID": "string", "PastDueDate": "date"}
WAIVER: Contract = {"LoanID": "string", "PrincipalWaived": "decimal(12,2)"}
HOLIDAY: Contract = {"HolidayDate": "date"}
ACTIVITY: Contract = {"LoanID": "string", "ActivityDate": "date"}

CONTRACTS = {
    "bill": BILL,
    "pay": PAY,
    "loan": LOAN,
    "loan2": LOAN2,
    "cb": CB,
    "pastdue": PASTDUE,
    "waiver": WAIVER,
    "holiday": HOLIDAY,
    "activity": ACTIVITY,
}

# Inputs that keep the columns their contract does not name.
OPEN = {"activity"}

# The source compares codes without regard to case or trailing blanks.
_LOWER_CODES = {"Status"}
_UPPER_CODES = {"AccountStatus", "U_PortMoveCode"}


def _conformed(name: str, type_: str) -> str:
    value = f"cast({name} as {type_})"
    if name in _LOWER_CODES:
        value = f"lower(rtrim({value}))"
    elif name in _UPPER_CODES:
        value = f"upper(rtrim({value}))"
    return f"{value} as {name}"


def conform(
    df: DataFrame, contract: Contract, partial: bool = False, others: bool = False
) -> DataFrame:
    """Select, cast and normalise the contract's columns.

    ``partial`` leaves out contract columns that ``df`` lacks, and ``others`` keeps the
    columns that the contract does not name. Casts are ANSI casts: a value that does not
    fit is an error, not a NULL.
    """
    present = {c.lower() for c in df.columns}
    named = {name.lower() for name in contract}
    return df.selectExpr(
        *[
            _conformed(name, type_)
            for name, type_ in contract.items()
            if not partial or name.lower() in present
        ],
        *[f"`{c}`" for c in df.columns if others and c.lower() not in named],
    )


# How the source compares strings: without regard to case or trailing blanks.
COLLATION = "UTF8_LCASE_RTRIM"


def same_spelling(df: DataFrame) -> DataFrame:
    """``df`` with loan ids that equal each other however they are spelled.

    Joins, groups, windows and lookups over them follow; a result shows an id as one of its spellings.
    A filter on such an id is not handed to the files, which know bytes alone, so this is an option
    for sources that spell ids in several ways.
    """
    return df.withColumn("LoanID", F.expr(f"cast(LoanID as string collate {COLLATION})"))


def one_row_per(df: DataFrame, key: str, what: str) -> DataFrame:
    """``df`` unchanged, but the query fails if ``key`` occurs twice.

    The check is part of the plan: a hash aggregate on the key the caller joins
    on next, so it adds no shuffle to a sort-merge join and no separate job.
    """
    others = [c for c in df.columns if c != key]
    rows = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.any_value(c).alias(c) for c in others]
    )
    single = F.assert_true(
        F.col("_rows") == 1,
        F.concat(F.lit(f"{what}: more than one row for {key} "), F.col(key)),
    )
    return rows.filter(single.isNull()).select(*df.columns)
