"""Detail rows and waived principal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.sources.contracts import MONEY


def loan_detail(table: DataFrame, loan_id: str | None = None) -> DataFrame:
    """All columns of a loan's rows, or of every loan's.

    The filter names the bare column, so it reaches the Parquet scan.
    """
    return table if loan_id is None else table.filter(F.col("LoanID") == loan_id)


def newest_activity(activity: DataFrame, loan_id: str | None = None) -> DataFrame:
    """Activity rows by loan, newest first."""
    return loan_detail(activity, loan_id).orderBy("LoanID", F.desc("ActivityDate"))


def waived_principal(waiver: DataFrame) -> DataFrame:
    """(LoanID, PrincipalWaived) by loan, zero where nothing is recorded."""
    waived = F.coalesce(F.col("PrincipalWaived"), F.lit(0).cast("decimal(12,2)"))
    return waiver.groupBy("LoanID").agg(F.sum(waived).cast(MONEY).alias("PrincipalWaived"))
