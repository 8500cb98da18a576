"""A stored table of statements whose month is filled in, and kept up to date, in place."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators.snapshot import due_statements, last_months
from tallyline.sources.tables import save_by_loan, update_loans


def store_statements(
    bill: DataFrame,
    table: str,
    as_of: datetime | date | None = None,
    buckets: int = 64,
    path: str | None = None,
) -> None:
    """A new table of the statements due by ``as_of``, with no month yet."""
    statements = due_statements(bill, as_of).select(
        "LoanID", F.lit(None).cast("int").alias("MonthNumber"), "PaymentNumber", "PaymentDate"
    )
    save_by_loan(statements, table, buckets, path)


def update_months(
    pay: DataFrame,
    table: str,
    as_of: datetime | date | None = None,
    loans: DataFrame | None = None,
) -> None:
    """Set the month of every statement to the largest that its loan paid by ``as_of``.

    Only loans with payments are changed, or those of ``loans`` among them. What is set does not
    depend on what was there, so an update that failed half way is simply run again.
    """
    months = last_months(pay, as_of).withColumnRenamed("MonthNumber", "_month")
    if loans is not None:
        months = months.join(loans.select("LoanID").distinct(), "LoanID", "left_semi")

    def with_months(statements: DataFrame) -> DataFrame:
        return (
            statements.join(months.withColumn("_paid", F.lit(True)), "LoanID", "left")
            .withColumn(
                "MonthNumber",
                F.when(F.col("_paid"), F.col("_month")).otherwise(F.col("MonthNumber")),
            )
            .select(*statements.columns)
        )

    update_loans(table, months, with_months)
