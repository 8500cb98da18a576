"""Readers and writers for the input tables and results."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.sources.contracts import CONTRACTS, OPEN, conform, same_spelling


def read_path(
    spark: SparkSession, name: str, path: str, format: str = "parquet", as_source: bool = False
) -> DataFrame:
    """Input ``name`` from files, conformed to its contract.

    Text formats are read with the contract as schema; a header names the columns
    of CSV files. ``as_source`` compares loan ids as ``contracts.same_spelling`` says.
    """
    contract = CONTRACTS[name]
    reader = spark.read.format(format)
    if format in ("csv", "json"):
        reader = reader.schema(", ".join(f"{column} {type_}" for column, type_ in contract.items()))
    if format == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    rows = conform(reader.load(path), contract, others=name in OPEN)
    return same_spelling(rows) if as_source else rows


def read_table(spark: SparkSession, name: str, table: str, as_source: bool = False) -> DataFrame:
    """Input ``name`` from a table or view, also of another catalog or database."""
    rows = conform(spark.table(table), CONTRACTS[name], others=name in OPEN)
    return same_spelling(rows) if as_source else rows


def new_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share, for tables of the session's own.

    It lies in ``spark.checkpoint.dir``; only a local session may do without.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tables-")
    return f"{shared}/{uuid.uuid4().hex}"


def save_new(df: DataFrame, table: str, path: str | None = None) -> None:
    """Copy ``df`` to a new table, stored at ``path`` if given; an existing one is an error."""
    writer = df.write.mode("errorifexists")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def append(df: DataFrame, table: str) -> None:
    """Add the rows of ``df`` to an existing table, matched by column name."""
    target = df.sparkSession.table(table)
    df.select(*target.columns).write.mode("append").insertInto(table)


def save_bucketed(df: DataFrame, table: str, buckets: int) -> None:
    """Store an input by ``LoanID`` buckets.

    Joins and aggregates by loan over tables with equal bucket counts need no
    shuffle. A bucket is read by one task: meant for tables without a loan that
    holds a large share of the rows.
    """
    df.write.bucketBy(buckets, "LoanID").sortBy("LoanID").saveAsTable(table)


def export(df: DataFrame, path: str, format: str = "parquet") -> None:
    """Write a result, keeping its order across and within files."""
    writer = df.write.mode("errorifexists").format(format)
    if format == "csv":
        writer = writer.option("header", True)
    writer.save(path)


# The partition column of tables that are updated by loan.
BUCKET = "LoanBucket"


def loan_bucket(buckets: int) -> Column:
    return F.pmod(F.hash("LoanID"), F.lit(buckets))


def _stored_by_loan(spark: SparkSession, table: str) -> tuple[str, int]:
    """Where a table lies, and the number of its buckets."""
    described = spark.sql(f"describe table extended {table}").filter(
        "col_name in ('Location', 'Storage Properties')"
    )
    found = {row.col_name: row.data_type for row in described.collect()}
    buckets = re.search(r"buckets=(\d+)", found.get("Storage Properties", ""))
    if not buckets:
        raise ValueError(f"{table} was not stored by loan")
    return found["Location"], int(buckets.group(1))


def save_by_loan(df: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Store ``df`` in partitions by a hash of the loan, so that loans can be updated in place.

    A loan lies in one partition, of as many files as its size asks for.
    """
    bucketed = df.withColumn(BUCKET, loan_bucket(buckets)).hint("rebalance", BUCKET)
    writer = bucketed.write.mode("errorifexists").partitionBy(BUCKET).option("buckets", buckets)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def update_loans(
    table: str, loans: DataFrame, change: Callable[[DataFrame], DataFrame]
) -> list[int]:
    """Rewrite the partitions of a table that hold any of ``loans``, and tell which.

    ``change`` takes the rows of these partitions and returns all of them, changed or not. The others keep
    their files. New files are written beside the old ones and take their place once all are
    there. The partitions are a bounded number, whatever the loans are. One that is left without rows
    stays as it was.
    """
    spark = loans.sparkSession
    location, buckets = _stored_by_loan(spark, table)
    touched = [
        row[0] for row in loans.select(loan_bucket(buckets).alias(BUCKET)).distinct().collect()
    ]
    if touched:
        stored = spark.table(table)
        changed = change(stored.filter(F.col(BUCKET).isin(touched))).select(*stored.columns)
        writer = changed.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET)
        writer.option("partitionOverwriteMode", "dynamic").parquet(location)
        spark.catalog.refreshTable(table)
    return sorted(touched)
