"""Readers and writers."""

import pytest
from conftest import as_set

from tallyline.sources import tables

ROWS = [
    {"LoanID": "A", "MonthNumber": 1, "PaymentDate": "2020-01-05", "Status": "Posted "},
    {"LoanID": "B", "PaymentDate": "2020-01-06", "AmountPrincipal": "12.50"},
]


@pytest.fixture
def pay(table):
    return table("pay", ROWS)


@pytest.mark.parametrize("format", ["parquet", "orc", "csv", "json"])
def test_export_and_read_back(spark, pay, tmp_path, format):
    path = str(tmp_path / "pay")
    tables.export(pay, path, format)
    again = tables.read_path(spark, "pay", path, format)
    assert again.schema.simpleString() == pay.schema.simpleString()
    assert as_set(again) == as_set(pay)
    with pytest.raises(Exception, match="already exists"):
        tables.export(pay, path, format)


def test_source_types_and_codes_are_conformed(spark, tmp_path):
    path = str(tmp_path / "cb")
    raw = spark.sql("select 5 as loanid, 'aB ' as AccountStatus, '24' as termsduration, 1 as more")
    raw.write.parquet(path)
    conformed = tables.read_path(spark, "cb", path)
    assert as_set(conformed) == [("5", "AB", 24)]
    assert conformed.columns == ["LoanID", "AccountStatus", "TermsDuration"]


def test_a_value_that_does_not_fit_is_an_error(spark, tmp_path):
    path = str(tmp_path / "cb")
    spark.sql("select '5' as LoanID, '11' as AccountStatus, 'two' as TermsDuration").write.parquet(
        path
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.read_path(spark, "cb", path).collect()


def test_tables_of_other_databases(spark, pay):
    spark.sql("create database if not exists elsewhere")
    tables.save_new(pay, "elsewhere.pay_copy")
    assert as_set(tables.read_table(spark, "pay", "elsewhere.pay_copy")) == as_set(pay)
    with pytest.raises(Exception, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        tables.save_new(pay, "elsewhere.pay_copy")
    tables.append(pay.select(*reversed(pay.columns)), "elsewhere.pay_copy")
    assert spark.table("elsewhere.pay_copy").count() == 2 * len(ROWS)


def test_views_are_read_like_tables(spark, pay):
    pay.createOrReplaceTempView("current_pay")
    pay.filter("LoanID = 'A'").createOrReplaceTempView("current_pay")
    assert tables.read_table(spark, "pay", "current_pay").count() == 1


def test_activity_of_another_database_keeps_its_columns(spark):
    spark.sql("create database if not exists elsewhere")
    rows = spark.sql("select 7 as loanid, '2020-01-05' as ActivityDate, 'call' as Kind, 3 as Agent")
    rows.write.mode("overwrite").saveAsTable("elsewhere.activity")
    activity = tables.read_table(spark, "activity", "elsewhere.activity")
    assert activity.columns == ["LoanID", "ActivityDate", "Kind", "Agent"]
    assert as_set(activity) == [("7", "2020-01-05", "call", 3)]
