import pathlib
import sys
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from tallyline.sources.contracts import CONTRACTS, conform  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Build a contract table from dicts; missing columns are NULL.

    Text is cast, so dates and amounts can be written as strings.
    """

    def build(name: str, rows: list[dict]):
        contract = CONTRACTS[name]
        schema = ", ".join(f"{column} string" for column in contract)
        values = [
            tuple(None if row.get(c) is None else str(row[c]) for c in contract) for row in rows
        ]
        return conform(spark.createDataFrame(values, schema), contract)

    return build


def as_set(df, *columns):
    """The rows as a sorted list of tuples with plain values."""
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(plain(v) for v in row) for row in rows), key=repr)


def plain(value):
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, date):
        return value.isoformat()
    return value
