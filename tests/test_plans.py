"""Shapes of the physical plans, and behaviour with one very large loan."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyline.operators import align, scans, snapshot, totals
from tallyline.operators.lookup import loan_detail
from tallyline.plans import registry
from tallyline.plans.ledger import analysis_ledger, cumulative_ledger
from tallyline.plans.routines import register_functions
from tallyline.sources import tables
from tallyline.sources.contracts import CONTRACTS

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sort_merge(spark):
    """Plans as for tables too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The inputs as Parquet files, with one loan holding most rows."""
    folder = tmp_path_factory.mktemp("inputs")
    first = F.lit(date(2020, 1, 1))
    many = spark.range(20000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("LoanID"),
        F.date_add(first, (F.col("id") % 50).cast("int")).alias("day"),
        F.element_at(F.array(F.lit("posted"), F.lit("past_due")), (F.col("id") % 2 + 1).cast("int")).alias("status"),
        "id",
    )
    frames = {
        "pay": many.select(
            "LoanID",
            F.col("day").alias("PaymentDate"),
            F.col("status").alias("Status"),
            (F.col("id") % 40).alias("MonthNumber"),
            F.lit("1.00").alias("AmountPrincipal"),
            F.lit("0.10").alias("AmountInterest"),
        ),
        # Numbered by date: 400 bills a day in the large loan.
        "bill": many.select(
            "LoanID",
            F.col("day").alias("PaymentDate"),
            F.when(
                F.col("LoanID") == "hot", (F.col("id") % 50) * 400 + F.floor(F.col("id") / 50)
            )
            .otherwise(1)
            .alias("PaymentNumber"),
        ),
        "loan": many.select("LoanID").distinct(),
        "cb": many.select("LoanID").distinct(),
    }
    inputs = {}
    for name, frame in frames.items():
        contract = CONTRACTS[name]
        columns = [
            (F.col(c) if c in frame.columns else F.lit(None)).cast(type_).alias(c)
            for c, type_ in contract.items()
        ]
        path = str(folder / name)
        frame.select(*columns).write.parquet(path)
        inputs[name] = tables.read_path(spark, name, path)
    return inputs


def ledger(inputs, **more):
    return cumulative_ledger(
        inputs["pay"], inputs["bill"], inputs["loan"], inputs["cb"], datetime(2030, 1, 1), **more
    )


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_pairwise_joins_and_no_python(spark, sort_merge, name):
    text = plan(registry.queries()[name](spark, SF_DIR))
    for node in ("CartesianProduct", "NestedLoopJoin", "Python", "Arrow"):
        assert node not in text


def test_only_needed_columns_are_read(stored, sort_merge):
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan(ledger(stored)))
    pay = next(scan for scan in scans if "AmountPrincipal" in scan)
    assert "PrincipalWaived" not in pay and "MonthNumber" not in pay
    bill = next(scan for scan in scans if "PaymentNumber" in scan)
    assert "PrincipalPayment" not in bill


def test_payments_are_collapsed_first_and_placed_by_piece(stored, sort_merge):
    text = plan(align.align_payments_to_statements(stored["pay"], stored["bill"]))
    by_day = r"Exchange hashpartitioning\(LoanID#\d+, PaymentDate#\d+, Status#\d+"
    assert len(re.findall(by_day, text)) == 1
    by_piece = r"Exchange hashpartitioning\(LoanID#\d+, _block#\d+, _piece#\d+"
    assert len(re.findall(by_piece, text)) == 2
    # By loan alone go the cuts of bills, and nothing else.
    for shuffle in re.finditer(r"Exchange hashpartitioning\(LoanID#\d+, \d+\)", text):
        below = text[shuffle.end() :].split("\n")[1]
        assert "collect_set" in below


def executed(df):
    """The plan as it was run, where a reused exchange names its scan no second time."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_alignment_reads_bills_twice(stored, sort_merge):
    """Once for the cuts and once for the periods."""
    with scans.rows_per_block(1024):
        text = executed(align.align_payments_to_statements(stored["pay"], stored["bill"]))
    assert reads(text, "PaymentNumber") == 2
    assert reads(text, "AmountPrincipal") == 1


def reads(text, column):
    return sum(column in scan for scan in re.findall(r"ReadSchema: struct<([^\n]*)", text))


def test_running_totals_read_the_amounts_once(stored, sort_merge):
    """Where no loan is cut, the pass for what is carried falls away as the query runs."""
    bills, chain = totals.bill_running_totals, totals.bill_chain_totals
    ordinary = stored["bill"].filter("LoanID <> 'hot'")
    assert reads(executed(bills(ordinary)), "PrincipalPayment") == 1
    assert reads(executed(chain(ordinary)), "PrincipalPayment") == 1
    assert reads(executed(snapshot.totals_by_month(stored["pay"])), "AmountPrincipal") == 1


def test_snapshot_measures_read_payments_twice(stored, sort_merge):
    position = stored["loan"].select("LoanID")
    inputs = stored["pay"], stored["bill"]
    as_of = date(2030, 1, 1)
    statements = snapshot.statement_measures(*inputs, position, as_of)
    loans = snapshot.loan_measures(*inputs, as_of)
    assert reads(executed(statements), "AmountPrincipal") <= 2
    assert reads(executed(loans), "AmountPrincipal") <= 2


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - registry.STORED))
def test_building_a_query_starts_no_job(spark, name):
    spark.sparkContext.setJobGroup(f"building {name}", name)
    registry.queries()[name](spark, SF_DIR)
    tracker = spark.sparkContext.statusTracker()
    assert list(tracker.getJobIdsForGroup(f"building {name}")) == []


def test_large_and_ordinary_loans_share_one_plan(stored, sort_merge):
    def shape(inputs):
        return re.sub(r"#\d+L?|\d+", "", plan(totals.bill_running_totals(inputs)))

    ordinary = stored["bill"].filter("LoanID <> 'hot'")
    large = stored["bill"].filter("LoanID <> 'ice'")
    assert shape(ordinary).replace("hot", "") == shape(large).replace("ice", "")


@pytest.mark.parametrize("name", ["loan_status", "nth_previous_business_day_of_bills"])
def test_holidays_are_read_once(spark, name):
    text = plan(registry.queries()[name](spark, SF_DIR))
    assert len(re.findall(r"date_format[^\n]*MM-dd", text.split("Initial Plan")[0])) <= 2
    assert text.count("MM-dd") <= 2


def test_loan_filter_reaches_both_scans(stored, sort_merge):
    one = analysis_ledger(
        stored["pay"], stored["bill"], stored["loan"], stored["cb"], loan_id="hot"
    )
    for scan in re.findall(r"PushedFilters: \[[^\]]*\], ReadSchema: [^\n]*Payment[^\n]*", plan(one)):
        assert "EqualTo(LoanID,hot)" in scan
    assert "EqualTo(LoanID,hot)" in plan(loan_detail(stored["bill"], "hot"))


def test_large_loan_is_collapsed_to_the_calendar(stored):
    pay, bill = stored["pay"], stored["bill"]
    days_and_statuses = 50 * 2
    payments = pay.filter("LoanID = 'hot'").count()
    assert payments > 13000
    assert align.daily_payments(pay).filter("LoanID = 'hot'").count() <= days_and_statuses
    aligned = align.align_payments_to_statements(pay, bill)
    assert aligned.filter("LoanID = 'hot'").count() <= days_and_statuses
    # Nothing is lost on the way: every payment of the loan has a period.
    total = aligned.filter("LoanID = 'hot'").agg(F.sum("AmountPrincipal")).first()[0]
    assert total == payments


def test_large_loan_spreads_over_blocks(stored):
    numbers = stored["bill"].filter("LoanID = 'hot'")
    with scans.rows_per_block(1024):
        cut = align.bill_cuts(stored["bill"])
        blocks = (
            scans.in_blocks(numbers, cut, "PaymentNumber").groupBy("_block").count().collect()
        )
        followed = {r.PaymentNumber: r for r in align.next_bill_date(numbers).collect()}
    assert len(blocks) >= 5
    assert max(row["count"] for row in blocks) <= 8 * 1024
    ordered = sorted(followed)
    for number, following in zip(ordered, ordered[1:]):
        assert followed[number].PaymentDateNext == followed[following].PaymentDate
    assert followed[ordered[-1]].PaymentDateNext == date(9999, 12, 31)


def test_cuts_are_bounded(stored, monkeypatch):
    monkeypatch.setattr(scans, "CUTS_OF_ONE", 40)
    monkeypatch.setattr(scans, "CUTS", 60)
    with scans.rows_per_block(2):
        cut = align.bill_cuts(stored["bill"])
        rows = {r.LoanID: len(r._cuts) for r in cut.collect()}
        assert sum(rows.values()) <= 60 and 20 <= rows["hot"] <= 40
        blocked = totals.bill_running_totals(stored["bill"]).filter("LoanID = 'hot'")
        blocked = sorted(map(repr, blocked.collect()))
    whole = totals.bill_running_totals(stored["bill"]).filter("LoanID = 'hot'")
    assert blocked == sorted(map(repr, whole.collect()))


@pytest.mark.parametrize("size", [64, 1024])
def test_a_loan_of_many_statements_is_totalled_in_blocks(stored, sort_merge, size):
    with scans.rows_per_block(size):
        blocked = ledger(stored, ordered=False)
    windows = re.findall(r"Window \[sum[^\n]*windowspecdefinition\(([^\n]*?) ASC", plan(blocked))
    assert windows and all("_block" in w for w in windows if "MonthNumber" in w)
    rows = sorted(map(repr, blocked.collect()))
    whole = sorted(map(repr, ledger(stored, ordered=False).collect()))
    assert [(a, b) for a, b in zip(rows, whole) if a != b][:2] == []
    assert len(rows) == len(whole)


def test_disordered_bills_of_one_loan_are_many_tasks_work(spark, table, sort_merge):
    """10,000 bills whose dates alternate between two rising series, a year apart."""
    first = date(2000, 1, 1).toordinal()
    day = [date.fromordinal(first + n // 4 + 365 * (n % 2)) for n in range(10_000)]
    bill = table(
        "bill", [{"LoanID": "hot", "PaymentNumber": n, "PaymentDate": d} for n, d in enumerate(day)]
    )
    pay = table(
        "pay", [{"LoanID": "hot", "PaymentDate": date.fromordinal(first + 9 * n)} for n in range(300)]
    )
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    with scans.rows_per_block(512):
        placed = align.placed_dates(pay, bill)
    assert not re.search(r"SortMergeJoin \[LoanID#\d+\]", plan(placed))
    tasks = placed.groupBy(F.spark_partition_id()).count().collect()
    spark.conf.unset(key)
    assert len(tasks) > 1
    total = sum(t["count"] for t in tasks)
    assert max(t["count"] for t in tasks) < 0.7 * total
    expected = sum(
        1
        for n in range(300)
        for a, b in zip(day, [*day[1:], date(9999, 12, 31)])
        if a <= date.fromordinal(first + 9 * n) < b
    )
    assert total == expected


def collapses(text):
    """For each shuffle that collapses payments, whether loans without a cut are dropped below it."""
    by_day = r"Exchange hashpartitioning\(LoanID#\d+, PaymentDate#\d+, Status#\d+"
    below = [text[found.end() :].split("FileScan")[0] for found in re.finditer(by_day, text)]
    return sorted("LeftSemi" in nodes for nodes in below)


@pytest.mark.parametrize("ordered", [False, True])
def test_only_payments_of_cut_loans_are_collapsed_twice(stored, sort_merge, ordered):
    inputs = stored["pay"], stored["bill"], stored["loan"], stored["cb"]
    for found in (ledger(stored, ordered=ordered), analysis_ledger(*inputs, ordered=ordered)):
        assert collapses(plan(found)) == [False, True]


def test_sql_functions_collapse_only_payments_of_cut_loans_twice(spark, stored, sort_merge):
    register_functions(spark, stored["pay"], stored["bill"], stored["loan"], stored["cb"])
    for name in ("cumulative_ledger", "ledger_analysis"):
        assert collapses(plan(spark.sql(f"select * from {name}()"))) == [False, True]


def test_the_order_of_the_ledger_costs_no_shuffle(stored, sort_merge):
    ordered, unordered = plan(ledger(stored)), plan(ledger(stored, ordered=False))
    assert ordered.count("Exchange ") == unordered.count("Exchange ")
    assert ordered.count("Exchange rangepartitioning(LoanID") == 1
    with scans.rows_per_block(64):
        rows = [tuple(r)[:5] for r in ledger(stored).collect()]
    # As the source sorts: NULLs first.
    in_order = sorted(rows, key=lambda r: [(v is not None, v) for v in (r[0], r[1], r[2], r[3])])
    assert [r[:4] for r in rows] == [r[:4] for r in in_order]


def test_bucketed_payments_and_terms_are_not_shuffled(spark, stored, sort_merge):
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    inputs = {}
    for name, frame in stored.items():
        tables.save_bucketed(frame, f"bucketed_{name}", buckets)
        inputs[name] = spark.table(f"bucketed_{name}")
    text = plan(ledger(inputs, ordered=False))
    # Payments are collapsed where they lie; shuffled are days, by piece, and never the terms.
    shuffled = "\n".join(re.findall(r"Exchange hashpartitioning[^\n]*", text))
    assert "PaymentDate#" not in shuffled
    for shuffle in re.finditer(r"Exchange hashpartitioning", text):
        scan = re.search(r"ReadSchema: struct<([^>]*)>", text[shuffle.end() :]).group(1)
        assert "Classification" not in scan and "AccountStatus" not in scan
    rows = sorted(map(repr, ledger(inputs).collect()))
    assert rows == sorted(map(repr, ledger(stored).collect()))
