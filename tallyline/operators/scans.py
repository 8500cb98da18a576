"""Ordered scans per loan that do not put a whole loan into one task.

A window partitioned by loan alone sends every row of the loan to one task. The
scans here partition by (loan, block) instead. Blocks come from the data: one row
in ``rows_per_block`` is a cut, as told by a hash of its loan and sort key, and a new
block of the loan begins there. A loan with a third of all rows has a third of the
cuts; most loans have none and are one block. The cuts are few, bounded in number
and found by one narrow scan, so the table of them is broadcast.
What a block needs from those before it is worked out again for the loans that have
cuts, and for them alone, and carried by a table with one row per (loan, block).

Everything is part of the plan: building a query starts no job, and small and
large loans share one plan. A hash finds the same cuts whenever a plan is evaluated.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ROWS_PER_BLOCK = ContextVar("rows_per_block", default=1 << 18)

# Cuts of one loan, and of all loans, at most. Beyond, every second, third, ... one counts.
CUTS_OF_ONE = 4096
CUTS = 1 << 17

ROWS = "rows"  # all rows up to this one
RANGE = "range"  # all rows up to this one and those tied with it
BEFORE = "before"  # all rows with a smaller sort key


@contextmanager
def rows_per_block(rows: int) -> Iterator[None]:
    """Queries built inside cut loans into blocks of so many rows on average."""
    token = _ROWS_PER_BLOCK.set(rows)
    try:
        yield
    finally:
        _ROWS_PER_BLOCK.reset(token)


def number_block(number: str, span: int = 4096) -> Column:
    """A block of ``span`` consecutive numbers, for numbers known to lie close."""
    return F.greatest(F.floor(F.col(number) / F.lit(span)), F.lit(0)).cast("int")


def cuts(rows: DataFrame, order: list[str], key: str = "LoanID") -> DataFrame:
    """(key, _cuts): the sort keys at which the blocks of a key begin, in order.

    A key without a cut is left out. No key has more than CUTS_OF_ONE and all have no more than CUTS.
    """
    chosen = F.pmod(F.xxhash64(key, *order), F.lit(_ROWS_PER_BLOCK.get())) == 0
    found = (
        rows.filter(chosen)
        .groupBy(key)
        .agg(F.sort_array(F.collect_set(F.struct(*order))).alias("_cuts"))
    )
    # One row for each loan that is cut: a small table, on its way to a broadcast.
    all_cuts = F.sum(F.size("_cuts")).over(Window.partitionBy())
    most = F.greatest(F.size("_cuts") / F.lit(CUTS_OF_ONE), all_cuts / F.lit(CUTS))
    step = F.ceil(most).cast("int")
    kept = F.filter("_cuts", lambda cut, i: F.pmod(i + 1, F.col("_step")) == 0)
    return (
        found.withColumn("_step", step)
        .filter(F.size("_cuts") >= F.col("_step"))
        .select(key, kept.alias("_cuts"))
    )


# Steps of a search among the cuts of a loan.
_STEPS = tuple(1 << i for i in reversed(range(CUTS_OF_ONE.bit_length())))


def reached(here: Column, field: str | None = None) -> Column:
    """The block of a sort key: how many of the row's ``_cuts`` lie at it or before.

    ``field`` compares that field of a cut alone. Found by halving, so a loan of many cuts costs
    few comparisons, and one without costs none.
    """

    def further(found: Column, step: Column) -> Column:
        at = F.get("_cuts", found + step - 1)
        return F.when((at[field] if field else at) <= here, found + step).otherwise(found)

    search = F.aggregate(F.array(*[F.lit(s) for s in _STEPS]), F.lit(0), further)
    # Known not to be NULL, or joins by block would search once more to check it.
    return F.when(F.col("_cuts").isNull(), 0).otherwise(F.coalesce(search, F.lit(0)))


def few(cut: DataFrame) -> DataFrame:
    """For joins: there are hardly more than CUTS, whatever the input."""
    return F.broadcast(cut)


def with_cuts(rows: DataFrame, cut: DataFrame, key: str = "LoanID") -> DataFrame:
    """Add ``_cuts`` to the rows, NULL for a key without."""
    return rows.join(few(cut), key, "left")


def of_cut(rows: DataFrame, cut: DataFrame, key: str = "LoanID") -> DataFrame:
    """The rows of keys that are cut."""
    return rows.join(few(cut.select(key)), key, "left_semi")


def in_blocks(rows: DataFrame, cut: DataFrame, by: str, key: str = "LoanID") -> DataFrame:
    """Add ``_block`` by the first sort column of the cuts."""
    first = cut.schema["_cuts"].dataType.elementType.names[0]
    block = reached(F.col(by), first)
    return with_cuts(rows, cut, key).withColumn("_block", block).drop("_cuts")


def running_totals(
    rows: DataFrame,
    totals: dict[str, Column],
    order: list[str],
    block: Column | None = None,
    frame: str = ROWS,
    key: str = "LoanID",
    cut: DataFrame | None = None,
    carry_from: DataFrame | None = None,
    in_range: bool | None = None,
) -> DataFrame:
    """Add one running sum per entry of ``totals``, in ``order`` within ``key``.

    Blocks follow the first column of ``order``, at the cuts of ``cut`` or those of the rows
    themselves. ``block`` gives the block of a row where it is known: with ``cut`` as found by it,
    alone where a calendar or the like divides all keys. It must not decrease along ``order``.
    RANGE and BEFORE take a single integer sort column. A sum over no non-NULL value is NULL.

    ``carry_from`` are the rows of loans that are cut, for the pass over them, best found by ``of_cut`` before any
    shuffle: where no loan is cut, nothing is shuffled for that pass then. For rows that come
    from a join by key, ``in_range`` asks for a shuffle by key and block, as theirs would do for the windows
    and leave a large key in one task. True deals them out in ranges and keeps ``_block``: a sort by key, block
    and ``order`` then needs no other shuffle.
    """
    if block is None:
        cut = cuts(rows, order[:1], key) if cut is None else cut
        blocked = in_blocks(rows, cut, order[0], key)
    else:
        blocked = rows.withColumn("_block", block)
    divided = blocked
    if cut is not None:
        if carry_from is not None:
            divided = in_blocks(carry_from, cut, order[0], key)
        divided = of_cut(divided, cut, key)
    if in_range is not None:
        deal = blocked.repartitionByRange if in_range else blocked.repartition
        blocked = deal(key, "_block")

    within = Window.partitionBy(key, "_block").orderBy(*order)
    within = {
        ROWS: within.rowsBetween(Window.unboundedPreceding, Window.currentRow),
        RANGE: within.rangeBetween(Window.unboundedPreceding, Window.currentRow),
        BEFORE: within.rangeBetween(Window.unboundedPreceding, -1),
    }[frame]
    local = blocked.select(
        "*", *[F.sum(value).over(within).alias(name) for name, value in totals.items()]
    )

    blocks = Window.partitionBy(key).orderBy("_block")
    earlier = blocks.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        divided.groupBy(key, "_block")
        .agg(*[F.sum(value).alias(name) for name, value in totals.items()])
        .select(
            key,
            "_block",
            F.lag("_block").over(blocks).alias("_previous"),
            *[F.sum(name).over(earlier).alias(f"_carried_{name}") for name in totals],
        )
        .filter(F.col("_previous").isNotNull())
        .drop("_previous")
    )

    def total(name: str) -> Column:
        here, before = F.col(name), F.col(f"_carried_{name}")
        return F.coalesce(here + before, here, before).alias(name)

    if cut is not None:
        carried = few(carried)
    return local.join(carried, [key, "_block"], "left").select(
        *rows.columns, *["_block"][: int(in_range or False)], *[total(name) for name in totals]
    )
