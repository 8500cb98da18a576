"""Mixing of sources to target weights by balanced sampling (the cube method).

Sources share all words by their weights, and none gets more than ``MOST`` times its own; what is above is
shared again among the others. A source's documents are then taken as often as its target goes into it whole,
and once more with the probability of the rest, so that the words and the documents taken are as
many as wanted: probabilities move through the null space of the balancing equations, at random but with
nothing expected to change, until they are 0 or 1.

A step looks at a few documents, moves the largest most and has the others make up for it, so only
a few small documents are left undecided. Where the others cannot make up for a
document in words and number both, that step keeps the words. The documents of a source are dealt
out to blocks by a hash, each block is one stream of such steps, and what blocks leave undecided is
dealt out again, until a source is one block: then two documents at most are left, one for each
equation, and these are given up, the one of documents first, which is the landing. A source of any size is many tasks' work, and a task holds a few documents.

Everything random comes from the documents, so reruns agree however rows lie in partitions. A NULL text
has no words, a NULL source is the last source, and NULL ids and repeated rows are documents like others.
Documents without words count in the number of documents. Without any words nothing is taken. Columns other than id, text
and source are not looked at.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import ship, stored
from tallyline.operators.scans import running_totals

# Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
# A source gives so many times its words at most, and a document its own.
MOST = 3
# Documents of a block, about.
BLOCK = 1 << 16
# Undecided documents that a step looks at, at most; more come when half are decided.
WINDOW = 40
# The share of a document's own direction that the equations may take before one is given up.
OUTLIER = 0.9
# Probabilities so near to 0 or 1 are there.
_NEAR = 1e-9

_WORD = r"[^\x20\x09-\x0D]+"
_UNIT = (
    "doc_id long, source string, source_no long, block long, size long, hash long, p double, "
    "source_size long, target double, whole long"
)


def sizes(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """(doc_id, source, size, hash) of every document."""
    given = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.regexp_count(given, F.lit(_WORD)).cast("long").alias("size"),
        F.xxhash64(doc_id, text).alias("hash"),
    )


def numbered_sources(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_no, weight, n, source_size), numbered by code point, NULL last."""
    found = stored(
        sized.groupBy("source").agg(
            F.count(F.lit(1)).alias("n"), F.sum("size").cast("long").alias("source_size")
        ),
        "sources",
        narrow=True,
    )
    named = found.filter("source is not null").withColumn("_all", F.lit(0))
    numbered = running_totals(named, {"source_no": F.lit(1)}, ["source"], key="_all").drop("_all")
    last = found.filter("source is null").withColumn(
        "source_no", named.agg(F.count(F.lit(1))).scalar() + 1
    )
    place = F.pmod(F.col("source_no") - 1, F.lit(len(weights))).cast("int")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), place)
    return stored(
        numbered.unionByName(last).select("source", "source_no", weight.alias("weight"), "n", "source_size"),
        "numbered",
        narrow=True,
    )


def with_targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """Add ``target``: the words that a source is to give.

    A round shares what the sources at their limit leave, by weight among the others; the words for
    a weight of 1 only grow, so no source comes back from its limit. Only sums reach the driver.
    """
    limit = F.col("source_size") * most
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    each, full = (total or 0) / (weights or 1), -1
    while True:
        above = limit <= F.lit(float(each)) * F.col("weight")
        now, given, rest = sources.agg(
            F.count_if(above),
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
        ).first()
        if now == full or not rest:
            share = F.lit(float(each)) * F.col("weight")
            return sources.withColumn("target", F.least(share, limit.cast("double")))
        full, each = now, (total - given) / rest


def _moved(p: list[float], x: list[int], equations: int, draw: float) -> None:
    """One step: move the probabilities along the null space until one is 0 or 1.

    ``equations`` is 2 to keep words and documents, 1 to keep words, 0 to keep nothing. The direction is the
    first document's own, as far as the equations leave it: what a regression on them cannot explain.
    """
    m, most = len(p), max(max(x), 1)
    scaled = [v / most for v in x]
    if equations == 2:
        mean = sum(scaled) / m
        centred = [v - mean for v in scaled]
        spread = sum(v * v for v in centred)
        explained = 1 / m + (centred[0] ** 2 / spread if spread > 1e-18 else 0.0)
        # A document unlike the others, which they cannot make up for in number too.
        equations -= explained > OUTLIER and m > 2
    for first in range(m):
        if equations == 2:
            slope = centred[first] / spread if spread > 1e-18 else 0.0
            u = [(k == first) - 1 / m - slope * v for k, v in enumerate(centred)]
        elif equations == 1 and any(x):
            slope = scaled[first] / sum(v * v for v in scaled)
            u = [(k == first) - slope * v for k, v in enumerate(scaled)]
        else:
            u = [float(k == first) for k in range(m)]
        if max(map(abs, u)) > 1e-9:
            break
    u = [0.0 if abs(v) <= 1e-12 else v for v in u]
    up = min((1 - q) / v if v > 0 else q / -v for q, v in zip(p, u) if v)
    down = min(q / v if v > 0 else (1 - q) / -v for q, v in zip(p, u) if v)
    step = up if draw * (up + down) < down else -down
    for k, v in enumerate(u):
        q = p[k] + step * v
        p[k] = 0.0 if q < _NEAR else 1.0 if q > 1 - _NEAR else q


class Flight:
    """The documents of one block, decided one after the other as they come, largest first."""

    def __init__(self, seed: str, landing: bool):
        self._draw = random.Random(seed).random
        self._landing = landing
        self._rows: list[tuple] = []
        self._p: list[float] = []
        self._x: list[int] = []

    def add(self, row: tuple, p: float, x: int) -> Iterator[tuple[tuple, float]]:
        self._rows.append(row)
        self._p.append(p)
        self._x.append(x)
        if len(self._rows) >= WINDOW:
            # The largest first, as long as others of its size can make up for it.
            largest = self._rows[0]
            while len(self._rows) > WINDOW // 2 and self._rows[0] is largest:
                yield from self._step(2)

    def _step(self, equations: int) -> Iterator[tuple[tuple, float]]:
        _moved(self._p, self._x, equations, self._draw())
        left = [k for k, p in enumerate(self._p) if 0 < p < 1]
        for k, p in enumerate(self._p):
            if not 0 < p < 1:
                yield self._rows[k], p
        self._rows = [self._rows[k] for k in left]
        self._p = [self._p[k] for k in left]
        self._x = [self._x[k] for k in left]

    def end(self) -> Iterator[tuple[tuple, float]]:
        """What is left: of a landing all decided, else the undecided with their probabilities."""
        if self._landing:
            while len(self._rows) > 2:
                yield from self._step(2)
            while len(self._rows) > 1:
                yield from self._step(1)
            while self._rows:
                yield from self._step(0)
        yield from zip(self._rows, self._p)


def _flown(units: DataFrame, level: int) -> DataFrame:
    """The units after the flight of their blocks; those of a source with one block are decided."""

    def fly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, flight, out = None, None, []

        def batch_of(rows: list) -> pa.RecordBatch:
            columns = list(zip(*[(*row[:6], p, *row[7:10]) for row, p in rows])) or [()] * 10
            kinds = [pa.int64(), pa.string(), *[pa.int64()] * 4, pa.float64(), pa.int64(), pa.float64(), pa.int64()]
            names = [c.split()[0] for c in _UNIT.split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if (row[2], row[3]) != group:
                    if flight:
                        out += flight.end()
                    group = row[2], row[3]
                    flight = Flight(f"{level} {row[2]} {row[3]}", row[10] == 1)
                out += flight.add(row, row[6], row[4])
            yield batch_of(out)
            out = []
        if flight:
            yield batch_of(list(flight.end()))

    # Blocks of a source by its undecided documents; a block is one stream, in one order.
    many = units.groupBy("source_no").agg(F.count(F.lit(1)).alias("_n"))
    blocks = F.ceil(F.col("_n") / F.lit(BLOCK)).cast("long")
    dealt = units.drop("block").join(many, "source_no").withColumn("_blocks", blocks)
    block = F.pmod(F.xxhash64("hash", F.lit(level)), F.col("_blocks"))
    names = [c.split()[0] for c in _UNIT.split(", ")]
    dealt = dealt.withColumn("block", block).select(*names, "_blocks")
    order = ["source_no", "block", F.col("size").desc(), "hash", F.col("doc_id").asc_nulls_first()]
    streams = dealt.repartition("source_no", "block").sortWithinPartitions(*order)
    return streams.mapInArrow(fly, _UNIT)


def mixed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
) -> DataFrame:
    """(doc_id, source, hash, size, source_size, target, copies, taken) of every document.

    ``copies`` says how often the mix takes the document and ``taken`` how many words that is.
    """
    ship(docs.sparkSession)
    sized = stored(sizes(docs, doc_id, text, source), "sizes")
    targets = with_targets(numbered_sources(sized, weights), most).select(
        F.col("source").alias("_source"), "source_no", "source_size", "target"
    )
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = sized.join(targets, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id",
        "source",
        "source_no",
        F.lit(0).cast("long").alias("block"),
        "size",
        "hash",
        _settled(times - F.floor(times)).alias("p"),
        "source_size",
        "target",
        F.floor(times).alias("whole"),
    )
    open_, level, decided = stored(units, "units"), 0, []
    undecided = (F.col("p") > 0) & (F.col("p") < 1)
    while True:
        decided.append(open_.filter(~undecided))
        open_ = open_.filter(undecided)
        if open_.isEmpty():
            break
        open_, level = stored(_flown(open_, level), "flown"), level + 1
    rows = decided[0]
    for more in decided[1:]:
        rows = rows.unionByName(more)
    copies = F.col("whole") + F.col("p").cast("long")
    return rows.select(
        "doc_id",
        "source",
        "hash",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (F.col("size") * copies).alias("taken"),
    )


def _settled(p: Column) -> Column:
    return F.when(p < _NEAR, 0.0).when(p > 1 - _NEAR, 1.0).otherwise(p)


def copies_of(
    docs: DataFrame, mix: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the number of the copy in ``_copy``.

    Rows equal in id, text and source are one document that is taken as often as they are together.
    """
    wanted = (
        mix.groupBy("doc_id", "source", "hash")
        .agg(F.sum("copies").alias("_copies"))
        .filter("_copies > 0")
        .select(F.struct("doc_id", "source", "hash").alias("_wanted"), "_copies")
    )
    unit = F.struct(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.xxhash64(doc_id, text).alias("hash"),
    )
    others = [c for c in docs.columns]
    once = docs.select(unit.alias("_unit"), F.struct(*others).alias("_row")).groupBy("_unit")
    taken = once.agg(F.any_value("_row").alias("_row")).join(
        wanted, F.col("_unit").eqNullSafe(F.col("_wanted"))
    )
    number = F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy")
    return taken.select(*[F.col("_row").getField(c).alias(c) for c in others], number)
