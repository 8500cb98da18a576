"""Compression of vectors to codes: a codebook for every part, fitted through metric trees.

Components become integers, vectors are cut into equal parts, and each part has a codebook that
starts as the part of the vectors of the smallest ids. In each round every part goes to its nearest entry and
each entry moves to the mean of its parts, rounded down. All is in integers, so results depend neither on
the order of rows nor on how they lie in partitions.

Vectors are never shuffled: each task plants the trees of ``anchors`` over chunks of the rows it reads
and stores them. A round settles the trees against the codebooks and adds up counts and sums, of
which one row for each task, part and entry is shuffled and one for each part and entry
reaches the driver. A hot vector or label is no task's burden but that of the chunks it lies in.

Dropped are rows whose vector is NULL, empty, holds a component that is NULL, not finite or of magnitude 2^15 or
more (whose squares do not fit), or has another number of components than the smallest id's. NULL ids
come last, equal ids by their vectors. Repeated rows count each. With fewer vectors than entries the
codebooks have as many entries as there are vectors. A number of components that the parts do not
divide is filled up with zeros. Of other columns than id, vector and label none is looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.anchors import Forest, planted, settled
from tallyline.llm.common import ship, stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LARGEST = float(1 << 15)
# Vectors that share their trees.
CHUNK = 2048


def whole_numbers(rows: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """(vec_id, label, v) of the rows whose vector is usable, as integers."""
    usable = F.size(vector) > 0
    usable &= F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(LARGEST), F.lit(False)))
    return rows.filter(usable).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("int")).alias("v"),
    )


def _first(rows: DataFrame, n: int) -> list[list[int]]:
    return [r.v for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(n).select("v").collect()]


def _cut(vectors: np.ndarray, parts: int) -> np.ndarray:
    """(n, parts, width), filled up with zeros."""
    n, size = vectors.shape
    return np.pad(vectors, ((0, 0), (0, -size % parts))).reshape(n, parts, -1)


def trees(rows: DataFrame, size: int, parts: int = PARTS, chunk: int = CHUNK) -> DataFrame:
    """(ids, labels, forest): one row for each chunk of vectors of ``size`` components."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(held: pa.Table) -> pa.RecordBatch:
            values = held["v"].combine_chunks().flatten().to_numpy()
            forest = planted(_cut(values.reshape(-1, size).astype(np.int32), parts)).dump()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([held["vec_id"].to_pylist()], pa.list_(pa.int64())),
                    pa.array([held["label"].to_pylist()], pa.list_(pa.string())),
                    pa.array([forest], pa.binary()),
                ],
                names=["ids", "labels", "forest"],
            )

        held, waiting = [], 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            waiting += batch.num_rows
            if waiting >= chunk:
                table = pa.concat_tables(held)
                for i in range(0, waiting - chunk + 1, chunk):
                    yield row(table.slice(i, chunk))
                held = [table.slice(waiting - waiting % chunk)]
                waiting %= chunk
        if waiting:
            yield row(pa.concat_tables(held))

    return rows.mapInArrow(grow, "ids array<bigint>, labels array<string>, forest binary")


def _moved(forests: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebooks after one round; entries without parts stay."""
    parts, entries, width = book.shape
    names = [f"s{i}" for i in range(width)]

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, entries), dtype=np.int64)
        sums = np.zeros((parts, entries, width), dtype=np.int64)
        for batch in batches:
            for data in batch.column("forest"):
                _, n, s = settled(Forest.load(data.as_py()), book)
                counts += n
                sums += s
        part, entry = np.nonzero(counts)
        columns = [part, entry, counts[part, entry], *sums[part, entry].T]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "n", *names]
        )

    schema = ", ".join(f"{name} long" for name in ["part", "entry", "n", *names])
    totals = (
        forests.select("forest")
        .mapInArrow(settle, schema)
        .groupBy("part", "entry")
        .agg(*[F.sum(name).alias(name) for name in ["n", *names]])
    )
    moved = book.copy()
    for row in totals.collect():
        moved[row.part, row.entry] = [row[name] // row.n for name in names]
    return moved


def fit(forests: DataFrame, book: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks after all rounds."""
    for _ in range(rounds):
        book = _moved(forests, book)
    return book


def digest(book: np.ndarray, size: int) -> str:
    """The SHA-256 of all components of the codebooks, without what was filled up."""
    parts, entries, width = book.shape
    numbers = [
        str(book[p, e, i])
        for p in range(parts)
        for e in range(entries)
        for i in range(width)
        if p * width + i < size
    ]
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def encoded(forests: DataFrame, book: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every vector."""
    parts = book.shape[0]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, data in zip(*(batch.column(i) for i in range(3))):
                forest = Forest.load(data.as_py())
                codes, _, _ = settled(forest, book)
                chosen = book[np.arange(parts), codes]
                error = ((forest.points.astype(np.int64) - chosen) ** 2).sum(axis=(1, 2))
                text = [bytes(row).hex() for row in codes.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [ids.values, labels.values, pa.array(text, pa.string()), pa.array(error)],
                    names=["vec_id", "label", "code", "error"],
                )

    schema = "vec_id long, label string, code string, error long"
    return forests.mapInArrow(encode, schema)


def compressed(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every usable row, and the codebooks.

    ``error`` is the squared distance of a vector from its entries, ``label_error`` its sum over the
    rows of the same label, those without one together.
    """
    spark = rows.sparkSession
    ship(spark)
    usable = whole_numbers(rows, vec_id, vector, label)
    first = _first(usable, 1)
    size = len(first[0]) if first else 0
    usable = usable.filter(F.size("v") == size)
    if first:
        starts = np.array(_first(usable, ENTRIES), dtype=np.int64)
        book = _cut(starts, PARTS).swapaxes(0, 1)
        forests = stored(trees(usable, size), "forests")
        book = fit(forests, book)
        codes = stored(encoded(forests, book), "codes")
    else:
        book = np.zeros((PARTS, 0, 0), dtype=np.int64)
        codes = spark.createDataFrame([], "vec_id long, label string, code string, error long")
    totals = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    totals = totals.withColumnRenamed("label", "_label")
    result = codes.join(totals, F.col("label").eqNullSafe(F.col("_label"))).select(
        *codes.columns, "label_error", F.lit(digest(book, size)).alias("codebooks_sha256")
    )
    return result, book
