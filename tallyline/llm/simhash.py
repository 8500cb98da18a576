"""Near duplicates by SimHash: fingerprints that differ in few bits, and what they connect.

The fingerprint of a text is taken over the hashes of its word shingles. Fingerprints that differ
in two bits at most, cut into two segments, agree in one of them but for one bit at most. So each
is indexed by both segments with one bit deleted, 64 keys in all, and every linked pair meets under
some key. Only distinct fingerprints are indexed; copies share one.

A key that two fingerprints share gives a pair, verified by counting the bits that differ. A key
that more share, as large groups of near copies make, is not expanded into pairs: its fingerprints
are indexed once more, by themselves and by each of the 64 with one bit changed. Two fingerprints
meet there exactly if two bits at most differ, no more than 65 meet under one key, and each is linked
to the smallest of them only, which connects the same. The work is in proportion to the distinct
fingerprints, whatever the sizes of the groups.

A text of no words, empty or NULL, has fingerprint zero and is linked like any other. Repeated rows
stay. A NULL id has a fingerprint and a component but names none. Of the other columns of the input
none is returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import as_bytes, ship, stored, thrifty
from tallyline.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
# Hashes whose bits are counted at a time.
_BLOCK = 1 << 16


def shingles(text: bytes, size: int) -> list[bytes]:
    """The runs of ``size`` lower-cased words joined by blanks; the whole text if it has fewer."""
    words = text.lower().split()
    joined = b" ".join(words)
    if len(words) <= size:
        return [joined] if words else []
    ends = list(accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends[:-1]]
    return [joined[a : b - 1] for a, b in zip(starts, ends[size - 1 :], strict=False)]


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """The 64 bits, each the majority of that bit in the hashes of all shingles; ties give 0."""
    hash_of = xxhash.xxh64_intdigest
    hashes = [hash_of(s, SEED) for s in shingles(text or b"", size)]
    if not hashes:
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), _BLOCK):
        block = np.array(hashes[i : i + _BLOCK], dtype="<u8").view(np.uint8)
        ones += np.unpackbits(block, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE
) -> DataFrame:
    """(doc_id, fp) of every row."""
    ship(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, size) for t in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"]
            )

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return given.mapInArrow(thrifty(of), "doc_id long, fp long")


def fingerprint_of(text: str, size: int = SHINGLE) -> Column:
    """The fingerprint of a column of texts, as ``fingerprints`` has it."""

    @F.pandas_udf("long")
    def of(batch: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t and t.encode(), size) for t in batch], dtype="int64")

    # Or a filter on the fingerprint would move below and take it once more, by a second worker a task.
    return of.asNondeterministic()(F.col(text))


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i)


def _differ(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _segment_keys(fps: DataFrame) -> DataFrame:
    """(key, fp): either half of a fingerprint with one of its 32 bits deleted."""
    half = F.when(F.col("_i") < 32, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(
        F.shiftrightunsigned("fp", 32)
    )
    rest = half.bitwiseAND(F.bitwise_not(_bit(F.col("_i") % 32)))
    return fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("_i")).select(
        F.shiftleft(F.col("_i").cast("long"), 32).bitwiseOR(rest).alias("key"), "fp"
    )


def _ball_keys(fps: DataFrame) -> DataFrame:
    """(key, fp): a fingerprint, and each that differs from it in one bit."""
    at = F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("_i")
    near = F.when(F.col("_i") < 0, F.col("fp")).otherwise(
        F.col("fp").bitwiseXOR(_bit(F.greatest("_i", F.lit(0))))
    )
    return fps.select("fp", at).select(near.alias("key"), "fp")


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect all within ``MAX_BITS`` bits."""
    keyed = _segment_keys(fps)
    shared = stored(
        keyed.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .filter("n > 1"),
        "keys",
        narrow=True,
    )
    pairs = shared.filter("n = 2").select("a", "b").distinct()
    # Merged at any size: a broadcast that only small inputs allow would hide a shuffle.
    crowded = shared.filter("n > 2").select("key").hint("merge")
    members = keyed.join(crowded, "key", "left_semi").select("fp").distinct()
    ball = _ball_keys(stored(members, "members", narrow=True))
    least = ball.groupBy("key").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n"))
    stars = ball.join(least.filter("n > 1"), "key").select("a", F.col("fp").alias("b")).distinct()
    return pairs.unionByName(stars).filter((F.col("a") != F.col("b")) & (_differ("a", "b") <= MAX_BITS))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE
) -> DataFrame:
    """(doc_id, fp, component_id) of every row: the smallest id among all that links reach."""
    fps = stored(fingerprints(docs, doc_id, text, size), "fingerprints")
    first = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct", narrow=True)
    rooted = components(links(first.select("fp")), "a", "b").withColumnRenamed("node", "fp")
    smallest = rooted.join(first, "fp").groupBy("root").agg(F.min("first").alias("component_id"))
    classes = stored(
        first.join(rooted.join(smallest, "root").select("fp", "component_id"), "fp", "left").select(
            "fp", F.coalesce("component_id", "first").alias("component_id")
        ),
        "classes",
        narrow=True,
    )
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")
