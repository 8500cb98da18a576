"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node at hand."""
    both = links.select(F.col("u").alias("node"), F.col("v").alias("other")).unionByName(
        links.select(F.col("v").alias("node"), F.col("u").alias("other"))
    )
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    return (
        both.filter("other > node")
        .join(least, "node")
        .select(F.col("other").alias("u"), F.least("node", "least").alias("v"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    moved = links.join(least, "u").filter("v <> least").select(F.col("v").alias("u"), "least")
    return moved.unionByName(least).select("u", F.col("least").alias("v")).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every linked node; the root is the smallest node of its component.

    Each round lets all nodes link to the least node near them, so rounds grow with the logarithm
    of the longest path. A round is written to the shared folder; what reaches the driver is a
    count and a checksum. Aggregates combine before they shuffle and joins can be split, so the
    centre of a large star is no single task's work. Links to itself and NULLs are left out.
    """
    now = stored(
        links.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
        narrow=True,
    )
    state = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == state or not seen[0]:
            break
        state = seen
        now = stored(_small_star(_large_star(now)), "links", narrow=True)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
