"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import pathlib
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

# Whitespace that separates words: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


_shipped: set[str] = set()

# Texts are long: batches to Python of the default size hold tens of megabytes each, in the JVM
# outside its heap and again in the worker.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_DEFAULT, _SMALL = "67108864b", "4194304b"


def ship(spark: SparkSession) -> None:
    """Make this library importable in the Python workers, once per application.

    Also lowers the size of batches in the session, if it is the default.
    """
    if spark.conf.get(_BATCH_BYTES, _DEFAULT) == _DEFAULT:
        spark.conf.set(_BATCH_BYTES, _SMALL)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = pathlib.Path(__file__).resolve().parents[1]
    archive = pathlib.Path(tempfile.mkdtemp(prefix="code-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``: the fold of a document."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(divisor))


def words(text: Column) -> Column:
    """The words of a text as an array; none for a NULL or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, BLANK_RUN)
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    Only a local session, whose executors are the driver, may do without the setting.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith(("local[", "local")) or (
        spark.sparkContext.master.startswith("local-cluster")
    ):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts the lineage, so a lost executor costs no recomputation, and is read column by column.
    ``narrow`` is for rows of a few numbers: they make one file per core instead of one per
    partition, since many small files cost more than they hold.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows = df.coalesce(df.sparkSession.sparkContext.defaultParallelism) if narrow else df
    rows.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return to the system what this process has freed but holds."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def thrifty(of: Callable[[Iterator[T]], Iterator[T]]) -> Callable[[Iterator[T]], Iterator[T]]:
    """``of`` for ``mapInArrow``, with freed memory given back at the end of a task.

    An executor has more workers than cores, and those between two tasks would hold the peak of their last.
    """

    def run(batches: Iterator[T]) -> Iterator[T]:
        yield from of(batches)
        give_back()

    return run


def released(spark: SparkSession) -> None:
    """Have idle Python workers give back the tables and buffers of the operator they served last.

    Workers outlive their tasks. Between the stages of a pipeline, what one stage's operator caches
    for its next task is only in the way of the next stage's.
    """
    ship(spark)

    def release(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, module in list(sys.modules.items()):
            if name.startswith(f"{__package__}."):
                for held in ("_tokenizers", "_models"):
                    getattr(module, held, {}).clear()
        gc.collect()
        give_back()
        yield from batches

    # As a task takes the worker that was idle longest, these reach all of them.
    tasks = 6 * spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).mapInArrow(release, "id long").count()


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow column as UTF-8, without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()
