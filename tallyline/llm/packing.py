"""Best-fit packing of tokenised documents into sequences of bounded length.

Documents are cut only where they exceed a sequence. What remains is packed by length alone: the
plan is made from the histogram of piece lengths, of which there are at most as many as a sequence
has tokens, by best fit decreasing over counts. A step of the plan puts a run of equally long pieces
into a run of equally filled sequences, so the plan's size depends on the sequence length and not on
the number of documents. Then every piece takes the slot that its rank among the pieces of its
length has in the plan.

Ranks are counted in cells of (length, salt) and shifted by the sizes of the cells before, so that
a length which most pieces share is ranked by many tasks.

A NULL text is empty and makes one piece, of the separator alone. Repeated rows are packed
repeatedly; rows with equal ids and pieces may exchange their slots. A NULL id is kept.
"""

from __future__ import annotations

import bisect
import re
import struct
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType
from tokenizers import Tokenizer

from tallyline.llm.common import ship, stored, thrifty

# Cells among which the pieces of one length are ranked.
SALTS = 256
# Words of which a worker caches the ids.
CACHED = 400_000

PIECES = [
    StructField("piece", IntegerType()),
    StructField("start", LongType()),
    StructField("length", LongType()),
    StructField("ids", BinaryType()),
]

# Characters below this code point are told apart here; a text with others, with control characters
# that count as blanks elsewhere, or with a special token goes to the library whole.
_PLAIN_END = 0x180
_SPECIAL = re.compile(r"<\|(?:startoftext|endoftext)\|>")


def _class(kinds: str) -> str:
    """The plain characters of the given general categories, for a character class."""
    return "".join(
        re.escape(chr(c))
        for c in range(_PLAIN_END)
        if unicodedata.category(chr(c))[0] in kinds and len(chr(c).lower()) == 1
    )


_BLANK = "".join(re.escape(chr(c)) for c in (*range(9, 14), 32, 0x85, 0xA0))
_ODD = re.compile(f"[^{_class('LNPSM')}{_BLANK}]")
_WORD_PARTS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_class('L')}]+|[{_class('N')}]|[^{_BLANK}{_class('LN')}]+"
)

_tokenizers: dict[str, WordIds] = {}


def _byte_signs() -> list[str]:
    """The printable sign that stands for each byte in the vocabulary of a byte-level model."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {b: chr(b) for b in plain}
    others = (b for b in range(256) if b not in signs)
    signs |= {b: chr(256 + i) for i, b in enumerate(others)}
    return [signs[b] for b in range(256)]


class WordIds(dict):
    """Packed token ids by word between blanks, of a word-wise byte-pair model.

    Tokens never reach over a blank, so a text's ids are those of its words in a row. The ids of
    a word come from the model of the library. The cache is bounded: when it is full, it becomes
    the older half, from which words in use are taken over.
    """

    def __init__(self, path: str, cached: int = CACHED):
        self._whole = Tokenizer.from_file(path)
        self._model = self._whole.model
        self._signs = _byte_signs()
        self._limit = cached // 2
        self._older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self._older.get(word)
        if ids is None:
            parts = _WORD_PARTS.findall(word)
            ids = b"".join([self.get(p) or self._older.get(p) or self._part(p) for p in parts])
        if len(self) >= self._limit:
            self._older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def _part(self, part: str) -> bytes:
        if not part.isascii():
            part = "".join([self._signs[b] for b in part.encode()])
        ids = [t.id for t in self._model.tokenize(part)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def of(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        if _ODD.search(text) or _SPECIAL.search(text):
            ids = self._whole.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype="<u4").tobytes()
        return b"".join(map(self.__getitem__, text.lower().split()))


def tokenizer(path: str) -> WordIds:
    """The tokenizer at ``path``, loaded once per process."""
    if path not in _tokenizers:
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


def tokenised(
    docs: DataFrame, path: str, capacity: int, separator: int = 1, text: str = "text"
) -> DataFrame:
    """The pieces of every document: its ids and the separator, cut after every ``capacity``.

    Has the columns of ``docs`` but the text and those named like a new one, and ``piece``,
    ``start`` (ids before it), ``length`` and ``ids``.
    """
    new = {f.name for f in PIECES}
    kept = docs.select(*[c for c in docs.columns if c != text and c not in new])
    schema = StructType([*kept.schema, *PIECES])
    end = struct.pack("<I", separator)
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = tokenizer(path).of
        for batch in batches:
            rows: list[int] = []
            pieces: list[tuple[int, int, bytes]] = []
            held = 0
            for row, value in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                ids = (ids_of(value) if value else b"") + end
                for i in range(0, len(ids), 4 * capacity):
                    rows.append(row)
                    part = ids[i : i + 4 * capacity]
                    pieces.append((i // (4 * capacity), i // 4, part))
                    held += len(part)
                if held > 1 << 26:
                    yield _pieces(batch, rows, pieces)
                    rows, pieces, held = [], [], 0
            if rows:
                yield _pieces(batch, rows, pieces)

    def _pieces(batch: pa.RecordBatch, rows: list[int], pieces: list) -> pa.RecordBatch:
        part, start, ids = zip(*pieces, strict=True)
        own = [c.take(pa.array(rows)) for c in batch.columns[:-1]]
        return pa.RecordBatch.from_arrays(
            [
                *own,
                pa.array(part, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array(ids, pa.binary()),
            ],
            names=[*batch.schema.names[:-1], "piece", "start", "length", "ids"],
        )

    return docs.select(*kept.columns, F.col(text).alias("_text")).mapInArrow(thrifty(cut), schema)


@dataclass(frozen=True)
class Step:
    """``count`` pieces of one length, from ``rank`` on, ``per`` to a sequence from ``sequence`` on."""

    length: int
    rank: int
    count: int
    sequence: int
    per: int
    offset: int


def plan(histogram: dict[int, int], capacity: int) -> list[Step]:
    """Best fit decreasing over the counts of lengths.

    Sequences with equal room form runs. Pieces of a length go to the run with the least room that
    takes them, several to a sequence while they fit; what no run takes opens new sequences. A run
    that is not used up is split, which adds two runs per step, so there are steps in proportion to
    the number of lengths and never to that of pieces.
    """
    steps: list[Step] = []
    runs: dict[int, list[tuple[int, int]]] = {}  # by room: (first sequence, sequences)
    rooms: list[int] = []  # in order
    opened = 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in runs:
                runs[room] = []
                bisect.insort(rooms, room)
            runs[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens")
        rank, left = 0, histogram[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = runs[room].pop()
                if not runs[room]:
                    del runs[room], rooms[at]
            else:
                room = capacity
                per = room // length
                first, n = opened, -(-left // per)
                opened += n
            per = room // length
            used = min(n, -(-left // per))
            count = min(left, used * per)
            steps.append(Step(length, rank, count, first, per, capacity - room))
            full = count // per
            put(room - per * length, first, full)
            put(room - (count - full * per) * length, first + full, used - full)
            put(room, first + used, n - used)
            rank, left = rank + count, left - count
    return steps


def ranked(pieces: DataFrame, salts: int = SALTS) -> DataFrame:
    """``pieces`` with ``_rank``, from 0 within each length, without a task per length."""
    key = [c for c in ("doc_id", "piece") if c in pieces.columns]
    salted = pieces.withColumn(
        "_salt", F.pmod(F.xxhash64(*key, "length"), F.lit(salts)).cast("int")
    )
    cells = Window.partitionBy("length").orderBy("_salt")
    before = (
        salted.groupBy("length", "_salt")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "length",
            "_salt",
            F.coalesce(
                F.sum("_n").over(cells.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_before"),
        )
    )
    within = Window.partitionBy("length", "_salt").orderBy(*key)
    return (
        salted.withColumn("_in_cell", F.row_number().over(within) - 1)
        .join(before, ["length", "_salt"])
        .withColumn("_rank", F.col("_before") + F.col("_in_cell"))
        .drop("_salt", "_before", "_in_cell")
    )


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, each piece whole and gapless from 0.

    Writes the pieces once to the shared folder, as both the histogram and the ranks need them.
    What reaches the driver is one count per length; the plan it broadcasts is bounded likewise.
    """
    given = stored(pieces.drop("sequence_id", "offset"), "pieces")
    counts = given.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    steps = sorted(
        plan({row.length: row.n for row in counts}, capacity), key=lambda s: (s.length, s.rank)
    )
    if not steps:
        return given.select(
            "*", F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("offset")
        )
    lengths = np.array(sorted({s.length for s in steps}))
    firsts = np.searchsorted([s.length for s in steps], lengths)
    table = given.sparkSession.sparkContext.broadcast(
        {
            int(length): tuple(
                np.array([getattr(s, name) for s in steps[a:b]], dtype=np.int64)
                for name in ("rank", "sequence", "per", "offset")
            )
            for length, a, b in zip(lengths, firsts, [*firsts[1:], len(steps)], strict=True)
        }
    )

    @F.pandas_udf("sequence_id long, offset long")
    def slots(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.zeros((2, len(length)), dtype=np.int64)
        lengths_, ranks = length.to_numpy(), rank.to_numpy()
        order = np.argsort(lengths_, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths_[order])) + 1
        for rows in np.split(order, cuts):
            if not len(rows):
                continue
            n = int(lengths_[rows[0]])
            first, sequence, per, offset = table.value[n]
            at = np.searchsorted(first, ranks[rows], side="right") - 1
            i = ranks[rows] - first[at]
            out[0, rows] = sequence[at] + i // per[at]
            out[1, rows] = offset[at] + i % per[at] * n
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    placed = ranked(given).withColumn("_slot", slots("length", "_rank"))
    return placed.select(*given.columns, "_slot.sequence_id", "_slot.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: ``ids`` of their pieces in order; each has bounded length."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("_parts")).select(
        "sequence_id",
        F.aggregate("_parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias(
            "ids"
        ),
    )


