"""Substring dedup: words in a window that an earlier document holds too are removed.

Windows of consecutive words are compared by 96 bits of a 128-bit hash of their words. A first pass
counts them in count-min sketches: each partition counts its windows in chunks and sends which cells
of the sketch it saw once and more often; merged, the cells that were seen twice are broadcast as bits.
A count can only be too high, so a window whose cell in either row was seen once occurs once. The second
pass sends only the other windows, grouped by hash, to find the smallest document of each.

A chunk settles its own repetitions: of the documents in it that share a window only the first can
keep it, and only that one is sent on. So a window that a third of all documents hold reaches its
group once per chunk. Groups of windows go to blocks of hashes, whose number follows that of the
windows. The sketch has a fixed largest size; past it more windows pass to the second pass, and the
result is the same.

Only documents that lose a window are shuffled to meet its place. Which may be among them is told by
a sketch of their ids, of a fixed largest size too; the others are finished where they are read.

A NULL or blank text has no words. A row with a NULL id stays as it is and does not count as
earlier. Rows are told apart by id and text; repeated rows are not earlier than each other.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tallyline.llm.common import as_bytes, ship, stored, thrifty

WINDOW = 13
# Windows that are counted and settled together.
CHUNK = 1 << 21
# Windows that are looked up together.
LOOKED_UP = 1 << 17
# Cells of a row of the sketch, at most: two rows of so many bits are broadcast.
MOST_CELLS = 1 << 28
# Cells of a row of the sketch of ids, at most.
MOST_IDS = 1 << 26
# Cells that are merged by one task.
CELL_BLOCK = 1 << 22
# Windows per block of the second pass.
HASH_BLOCK = 1 << 21
_SEED = 42

_CELLS = "line int, block int, once binary, again binary"
_BITS = "line int, block int, bits binary"
_FOUND = "block int, ids binary, texts binary, doc binary, start binary, high binary, low binary"
_REMOVED = "doc_id long, text_hash long, starts binary"


def window_hashes(text: bytes, size: int) -> np.ndarray:
    """Two 64-bit numbers for each window of words."""
    words = text.split()
    if len(words) < size:
        return np.empty((0, 2), dtype=np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate([len(w) + 1 for w in words]))
    digest = xxhash.xxh3_128_digest
    starts = [0, *ends[:-1]]
    found = [digest(joined[a : b - 1]) for a, b in zip(starts, ends[size - 1 :], strict=False)]
    return np.frombuffer(b"".join(found), dtype="<u8").reshape(-1, 2)


def pack_places(places: np.ndarray) -> bytes:
    """Ascending distinct numbers as their gaps, a byte for each 255 and one for the rest."""
    gaps = np.diff(places.astype(np.int64), prepend=-1)
    skips = gaps // 255
    out = np.full(len(gaps) + int(skips.sum()), 255, dtype=np.uint8)
    out[np.cumsum(skips + 1) - 1] = gaps % 255
    return out.tobytes()


def unpack_places(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(packed, dtype=np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != 255] - 1


def _cells(hashes: np.ndarray, line: int, bits: int) -> np.ndarray:
    return (hashes[:, line] >> np.uint64(64 - bits)).astype(np.uint32)


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(v, kinds[kind]) for v, (_, kind) in zip(columns, fields, strict=True)],
        names=[name for name, _ in fields],
    )


def _count(
    lines: tuple[list[np.ndarray], list[np.ndarray]], bits: int
) -> Iterator[tuple[int, int, bytes, bytes]]:
    """The cells of each line that were seen, by block; the lists of cells are emptied."""
    for line, chunk in enumerate(lines):
        cells = np.concatenate(chunk)
        chunk.clear()
        cells.sort()
        # Equal to the one before; a cell is seen again where the first of its run is followed by such.
        same = np.zeros(len(cells) + 1, dtype=bool)
        np.equal(cells[1:], cells[:-1], out=same[1:-1])
        first = ~same[:-1]
        again, cells = same[1:][first], cells[first]
        del same, first
        edges = np.arange(0, (1 << bits) + CELL_BLOCK, CELL_BLOCK)
        cuts = np.searchsorted(cells, edges)
        for block, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if a < b:
                own = cells[a:b] - block * CELL_BLOCK
                yield line, block, pack_places(own), pack_places(own[again[a:b]])


def merged(cells: DataFrame, bits: int, least: int) -> Sketch:
    """The sketch of ``cells``, with a bit for each cell that was seen ``least`` times or more.

    Cells come as ``_count`` makes them, by block; a block is merged row by row.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(key: tuple[int, int], seen: np.ndarray) -> pa.RecordBatch:
            packed = zlib.compress(np.packbits(seen >= least, bitorder="little").tobytes(), 1)
            return _batch(_BITS, [(*key, packed)])

        key, seen = None, np.empty(0)
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for line, block, once, again in zip(*columns, strict=True):
                if key != (line, block):
                    if key:
                        yield row(key, seen)
                    key, seen = (line, block), np.zeros(CELL_BLOCK, dtype=np.uint8)
                places = unpack_places(once)
                seen[places] = np.minimum(seen[places] + 1, 2)
                seen[unpack_places(again)] = 2
        if key:
            yield row(key, seen)

    rows = (
        cells.repartition("line", "block")
        .sortWithinPartitions("line", "block")
        .mapInArrow(thrifty(merge), _BITS)
        .collect()
    )
    return Sketch(bits, {(row.line, row.block): bytes(row.bits) for row in rows})


def _bits(wanted: int, most: int) -> int:
    """The binary logarithm of the cells of a row of a sketch."""
    return (min(max(wanted, CELL_BLOCK), most) - 1).bit_length()


class Sketch:
    """The merged sketch, as compressed blocks until a worker looks a window up.

    A worker's copy gives up its blocks for that, so that it holds the sketch once.
    """

    def __init__(self, bits: int, blocks: dict[tuple[int, int], bytes], copy: bool = False):
        self._bits, self._blocks, self._lines, self._copy = bits, blocks, None, copy

    def __reduce__(self):
        if self._copy and self._lines is not None:
            raise ValueError("a worker's sketch cannot be sent on")
        return Sketch, (self._bits, self._blocks, True)

    def likely(self, hashes: np.ndarray) -> np.ndarray:
        """Whether the cells of each window in both lines were seen twice or more."""
        if self._lines is None:
            self._lines = [np.zeros((1 << self._bits) // 8, dtype=np.uint8) for _ in range(2)]
            step = CELL_BLOCK // 8
            for line, block in list(self._blocks):
                packed = self._blocks.pop((line, block)) if self._copy else self._blocks[line, block]
                own = np.frombuffer(zlib.decompress(packed), dtype=np.uint8)
                self._lines[line][block * step : (block + 1) * step] = own
        found = np.ones(len(hashes), dtype=bool)
        for line, seen in enumerate(self._lines):
            cell = _cells(hashes, line, self._bits)
            found &= (seen[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
        return found


def repeated_cells(texts: DataFrame, bits: int, size: int, chunk: int = CHUNK) -> Sketch:
    """The two rows of the merged sketch: a bit for each cell that was seen twice or more."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list[np.ndarray], list[np.ndarray]] = [], []

        n = 0
        for batch in batches:
            for text in as_bytes(batch.column(0)):
                if text:
                    hashes = window_hashes(text, size)
                    for line, cells in enumerate(held):
                        cells.append(_cells(hashes, line, bits))
                    n += len(hashes)
                    if n >= chunk:
                        yield _batch(_CELLS, list(_count(held, bits)))
                        n = 0
        if n:
            yield _batch(_CELLS, list(_count(held, bits)))

    return merged(texts.select("text").mapInArrow(thrifty(sketched), _CELLS), bits, 2)


def known_cells(keys: DataFrame, bits: int) -> Sketch:
    """The sketch of rows of two 64-bit numbers, with a bit for each cell that one of them has."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                pairs = _pairs(*batch.columns)
                cells = [_cells(pairs, 0, bits)], [_cells(pairs, 1, bits)]
                yield _batch(_CELLS, list(_count(cells, bits)))

    return merged(keys.mapInArrow(thrifty(sketched), _CELLS), bits, 1)


def _pairs(*numbers: pa.Array) -> np.ndarray:
    columns = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in numbers]
    return np.stack(columns, axis=1).view(np.uint64)


class _Chunk:
    """Documents whose windows are settled together, of which those the sketch lets through are held."""

    def __init__(self, sketch: Sketch) -> None:
        self.n = 0
        self._sketch = sketch
        self.ids: list[int] = []
        self.texts: list[int] = []
        self._waiting, self._new = 0, []
        self._held: list[tuple[np.ndarray, ...]] = []

    def add(self, doc_id: int, text: bytes, hashes: np.ndarray) -> None:
        self.n += len(hashes)
        self.ids.append(doc_id)
        self.texts.append(xxhash.xxh64_intdigest(text, _SEED))
        self._new.append(hashes)
        self._waiting += len(hashes)
        if self._waiting >= LOOKED_UP:
            self._look_up()

    def _look_up(self) -> None:
        lengths = [len(h) for h in self._new]
        hashes = np.concatenate(self._new)
        at = np.flatnonzero(self._sketch.likely(hashes))
        firsts = np.cumsum([0, *lengths[:-1]])
        doc = np.searchsorted(firsts, at, side="right") - 1
        # Empty documents share a first place; the last of them owns it.
        start = (at - firsts[doc]).astype(np.uint32)
        doc = (doc + len(self.ids) - len(lengths)).astype(np.uint32)
        self._held.append((doc, start, hashes[at, 0], hashes[at, 1].astype(np.uint32)))
        self._waiting, self._new = 0, []

    def found(self, blocks: int) -> Iterator[tuple]:
        """Rows for the second pass: by block what others may hold too, and what is settled here."""
        if self._new:
            self._look_up()
        doc, start, high, low = (np.concatenate(c) for c in zip(*self._held, strict=True))
        self._held = []
        if not len(doc):
            return
        order_of = np.unique(np.array(self.ids, dtype=np.int64), return_inverse=True)[1]
        rank = order_of.astype(np.uint32)[doc]
        order = np.lexsort((rank, low, high))
        doc, start, rank = doc[order], start[order], rank[order]
        high, low = high[order], low[order]
        del order
        new = np.ones(len(high), dtype=bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        later = rank > rank[np.flatnonzero(new)][np.cumsum(new) - 1]
        if later.any():
            yield self._row(int(rank[0]) % blocks, doc[later], start[later], high[:0], low[:0])
        keep = ~later
        doc, start, high, low = doc[keep], start[keep], high[keep], low[keep]
        shift = np.uint64(64 - (blocks - 1).bit_length()) if blocks > 1 else None
        block = (high >> shift).astype(np.int64) if shift else np.zeros(len(high), dtype=np.int64)
        cuts = np.searchsorted(block, np.arange(blocks + 1))
        for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if i < j:
                yield self._row(b, doc[i:j], start[i:j], high[i:j], low[i:j])

    def _row(self, block: int, doc: np.ndarray, *arrays: np.ndarray) -> tuple:
        start, high, low = arrays
        used, index = np.unique(doc, return_inverse=True)
        ids = np.array(self.ids, dtype=np.int64)[used]
        texts = np.array(self.texts, dtype=np.uint64)[used]
        short = np.uint16 if len(used) < 1 << 16 else np.uint32
        if len(start) and start.max() < 1 << 16:
            start = start.astype(np.uint16)
        arrays = (ids, texts, index.astype(short), start, high, low)
        return block, *[a.tobytes() for a in arrays]


def _unpacked(row: tuple) -> tuple[np.ndarray, ...]:
    ids, texts, doc, start, high, low = row
    ids, texts = np.frombuffer(ids, np.int64), np.frombuffer(texts, np.int64)
    doc = np.frombuffer(doc, np.uint16 if len(ids) < 1 << 16 else np.uint32)
    start = np.frombuffer(start, np.uint16 if len(start) == 2 * len(doc) else np.uint32)
    return ids, texts, doc, start, np.frombuffer(high, np.uint64), np.frombuffer(low, np.uint32)


def _removed(ids: np.ndarray, texts: np.ndarray, start: np.ndarray) -> pa.RecordBatch | None:
    """A row per document with the starts of its windows to remove."""
    if not len(ids):
        return None
    order = np.lexsort((start, texts, ids))
    ids, texts, start = ids[order], texts[order], start[order].astype("<u4")
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (ids[1:] != ids[:-1]) | (texts[1:] != texts[:-1])
    cuts = np.flatnonzero(new)
    ends = [*cuts[1:], len(ids)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[cuts], pa.int64()),
            pa.array(texts[cuts], pa.int64()),
            pa.array([start[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
        ],
        names=["doc_id", "text_hash", "starts"],
    )


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows to remove; rows come by block, and a block is settled at a time."""

    def settle(rows: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch | None:
        ids = np.concatenate([r[0][r[2]] for r in rows])
        high, low = (np.concatenate([r[i] for r in rows]) for i in (4, 5))
        order = np.lexsort((ids, low, high))
        high, low, ids = high[order], low[order], ids[order]
        new = np.ones(len(high), dtype=bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        del high, low
        later = ids > ids[np.flatnonzero(new)][np.cumsum(new) - 1]
        ids, later = ids[later], order[later]
        del order
        # Text and place only of the windows that go.
        texts = np.concatenate([r[1][r[2]] for r in rows])[later]
        start = np.concatenate([r[3].astype(np.uint32) for r in rows])[later]
        return _removed(ids, texts, start)

    block, held = None, []
    for batch in batches:
        for of, *rest in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if of != block:
                if held and (out := settle(held)):
                    yield out
                block, held = of, []
            row = _unpacked(tuple(rest))
            if len(row[4]):
                held.append(row)
            elif out := _removed(row[0][row[2]], row[1][row[2]], row[3]):
                yield out
    if held and (out := settle(held)):
        yield out


def removed_windows(
    docs: DataFrame, size: int = WINDOW, chunk: int = CHUNK, bits: int | None = None
) -> DataFrame:
    """(doc_id, text_hash, starts): per document of ``docs`` (doc_id, text) the windows to remove.

    ``starts`` are arrays of little-endian 32-bit word numbers. A document may have several rows.
    """
    spark = docs.sparkSession
    ship(spark)
    # A guess at the number of windows, for sizes only: a word and its blank have six bytes or so.
    guess = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6
    bits = bits or _bits(2 * guess, MOST_CELLS)
    blocks = 1 << max(6, (guess // HASH_BLOCK).bit_length())
    sketch = spark.sparkContext.broadcast(repeated_cells(docs, bits, size, chunk))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: _Chunk) -> Iterator[pa.RecordBatch]:
            if rows := list(held.found(blocks)):
                yield _batch(_FOUND, rows)

        held = _Chunk(sketch.value)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                if doc_id is not None and text:
                    hashes = window_hashes(text, size)
                    if len(hashes):
                        held.add(doc_id, text, hashes)
                if held.n >= chunk:
                    yield from flush(held)
                    held = _Chunk(sketch.value)
        if held.n:
            yield from flush(held)

    return (
        docs.select("doc_id", "text")
        .mapInArrow(thrifty(likely), _FOUND)
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(thrifty(_settled), _REMOVED)
    )


def kept_words(text: bytes, starts: list[bytes], size: int) -> tuple[list[bytes], int]:
    """The words of a text outside the windows that start at ``starts``, and how many it had."""
    words = text.split()
    if not starts:
        return words, len(words)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.frombuffer(b"".join(starts), dtype="<u4").astype(np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + size, -1)
    covered = np.cumsum(edges[:-1]) > 0
    return [w for w, c in zip(words, covered.tolist(), strict=True) if not c], len(words)


def without_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = WINDOW,
    digest: bool = False,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``, the words left joined by blanks.

    With ``digest`` it has ``kept_sha256`` in place of the text before and after. Input columns of
    the new names are replaced.
    """
    kept = "kept_sha256" if digest else "kept_text"
    new = {"n_words", "n_removed", "kept_text", "kept_sha256", "_starts", "_id", "text_hash", "_text"}
    columns = [c for c in docs.columns if c not in new and c != text]
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    starts = stored(
        removed_windows(given, size)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list("starts").alias("starts")),
        "starts",
    )
    # Two hashes of id and text, by which a document is looked up among those that lose a window.
    own = [F.col(doc_id).cast("long"), F.xxhash64(text)]
    lookup = [F.xxhash64(*own).alias("_a"), F.xxhash64(*own[::-1]).alias("_b")]
    rows = docs.select(*columns, F.col(text).alias("_text"), *lookup)
    sketch = _losing(starts)

    def split(batch: pa.RecordBatch, losing: bool) -> pa.RecordBatch:
        likely = sketch.value.likely(_pairs(*batch.columns[-2:]))
        kept = batch.filter(pa.array(likely == losing))
        return kept.select(range(batch.num_columns - 2))

    def losing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield split(batch, True)

    schema = StructType(
        [
            *docs.select(*columns).schema,
            StructField("_text", StringType()),
            StructField("n_words", LongType()),
            StructField("n_removed", LongType()),
            StructField(kept, StringType()),
        ]
    )

    def told(batch: pa.RecordBatch, texts: pa.Array, marks: list[list[bytes]]) -> pa.RecordBatch:
        n_words, n_removed, found = [], [], []
        for value, marked in zip(as_bytes(texts), marks, strict=True):
            words, n = kept_words(value or b"", marked, size)
            left = b" ".join(words)
            n_words.append(n)
            n_removed.append(n - len(words))
            found.append(hashlib.sha256(left).hexdigest() if digest else left.decode())
        texts = pa.nulls(len(texts), pa.string()) if digest else texts
        counts = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, texts, *counts, pa.array(found, pa.string())],
            names=[*batch.schema.names, "_text", "n_words", "n_removed", kept],
        )

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = split(batch, False)
            n = len(columns)
            yield told(rest.select(range(n)), rest.column(n), [[]] * rest.num_rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(columns)
            marks = [m or [] for m in batch.column(n + 1).to_pylist()]
            yield told(batch.select(range(n)), batch.column(n), marks)

    text_kept = rows.drop("_a", "_b")
    joined = rows.mapInArrow(thrifty(losing), text_kept.schema).join(
        starts.select(F.col("doc_id").alias("_id"), "text_hash", F.col("starts").alias("_starts")),
        (F.col(doc_id).cast("long") == F.col("_id")) & (F.xxhash64("_text") == F.col("text_hash")),
        "left",
    )
    shared = joined.select(*columns, "_text", "_starts").mapInArrow(thrifty(cut), schema)
    out = rows.mapInArrow(thrifty(whole), schema).unionByName(shared)
    if digest:
        return out.drop("_text")
    ordered = [c for c in docs.columns if c in columns or c == text]
    out = out.withColumnRenamed("_text", text)
    return out.select(*ordered, "n_words", "n_removed", "kept_text")


def _losing(starts: DataFrame) -> Broadcast:
    """A sketch of the documents in ``starts``, by two hashes of id and text."""
    bits = _bits(16 * starts.count(), MOST_IDS)
    keys = starts.select(F.xxhash64("doc_id", "text_hash"), F.xxhash64("text_hash", "doc_id"))
    return starts.sparkSession.sparkContext.broadcast(known_cells(keys, bits))
