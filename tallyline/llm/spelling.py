"""Groups of spelling variants: rare words drawn to a frequent word one letter away.

Words that differ by one replaced letter have multisets of letters that, as binary vectors over
(letter, occurrence), differ in two places; by an inserted or deleted one, in one place. Vectors are cut
into parts, and a signature is what is left of one when as many parts are left out as places may differ:
whichever these are, some signature of two such words is the same (PartEnum). The length of the shorter
word belongs to it. Words that share a signature meet, as one shuffle by signature brings them together in
order, and are verified letter by letter.

A signature that many words share, as anagrams do, is not expanded into pairs as it is: its words also have
to agree in the half of their letters in which they do not differ, the first or the last, of which
one must be the same. If more share it than a task should hold, they meet by a join on signature and half. Words are counted in their tasks before they are shuffled, and the rest
works on distinct words.

A NULL or empty text has no words. A NULL id is written as no characters. Repeated rows count each time.
Of other columns than id and text none is looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import ship, stored

SHORTEST = 7
FEWEST = 2
# A form is so many times as frequent as its variant.
TIMES = 10
# One run of a document in so many loses a letter.
DAMAGED = 31
# Parts of a vector, for two places that differ and for one.
PARTS = 5
PARTS_OF_ONE = 3
# Words that share a signature before their halves have to agree too.
CROWD = 24
# Rows of signatures that a task looks at together.
TOGETHER = 1 << 18
# Letters of a word that is compared in bulk.
WIDTH = 32
# Distinct words that a task counts before it hands them on.
HELD = 200_000
# Characters of a text that are looked at together.
_SLICE = 1 << 22

# Letters as in Latin-1, where a code point is a byte and only A-Z change by lower().
_RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % SHORTEST)


def _slices(text: str) -> Iterator[bytes]:
    """The text in Latin-1 and lower case, cut where no run is; other letters become signs."""
    start = 0
    while start < len(text):
        end = start + _SLICE
        while end < len(text) and (text[end].isascii() and text[end].isalpha() or "\xc0" <= text[end] <= "\xff"):
            end += 1
        yield text[start:end].encode("latin-1", "replace").lower()
        start = end


def words_of(doc_id: int | None, text: str) -> Counter[bytes]:
    """The words of a text, in Latin-1, with their occurrences."""
    runs: Counter[bytes] = Counter()
    for part in _slices(text):
        runs.update(_RUN.findall(part))
    damaged = []
    salt = f"{'' if doc_id is None else doc_id}:".encode()
    start = zlib.crc32(salt)
    for run in runs:
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if not h % DAMAGED:
            damaged.append((run, h % len(run)))
    lost = [(run[:at] + run[at + 1 :], runs.pop(run)) for run, at in damaged]
    for word, n in lost:
        if len(word) >= SHORTEST:
            runs[word] += n
    return runs


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the words that occur often enough."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def handed_on() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in counts]
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())],
                names=["word", "n"],
            )

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                if t.is_valid:
                    counts.update(words_of(i, t.as_py()))
                if len(counts) > HELD:
                    yield handed_on()
                    counts.clear()
        yield handed_on()

    found = docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(
        count, "word string, n long"
    )
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= FEWEST)


@cache
def _element(letter: str, occurrence: int) -> tuple[int, int, int]:
    """The hash of an element, and the part that it lies in for two places and for one."""
    element = ord(letter) * 31 + occurrence
    place = element * 7 + occurrence
    return zlib.crc32(b"%d" % element) << 24 ^ element, place % PARTS, place % PARTS_OF_ONE


_LEFT_OUT = tuple(combinations(range(PARTS), 2))
_MASK = (1 << 63) - 1
_STEP = 0x9E3779B97F4A7C15


def signatures(word: str) -> list[tuple[int, int]]:
    """(signature, length of the shorter word) for words as long, and for those one longer or shorter."""
    size, whole = len(word), 0
    two, one = [0] * PARTS, [0] * PARTS_OF_ONE
    seen: dict[str, int] = {}
    for letter in word:
        occurrence = seen[letter] = seen.get(letter, -1) + 1
        value, of_two, of_one = _element(letter, occurrence)
        two[of_two] += value
        one[of_one] += value
        whole += value
    salt = whole + 64 * size * _STEP
    found = [
        (salt + i * _STEP - two[a] - two[b] & _MASK, size) for i, (a, b) in enumerate(_LEFT_OUT)
    ]
    for i, part in enumerate(one, 32):
        found.append((salt + i * _STEP - part & _MASK, size))
        found.append((salt + (i - 64) * _STEP - part & _MASK, size - 1))
    return found


def _signed(words: DataFrame) -> DataFrame:
    """(signature, shorter, word, n): every word, in Latin-1, under all of its signatures."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                held = batch.slice(i, 1024)
                given = held.column(0).to_pylist()
                keys = [key for word in given for key in signatures(word)]
                signature, shorter = zip(*keys)
                again = pa.array(np.repeat(np.arange(len(given)), len(keys) // len(given)))
                words = pa.array([word.encode("latin-1") for word in given], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signature, pa.int64()),
                        pa.array(shorter, pa.int32()),
                        words.take(again),
                        held.column(1).take(again),
                    ],
                    names=["signature", "shorter", "word", "n"],
                )

    return words.select("word", "n").mapInArrow(
        sign, "signature long, shorter int, word binary, n long"
    )


class Letters:
    """Words side by side, to compare many pairs at once."""

    def __init__(self, words: pa.Array):
        self.words = words
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset :][: len(words) + 1]
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        self.size = np.diff(offsets)
        width = min(int(self.size.max(initial=0)), WIDTH)
        short = self.size <= width
        kept = np.repeat(short, self.size)
        places, sizes = np.arange(width), np.where(short, self.size, 0)[:, None]
        self.left = np.zeros((len(words), width), np.uint8)
        self.left[places < sizes] = data[kept]
        self.right = np.zeros_like(self.left)
        self.right[places >= width - sizes] = data[kept]

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of the pairs are one letter apart: all but one are before or after it."""
        shorter, longer = np.minimum(self.size[i], self.size[j]), np.maximum(self.size[i], self.size[j])
        long = longer > self.left.shape[1]
        width = self.left.shape[1]
        before = np.where((differ := self.left[i] != self.left[j]).any(axis=1), differ.argmax(axis=1), width)
        differ = (self.right[i] != self.right[j])[:, ::-1]
        after = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        near = (longer - shorter <= 1) & (before + after >= longer - 1) & (before < longer)
        for k in np.flatnonzero(long):
            near[k] = one_apart(self.words[int(i[k])].as_py(), self.words[int(j[k])].as_py())
        return near


def one_apart(a: bytes, b: bytes) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def _met(signature: np.ndarray, shorter: np.ndarray, words: Letters) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of places that share a signature and are one letter apart; signatures come in order."""
    border = np.flatnonzero(np.diff(signature)) + 1
    sizes = np.diff(np.concatenate([[0], border, [len(signature)]]))
    group = np.repeat(np.arange(len(sizes)), sizes)
    crowded = np.repeat(sizes > CROWD, sizes)
    place = np.flatnonzero(~crowded)
    found = [_joined(group[place], place, words)]
    halves: dict[tuple, int] = {}
    keys, places = [], []
    for k in np.flatnonzero(crowded).tolist():
        word, cut = words.words[k].as_py(), int(shorter[k]) // 2
        for half in (b"<" + word[:cut], b">" + word[len(word) - int(shorter[k]) + cut :]):
            keys.append(halves.setdefault((int(group[k]), half), len(halves)))
            places.append(k)
    if keys:
        order = np.argsort(keys, kind="stable")
        found.append(_joined(np.array(keys)[order], np.array(places)[order], words))
    return tuple(np.concatenate(side) for side in zip(*found))


def _joined(key: np.ndarray, place: np.ndarray, words: Letters) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of equal keys, which stand side by side: each with the next, the one after it, and so on."""
    at, step, left, right = np.arange(len(key)), 1, [], []
    while len(at):
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        i, j = place[at], place[at + step]
        near = words.apart(i, j) if len(at) else np.zeros(0, bool)
        left.append(i[near])
        right.append(j[near])
        step += 1
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of words, from rows that come in the order of their signatures.

    Rows of a signature that more than ``TOGETHER`` words share are handed on without a near word.
    """
    nothing = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.int64()]
    names = ["signature", "shorter", "word", "n", "near", "m"]

    def pairs(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        signature, shorter = (table[c].to_numpy() for c in names[:2])
        word = table["word"].combine_chunks()
        i, j = _met(signature, shorter, Letters(word))
        n = table["n"].combine_chunks()
        sides = [word.take(pa.array(i)), n.take(pa.array(i)), word.take(pa.array(j)), n.take(pa.array(j))]
        blank = [pa.nulls(len(i), kind) for kind in nothing[:2]]
        return pa.RecordBatch.from_arrays([*blank, *sides], names=names)

    def handed_on(table: pa.Table) -> pa.RecordBatch:
        columns = [table[c].combine_chunks() for c in names[:4]]
        return pa.RecordBatch.from_arrays(
            [*columns, *[pa.nulls(table.num_rows, kind) for kind in nothing[4:]]], names=names
        )

    held, many = [], None
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < TOGETHER // 4:
            continue
        table = pa.Table.from_batches(held)
        signature = table["signature"].to_numpy()
        if many is not None:
            end = int(np.searchsorted(signature, many, "right"))
            yield handed_on(table.slice(0, end))
            table, signature = table.slice(end), signature[end:]
        last = int(np.searchsorted(signature, signature[-1])) if len(signature) else 0
        if last:
            yield pairs(table.slice(0, last))
            many = None
        table = table.slice(last)
        if table.num_rows > TOGETHER:
            many = signature[-1]
            yield handed_on(table)
            table = table.slice(table.num_rows)
        held = table.to_batches()
    if held:
        table = pa.Table.from_batches(held)
        if many is not None:
            end = int(np.searchsorted(table["signature"].to_numpy(), many, "right"))
            yield handed_on(table.slice(0, end))
            table = table.slice(end)
        if table.num_rows:
            yield pairs(table)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, m): all unordered pairs of words that are one letter apart, with occurrences."""
    in_order = _signed(words).repartition("signature").sortWithinPartitions("signature")
    met = stored(
        in_order.mapInArrow(
            _meet, "signature long, shorter int, word binary, n long, near binary, m long"
        ),
        "met",
    )
    # What no task can hold meets by halves: cut at half the length of the shorter, two words have
    # the first or the last letters in common.
    many = met.filter("near is null").select("signature", "shorter", _text("word"), "n")
    first = F.floor(F.col("shorter") / 2).cast("int")
    halves = F.array(
        F.concat(F.lit("<"), F.left("word", first)),
        F.concat(F.lit(">"), F.right("word", F.col("shorter") - first)),
    )
    a = many.withColumn("half", F.explode(halves)).alias("a")
    b = a.alias("b")
    alike = (F.col("a.signature") == F.col("b.signature")) & (F.col("a.half") == F.col("b.half"))
    rest = (
        a.join(b, alike & (F.col("a.word") < F.col("b.word")))
        .filter(F.levenshtein("a.word", "b.word", 1) == 1)
        .select("a.word", "a.n", F.col("b.word").alias("near"), F.col("b.n").alias("m"))
    )
    found = met.filter("near is not null").select(_text("word"), "n", _text("near"), "m")
    ordered = F.col("word") < F.col("near")
    return (
        found.select(
            F.least("word", "near").alias("word"),
            F.when(ordered, F.col("n")).otherwise(F.col("m")).alias("n"),
            F.greatest("word", "near").alias("near"),
            F.when(ordered, F.col("m")).otherwise(F.col("n")).alias("m"),
        )
        .unionByName(rest)
        .distinct()
    )


def _text(column: str) -> Column:
    return F.decode(F.col(column), "ISO-8859-1").alias(column)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all words with a form: the last that is reached from form to form.

    A form is ``TIMES`` times as frequent as the word before, so paths are short; a round halves them.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moving = now.join(further, "root", "left")
        if moving.filter("_next is not null").isEmpty():
            return now
        now = stored(moving.select("word", F.coalesce("_next", "root").alias("root")), "roots")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the documents.

    The form is the near word of most occurrences, the first of these in code-point order, if it has
    ``TIMES`` the word's own at least; the root is where forms of forms end, or the word itself.
    """
    words = stored(vocabulary(docs, doc_id, text), "words")
    near = near_words(words)
    both = F.array(
        F.struct("word", F.col("near").alias("other"), F.col("m").alias("times")),
        F.struct(F.col("near").alias("word"), F.col("word").alias("other"), F.col("n").alias("times")),
    )
    nearest = (
        near.select(F.inline(both))
        .groupBy("word")
        .agg(
            F.count(F.lit(1)).alias("n_near"),
            F.min(F.struct((-F.col("times")).alias("n"), F.col("other").alias("word"))).alias("_best"),
        )
    )
    drawn = words.join(nearest, "word", "left").withColumn(
        "_drawn", -F.col("_best.n") >= TIMES * F.col("n")
    )
    formed = stored(
        drawn.select(
            "word",
            F.when(F.col("_drawn"), F.col("_best.word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("_drawn"), -F.col("_best.n")).alias("form_n"),
        ),
        "forms",
    )
    ended = roots(formed.filter("form is not null"))
    return formed.join(ended, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
