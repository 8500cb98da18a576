"""Benchmark decontamination: passages of documents within a small edit distance of a test item.

Texts are sequences of lower-cased words. The CGK embedding walks over a sequence: at every step it
notes the word at hand and moves on to the next one or not, as a random bit for that step and word
says. Walks over two sequences that differ by an edit fall into step again soon after it, so a small
edit distance becomes a small Hamming distance between the notes. A hash of the notes at sampled steps
then collides for similar sequences, and repetitions with other bits and steps reach the target
recall. Documents are walked over from every word; an item is indexed from every word of it, so that an
edit hides few of its walks. A walk is given up as soon as the samples noted so far are those of no
item, which nearly all are after two or three.

How many words of an item its walks cover and how often they are repeated follows from ``RECALL``: as
many edits as ``SIMILARITY`` allows, at even distances, leave the shortest runs of unchanged words, and
a walk that stays in a run is the same in both texts. Walks that cover fewer words are not indexed, since
one that stays on a frequent word collides with all its occurrences.

A collision proposes an item-sized window of the document; whether it holds the item is decided by
the exact edit distance between the item and the best alignment in the window, counted in words.

Items are a stated query set: they are indexed in blocks of bounded size, each by one task, and the
indexes of a pass are broadcast. Every document is searched by the task that reads it, without a
shuffle. Items with equal words are searched once and reported each. Items that are too short for an
edit are found by equality, those without words not at all. In scripts without blanks every character
is a word. A NULL text has no words; repeated documents are each searched; ids may be NULL.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import ship, stored

# The least share of an item's words that must be unchanged.
SIMILARITY = 0.8
# The least share of such passages that is to be found, however the edits lie.
RECALL = 0.99
# Steps of a walk, and the samples drawn from them besides the first step: (from, to, number).
SPAN = 8
SAMPLES = ((1, 4, 2), (4, 8, 3))
# As many as a hash of 64 bits has for the steps of a walk.
REPETITIONS = 64 // SPAN
# Places of an item that the samples of an indexed walk cover, and the number of samples; the most
# telling first.
PLACES = (5, 4, 3, 2, 1)
LENGTHS = (6, 3, 2)
# First words by which an item without edits is looked up.
EXACT = 4
# Items and their characters that one broadcast index holds on average at most, and indexes of a pass.
BLOCK_ITEMS, BLOCK_CHARS = 5_000, 3_000_000
PASS_BLOCKS = 16
# Words of documents that are walked over together.
CHUNK = 1 << 19
_GAP = 64

MATCH = (
    "array<struct<item_id:bigint,word_start:int,n_words:int,distance:int,similarity:double>>"
)
# Thai to Tibetan, Burmese, Khmer, Japanese kana and Han.
_UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[^\W_{_UNSPACED}]+|[{_UNSPACED}]")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


@cache
def steps(repetition: int) -> tuple[int, ...]:
    """The sampled steps of a repetition, in order."""
    random = np.random.default_rng([repetition, 1])
    chosen = [0]
    for low, high, n in SAMPLES:
        chosen += sorted(random.choice(np.arange(low, high), n, replace=False).tolist())
    return tuple(chosen)


def most_edits(n: int, similarity: float) -> int:
    return int(n * (1 - similarity) + 1e-9)


@cache
def caught(run: int, places: int, length: int, repetition: int) -> float:
    """The chance that a walk from the start of a run of words stays in it and samples enough places."""
    sampled = steps(repetition)[:length]
    # By place, number of places sampled, and whether this one is sampled.
    chance = {(0, 1, True): 1.0}
    for step in range(1, sampled[-1] + 1):
        after: dict[tuple[int, int, bool], float] = {}
        for (place, seen, noted), p in chance.items():
            for moved in (0, 1):
                known = noted and not moved
                fresh = step in sampled and not known
                state = (place + moved, seen + fresh, known or fresh)
                after[state] = after.get(state, 0.0) + p / 2
        chance = after
    return sum(p for (place, seen, _), p in chance.items() if place < run and seen >= places)


@cache
def walks(n: int, similarity: float, recall: float = RECALL) -> tuple[int, int, int]:
    """(places, samples, repetitions) for items of ``n`` words: the most that reach the recall.

    Edits at even distances leave runs of words unchanged. A walk from the start of a run is the same
    in both texts if it stays in the run up to its last sampled step. Walks from inside a run and
    those that fall into step again come on top.
    """
    edits = most_edits(n, similarity)
    short, longer = divmod(n - edits, edits + 1)
    runs = {short + 1: longer, short: edits + 1 - longer}
    for places in PLACES:
        for length in LENGTHS:
            missed = 1.0
            for repetition in range(REPETITIONS):
                for run, many in runs.items():
                    missed *= (1 - caught(run, places, length, repetition)) ** many
                if missed <= 1 - recall:
                    return places, length, repetition + 1
    return PLACES[-1], LENGTHS[-1], REPETITIONS


def edit_distance(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """The least edit distance of the pattern to a part of the text, and where that part ends first."""
    n = len(pattern)
    equal: dict[int, int] = {}
    for i, symbol in enumerate(pattern):
        equal[symbol] = equal.get(symbol, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    best, end = n, 0
    for at, symbol in enumerate(text, 1):
        match = equal.get(symbol, 0)
        zero = (((match & plus) + plus) ^ plus) | match | minus
        up, down = minus | ~(zero | plus) & full, plus & zero
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | ~(zero | up) & full, up & zero
        if score < best:
            best, end = score, at
    return best, end


@dataclass
class _Level:
    """One level of the tree of samples: the keys of its nodes, and what ends there."""

    keys: np.ndarray
    likely: np.ndarray
    starts: np.ndarray  # by node: its first window in ``item`` and ``offset``
    item: np.ndarray
    offset: np.ndarray

    def found(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the keys are nodes, and their numbers."""
        alive = np.flatnonzero(self.likely[_slot(keys)])
        keys = keys[alive]
        node = np.searchsorted(self.keys, keys)
        node[node == len(self.keys)] = 0
        known = self.keys[node] == keys if len(self.keys) else np.zeros(len(keys), bool)
        return alive[known], node[known]


_LIKELY_BITS = 18


def _slot(keys: np.ndarray) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - _LIKELY_BITS)).astype(np.int64)


# Words that no item has are told apart by as many numbers, which is enough for their bits.
_OTHERS = 1 << 16
# Distinct words whose numbers a search keeps at hand.
_KEPT_WORDS = 200_000


class _Numbers(dict):
    """Words by number: those of items, and others by their hash; of these a bounded part is kept."""

    def __init__(self, known: dict[str, int]):
        super().__init__(known)
        self.first = len(known) + 1

    def __missing__(self, word: str) -> int:
        number = self.first + (xxhash.xxh64_intdigest(word.encode("utf-8", "replace"), 7) & _OTHERS - 1)
        if len(self) < self.first + _KEPT_WORDS:
            self[word] = number
        return number


@dataclass
class _Tree:
    """The walks of one repetition; ``None`` moves on at every step, for equality."""

    repetition: int | None
    sampled: tuple[int, ...]
    first: np.ndarray  # the node of the first level by symbol, -1 where there is none
    levels: list[_Level]


class Index:
    """The items of a block by the samples of their walks."""

    def __init__(self, items: list[tuple[int, list[str]]], similarity: float = SIMILARITY):
        by_words: dict[tuple[str, ...], list[int]] = {}
        for item_id, own in items:
            if own:
                by_words.setdefault(tuple(own), []).append(item_id)
        self.ids = list(by_words.values())
        vocabulary = sorted({w for own in by_words for w in own})
        self.known = {w: i for i, w in enumerate(vocabulary, 1)}
        self.items = [[self.known[w] for w in own] for own in by_words]
        self.members = [frozenset(own) for own in self.items]
        self.most = [most_edits(len(own), similarity) for own in self.items]
        hashes = [xxhash.xxh64_intdigest(w.encode("utf-8", "replace"), 7) for w in vocabulary]
        others = np.random.default_rng(7).integers(0, 1 << 64, _OTHERS, dtype=np.uint64)
        # Number 0 is the gap between texts, which no walk leaves.
        self.bits = np.concatenate([np.array([0, *hashes], dtype=np.uint64), others])
        self.trees = self._trees(similarity) if self.items else []

    def numbers(self) -> _Numbers:
        return _Numbers(self.known)

    def _moves(self, repetition: int | None, symbols: np.ndarray, step: int) -> np.ndarray:
        """A random bit for each symbol at a step: a bit of its hash, the same wherever it occurs."""
        if repetition is None:
            return (symbols > 0).astype(np.int64)
        return (self.bits[symbols] >> np.uint64(repetition * SPAN + step)).astype(np.int64) & 1

    def _trees(self, similarity: float) -> list[_Tree]:
        sizes = np.array([len(own) for own in self.items])
        # All items in one row, with gaps that hold the end of any walk.
        firsts = np.cumsum(sizes + SPAN) - sizes - SPAN
        row = np.zeros(firsts[-1] + sizes[-1] + SPAN, dtype=np.int64)
        for first, own in zip(firsts, self.items, strict=True):
            row[first : first + len(own)] = own
        item = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(item)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        plain = np.array(self.most) == 0
        plans = [
            (0, 1, 0) if p else walks(n, similarity)
            for p, n in zip(plain.tolist(), sizes.tolist(), strict=True)
        ]
        places, lengths, repeats = np.array(plans).T
        trees = []
        for repetition in range(repeats.max()):
            sampled = steps(repetition)
            chosen = repeats[item] > repetition
            begin = item[chosen], place[chosen]
            trees.append(self._tree(repetition, sampled, row, firsts, *begin, lengths - 1, places))
        if plain.any():
            sampled = tuple(range(EXACT))
            chosen = plain[item] & (place == 0)
            last = np.minimum(sizes, EXACT) - 1
            begin = item[chosen], place[chosen]
            trees.append(self._tree(None, sampled, row, firsts, *begin, last, places))
        return trees

    def _tree(self, repetition, sampled, row, firsts, item, place, last, places) -> _Tree:
        """The tree of the walks from (item, place).

        ``last`` is the depth of an item's last sample, ``places`` how many places its samples cover.
        """
        at = firsts[item] + place
        noted = []
        for step in range(sampled[-1] + 1):
            if step in sampled:
                noted.append(at)
            at = at + self._moves(repetition, row[at], step)
        noted, end = np.array(noted), last[item]
        notes = row[noted]
        moves = (np.diff(noted, axis=0) > 0) & (np.arange(1, len(noted))[:, None] <= end)
        seen = 1 + moves.sum(axis=0)
        # Walks that hardly move, or whose last sample lies beyond the item, tell less than they should.
        told = (notes[end, np.arange(len(item))] > 0) & (seen >= places[item])
        notes, end, item, place = notes[:, told], end[told], item[told], place[told]
        levels = []
        node = np.zeros(len(item), dtype=np.int64)
        for depth in range(len(sampled)):
            alive = np.flatnonzero(end >= depth)
            distinct, node[alive] = np.unique(node[alive] << 32 | notes[depth, alive], return_inverse=True)
            ends = np.flatnonzero(end == depth)
            ends = ends[np.lexsort((place[ends], item[ends], node[ends]))]
            likely = np.zeros(1 << _LIKELY_BITS, dtype=bool)
            likely[_slot(distinct)] = True
            starts = np.searchsorted(node[ends], np.arange(len(distinct) + 1))
            levels.append(_Level(distinct, likely, starts, item[ends], place[ends]))
        first = np.full(len(self.bits), -1, dtype=np.int32)
        first[levels[0].keys] = np.arange(len(levels[0].keys))
        return _Tree(repetition, sampled, first, levels)

    def proposed(self, symbols: np.ndarray) -> np.ndarray:
        """(item, place) rows: where an item may begin, over the symbols of many texts with gaps."""
        found = []
        begins = np.flatnonzero((symbols > 0) & (symbols <= len(self.known)))
        begins = begins[begins < len(symbols) - _GAP]
        for tree in self.trees:
            start, at = begins, begins
            node = np.zeros(len(begins), dtype=np.int64)
            depth = 0
            for step in range(tree.sampled[-1] + 1):
                now = symbols[at]
                if step == tree.sampled[depth]:
                    level = tree.levels[depth]
                    if depth:
                        alive, node = level.found(node << 32 | now)
                    else:
                        alive = np.flatnonzero(tree.first[now] >= 0)
                        node = tree.first[now[alive]].astype(np.int64)
                    start, at, now = start[alive], at[alive], now[alive]
                    a, b = level.starts[node], level.starts[node + 1]
                    if len(level.item) and (many := b > a).any():
                        own = np.repeat(np.flatnonzero(many), (b - a)[many])
                        firsts = np.cumsum((b - a)[many]) - (b - a)[many]
                        row = np.arange(len(own)) - np.repeat(firsts - a[many], (b - a)[many])
                        found.append(
                            np.stack([level.item[row], start[own] - level.offset[row]], axis=1)
                        )
                    depth += 1
                    if depth == len(tree.sampled) or not len(start):
                        break
                at = at + self._moves(tree.repetition, now, step)
        if not found:
            return np.empty((0, 2), dtype=np.int64)
        return np.unique(np.concatenate(found), axis=0)

    def verified(self, item: int, place: int, symbols: np.ndarray, low: int, high: int):
        """(start, words, distance) of the item near ``place`` of one text, or None."""
        own, most = self.items[item], self.most[item]
        a, b = max(low, place - most), min(high, place + len(own) + most)
        window = symbols[a:b].tolist()
        # Each unchanged word of the item is a word of the window.
        if sum(map(self.members[item].__contains__, window)) < len(own) - most:
            return None
        distance, end = edit_distance(own, window)
        if distance > most:
            return None
        back = edit_distance(own[::-1], window[:end][::-1])[1]
        return a + end - back - low, back, distance


def search(index: Index, texts: list[str | None]) -> list[list[dict]]:
    """For each text its best match with each item that it holds."""
    return search_all([(index, index.numbers())], texts)


def search_all(
    indexes: list[tuple[Index, _Numbers]], texts: list[str | None]
) -> list[list[dict]]:
    """``search`` in several indexes; a text is split once."""
    out: list[list[dict]] = [[] for _ in texts]
    rows, held, n = [], [], 0
    for row, text in enumerate(texts):
        own = words(text)
        rows.append(row)
        held.append(own)
        n += len(own) + _GAP
        if n >= CHUNK or row == len(texts) - 1:
            for index, numbers in indexes:
                if index.items:
                    _search_chunk(index, numbers, rows, held, out)
            rows, held, n = [], [], 0
    return out


def _search_chunk(index: Index, numbers: _Numbers, rows: list[int], held: list, out: list) -> None:
    sizes = [len(h) for h in held]
    lows = np.cumsum([0, *[s + _GAP for s in sizes]])
    symbols = np.zeros(lows[-1] + _GAP, dtype=np.int64)
    for low, own in zip(lows, held, strict=False):
        symbols[low : low + len(own)] = list(map(numbers.__getitem__, own))
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    proposed = index.proposed(symbols)
    # A proposed start may lie before its text, by an item's length at most.
    inside = np.clip(proposed[:, 1], 0, None)
    texts_of = np.searchsorted(lows, inside, side="right") - 1
    for (item, place), t in zip(proposed.tolist(), texts_of.tolist(), strict=True):
        for text in (t, t + 1):
            if text >= len(held) or text > t and lows[text] - place > len(index.items[item]):
                continue
            low, high = int(lows[text]), int(lows[text]) + sizes[text]
            if found := index.verified(item, place, symbols, low, high):
                start, n, distance = found
                key = (rows[text], item)
                best[key] = min(best.get(key, (distance, start, n)), (distance, start, n))
    for (row, item), (distance, start, n) in best.items():
        similarity = 1 - distance / len(index.items[item])
        out[row] += [
            {
                "item_id": item_id,
                "word_start": start,
                "n_words": n,
                "distance": distance,
                "similarity": similarity,
            }
            for item_id in index.ids[item]
        ]


def indexes(
    items: DataFrame, similarity: float, item_id: str = "item_id", text: str = "text"
) -> Iterator[Index]:
    """The indexes of the items in blocks of bounded size, each built by one task."""
    own = items.select(F.col(item_id).cast("long").alias("id"), F.col(text).alias("text"))
    n, chars = own.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    n_blocks = max(1, math.ceil(n / BLOCK_ITEMS), math.ceil((chars or 0) / BLOCK_CHARS))

    def build(block: pa.Table) -> pa.Table:
        held = zip(block["id"].to_pylist(), map(words, block["text"].to_pylist()), strict=True)
        return pa.table({"index": pa.array([pickle.dumps(Index(list(held), similarity))], pa.binary())})

    numbered = own.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(n_blocks)))
    built = stored(numbered.groupBy("block").applyInArrow(build, "index binary"), "items")
    for row in built.toLocalIterator():
        yield pickle.loads(row["index"])


def with_matches(
    docs: DataFrame, items: DataFrame, text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """``docs`` with ``matches``: the items that a document holds, each with its best passage.

    A passage is given by its first word and length, in words of the pattern above, with the edit
    distance to the item. An input column named ``matches`` is replaced. Items beyond the blocks of
    a pass are searched in further passes, between which the documents are written.
    """
    ship(docs.sparkSession)
    context = docs.sparkSession.sparkContext

    def matcher(shared: list[Broadcast]) -> Callable[[Column], Column]:
        @F.pandas_udf(MATCH)
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            held = [(s.value, s.value.numbers()) for s in shared]
            for batch in batches:
                yield pd.Series(search_all(held, batch.tolist()), index=batch.index)

        # Or a filter on the matches would move below and search once more for what it keeps.
        return of.asNondeterministic()

    found = docs.select(*[c for c in docs.columns if c != "matches"]).withColumn(
        "matches", F.array().cast(MATCH)
    )
    shared: list[Broadcast] = []
    for index in indexes(items, similarity):
        if len(shared) == PASS_BLOCKS:
            found = stored(_joined(found, matcher(shared)(F.col(text))), "matches")
            for held in shared:
                held.unpersist()
            shared = []
        shared.append(context.broadcast(index))
    if shared:
        found = _joined(found, matcher(shared)(F.col(text)))
    return found.withColumn("matches", F.sort_array("matches"))


def _joined(found: DataFrame, more: Column) -> DataFrame:
    return found.withColumn("matches", F.concat("matches", more))
