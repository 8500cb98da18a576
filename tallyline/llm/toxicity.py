"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

The examples are a bounded sample of the labelled rows, as many of either class at most. Every word
of theirs is a term with an idf of its own. A word has additional weight the more, the more
significantly and the more often toxic examples have it than the others; beginnings of words are terms
for that weight only. One more term of all texts weighs like their words without it, and so sees
how much of a text is not toxic. No threshold selects words, so a few examples give neighbours too.
Examples are kept in an inverted index whose postings are cut into blocks, with the largest weight of
each term in each block. A query bounds the cosine of every block by these and scores blocks from
the highest bound down until no bound reaches the k-th best cosine, so the neighbours are exact.

Neighbours vote by distance, each for the share of labelled rows that its class's sample stands for,
and a constant weight votes for the share of toxic rows; that weight is the one of least log loss
when every example is scored without itself. A text without words has the share of
toxic rows among such texts. Only texts are looked at.

A NULL text is empty. Rows are scored one by one; repeated rows and NULL ids stay. Of several
labels of one id the toxic one counts; a NULL label is none. Without examples of both classes every
score is the share of toxic rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import give_back, ship, stored

# Examples of a class in the index, at most.
EXAMPLES = 2048
# Beginnings of words that are terms, at most.
TERMS = 4096
# Lengths of the beginnings of words that are terms beside whole words.
STEMS = (4, 5, 6)
# The G statistic of a term's table against the label at which half of what it tells is believed.
HALF_G = 20.0
# Terms that a task counts before it passes the counts on.
HELD = 50_000
NEIGHBOURS = 7
BLOCK = 32
# A term that one example in so many has is frequent.
FREQUENT = 8
# Blocks that are scored before bounds count.
START = 8
# The weight of the term that all texts have, by the length of their words without additional weight.
POOLED = 2.0
# Added to distances, so that an equal example does not outvote all others.
NEAR = 0.05
THRESHOLD = 0.3

_WORD = re.compile(r"\w+")
# The signs of ASCII that are in no word, as blanks.
_APART = {i: " " for i in range(128) if not _WORD.match(chr(i))}


def words_of(text: str | None) -> list[str]:
    """The lower-cased words of a text; one of ASCII alone is split, which is the same and faster."""
    text = (text or "").lower()
    return text.translate(_APART).split() if text.isascii() else _WORD.findall(text)


def terms(text: str | None) -> Counter[str]:
    """Counts of the words of a text and of their beginnings, which end in a star."""
    words = Counter(words_of(text))
    found = Counter(words)
    for word, n in words.items():
        for size in STEMS:
            if len(word) > size:
                found[word[:size] + "*"] += n
    return found


class Vocabulary:
    """Rows, idf and additional weights of terms. The last row is the term that all texts have.

    The words of a text together have the length 1 + log of their number before additional weights.
    Words that no example has count in that length only.
    """

    def __init__(self, terms: list[tuple[str, float, float]], unknown: float):
        self.rows = {term: i for i, (term, *_) in enumerate(terms)}
        self.idf = np.array([0.0 if term.endswith("*") else idf for term, idf, _ in terms])
        self.added = np.array([added for *_, added in terms])
        self.unknown = unknown
        starts = [(term, row) for term, row in self.rows.items() if term.endswith("*")]
        self._starts = {term: i for i, (term, _) in enumerate(starts)}
        self._start_rows = np.array([row for _, row in starts], dtype=np.int64)
        self._first = {term[: STEMS[0]] for term in self._starts}
        # By row of a word: its beginnings, or -1.
        self._starts_of = np.full((len(terms), len(STEMS)), -1, dtype=np.int32)
        for term, row in self.rows.items():
            for i, start in self._starts_in(term):
                self._starts_of[row, i] = start

    def _starts_in(self, word: str) -> list[tuple[int, int]]:
        """The beginnings of a word that are terms, with the place of their length."""
        if word[: STEMS[0]] not in self._first or word.endswith("*"):
            return []
        found = [(i, word[:size] + "*") for i, size in enumerate(STEMS) if len(word) > size]
        return [(i, self._starts[term]) for i, term in found if term in self._starts]

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The rows of a text and their weights at length one; none without words."""
        words = Counter(words_of(text))
        if not words:
            return np.empty(0, dtype=np.int64), np.empty(0)
        times = np.fromiter(words.values(), np.float64, len(words))
        own = np.array(list(map(self.rows.get, words, repeat(-1))))
        known = own >= 0
        own = own[known]
        found = self._starts_of.take(own, axis=0).ravel()
        at = np.flatnonzero(found >= 0)
        starts = np.bincount(found[at], times[known][at // len(STEMS)], len(self._start_rows))
        # Words that no example has may begin like those that one has.
        for word, n in compress(words.items(), (~known).tolist()):
            for _, start in self._starts_in(word):
                starts[start] += n
        often = 1 + np.log(times)
        others = self.unknown**2 * float(often[~known] @ often[~known])
        begun = np.flatnonzero(starts)
        rows = np.append(own, self._start_rows[begun])
        often = np.append(often[known], 1 + np.log(starts[begun]))
        plain = often * self.idf[rows]
        length = 1 + math.log(words.total())
        scale = length / math.sqrt(float(plain @ plain) + others)
        weights = np.append(scale * plain + often * self.added[rows], POOLED * length)
        whole = math.sqrt(float(weights @ weights) + scale * scale * others)
        return np.append(rows, len(self.rows)), weights / whole


def _ranges(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers from each ``first`` up to its ``end``, one range after the other."""
    sizes = end - first
    return np.arange(sizes.sum()) + np.repeat(first - np.cumsum(sizes) + sizes, sizes)


@dataclass
class Index:
    """Examples by term and block.

    Rare terms have postings. A term that many examples have is a row of a table of all
    blocks instead, with its largest weight in each.
    """

    ids: np.ndarray
    toxic: np.ndarray
    share: np.ndarray
    first: np.ndarray  # by term: where its postings begin; none for a frequent one
    example: np.ndarray
    weight: np.ndarray
    place: np.ndarray  # by term: its row in the table, or -1
    table: np.ndarray  # (blocks, frequent terms, BLOCK): weights
    highest: np.ndarray  # (frequent terms, blocks)
    blocks_scored: int = 0

    def nearest(self, rows: np.ndarray, weights: np.ndarray, k: int, without: int | None = None):
        """The k examples of highest cosine, ties by their order, and the cosines.

        What rare terms give is added up for all examples, as they are in few. With the largest
        weights of the frequent ones that bounds each block, and a block's examples are scored only
        if its bound reaches the k-th best of the blocks before.
        """
        place = self.place[rows]
        rare = place < 0
        a, b = self.first[rows[rare]], self.first[rows[rare] + 1]
        at = _ranges(a, b)
        blocks, frequent, _ = self.table.shape
        products = self.weight.take(at)
        products *= np.repeat(weights[rare], b - a)
        given = np.bincount(self.example.take(at), products, blocks * BLOCK).reshape(blocks, BLOCK)
        place, weights = place[~rare], weights[~rare].astype(np.float32)
        # A row of a block and frequent term, so that rows are taken by one number.
        rows = self.table.reshape(blocks * frequent, BLOCK)
        # The table is in single precision; bounds leave room for its rounding.
        bounds = given.max(axis=1) + weights @ self.highest[place] + 1e-5
        order = np.argsort(-bounds, kind="stable")
        best, scores = np.empty(0, dtype=np.int64), np.empty(0)
        # The blocks of the highest bounds first, then all that may still hold a nearer one.
        for now in (order[:START], order[START:]):
            if len(best) == k:
                now = now[bounds[now] >= scores[-1]]
            if not len(now):
                break
            self.blocks_scored += len(now)
            own = given[now] + np.matmul(weights, rows.take(now[:, None] * frequent + place, axis=0))
            at = (now[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            own = own.ravel()
            kept = (own > 0) & (at < len(self.ids))
            at, own = at[kept], own[kept]
            if without is not None:
                other = self.ids[at] != without
                at, own = at[other], own[other]
            if len(own) > k:
                enough = own >= np.partition(own, len(own) - k)[len(own) - k]
                at, own = at[enough], own[enough]
            best, scores = np.concatenate([best, at]), np.concatenate([scores, own])
            nearest = np.lexsort((best, -scores))[:k]
            best, scores = best[nearest], scores[nearest]
        return best, scores

    def votes(self, rows: list[int], weights: list[float], k: int, without: int | None = None):
        """The votes for toxic, all votes, and the three nearest examples."""
        if not len(rows):
            return 0.0, 0.0, []
        rows, weights = np.asarray(rows, dtype=np.int64), np.asarray(weights)
        best, cosines = self.nearest(rows, weights, k, without)
        power = self.share[best] / (1 + NEAR - np.minimum(cosines, 1.0))
        evidence = [
            (int(self.ids[e]), min(float(c), 1.0), int(self.toxic[e]))
            for e, c in zip(best[:3], cosines[:3], strict=True)
        ]
        return float(power @ self.toxic[best]), float(power.sum()), evidence


def build(terms: int, examples: list[tuple]) -> Index:
    """The index of (id, toxic, share, rows, weights); those with the same chief terms are neighbours."""

    def chief(e: tuple) -> tuple:
        rows, weights = np.asarray(e[3]), np.asarray(e[4])
        return rows[np.lexsort((-rows, -weights))[:3]].tolist(), e[0]

    held = sorted((e for e in examples if len(e[3])), key=chief)
    example = np.repeat(np.arange(len(held)), [len(e[3]) for e in held]).astype(np.int64)
    row = np.concatenate([np.empty(0, np.int64), *[np.asarray(e[3], np.int64) for e in held]])
    weight = np.concatenate([np.empty(0), *[np.asarray(e[4], np.float64) for e in held]])
    blocks = max(1, -(-len(held) // BLOCK))
    frequent = np.flatnonzero(np.bincount(row, minlength=terms) * FREQUENT >= max(1, len(held)))
    place = np.full(terms, -1)
    place[frequent] = np.arange(len(frequent))
    common = place[row] >= 0
    table = np.zeros((blocks, len(frequent), BLOCK), dtype=np.float32)
    at = example[common]
    table[at // BLOCK, place[row[common]], at % BLOCK] = weight[common]
    example, row, weight = example[~common], row[~common], weight[~common]
    order = np.lexsort((example, row))
    example, row, weight = example[order], row[order], weight[order]
    return Index(
        ids=np.array([e[0] for e in held], dtype=np.int64),
        toxic=np.array([e[1] for e in held], dtype=np.int64),
        share=np.array([e[2] for e in held], dtype=np.float64),
        first=np.searchsorted(row, np.arange(terms + 1)),
        example=example.astype(np.int32),
        weight=weight,
        place=place,
        table=table,
        highest=np.ascontiguousarray(table.max(axis=2).T),
    )


def _sample(docs: DataFrame, labelled: DataFrame, limit: int) -> tuple[DataFrame, dict[int, float]]:
    """(doc_id, toxic, share, text) of at most ``limit`` ids of a class, and the classes' sizes.

    Of the texts that share an id the least one is the example.
    """
    rows = (
        labelled.filter("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    sizes = {int(r.toxic): r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for label in (0, 1):
        part = rows.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
        part = part.withColumn("share", F.lit(sizes.get(label, 0) / max(1, min(limit, sizes.get(label, 0)))))
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # At most two times ``limit`` ids, so this side is small at any size.
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic", "share")
    return stored(found.agg(F.min("text").alias("text")), "examples"), sizes


def _vocabulary(sample: DataFrame, sizes: dict[int, float], limit: int) -> Vocabulary | None:
    """The words of the examples and the beginnings that tell most, by their idf over the labelled
    rows and by what they tell; None without examples of both classes."""

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: tuple[Counter[str], Counter[str]] = Counter(), Counter()

        def rows() -> pd.DataFrame:
            found = [(t, counts[1][t], counts[0][t]) for t in counts[0].keys() | counts[1].keys()]
            for held in counts:
                held.clear()
            return pd.DataFrame(found, columns=["term", "toxic", "other"])

        for frame in frames:
            for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
                counts[int(toxic)].update(terms(text).keys())
                if len(counts[0]) + len(counts[1]) > HELD:
                    yield rows()
        yield rows()

    have = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not have.get(0) or not have.get(1):
        return None
    counted = (
        sample.select("text", "toxic")
        .mapInPandas(found, "term string, toxic long, other long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("a"), F.sum("other").alias("b"))
        .withColumns({"c": have[1] - F.col("a"), "d": have[0] - F.col("b")})
    )
    n = have[0] + have[1]

    def part(cell: str, row: str, column: int):
        expected = (F.expr(row)) * column / n
        return F.when(F.col(cell) > 0, F.col(cell) * F.log(F.col(cell) / expected)).otherwise(0.0)

    g = 2 * (
        part("a", "a + b", have[1]) + part("b", "a + b", have[0])
        + part("c", "c + d", have[1]) + part("d", "c + d", have[0])
    )
    lift = F.log((F.col("a") + 0.5) * (have[0] + 1) / ((F.col("b") + 0.5) * (have[1] + 1)))
    told = stored(counted.select("term", "a", "b", g.alias("g"), lift.alias("lift")), "terms", narrow=True)
    beginning = F.col("term").endswith("*")
    stems = told.filter(beginning & (F.col("lift") > 0)).orderBy(F.desc("g"), "term").limit(limit)
    rows = told.filter(~beginning).unionByName(stems).orderBy("term").toArrow().to_pydict()
    total = sizes[0] + sizes[1]
    weighed = []
    for term, a, b, g, lift in zip(*(rows[c] for c in ("term", "a", "b", "g", "lift")), strict=True):
        idf = math.log((total + 1) / (a * sizes[1] / have[1] + b * sizes[0] / have[0] + 1)) + 1
        believed = max(g, 0.0) / (max(g, 0.0) + HALF_G)
        weighed.append((term, idf, idf * believed**2 * max(lift, 0.0)))
    return Vocabulary(weighed, math.log(total + 1) + 1)


@dataclass
class Scorer:
    """A fitted model: the vocabulary and the index, the constant weight, and what it votes for."""

    vocabulary: Vocabulary | None
    index: Index | None
    constant: float
    prior: float
    without_terms: float

    def votes(self, text: str | None, k: int) -> tuple:
        if not self.vocabulary or not self.index:
            return 0.0, 0.0, []
        return self.index.votes(*self.vocabulary.vector(text), k)

    def score(self, votes: float, total: float) -> float:
        if not total:
            return self.without_terms
        return (votes + self.constant * self.prior) / (total + self.constant)


def fit(docs: DataFrame, labelled: DataFrame, limit: int = EXAMPLES, k: int = NEIGHBOURS) -> Scorer:
    """A scorer from the texts of ``docs`` (doc_id, text) and ``labelled`` (doc_id, toxic)."""
    spark = docs.sparkSession
    ship(spark)
    sample, sizes = _sample(docs, labelled, limit)
    total = sum(sizes.values())
    prior = sizes.get(1, 0) / total if total else 0.0
    vocabulary = _vocabulary(sample, sizes, TERMS)
    if not vocabulary:
        return Scorer(None, None, 1.0, prior, prior)
    known = spark.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("rows array<int>, weights array<double>")
    def vectors(text: pd.Series) -> pd.DataFrame:
        found = [known.value.vector(t) for t in text]
        return pd.DataFrame({"rows": [r for r, _ in found], "weights": [w for _, w in found]})

    held = stored(
        sample.select("doc_id", "toxic", "share", vectors("text").alias("v")).select(
            "doc_id", "toxic", "share", "v.rows", "v.weights"
        ),
        "vectors",
    )
    examples = [
        (*r[:3], np.asarray(r[3].values), np.asarray(r[4].values))
        for batch in held.toArrow().to_batches()
        for r in zip(*(c.to_pylist() for c in batch.columns[:3]), *batch.columns[3:], strict=True)
    ]
    index = build(len(vocabulary.rows) + 1, examples)
    shared = spark.sparkContext.broadcast(index)

    def left_out(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [
                shared.value.votes(rows, weights, k, without)[:2]
                for rows, weights, without in zip(
                    frame["rows"], frame["weights"], frame["doc_id"], strict=True
                )
            ]
            yield pd.DataFrame(found, columns=["votes", "total"]).assign(
                toxic=frame["toxic"].to_numpy(), share=frame["share"].to_numpy()
            )

    tried = held.mapInPandas(left_out, "votes double, total double, toxic int, share double")
    rows = np.array([tuple(r) for r in tried.collect()]).reshape(-1, 4)
    votes, totals, toxic, share = rows.T
    bare = totals == 0
    # One row of each class more, so that no text is certain.
    without = (float(share[bare] @ toxic[bare]) + prior) / (float(share[bare].sum()) + 1)

    def loss(constant: float) -> float:
        p = np.clip((votes + constant * prior) / (totals + constant), 1e-9, 1 - 1e-9)[~bare]
        y, w = toxic[~bare], share[~bare]
        return float(-(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum())

    constant = min((10.0**e for e in range(-2, 3)), key=loss)
    return Scorer(vocabulary, index, constant, prior, without)


def scored(
    docs: DataFrame, scorer: Scorer, text: str = "text", threshold: float = THRESHOLD, k: int = NEIGHBOURS
) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and ``evidence``, the nearest examples.

    Input columns of these names are replaced.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    @F.pandas_udf("score double, evidence array<struct<doc_id long, similarity double, toxic int>>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            found = [model.votes(t, k) for t in batch]
            yield pd.DataFrame(
                {
                    "score": [model.score(votes, total) for votes, total, _ in found],
                    "evidence": [
                        [{"doc_id": i, "similarity": c, "toxic": y} for i, c, y in evidence]
                        for *_, evidence in found
                    ],
                }
            )
        give_back()

    kept = [c for c in docs.columns if c not in {"score", "predicted", "evidence"}]
    return docs.select(*kept, score(text).alias("_found")).select(
        *kept,
        "_found.score",
        (F.col("_found.score") >= threshold).cast("int").alias("predicted"),
        "_found.evidence",
    )
