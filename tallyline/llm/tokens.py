"""Token counts of whole texts by a SentencePiece model, without a shuffle of words.

In a model whose pieces have a blank only at their start, the pieces of a text are those of its
pre-tokens: runs of blanks with what follows, up to the next blank or line end. So a text's count is
the sum over its pre-tokens, and their counts are looked up in two tiers: a broadcast table of the
most frequent ones, found by merging summaries that each partition makes of its own words, and a
bounded cache of each worker for the rest. No word is shuffled beyond those summaries. The tables
only save work; every count is the model's own.

A NULL or empty text has no tokens. Rows are counted one by one, so repeated rows and NULL ids stay.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import ship

# Entries of the broadcast table, each with at most so many characters.
FREQUENT = 32_768
LONGEST = 32
# Entries that a worker caches beside them.
CACHED = 300_000
# Words that a partition's summary holds while it is made, and those that it reports.
SUMMARY = 200_000

_BLANK = "▁"

_models: dict[str, sentencepiece.SentencePieceProcessor] = {}


def model(path: str) -> sentencepiece.SentencePieceProcessor:
    """The model at ``path``, loaded once per process."""
    if path not in _models:
        _models[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _models[path]


def separable(path: str) -> bool:
    """Whether pieces of the model never reach over a blank or a line end."""
    m = model(path)
    pieces = (m.id_to_piece(i) for i in range(m.get_piece_size()))
    return (
        not any(re.search(f"[^{_BLANK}]{_BLANK}|\n", p) for p in pieces)
        and m.encode("a  b", out_type=str) == [f"{_BLANK}a", _BLANK, f"{_BLANK}b"]
        and len(m.encode("a\nb")) == len(m.encode("a")) + len(m.encode("\nb")) - 1
    )


def pre_tokens(text: str) -> list[str]:
    """The text in parts whose counts add up; none if runs of blanks need the model itself.

    A part stands for itself with a blank before it, one that begins with a line end for itself
    alone, and an empty one for a blank.
    """
    if "  " in text or _BLANK in text or text[:1] == " ":
        return []
    return text.replace("\n", " \n").split(" ")


class Counts(dict):
    """Token counts by pre-token: the frequent ones, and a bounded cache of others."""

    def __init__(self, path: str, frequent: dict[str, int], cached: int = CACHED):
        super().__init__(frequent)
        self._model = model(path)
        self._frequent = frequent
        self._limit = len(frequent) + cached

    def __missing__(self, part: str) -> int:
        n = len(self._model.encode(part))
        if part[:1] == "\n":
            n -= 1  # the blank that the model puts before any text
        elif not part:
            n = 1  # a blank alone
        if len(self) >= self._limit:
            self.clear()
            self.update(self._frequent)
        self[part] = n
        return n

    def of(self, text: str) -> int:
        if not text:
            return 0
        parts = pre_tokens(text)
        if parts:
            return sum(map(self.__getitem__, parts))
        return len(self._model.encode(text))


def frequent(docs: DataFrame, text: str = "text", limit: int = FREQUENT) -> list[str]:
    """The most frequent pre-tokens, as merged from a bounded summary of every partition.

    A summary counts exactly until it is full, then forgets its rarest words.
    """

    ship(docs.sparkSession)

    def summaries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        for frame in frames:
            for value in frame["t"]:
                counts.update(pre_tokens(value) if value else ())
                if len(counts) > 2 * SUMMARY:
                    counts = Counter(dict(counts.most_common(SUMMARY)))
        top = [(w, n) for w, n in counts.most_common(limit) if n > 1 and len(w) <= LONGEST]
        yield pd.DataFrame(top, columns=["word", "n"])

    merged = (
        docs.select(F.col(text).alias("t"))
        .mapInPandas(summaries, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(limit)
    )
    return [row.word for row in merged.collect()]


def with_counts(docs: DataFrame, path: str, limit: int = 4096, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    Input columns of these names are replaced.
    """
    if not separable(path):
        raise ValueError(f"pieces of {path} reach over blanks")
    spark = docs.sparkSession
    known = frequent(docs, text)
    encoded = model(path).encode(known)
    counts = {
        w: 1 if not w else len(ids) - (w[:1] == "\n") for w, ids in zip(known, encoded, strict=True)
    }
    table = spark.sparkContext.broadcast(counts)

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lookup = Counts(path, table.value)
        for batch in batches:
            yield pd.Series([lookup.of(t) if t else 0 for t in batch], dtype="int64")

    n_tokens = F.pandas_udf(count, "long")
    given: Column = F.coalesce(F.col(text), F.lit(""))
    kept = [c for c in docs.columns if c not in {text, "n_bytes", "n_tokens", "over_limit"}]
    return docs.select(
        *kept,
        F.octet_length(given).cast("long").alias("n_bytes"),
        n_tokens(F.col(text)).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
