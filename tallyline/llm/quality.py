"""A quality classifier: regularised quadratic discriminant analysis over document statistics.

Each document is described by a fixed number of statistics, transformed to spread evenly. Of the
labelled documents only their number, sums and sums of products per class are gathered, whatever their
number, so the fit uses them all. A class covariance is shrunk towards the one shared by the classes
and towards its own variances; both weights follow the sizes of the classes. The score of a document is
the logistic of the difference of the log densities, from Mahalanobis distances by Cholesky factors
that are computed once, and of the log shares of the classes.

A NULL text is empty. Rows are scored one by one; repeated rows and NULL ids stay. Of several
labels of one id the lower counts; a NULL label is none. Without a label of either class every score is
the share of good rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import ship, stored

THRESHOLD = 0.3
# Rows that the prior variances weigh like in a class covariance.
PRIOR_ROWS = 50.0
# The least variance of a standardised statistic.
FLOOR = 0.3
# Distances beyond which log densities are no longer told apart, per statistic.
FAR = 50.0

STATISTICS = [
    "log_words",
    "word_length",
    "long_words",
    "short_words",
    "upper",
    "capitalised",
    "digits",
    "signs",
    "symbols",
    "bars",
    "stops",
    "exclamations",
    "line_words",
    "repeated_lines",
    "distinct_words",
    "commonest_word",
    "neighbours",
    "repeated_pairs",
    "other_script",
]

_SYMBOLS = str.maketrans("", "", "#*$%&<>{}[]\\^~=_@")
_SIGNS = re.compile(r"[^\w\s]")
_CAPITAL = re.compile(r"\b[^\W\d_a-z]")


def statistics(text: str | None) -> list[float]:
    """The statistics of a text, in the order of ``STATISTICS``; shares are of words or characters."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    chars = sum(map(len, words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:], strict=False))
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    digits = chars - len("".join(words).translate(_DIGITS))
    upper = sum(map(str.isupper, words))
    return [
        np.log1p(n),
        np.log(chars / n),
        np.sqrt((lengths > 12).mean()),
        np.sqrt((lengths < 3).mean()),
        np.sqrt(upper / n),
        np.sqrt(len(_CAPITAL.findall(text)) / n),
        np.sqrt(digits / chars),
        np.sqrt(len(_SIGNS.findall(text)) / chars),
        np.sqrt((len(text) - len(text.translate(_SYMBOLS))) / chars),
        np.sqrt(text.count("|") / n),
        np.sqrt((text.count(".") + text.count(",")) / n),
        np.sqrt((text.count("!") + text.count("?")) / n),
        np.log1p(n / len(lines)),
        np.sqrt(1 - len(set(lines)) / len(lines)),
        np.log(len(counts)) / np.log(n) if n > 1 else 1.0,
        np.sqrt(counts.most_common(1)[0][1] / n),
        np.sqrt(sum(a == b for a, b in zip(words, words[1:], strict=False)) / n),
        np.sqrt(1 - len(pairs) / (n - 1)) if n > 1 else 0.0,
        np.sqrt(sum(not w.isascii() for w in words) / n),
    ]


_DIGITS = str.maketrans("", "", "0123456789")


def described(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``x``, the statistics, in place of the text."""
    ship(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def x(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([statistics(t) for t in batch])

    return docs.select(*[c for c in docs.columns if c not in {text, "x"}], x(text).alias("x"))


@dataclass
class Discriminant:
    """The class densities: centres, inverse Cholesky factors, log determinants and log shares."""

    prior: float
    scale: tuple[np.ndarray, np.ndarray] | None = None
    centres: tuple[np.ndarray, ...] = ()
    whiten: tuple[np.ndarray, ...] = ()
    logdet: tuple[float, ...] = ()
    log_share: tuple[float, ...] = ()

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row."""
        if not self.scale:
            return np.full(len(x), self.prior)
        z = np.clip((x - self.scale[0]) / self.scale[1], -FAR, FAR)
        density = [
            share - 0.5 * (((z - centre) @ whiten.T) ** 2).sum(axis=1) - 0.5 * logdet
            for centre, whiten, logdet, share in zip(
                self.centres, self.whiten, self.logdet, self.log_share, strict=True
            )
        ]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def discriminant(moments: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> Discriminant:
    """The fit from (rows, sums, sums of products) by class."""
    n = {y: moments[y][0] if y in moments else 0.0 for y in (0, 1)}
    total = n[0] + n[1]
    prior = n[1] / total if total else 0.0
    if not n[0] or not n[1]:
        return Discriminant(prior)
    mean = {y: moments[y][1] / n[y] for y in n}
    cov = {y: moments[y][2] / n[y] - np.outer(mean[y], mean[y]) for y in n}
    centre = (moments[0][1] + moments[1][1]) / total
    spread = np.sqrt(
        np.maximum(np.diag(moments[0][2] + moments[1][2]) / total - centre**2, 1e-12)
    )
    shared = sum(n[y] * cov[y] for y in n) / total
    centres, whiten, logdet, share = [], [], [], []
    for y in (0, 1):
        own = n[y] / (n[y] + PRIOR_ROWS)
        mixed = own * cov[y] + (1 - own) * shared
        # The more statistics there are per row, the more the correlations are shrunk.
        trust = n[y] / (n[y] + len(mean[y]))
        mixed = trust * mixed + (1 - trust) * np.diag(np.diag(mixed))
        mixed = mixed / np.outer(spread, spread) + FLOOR * np.eye(len(spread))
        factor = np.linalg.cholesky(mixed)
        centres.append((mean[y] - centre) / spread)
        whiten.append(np.linalg.inv(factor))
        logdet.append(2 * float(np.log(np.diag(factor)).sum()))
        share.append(float(np.log(n[y] / total)))
    return Discriminant(
        prior, (centre, spread), tuple(centres), tuple(whiten), tuple(logdet), tuple(share)
    )


def fit(rows: DataFrame, labelled: DataFrame) -> Discriminant:
    """The discriminant of ``rows`` (doc_id, x) by ``labelled`` (doc_id, quality), over all of them."""
    given = (
        labelled.filter("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("y"))
    )
    size = len(STATISTICS)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {y: [0.0, np.zeros(size), np.zeros((size, size))] for y in (0, 1)}
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.array(batch.column(1).to_pylist(), dtype=float).reshape(-1, size)
            for label, held in sums.items():
                own = x[y == label]
                held[0] += len(own)
                held[1] += own.sum(axis=0)
                held[2] += own.T @ own
        # A row per number, so that the sums of all partitions are added by an aggregate.
        values = [
            (y, i, float(v))
            for y, (n, total, products) in sums.items()
            for i, v in enumerate([n, *total, *products.ravel()])
        ]
        kinds = [pa.int32(), pa.int32(), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(zip(*values, strict=True), kinds, strict=True)],
            names=["y", "i", "v"],
        )

    sums = (
        rows.select("doc_id", "x")
        .join(given, "doc_id")
        .select("y", "x")
        .mapInArrow(moments, "y int, i int, v double")
        .groupBy("y", "i")
        .agg(F.sum("v").alias("v"))
        .orderBy("y", "i")
        .collect()
    )
    flat = {y: np.array([r.v for r in sums if r.y == y]) for y in (0, 1)}
    return discriminant(
        {
            y: (v[0], v[1 : size + 1], v[size + 1 :].reshape(size, size))
            for y, v in flat.items()
            if len(v)
        }
    )


def scored(rows: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """``rows`` with ``score`` and ``predicted`` in place of ``x``."""
    ship(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(np.stack(x.to_numpy())) if len(x) else [], dtype=float)

    kept = [c for c in rows.columns if c not in {"x", "score", "predicted"}]
    return rows.select(*kept, score("x").alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def described_once(docs: DataFrame, text: str = "text") -> DataFrame:
    """``described``, written to the shared folder, as fitting and scoring both read it."""
    return stored(described(docs, text), "statistics")
