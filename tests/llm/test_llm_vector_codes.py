"""Vector codes against plain rounds over all vectors."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import anchors, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, v string"


def plain(vectors, parts=8, entries=16, rounds=6):
    """Codes, errors and codebooks of integer vectors already in order of their ids."""
    cut = np.pad(vectors, ((0, 0), (0, -vectors.shape[1] % parts))).reshape(len(vectors), parts, -1)
    book = cut[:entries].swapaxes(0, 1).astype(np.int64).copy()
    for i in range(rounds + 1):
        away = ((cut[:, :, None] - book[None]) ** 2).sum(axis=3)
        codes = away.argmin(axis=2)
        if i == rounds:
            return codes, away.min(axis=2).sum(axis=1), book
        for p in range(parts):
            for e in range(book.shape[1]):
                own = cut[codes[:, p] == e, p]
                if len(own):
                    book[p, e] = [int(s) // len(own) for s in own.sum(axis=0)]


def frame(spark, rows):
    return spark.createDataFrame([(*row, "own", "own", "own") for row in rows], SCHEMA)


def made(seed, n, size, kinds):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(kinds, size))
    return np.float32(centres[rng.integers(kinds, size=n)] + rng.normal(scale=0.2, size=(n, size)))


@pytest.mark.parametrize("n, size, kinds", [(700, 16, 3), (40, 24, 2), (900, 8, 900)])
def test_trees_settle_like_all_distances(n, size, kinds):
    points = np.floor(made(n, n, size, kinds) * 40).astype(np.int32).reshape(n, 8, -1)
    points[n // 2 :: 3] = points[0]  # many equal ones
    forest = anchors.Forest.load(anchors.planted(points).dump())
    for seed in range(3):
        chosen = np.random.default_rng(seed).integers(n, size=16)
        book = points[chosen].swapaxes(0, 1).astype(np.int64)
        codes, counts, sums = anchors.settled(forest, book)
        away = ((points[:, :, None] - book[None]) ** 2).sum(axis=3)
        expected = away.argmin(axis=2)
        assert (codes == expected).all()
        for p in range(8):
            for e in range(16):
                own = points[expected[:, p] == e, p]
                assert counts[p, e] == len(own) and (sums[p, e] == own.sum(axis=0)).all()


def test_balls_hold_their_points_and_few_are_opened():
    points = np.floor(made(5, 2000, 8, 6) * 500).astype(np.int32).reshape(2000, 1, 8)
    forest = anchors.planted(points)
    assert sorted(forest.order[0]) == list(range(2000))
    for node in range(len(forest.part)):
        inside = points[forest.order[0, forest.start[node] : forest.end[node]], 0]
        mean = forest.sums[node] / len(inside)
        assert (np.sqrt(((inside - mean) ** 2).sum(axis=1)) <= forest.radius[node] + 1e-6).all()
        if forest.left[node] >= 0:
            assert forest.start[forest.left[node]] == forest.start[node]
            assert forest.end[forest.left[node]] == forest.start[forest.right[node]]
    # Entries at the six centres: most points are settled by whole balls.
    centres = np.random.default_rng(5).normal(size=(6, 8))
    book = np.floor(centres * 500).astype(np.int64)[None]
    compared = 0
    original = anchors._compared

    def counting(forest, book, leaves, candidates, *rest):
        nonlocal compared
        compared += sum(forest.end[n] - forest.start[n] for n in leaves)
        original(forest, book, leaves, candidates, *rest)

    anchors._compared = counting
    try:
        anchors.settled(forest, book)
    finally:
        anchors._compared = original
    assert compared < 500


@pytest.mark.parametrize("partitions, chunk", [(1, 2048), (5, 64)])
def test_codes_equal_plain_rounds(spark, monkeypatch, partitions, chunk):
    monkeypatch.setattr(vector_codes, "CHUNK", chunk)
    vectors = made(1, 400, 64, 5)
    vectors[100:160] = vectors[3]
    nan = vectors[0].copy()
    nan[5] = math.nan
    odd = [
        (-9, None, 1),
        (-8, [None, *vectors[0][1:].tolist()], 1),
        (-7, nan.tolist(), 1),
        (-6, [math.inf] * 64, 1),
        (-5, [], 1),
        (10_000, [1.0] * 63, 1),
        (10_001, [1e30] * 64, 1),
    ]
    labels = [None if i % 7 == 0 else 0 if i % 3 else i % 5 for i in range(400)]
    rows = [(i, v.tolist(), label) for i, (v, label) in enumerate(zip(vectors, labels))]
    rows += [(7, vectors[7].tolist(), 2), (None, vectors[9].tolist(), None)]  # repeated; no id
    given = frame(spark, odd + rows[::-1]).repartition(partitions)
    codes, book = vector_codes.compressed(given)
    in_order = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    numbers = np.floor(np.array([r[1] for r in in_order], dtype=np.float32) * 4096).astype(np.int64)
    expected_codes, errors, expected_book = plain(numbers)
    assert (book == expected_book).all()
    by_label = {}
    for row, error in zip(in_order, errors):
        by_label[row[2]] = by_label.get(row[2], 0) + int(error)
    digest = hashlib.sha256(",".join(map(str, expected_book.ravel())).encode()).hexdigest()
    expected = [
        (row[0], "".join(f"{e:02x}" for e in code), int(error), by_label[row[2]], digest)
        for row, code, error in zip(in_order, expected_codes, errors)
    ]
    found = codes.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_few_vectors_and_sizes_that_parts_do_not_divide(spark):
    vectors = made(2, 5, 10, 5)
    codes, book = vector_codes.compressed(
        frame(spark, [(i, v.tolist(), None) for i, v in enumerate(vectors)])
    )
    assert book.shape == (8, 5, 2)
    assert {r.error for r in codes.collect()} == {0}


def test_no_vectors(spark):
    codes, _ = vector_codes.compressed(frame(spark, [(1, None, 1), (2, [], 1)]).filter(F.lit(True)))
    assert codes.collect() == [] and "label_error" in codes.columns
