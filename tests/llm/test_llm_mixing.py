"""The mix of sources: targets, balance, and that reruns agree."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyline.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, p string, target string"


def frame(spark, rows):
    return spark.createDataFrame([(*row, "own", "own", "own") for row in rows], SCHEMA)


def made(seed, sizes):
    """Documents of heavy-tailed length, ``sizes`` of each source."""
    rng = random.Random(seed)
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            words = int(min(3000, 20 * rng.paretovariate(1.2)))
            rows.append((len(rows), "w " * words, source))
    return rows


def plain_targets(sizes):
    """Share by weight, cut at three times the size and share again, source after source."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        shares = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = {s for s in rest if shares[s] > 3 * sizes[s]}
        if not above:
            return shares | {s: 3 * sizes[s] for s in full}
        full |= above


def checked(result, rows):
    words = {(i, s): len((t or "").split()) for i, t, s in rows}
    sizes = defaultdict(int)
    for (_, source), n in words.items():
        sizes[source] += n
    targets = plain_targets(sizes)
    found = result.collect()
    assert sorted(((r.doc_id, r.source, r["size"]) for r in found), key=repr) == sorted(
        ((i, s, n) for (i, s), n in words.items()), key=repr
    )
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"])
    taken, copies, n = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in found:
        taken[r.source] += r.taken
        copies[r.source] += r.copies
        n[r.source] += 1
    return taken, copies, n, sizes, targets


@pytest.mark.parametrize("block", [1 << 16, 200])
def test_sources_come_near_their_targets(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    rows = made(3, {"a": 900, "b": 300, "é": 100, "Z": 500, None: 200, "tiny": 30})
    taken, copies, n, sizes, targets = checked(mixing.mixed(frame(spark, rows)), rows)
    for source in sizes:
        assert abs(taken[source] - targets[source]) <= max(60, 0.01 * targets[source])
        # The documents too, up to the landing.
        if sizes[source]:
            assert abs(copies[source] - n[source] * targets[source] / sizes[source]) <= 0.05 * n[source] + 8


def test_reruns_agree_however_rows_lie(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 100)
    rows = made(4, {"a": 300, "b": 120, "c": 60})
    given = frame(spark, rows)
    first = sorted(map(tuple, mixing.mixed(given.repartition(5)).collect()))
    assert first == sorted(map(tuple, mixing.mixed(given.orderBy(F.rand(1)).coalesce(1)).collect()))


def test_a_document_is_taken_with_its_probability():
    """Over many draws each document is taken as often as its source's share says."""
    sizes = [5, 400, 20, 20, 7, 90, 33, 0, 61, 12, 250, 18, 9, 40, 3]
    sizes.sort(reverse=True)
    times = [0] * len(sizes)
    for seed in range(4000):
        flight = mixing.Flight(str(seed), landing=True)
        decided = [d for k, x in enumerate(sizes) for d in flight.add((k,), 0.3, x)]
        decided += flight.end()
        assert sorted(row[0] for row, _ in decided) == list(range(len(sizes)))
        for row, p in decided:
            times[row[0]] += p
    assert all(abs(t / 4000 - 0.3) < 0.035 for t in times)


@pytest.mark.parametrize("tail", [False, True])
def test_flight_keeps_both_totals(tail):
    rng = random.Random(2)
    size = (lambda: int(rng.paretovariate(1))) if tail else (lambda: rng.randrange(300))
    units = sorted(((rng.random(), size()) for _ in range(500)), key=lambda u: -u[1])
    flight = mixing.Flight("x", landing=False)
    decided = [d for k, (p, x) in enumerate(units) for d in flight.add((k, x), p, x)]
    decided += flight.end()
    assert sum(0 < p < 1 for _, p in decided) <= mixing.WINDOW
    assert sum(p * row[1] for row, p in decided) == pytest.approx(sum(p * x for p, x in units))
    number = sum(p for p, _ in units)
    assert sum(p for _, p in decided) == (pytest.approx(number, abs=25) if tail else pytest.approx(number))


def test_odd_rows(spark, odd_rows):
    rows = [(i, t, s) for k, (i, t) in enumerate(odd_rows) for s in [None if k % 3 == 0 else "ab"[k % 2]]]
    result = mixing.mixed(frame(spark, rows)).collect()
    assert len(result) == len(rows)
    assert all(0 <= r.taken <= 3 * r["size"] for r in result)


def test_empty_tables_and_texts(spark):
    assert mixing.mixed(frame(spark, [])).collect() == []
    rows = mixing.mixed(frame(spark, [(1, None, "a"), (2, "", None), (3, " ", "b")])).collect()
    assert {(r.target, r.taken) for r in rows} == {(0.0, 0)}


def test_copies_of_the_mix(spark):
    rows = made(7, {"a": 60, "b": 20}) + [(None, "no id", "b"), (None, "no id", "b")]
    docs = frame(spark, rows)
    mix = mixing.mixed(docs)
    copies = mixing.copies_of(docs, mix)
    assert copies.columns == [*docs.columns, "_copy"]
    wanted = {(r.doc_id, r.source): r.n for r in mix.groupBy("doc_id", "source").agg(F.sum("copies").alias("n")).collect() if r.n}
    found = {(r.doc_id, r.source): r["count"] for r in copies.groupBy("doc_id", "source").count().collect()}
    assert found == wanted
