"""Substring dedup against a dictionary of windows."""

import hashlib
import pickle
import random
import re
import tracemalloc

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tallyline.llm import substring


def expected(rows, size):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, words in split:
        if i is not None:
            for k in range(len(words) - size + 1):
                window = tuple(words[k : k + size])
                first[window] = min(first.get(window, i), i)
    out = []
    for i, words in split:
        cut = set()
        for k in range(len(words) - size + 1):
            if i is not None and first[tuple(words[k : k + size])] < i:
                cut.update(range(k, k + size))
        kept = [w for k, w in enumerate(words) if k not in cut]
        out.append((i, len(words), len(cut), " ".join(kept)))
    return out


def texts(seed, n=60):
    random.seed(seed)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for i in range(n):
        words = [f"w{random.randrange(9)}" for _ in range(random.randrange(0, 60))]
        if random.random() < 0.5:
            at = random.randrange(len(words) + 1)
            a = random.randrange(10)
            words[at:at] = passage[a : a + random.randint(5, 20)]
        rows.append((i, " ".join(words)))
    return rows


def told(df):
    rows = df.select("doc_id", "n_words", "n_removed", "kept_text").collect()
    return sorted(map(tuple, rows), key=repr)


def test_equals_a_dictionary_of_windows(documents, odd_rows):
    rows = [*odd_rows, *[(i + 100, t) for i, t in texts(1)]]
    found = substring.without_repeats(documents(rows))
    assert told(found) == sorted(expected(rows, substring.WINDOW), key=repr)
    assert {"text", "score"} <= set(found.columns)


@pytest.mark.parametrize(("size", "chunk"), [(3, 40), (5, 500), (1, 1)])
def test_chunks_and_sizes_change_nothing(documents, monkeypatch, size, chunk):
    rows = texts(size)
    whole = substring.removed_windows
    monkeypatch.setattr(
        substring, "removed_windows", lambda docs, size: whole(docs, size, chunk=chunk)
    )
    found = substring.without_repeats(documents(rows).repartition(3), size=size)
    assert told(found) == sorted(expected(rows, size), key=repr)


def test_a_crowded_sketch_loses_no_window(documents):
    """With every cell taken, all windows reach the second pass and the result is the same."""
    rows = texts(7)
    docs = documents(rows).select("doc_id", "text")
    sketch = substring.repeated_cells(docs, 22, 5)
    for _, text in rows:
        hashes = substring.window_hashes(text.encode(), 5)
        again = substring.window_hashes((text + " " + text).encode(), 5)
        assert len(sketch.likely(hashes)) == len(hashes)
        assert len(again) >= len(hashes)
    full = substring.Sketch(22, {})
    assert not full.likely(substring.window_hashes(b"a b c d e f", 5)).any()


def test_the_sketch_only_overestimates(documents):
    rows = texts(8)
    sketch = substring.repeated_cells(documents(rows).select("doc_id", "text"), 22, 5, chunk=50)
    counts = {}
    for _, text in rows:
        words = text.split()
        for k in range(len(words) - 4):
            counts[tuple(words[k : k + 5])] = counts.get(tuple(words[k : k + 5]), 0) + 1
    for window, n in counts.items():
        if n > 1:
            assert sketch.likely(substring.window_hashes(" ".join(window).encode(), 5)).all()


def test_digest(documents):
    rows = texts(2)
    found = substring.without_repeats(documents(rows), size=5, digest=True)
    assert not {"text", "kept_text"} & set(found.columns)
    expect = {i: hashlib.sha256(k.encode()).hexdigest() for i, _, _, k in expected(rows, 5)}
    assert {r.doc_id: r.kept_sha256 for r in found.collect()} == expect


def test_empty_table(documents):
    assert substring.without_repeats(documents([])).count() == 0


def test_no_text_has_a_window(documents):
    found = substring.without_repeats(documents([(1, None), (2, "a b")]))
    assert told(found) == [(1, 0, 0, ""), (2, 2, 0, "a b")]


@given(st.sets(st.integers(0, 5_000), max_size=50))
def test_places_round_trip(places):
    array = np.array(sorted(places), dtype=np.int64)
    assert substring.unpack_places(substring.pack_places(array)).tolist() == array.tolist()


def hashes_of(windows):
    return np.random.default_rng(5).integers(0, 1 << 64, (windows, 2), dtype=np.uint64)


def test_a_chunk_holds_the_windows_that_pass_the_sketch_alone():
    hashes = hashes_of(1 << 20)
    cells = [[substring._cells(h, line, 22) for h in (hashes[:50], hashes[:50])] for line in (0, 1)]
    rows = list(substring._count(cells, 22))
    assert cells == [[], []]
    blocks = {}
    for line, block, _, again in rows:
        seen = np.zeros(substring.CELL_BLOCK, dtype=np.uint8)
        seen[substring.unpack_places(again)] = 1
        blocks[line, block] = substring.zlib.compress(np.packbits(seen, bitorder="little").tobytes())
    sketch = substring.Sketch(22, blocks)
    sketch.likely(hashes[:1])
    chunk = substring._Chunk(sketch)
    tracemalloc.start()
    for i in range(0, len(hashes), 512):
        chunk.add(i, b"text %d" % i, hashes[i : i + 512])
    found = list(chunk.found(1))
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert [len(r[-1]) // 4 for r in found] == [50]
    # All windows together would be 16 bytes each, and more to settle them.
    assert most < 8 * len(hashes)


def test_a_worker_holds_the_sketch_once(documents):
    rows = [(1, "a b c d e f"), (2, "b c d e f g")]
    sketch = substring.repeated_cells(documents(rows), 22, 5)
    copy = pickle.loads(pickle.dumps(sketch))
    hashes = substring.window_hashes(b"a b c d e f g", 5)
    assert copy.likely(hashes).tolist() == sketch.likely(hashes).tolist() == [False, True, False]
    assert sketch._blocks and not copy._blocks
    with pytest.raises(ValueError):
        pickle.dumps(copy)
    assert pickle.loads(pickle.dumps(sketch)).likely(hashes).any()
