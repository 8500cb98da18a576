"""Packing: ids against the library, a plan against its rules, every token in its place once."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyline.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=500, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.characters(max_codepoint=0x260, exclude_categories=()),
            st.sampled_from(["the", "'s", "'LL", " ", "\n", "<|endoftext|>", "日", "Σ", "é"]),
        ),
        max_size=10,
    )
)
def test_ids_equal_the_library(parts):
    text = "".join(parts)
    ids = np.frombuffer(packing.tokenizer(PATH).of(text), dtype="<u4").tolist()
    assert ids == library_ids(text)


def test_a_full_cache_changes_nothing():
    words = packing.WordIds(PATH, cached=8)
    for i in range(60):
        text = f"the word{i}, Word{i % 5}! the"
        assert np.frombuffer(words.of(text), dtype="<u4").tolist() == library_ids(text)


def check_plan(histogram, capacity):
    filled = {}
    for step in packing.plan(histogram, capacity):
        for i in range(step.count):
            sequence = step.sequence + i // step.per
            place = step.offset + i % step.per * step.length
            filled.setdefault(sequence, []).append((place, step.length, step.rank + i))
    ranks = {}
    for slots in filled.values():
        end = 0
        for place, length, rank in sorted(slots):
            assert place == end
            end += length
            ranks.setdefault(length, []).append(rank)
        assert end <= capacity
    assert {n: sorted(r) for n, r in ranks.items()} == {
        n: list(range(c)) for n, c in histogram.items() if c
    }
    return filled


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 30), max_size=12))
def test_plan_places_every_piece_gapless(histogram):
    check_plan(histogram, 20)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 30), min_size=1, max_size=12))
def test_plan_needs_as_few_sequences_as_best_fit_decreasing(histogram):
    rooms = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = [r for r in rooms if r >= length]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - length)
            else:
                rooms.append(20 - length)
    assert len(check_plan(histogram, 20)) == len(rooms)


def test_plan_size_does_not_follow_the_number_of_pieces():
    random.seed(1)
    small = {n: random.randint(1, 20) for n in range(1, 513)}
    large = {n: c * 1_000_000 for n, c in small.items()}
    assert len(packing.plan(large, 512)) < 4 * 512


def test_plan_refuses_what_does_not_fit():
    with pytest.raises(ValueError):
        packing.plan({21: 1}, 20)


def test_round_trip(documents, odd_rows):
    """Sequences hold the pieces' ids in order, and the pieces of a row are its ids and the end."""
    rows = [*odd_rows, *[(100 + i, "same words here") for i in range(300)]]
    pieces = packing.tokenised(documents(rows), PATH, 4096)
    packed = packing.pack(pieces, 4096)
    got = packed.select("doc_id", "piece", "start", "length", "ids", "sequence_id", "offset").collect()
    expected = []
    for i, text in rows:
        ids = [*library_ids(text), 1]
        expected += [
            (i, k // 4096, k, ids[k : k + 4096]) for k in range(0, len(ids), 4096)
        ]
    found = [(r.doc_id, r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in got]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    sequences = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, bytes(r.ids)))
    for sequence, parts in by_sequence.items():
        parts.sort()
        assert sequences[sequence] == b"".join(ids for _, ids in parts)
        assert len(sequences[sequence]) <= 4 * 4096
        end = 0
        for offset, ids in parts:
            assert offset == end
            end += len(ids) // 4


def test_empty_table(documents):
    packed = packing.pack(packing.tokenised(documents([]), PATH, 4096), 4096)
    assert packed.count() == 0
    assert {"sequence_id", "offset"} <= set(packed.columns)


def test_ranks_of_a_common_length_are_dense(spark):
    pieces = spark.range(5_000).selectExpr("id as doc_id", "0 as piece", "7L as length")
    ranks = [r._rank for r in packing.ranked(pieces, salts=16).select("_rank").collect()]
    assert sorted(ranks) == list(range(5_000))
