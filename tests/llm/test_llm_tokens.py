"""Token counts against the library's own."""

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyline.llm import tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_pieces_of_the_model_do_not_reach_over_blanks():
    assert tokens.separable(PATH)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab  \n\t\r▁é日🙂<s>\x00.　"), max_size=24))
def test_parts_add_up(text):
    assert tokens.Counts(PATH, {}).of(text) == len(MODEL.encode(text))


def test_a_full_cache_changes_nothing():
    counts = tokens.Counts(PATH, {"the": 1}, cached=3)
    for i in range(40):
        text = f"the word{i} the word{i % 3}"
        assert counts.of(text) == len(MODEL.encode(text))
    assert len(counts) <= 4


@pytest.mark.parametrize("limit", [10, 4096])
def test_counts_equal_the_library(documents, odd_rows, limit):
    found = tokens.with_counts(documents(odd_rows), PATH, limit)
    rows = found.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    expected = []
    for i, text in odd_rows:
        n = len(MODEL.encode(text or ""))
        expected.append((i, len((text or "").encode()), n, n > limit))
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)
    assert "lang" in found.columns and "text" not in found.columns


def test_empty_table(documents):
    assert tokens.with_counts(documents([]), PATH).count() == 0


def test_frequent_parts_come_from_all_partitions(documents):
    docs = documents([(i, "common words " * 3 + f"rare{i}") for i in range(40)]).repartition(8)
    assert {"common", "words"} <= set(tokens.frequent(docs, limit=5))
