"""Decontamination: exact distances, planted passages, and clean documents left alone."""

import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyline.llm import decontamination as d


def least_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


@given(
    st.lists(st.integers(1, 4), min_size=1, max_size=80), st.lists(st.integers(0, 4), max_size=90)
)
def test_edit_distance(pattern, text):
    distance, end = d.edit_distance(pattern, text)
    assert distance == least_distance(pattern, text)
    assert distance == least_distance(pattern, text[:end])


def vocabulary(seed=1):
    random.seed(seed)
    return ["".join(random.choice("abcdefgh") for _ in range(5)) for _ in range(3_000)]


def items(words, n=60):
    return [(i, " ".join(random.choices(words, k=random.randint(5, 60)))) for i in range(n)]


def edited(words, vocabulary, edits):
    words = list(words)
    for _ in range(edits):
        at = random.randrange(len(words))
        kind = random.random()
        if kind < 0.5:
            words[at] = random.choice(vocabulary)
        elif kind < 0.75:
            del words[at]
        else:
            words.insert(at, random.choice(vocabulary))
    return words


@pytest.mark.parametrize(("share", "least"), [(0.0, 1.0), (0.1, 0.97), (0.2, 0.9)])
def test_recall_of_edited_passages(share, least):
    words = vocabulary()
    tests = items(words)
    index = d.Index([(i, d.words(t)) for i, t in tests])
    texts, wanted = [], []
    for item_id, text in tests * 4:
        own = d.words(text)
        passage = edited(own, words, int(len(own) * share + 1e-9))
        around = random.choices(words, k=60)
        texts.append(" ".join([*around, *passage, *around]))
        wanted.append(item_id)
    found = d.search(index, texts)
    hits = [any(m["item_id"] == i for m in row) for row, i in zip(found, wanted, strict=True)]
    assert sum(hits) / len(hits) >= least


@pytest.mark.parametrize("length", [5, 6, 9, 10, 14, 15, 20, 31, 32, 40, 45, 46, 59, 120])
@pytest.mark.parametrize("even", [True, False])
def test_recall_by_length_with_words_of_no_item(length, even):
    random.seed(length)
    own_words = ["".join(random.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    tests = [(i, random.choices(own_words, k=length)) for i in range(100)]
    index = d.Index(tests)
    edits = d.most_edits(length, d.SIMILARITY)

    def strange():
        return "x" + "".join(random.choice("abcdefgh") for _ in range(7))

    texts = []
    for _, own in tests:
        if even:
            places = [round((j + 1) * (length + 1) / (edits + 1)) - 1 for j in range(edits)]
        else:
            places = random.sample(range(length), edits)
        passage = [strange() if at in places else w for at, w in enumerate(own)]
        texts.append(" ".join([strange() for _ in range(20)] + passage + [strange() for _ in range(20)]))
    found = d.search(index, texts)
    hits = [any(m["item_id"] == i for m in row) for (i, _), row in zip(tests, found, strict=True)]
    assert sum(hits) / len(hits) >= 0.95


def test_short_items_and_scripts_without_blanks():
    given = [(1, "yes"), (2, "Red green"), (3, "a b c d"), (4, "日本語の文章"), (5, ""), (6, None)]
    index = d.Index([(i, d.words(t)) for i, t in given])
    texts = ["no", "yes!", "red blue green", "so red, green", "a b c", "x a b c d e", "これは日本人の文章です"]
    found = [[(m["item_id"], m["word_start"], m["distance"]) for m in row] for row in d.search(index, texts)]
    assert found == [[], [(1, 0, 0)], [], [(2, 1, 0)], [], [(3, 1, 0)], [(4, 3, 1)]]


def test_walks_reach_the_recall():
    for n in range(5, 300):
        places, length, repetitions = d.walks(n, d.SIMILARITY)
        edits = d.most_edits(n, d.SIMILARITY)
        short, longer = divmod(n - edits, edits + 1)
        missed = 1.0
        for r in range(repetitions):
            missed *= (1 - d.caught(short + 1, places, length, r)) ** longer
            missed *= (1 - d.caught(short, places, length, r)) ** (edits + 1 - longer)
        assert missed <= 1 - d.RECALL + 1e-9


def test_every_match_is_within_the_distance():
    words = vocabulary(2)
    tests = items(words)
    index = d.Index([(i, d.words(t)) for i, t in tests])
    texts = [
        " ".join(random.choices(words, k=20) + edited(d.words(t), words, random.randint(0, 20)))
        for _, t in tests
    ]
    by_id = dict(tests)
    for text, matches in zip(texts, d.search(index, texts), strict=True):
        for m in matches:
            own = d.words(by_id[m["item_id"]])
            passage = d.words(text)[m["word_start"] : m["word_start"] + m["n_words"]]
            assert m["distance"] == least_distance(own, passage) <= 0.2 * len(own)
            assert m["similarity"] >= d.SIMILARITY - 1e-9


def test_a_passage_does_not_cross_documents():
    index = d.Index([(1, "a b c d e f g h i j k l".split())])
    assert d.search(index, ["a b c d e f", "g h i j k l"]) == [[], []]
    assert [m["word_start"] for m in d.search(index, ["z", "x a b c d e f g h i j k l"])[1]] == [1]


def test_matches_of_documents(spark, documents, odd_rows):
    words = vocabulary(3)
    tests = items(words, 8)
    tests += [(90, tests[0][1]), (91, None), (92, "too short"), (None, tests[1][1])]
    table = spark.createDataFrame(tests, "item_id long, text string")
    rows = [*odd_rows, (100, "x " + tests[0][1].upper().replace(" ", " ,\n") + " y")]
    rows += [(101, tests[1][1]), (101, tests[1][1]), (None, tests[2][1]), (102, None)]
    found = d.with_matches(documents(rows), table)
    held = sorted(
        ((r.doc_id, m.item_id) for r in found.collect() for m in r.matches), key=repr
    )
    expected = [(100, 0), (100, 90), (101, 1), (101, 1), (101, None), (101, None), (None, 2)]
    assert held == sorted(expected, key=repr)
    assert found.count() == len(rows) and "score" in found.columns


def test_blocks_of_items_change_nothing(spark, documents, monkeypatch):
    words = vocabulary(4)
    tests = items(words, 9)
    table = spark.createDataFrame(tests, "item_id long, text string")
    docs = documents([(i, t) for i, t in tests])
    whole = d.with_matches(docs, table).select("doc_id", "matches").collect()
    monkeypatch.setattr(d, "BLOCK_ITEMS", 2)
    monkeypatch.setattr(d, "PASS_BLOCKS", 2)
    parts = d.with_matches(docs, table).select("doc_id", "matches").collect()
    assert sorted(whole, key=repr) == sorted(parts, key=repr)


def test_a_filter_does_not_search_again(spark, documents):
    table = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    found = d.with_matches(documents([(1, "x a b c d e f"), (2, "y")]), table)
    held = found.select("doc_id", F.explode("matches").alias("m")).filter("m.distance = 0")
    assert held.count() == 1
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert d.with_matches(documents([(1, "a b c d e f")]), none).first().matches == []
    assert d.with_matches(documents([]), one).count() == 0
