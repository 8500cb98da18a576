"""Quality rules against a plain count, and what policies and ablations make of the bits."""

import re
from collections import Counter

import pytest

from tallyline.llm import rules


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


CASES = [
    "a b c",
    "a b c a b c",
    "a a a",
    "a a a a",
    "a b a b a b c a b",
    "x\nx\n \n\nx\ny",
    "# * $ % & | < > ~",
]


def test_measures_equal_a_plain_count(documents, odd_rows):
    rows = [*odd_rows, *enumerate(CASES, 100)]
    found = rules.ledger(documents(rows)).select("doc_id", *rules.MEASURES).collect()
    expected = [(i, *measured(t)) for i, t in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_extra_columns_stay(documents):
    ledger = rules.ledger(documents([(1, "a b")]))
    assert {"lang", "source", "score", "text"} <= set(ledger.columns)
    assert ledger.first().n_words == 2


def test_empty_table(documents):
    ledger = rules.ledger(documents([]))
    assert ledger.count() == 0
    assert rules.ablations(ledger).count() == 0


def test_bits_name_the_rules_that_fail(documents):
    row = rules.ledger(documents([(1, "a b c a b c")])).first()
    assert row.failures == rules.bits("few_words", "repeated_words", "short_words")


@pytest.mark.parametrize("policy", sorted(rules.POLICIES))
def test_ablations_equal_policies_without_a_rule(documents, odd_rows, policy):
    ledger = rules.ledger(documents([*odd_rows, *enumerate(CASES, 100), (200, "word and " * 3)]))
    failures = [r.failures for r in ledger.collect()]
    for row in rules.ablations(ledger, policy).collect():
        others = rules.bits(*[r for r in rules.POLICIES[policy] if r != row.rule])
        own = rules.bits(row.rule)
        assert row.n_fail == sum(f & own != 0 for f in failures)
        assert row.n_fail_alone == sum(f & own != 0 and f & others == 0 for f in failures)
        assert row.n_kept_without == sum(f & others == 0 for f in failures)


def test_policies_are_applied_to_a_stored_ledger(documents):
    text = " ".join(f"word{i} ##" for i in range(40))
    ledger = rules.ledger(documents([(1, text)]))
    kept = ledger.select(*[rules.passes(p).alias(p) for p in ("v1", "v2")]).first()
    assert (kept.v1, kept.v2) == (True, False)
