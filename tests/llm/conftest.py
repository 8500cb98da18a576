import random

import pytest

# Names that operators give to columns of their own.
CLASHES = "n_words score x piece length matches lists kept kept_text n_tokens _hash"


@pytest.fixture(scope="session")
def documents(spark):
    """Build documents from (doc_id, text) pairs, with columns that clash with the operators' own."""

    def build(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        schema += "".join(f", {name} string" for name in CLASHES.split())
        full = [
            (i, t, "en", "s", None if t is None else len(t), *["own"] * len(CLASHES.split()))
            for i, t in rows
        ]
        return spark.createDataFrame(full, schema)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs, empty and blank texts, repeated rows, a NULL id, odd signs and a very long text."""
    random.seed(3)
    words = [f"w{i}" for i in range(50)]
    long = " ".join(random.choice(words) for _ in range(30_000))
    same = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    return [
        (1, same),
        (1, same),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (None, same + " fifteen"),
        (5, same.upper()),
        (6, "ä\x0bö\x0cü\r# | <|endoftext|> <s> Σ"),
        (7, long),
        (8, "x " * 5_000),
        (9, "a"),
        (9, "b"),
    ]
