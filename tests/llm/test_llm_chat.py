"""Preference pairs against a loop over conversations."""

import random

import pytest

from tallyline.llm import chat

TURNS = "pair_id long, turn long, role string, text string, extra string"


def conversations(seed):
    random.seed(seed)
    chosen, rejected = [], []
    for pair in range(40):
        n = random.randint(0, 6)
        said = [(pair, t, random.choice(["user", "assistant"]), f"t{random.randrange(3)}") for t in range(n)]
        at = random.randint(0, n)
        ending = range(at, at + random.randint(0, 3))
        other = said[:at] + [(pair, t, "assistant", f"o{random.randrange(2)}") for t in ending]
        chosen += said
        rejected += other
    odd = [(50, 0, None, None), (50, 1, "assistant", "a"), (50, 1, "assistant", "b")]
    odd += [(None, 1, "user", "x"), (51, None, "user", "x")]
    chosen += odd + [(52, 3, "assistant", "w " * 50_000), (52, 3, "assistant", "w " * 50_000)]
    rejected += [(50, 0, "", ""), (50, 1, "assistant", "c")]
    return chosen, rejected


def expected(chosen, rejected):
    def sides(rows):
        out = {}
        for pair, turn, role, text in rows:
            if pair is not None and turn is not None:
                out.setdefault(pair, {}).setdefault(turn, set()).add((role or "", text or ""))
        return {p: {t: min(s) for t, s in turns.items()} for p, turns in out.items()}

    a, b = sides(chosen), sides(rejected)
    rows = []
    for pair in a.keys() | b.keys():
        one, two = a.get(pair, {}), b.get(pair, {})
        differ = [t for t in one.keys() | two.keys() if one.get(t) != two.get(t)]
        split = min(differ) if differ else float("inf")
        parts = {
            "prompt": [t for t in one if t < split],
            "chosen": [t for t in one if t >= split],
            "rejected": [t for t in two if t >= split],
        }
        for part, turns in parts.items():
            text = ""
            for turn in sorted(turns):
                role, said = (two if part == "rejected" else one)[turn]
                rendered = f"<|im_start|>{role}\n{said}<|im_end|>\n"
                trained = part != "prompt" and role == "assistant"
                mask = len(text) + rendered.index("\n") + 1
                rows.append(
                    (pair, part, turn, role, rendered, len(text), len(rendered))
                    + ((mask, len(rendered) - rendered.index("\n") - 1) if trained else (None, 0))
                )
                text += rendered
    return rows


def tables(spark, chosen, rejected):
    return [
        spark.createDataFrame([(*r, "x") for r in rows], TURNS) for rows in (chosen, rejected)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_loop_over_conversations(spark, seed):
    chosen, rejected = conversations(seed)
    found = chat.preferences(*tables(spark, chosen, rejected)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected(chosen, rejected), key=repr)


def test_a_long_conversation_is_placed_in_blocks(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", "a") for t in range(9_000)]
    other = [*rows[:5_000], (1, 5_000, "user", "b")]
    found = chat.preferences(*tables(spark, rows, other)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected(rows, other), key=repr)


def test_empty_tables(spark):
    none, one = tables(spark, [], [(1, 0, "assistant", "x")])
    assert chat.preferences(none, none).count() == 0
    assert [r.part for r in chat.preferences(none, one).collect()] == ["rejected"]
    assert [r.part for r in chat.preferences(one, one).collect()] == ["prompt"]
