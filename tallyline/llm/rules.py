"""Quality rules: every rule is evaluated once per document and kept as a bit.

``ledger`` measures a document, evaluates every rule and stores the failures as bits of one number
beside the measurements. A policy names the rules that reject; policies have versions and are
applied to a stored ledger, and ablations are counted from the bits, without a look at the texts.

Everything is DataFrame expressions. A NULL text has no words. Rows are judged one by one, so
repeated rows and NULL ids stay as they are; further columns of the input are carried along unless
a measurement has their name, which then replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import BLANK_RUN, words

SYMBOLS = r"[#*$%&|<>]"
# Words of the windows whose repetition within a text is measured.
WINDOW = 3

MEASURES = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
]


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements; the position in ``RULES`` is the bit."""

    name: str
    fails: str


# Bits are positions: append new rules, never reorder.
RULES = [
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("many_symbols", "2 * n_symbols > n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("no_words", "n_words = 0"),
]


def bits(*names: str) -> int:
    """The bit mask of the named rules."""
    at = {rule.name: i for i, rule in enumerate(RULES)}
    return sum(1 << at[name] for name in names)


BASE = ("few_words", "repeated_words")

# Versions of the policy: a document is kept if none of the named rules fails.
POLICIES = {
    "v1": BASE,
    "v2": (*BASE, "short_words", "long_words", "many_symbols"),
    "v3": (*BASE, "short_words", "long_words", "many_symbols", "repeated_lines"),
}
CURRENT = "v3"


def _repeat_words(n_words: str, grams: str) -> Column:
    """Words in a window that occurs twice or more, from the sorted (window, place) pairs.

    Of the places of such windows in order, each covers the words up to the next one, three at
    most. No step compares all pairs, so a long text of one repeated line costs a sort.
    """
    repeated = f"""
        filter({grams}, (g, i) -> g.h = get({grams}, i - 1).h or g.h = get({grams}, i + 1).h)
    """
    places = f"array_sort(transform({repeated}, g -> g.p))"
    return F.expr(
        f"""case when {n_words} < {WINDOW} then 0L else
        aggregate({places}, named_struct('n', 0L, 'end', 0),
            (a, p) -> named_struct('n', a.n + p + {WINDOW} - greatest(a.end, p), 'end', p + {WINDOW}),
            a -> a.n) end"""
    )


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Measurements and ``failures`` (one bit per rule) of every document."""
    given = F.coalesce(F.col(text), F.lit(""))
    kept = [c for c in docs.columns if c not in {*MEASURES, "n_lines", "failures"}]
    split = docs.select(
        *kept,
        words(F.col(text)).alias("_words"),
        F.length(F.regexp_replace(given, BLANK_RUN, "")).cast("long").alias("word_chars"),
        F.regexp_count(given, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.expr(
            f"filter(split(coalesce({_name(text)}, ''), '\\n', -1), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
        ).alias("_lines"),
    )
    counted = split.select(
        *kept,
        F.size("_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            f"""array_sort(transform(
                slice(_words, 1, greatest(size(_words) - {WINDOW - 1}, 0)),
                (w, i) -> named_struct('h', xxhash64(w, get(_words, i + 1), get(_words, i + 2)), 'p', i)))"""
        ).alias("_grams"),
    )
    measured = counted.withColumn("n_repeat_words", _repeat_words("n_words", "_grams"))
    failed = " | ".join(
        f"shiftleft(cast(coalesce({rule.fails}, false) as bigint), {i})"
        for i, rule in enumerate(RULES)
    )
    return measured.select(*kept, *MEASURES, "n_lines", F.expr(failed).alias("failures"))


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def passes(policy: str = CURRENT) -> Column:
    """Whether a row of a ledger is kept under a version of the policy."""
    return F.col("failures").bitwiseAND(F.lit(bits(*POLICIES[policy]))) == 0


def ablations(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: failures, documents only it rejects, and what is kept without it.

    The ledger is first counted by its distinct failure bits, of which there are 2 ** rules at
    most, so each rule is judged on that small table.
    """
    mask = bits(*POLICIES[policy])
    masks = rows.groupBy(F.col("failures").bitwiseAND(F.lit(mask)).alias("failures")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rules = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("rule"), F.lit(bits(name)).cast("long").alias("bit"))
                for name in POLICIES[policy]
            ]
        )
    )
    each = masks.select("failures", "n", rules.alias("r")).select("failures", "n", "r.*")
    fails = F.col("failures").bitwiseAND(F.col("bit")) != 0
    alone = F.col("failures") == F.col("bit")
    kept = F.col("failures") == 0
    return each.groupBy("rule").agg(
        F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("n_fail"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("n_fail_alone"),
        F.sum(F.when(kept | alone, F.col("n")).otherwise(0)).alias("n_kept_without"),
    )
