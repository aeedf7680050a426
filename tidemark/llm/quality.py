"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements and
one bit per failed rule. A policy is a set of rules, that is a mask over those bits,
so versions of a policy and ablations are bit operations on the ledger and never
read a text again.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD

SYMBOLS = "[#*$%&|<>]"
#: Rules in the order of their bits; each says which documents fail.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "long_words": "word_chars > 14 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "some_repeated_words": "100 * n_repeat_words > 20 * n_words",
}
#: Versions of the policy; a document is kept if it fails none of the rules.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols"),
    "v2": ("few_words", "repeated_words", "symbols", "long_words", "short_words"),
    "strict": tuple(RULES),
}


def repeated_words(words: Column) -> Column:
    """Number of words of the array inside 3-word windows that occur at least twice.

    Windows are sorted with their places; equal neighbours repeat. Their places, in
    order, cover three words each, less what the next one covers too.
    """
    last = F.size(words) - 3
    windows = F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(
                F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias(
                    "window"
                ),
                i.alias("place"),
            ),
        ),
    )

    def repeats(ordered: Column) -> Column:
        def same(i: Column, step: int) -> Column:
            window = F.get(ordered, i)["window"]
            return F.coalesce(F.get(ordered, i + step)["window"] == window, F.lit(False))

        marked = F.filter(
            F.transform(
                ordered, lambda w, i: F.when(same(i, -1) | same(i, 1), w["place"])
            ),
            lambda place: place.isNotNull(),
        )
        return F.sort_array(marked)

    def covered(places: Column) -> Column:
        reach = F.transform(
            places, lambda p, i: F.least(F.coalesce(F.get(places, i + 1) - p, F.lit(3)), F.lit(3))
        )
        return F.aggregate(reach, F.lit(0), lambda total, n: total + n)

    bound = F.transform(F.array(F.sort_array(windows)), repeats)
    return F.coalesce(F.get(F.transform(bound, covered), F.lit(0)), F.lit(0)).cast("long")


def measured(docs: DataFrame, text: str) -> DataFrame:
    """``doc`` (the row as a struct) and the measurements of its whole text."""
    whole = F.coalesce(F.col(f"doc.{text}"), F.lit(""))
    parts = docs.select(F.struct("*").alias("doc")).select(
        "doc",
        whole.alias("whole"),
        F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split(whole, "\n", -1), lambda line: F.rlike(line, F.lit(WORD))).alias("lines"),
    )
    return parts.select(
        "doc",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("whole") - F.length(F.regexp_replace("whole", SYMBOLS, "")))
        .cast("long")
        .alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )


def mask(rules: tuple[str, ...]) -> int:
    order = list(RULES)
    return sum(1 << order.index(rule) for rule in rules)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc`` (the row as a struct), the measurements, and ``failed``: one bit per rule.

    One row for each row of ``docs``, repeated rows included; needs no shuffle. Null and
    empty texts measure 0 everywhere.
    """
    bits = [
        F.when(F.expr(failed), F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long"))
        for bit, failed in enumerate(RULES.values())
    ]
    return measured(docs, text).withColumn("failed", reduce(lambda a, b: a.bitwiseOR(b), bits))


def fails(failed: Column, rules: tuple[str, ...]) -> Column:
    return failed.bitwiseAND(F.lit(mask(rules)).cast("long")) != 0


def verdicts(
    kept_ledger: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES
) -> DataFrame:
    """The ledger with a column ``kept_<version>`` for each policy."""
    return kept_ledger.withColumns(
        {f"kept_{name}": ~fails(F.col("failed"), rules) for name, rules in policies.items()}
    )


def ablations(
    kept_ledger: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES
) -> DataFrame:
    """What each rule does in each policy: ``policy``, ``rule``, ``n_docs``, ``n_kept``,
    ``n_failing`` (the rule), ``n_only`` (documents that the policy loses by this rule
    alone, so what leaving it out would win back).

    The ledger shrinks to a count for each combination of bits first.
    """
    counts = kept_ledger.groupBy("failed").agg(F.count("*").alias("n"))
    cases = F.array(
        *[
            F.struct(
                F.lit(name).alias("policy"),
                F.lit(rule).alias("rule"),
                F.lit(mask(rules)).cast("long").alias("policy_mask"),
                F.lit(mask((rule,))).cast("long").alias("rule_mask"),
            )
            for name, rules in policies.items()
            for rule in rules
        ]
    )
    spread = counts.select("failed", "n", F.explode(cases).alias("case")).select(
        "failed", "n", "case.*"
    )
    within = F.col("failed").bitwiseAND(F.col("policy_mask"))

    def counted(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return spread.groupBy("policy", "rule").agg(
        F.sum("n").alias("n_docs"),
        counted(within == 0).alias("n_kept"),
        counted(within.bitwiseAND(F.col("rule_mask")) != 0).alias("n_failing"),
        counted(within == F.col("rule_mask")).alias("n_only"),
    )
