"""Quality rules as a ledger of bits, and policies over it.

Every rule is evaluated once per text. A ledger row keeps the measurements and one
integer with a bit for each rule that failed; a policy is a set of bits, so that another
policy, or a policy without one of its rules, needs no second look at a text.

A null text has no words. Very long texts are measured whole, within their row; nothing
here shuffles but the totals of :func:`ablation`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sequon.llm.common import GAP, let

#: Rule to condition over the measurements; its place is its bit. Append only.
RULES = {
    "few_words": lambda m: m.n_words < 50,
    "repeated_words": lambda m: 100 * m.n_repeat_words > 50 * m.n_words,
    "symbols": lambda m: 100 * m.n_symbols > 30 * m.n_words,
    "repeated_lines": lambda m: 100 * m.n_dup_lines > 50 * m.n_lines,
    "long_words": lambda m: m.word_chars > 20 * m.n_words,
}
#: Version to the rules it enforces.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines", "long_words"),
}


def mask(policy: str, without: str | None = None) -> int:
    """The bits a policy enforces, less those of one rule."""
    order = list(RULES)
    return sum(1 << order.index(rule) for rule in POLICIES[policy] if rule != without)


def _windows(words: Column) -> Column:
    whole = F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    return F.transform(
        whole,
        lambda x, i: F.struct(
            F.concat_ws(" ", x, F.get(words, i + 1), F.get(words, i + 2)).alias("text"),
            i.alias("at"),
        ),
    )


def _repeated(words: Column) -> Column:
    """Words in a three-word window that the text has twice or more."""

    def count(by_text: Column) -> Column:
        # Equal windows are neighbours once sorted; the sort keeps this n log n.
        same = F.transform(
            by_text,
            lambda x, i: F.when(
                F.coalesce(F.get(by_text, i - 1)["text"] == x["text"], F.lit(False))
                | F.coalesce(F.get(by_text, i + 1)["text"] == x["text"], F.lit(False)),
                x["at"],
            ),
        )
        starts = F.filter(same, lambda at: at.isNotNull())
        covered = F.flatten(F.transform(starts, lambda at: F.array(at, at + 1, at + 2)))
        return F.size(F.array_distinct(covered))

    return let(F.array_sort(_windows(words)), count)


def measures(text: Column) -> Column:
    """All measurements of a text as one struct of longs."""

    def of_lines(whole: Column, words: Column) -> Column:
        lines = F.filter(F.split(whole, "\n"), lambda x: F.regexp_replace(x, GAP, "") != "")
        return let(
            lines,
            lambda own: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.char_length(F.regexp_replace(whole, GAP, "")).cast("long").alias("word_chars"),
                F.char_length(F.regexp_replace(whole, r"[^#*$%&|<>]", ""))
                .cast("long")
                .alias("n_symbols"),
                F.size(own).cast("long").alias("n_lines"),
                (F.size(own) - F.size(F.array_distinct(own))).cast("long").alias("n_dup_lines"),
                _repeated(words).cast("long").alias("n_repeat_words"),
            ),
        )

    def of_words(whole: Column) -> Column:
        words = F.filter(F.split(whole, GAP), lambda x: x != "")
        return let(words, lambda own: of_lines(whole, own))

    return let(F.coalesce(text, F.lit("")), of_words)


class _Fields:
    def __init__(self, struct: Column):
        self._struct = struct

    def __getattr__(self, name: str) -> Column:
        return self._struct[name]


def failures(measured: Column) -> Column:
    """One bit per rule that fails."""
    bits = (
        F.when(rule(_Fields(measured)), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
        for i, rule in enumerate(RULES.values())
    )
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def passes(failed: Column, policy: str, without: str | None = None) -> Column:
    return failed.bitwiseAND(F.lit(mask(policy, without))) == 0


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the measurements and ``failed`` for every row; other columns are left out."""
    measured = docs.select(F.col(doc_id).alias("doc_id"), measures(F.col(text)).alias("m"))
    return measured.select("doc_id", "m.*", failures(F.col("m")).alias("failed"))


def keep(docs: DataFrame, policy: str, text: str = "text") -> DataFrame:
    """The rows that pass a policy, with all their columns."""
    return docs.where(let(measures(F.col(text)), lambda m: passes(failures(m), policy)))


def ablation(ledger: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: rows that fail it, and rows that only this rule rejects."""
    bits = {rule: mask(policy) - mask(policy, rule) for rule in POLICIES[policy]}
    own = F.col("failed").bitwiseAND(F.lit(mask(policy)))
    total = ledger.select(own.alias("own")).agg(
        F.array(
            *(
                F.struct(
                    F.lit(rule).alias("rule"),
                    F.count_if(F.col("own").bitwiseAND(F.lit(bit)) != 0).alias("n_failed"),
                    F.count_if(F.col("own") == bit).alias("n_only"),
                )
                for rule, bit in bits.items()
            )
        ).alias("rules")
    )
    return total.select(F.inline("rules"))
