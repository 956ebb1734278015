"""Quality rules kept as a bitmask ledger.

Every rule is evaluated once per document. The ledger stores the measurements and one bit per
failed rule; a policy is a named, versioned mask over those bits, so changing a policy or asking
what a rule costs never reads a text again.

Defined cases: a NULL or empty text has no words and zero in every measure, so it fails ``few_words``
only. Rows are judged one by one: repeated rows, equal ids and NULL ids stay, each with its own
verdict. Columns of the input other than the two named ones are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.texts import GAP, let, words

SYMBOLS = "[#*$%&|<>]+"
WINDOW = 3
MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_shouts",
]

def _rules() -> dict[str, Column]:
    c = F.col
    return {
        "few_words": c("n_words") < 50,
        "repeated_windows": 100 * c("n_repeat_words") > 50 * c("n_words"),
        "symbols": 10 * c("n_symbols") > c("n_words"),
        "upper_case": (c("n_upper") > c("n_lower")) & (c("n_upper") >= 20),
        "shouting": 10 * c("n_shouts") > c("n_words"),
        "duplicate_lines": (100 * c("n_dup_lines") > 50 * c("n_lines")) & (c("n_lines") >= 4),
        "word_length": (c("word_chars") > 20 * c("n_words")) | (c("word_chars") < 2 * c("n_words")),
    }


# Bit number = place in this list; append only, so that stored ledgers keep their meaning.
RULE_NAMES = [
    "few_words", "repeated_windows", "symbols", "upper_case", "shouting", "duplicate_lines", "word_length",
]


@dataclass(frozen=True)
class Policy:
    """A document passes when none of ``rejects`` failed and at most ``tolerates`` of ``counts`` did."""

    version: str
    rejects: tuple[str, ...]
    counts: tuple[str, ...] = ()
    tolerates: int = 0

    def passes(self, bits: Column) -> Column:
        hard = bits.bitwiseAND(F.lit(mask(self.rejects))) == 0
        return hard & (F.bit_count(bits.bitwiseAND(F.lit(mask(self.counts)))) <= self.tolerates)


def mask(names: tuple[str, ...] | list[str]) -> int:
    return sum(1 << RULE_NAMES.index(name) for name in set(names))


BASE = Policy("base", ("few_words", "repeated_windows"))
STRICT = Policy("strict-1", tuple(RULE_NAMES))
POLICIES = {policy.version: policy for policy in (BASE, STRICT)}


def _without(text: Column, pattern: str) -> Column:
    """Characters of the text that the pattern takes."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def _repeated(found: Column) -> Column:
    """Words inside windows that occur at least twice in the text.

    Windows are compared by 64-bit hashes within one text. Sorted hashes tell whether any is found
    twice; only then are they sorted together with their places, so that equal ones are neighbours,
    and the places of the repeated ones laid side by side, overlaps counted once.
    """
    starts = F.sequence(F.lit(0), F.size(found) - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(WINDOW)]))

    def any_twice(ordered: Column) -> Column:
        return F.size(F.filter(ordered, lambda h, k: F.coalesce(h == F.get(ordered, k - 1), F.lit(False)))) > 0

    def places(ordered: Column) -> Column:
        def again(gram: Column, k: Column) -> Column:
            before, after = F.get(ordered, k - 1)["h"], F.get(ordered, k + 1)["h"]
            return F.coalesce(gram["h"] == before, F.lit(False)) | F.coalesce(gram["h"] == after, F.lit(False))

        return F.sort_array(F.transform(F.filter(ordered, again), lambda gram: gram["i"]))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    def counted(all_hashes: Column) -> Column:
        placed = F.transform(all_hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        twice = let(F.sort_array(all_hashes), any_twice)
        return F.when(twice, let(F.sort_array(placed), lambda ordered: let(places(ordered), covered))).otherwise(none)

    none = F.lit(0).cast("long")
    return F.when(F.size(found) > WINDOW, let(hashes, counted)).otherwise(none)


def _measures(text: Column) -> Column:
    def of_words(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("long").alias("n_words"),
            F.length(F.array_join(found, "")).cast("long").alias("word_chars"),
            _repeated(found).alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        distinct = F.size(F.array_distinct(lines))
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - distinct).cast("long").alias("n_dup_lines")
        )

    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return F.struct(
        let(words(text), of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        F.struct(
            _without(text, SYMBOLS).alias("n_symbols"),
            _without(text, r"\p{Lu}+").alias("n_upper"),
            _without(text, r"\p{Ll}+").alias("n_lower"),
            _without(text, "!+").alias("n_shouts"),
        ).alias("c"),
    )


def _measured(docs: DataFrame, text: str, *carried: Column) -> DataFrame:
    """``carried`` columns, the measurements and ``fail_bits``.

    A generated row is a border no projection is merged across, so the text is measured once.
    """
    measured = F.inline(F.array(_measures(F.coalesce(F.col(text), F.lit("")))))
    found = docs.select(F.struct(*carried).alias("_row"), measured).select("_row", "w.*", "l.*", "c.*")
    rules = _rules()
    failed = [F.when(rules[name], F.lit(1 << bit)).otherwise(F.lit(0)) for bit, name in enumerate(RULE_NAMES)]
    return found.select("_row", *MEASURES, reduce(add, failed).cast("long").alias("fail_bits"))


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the measurements and ``fail_bits``; one map pass in the JVM, no shuffle."""
    found = _measured(docs, text, F.col(key).alias("_key"))
    return found.select(F.col("_row._key").alias(key), *MEASURES, "fail_bits")


def passing(docs: DataFrame, policy: Policy, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the policy passes, their columns as they were."""
    found = _measured(docs, text, *[F.col(f"`{c}`") for c in docs.columns])
    return found.where(policy.passes(F.col("fail_bits"))).select("_row.*")


def judge(ledger_table: DataFrame, policy: Policy, column: str = "kept") -> DataFrame:
    """The ledger with the verdict of one policy; reads bits only."""
    return ledger_table.withColumn(column, policy.passes(F.col("fail_bits")))


def ablations(ledger_table: DataFrame, policies: list[Policy]) -> DataFrame:
    """Per policy and rule: documents that failed it, that failed nothing else, and that the policy rejects.

    The ledger is first counted by its bits (at most 2 ** rules groups), the rest works on those counts.
    """
    counts = ledger_table.groupBy("fail_bits").agg(F.count("*").alias("n"))
    ruled = [
        (policy, name) for policy in policies for name in RULE_NAMES if name in policy.rejects or name in policy.counts
    ]
    rows = F.array(*[
        F.struct(
            F.lit(policy.version).alias("policy"), F.lit(name).alias("rule"), F.lit(mask([name])).alias("bit"),
            (~policy.passes(F.col("fail_bits"))).alias("rejected"),
            (~policy.passes(F.col("fail_bits").bitwiseAND(F.lit(~mask([name]))))).alias("still_rejected"),
        )
        for policy, name in ruled
    ])
    cells = counts.select("fail_bits", "n", F.explode(rows).alias("c")).select("fail_bits", "n", "c.*")
    failed = F.col("fail_bits").bitwiseAND(F.col("bit")) != 0

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    return cells.groupBy("policy", "rule").agg(
        total(failed).alias("n_failed"),
        total(F.col("rejected") & ~F.col("still_rejected")).alias("n_saved_without"),
        total(F.col("rejected")).alias("n_rejected"),
    )
