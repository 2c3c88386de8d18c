"""Quality rules in a ledger: every rule once, failures as bits, policies and ablations by bit arithmetic.

Built-in expressions only. ``ledger`` measures each text and stores one bit per failed rule; a policy is
a versioned set of rules, applied to the stored bits without reading a text again, and ``ablation``
counts for each rule what it removes, and what it alone removes, from the bits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.common import set_aside, unused

#: Rules in the order of their bits: name, condition on the measurements under which a text fails.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 14 * n_words"),
    ("shouting", "10 * n_shouts > 3 * n_words"),
    ("one_word", "n_words > 20 and 5 * n_distinct_words < n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A version and the rules it applies."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {name: 1 << i for i, (name, _) in enumerate(RULES)}
        return sum(bits[r] for r in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_windows"))
POLICIES = (BASE, Policy("web-1", tuple(name for name, _ in RULES)), Policy("lenient-1", ("few_words", "repeated_windows", "symbols")))


def words_of(text: Column) -> Column:
    """Runs of anything but the six ASCII white-space bytes."""
    return F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " "), "")


def shingle_hashes(words: Column, k: int) -> Column:
    """xxhash64 of each k words in a row; ``words`` must be a stored column."""
    starts = F.slice(words, 1, F.greatest(F.size(words) - (k - 1), F.lit(0)))
    return F.transform(starts, lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, k)]))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_shouts", "n_lines", "n_dup_lines", "n_distinct_words", "n_repeat_words")


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the measurements to ``docs``; a column of its own with a measurement's name is kept with ``_in`` after the name."""
    docs, (text_col,) = set_aside(docs, (*MEASURES, "failures"), text_col)
    name = unused(*docs.columns)
    words_, lines_, hashes_, sorted_, places_ = map(name, ("_words", "_lines", "_hashes", "_sorted", "_places"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0)
    out = docs.withColumns({words_: words_of(text), lines_: lines})
    out = out.withColumns({
        "n_words": F.size(words_).cast("long"),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
        "n_shouts": ((F.length(text) - F.length(F.replace(text, F.lit("!!"), F.lit("")))) / 2).cast("long"),
        "n_lines": F.size(lines_).cast("long"),
        "n_dup_lines": (F.size(lines_) - F.size(F.array_distinct(lines_))).cast("long"),
        "n_distinct_words": F.size(F.array_distinct(words_)).cast("long"),
        hashes_: shingle_hashes(F.col(words_), 5),
    }).drop(words_, lines_)
    # Most texts repeat no window: only those that do are sorted.
    again = F.size(F.array_distinct(hashes_)) < F.size(hashes_)
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    out = out.withColumn(sorted_, F.when(again, F.sort_array(F.transform(hashes_, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(empty)).drop(hashes_)
    s = F.col(sorted_)
    twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
    out = out.withColumn(places_, F.sort_array(F.transform(twice, lambda x: x["i"]))).drop(sorted_)
    p = F.col(places_)
    covered = F.aggregate(F.transform(p, lambda a, i: F.coalesce(F.least(F.get(p, i + 1) - a, F.lit(5)), F.lit(5))), F.lit(0), lambda x, y: x + y)
    return out.withColumn("n_repeat_words", covered.cast("long")).drop(places_)


def ledger(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with measurements and ``failures``, one bit per rule of RULES.

    Null and empty texts have no words, so few_words fails and ratios do not. Windows are compared by
    64-bit hashes within a text. Rows that repeat are judged alike; null ids need no care; no rows give no rows. Columns of
    ``docs`` survive, see ``measured``.
    """
    bits = [F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, condition) in enumerate(RULES)]
    out = measured(docs, text_col)
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return out.withColumn("failures", total.cast("long"))


def kept_by(policy: Policy, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(policy.mask) == 0


def ablation(stored: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of a policy, from stored bits: rows that fail it, and rows that fail nothing else of the policy."""
    own = F.col("failures").bitwiseAND(policy.mask)
    sums = [F.sum(F.when(own.bitwiseAND(1 << i) != 0, 1).otherwise(0)).alias(f"f{i}") for i in range(len(RULES))]
    alone = [F.sum(F.when(own == (1 << i), 1).otherwise(0)).alias(f"a{i}") for i in range(len(RULES))]
    row = stored.agg(*sums, *alone, F.bit_or(own).alias("_any"))
    each = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"f{i}").alias("n_failed"), F.col(f"a{i}").alias("n_alone")) for i, (name, _) in enumerate(RULES) if name in policy.rules])
    return row.select(F.explode(each).alias("x")).select(F.lit(policy.version).alias("policy"), "x.*")


def ablations(stored: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """For each rule of each policy, in one pass over stored bits: rows that fail it, that fail nothing else of the policy, and that the policy keeps with the rule and without.

    The ledger is counted by its bits first, one row for each set of failures that occurs. No rows give no rows.
    """
    patterns = stored.groupBy("failures").agg(F.count("*").alias("_n"))
    rules = F.array(*[F.struct(F.lit(p.version).alias("policy"), F.lit(p.mask).alias("_mask"), F.lit(name).alias("rule"), F.lit(1 << i).alias("_bit")) for p in policies for i, (name, _) in enumerate(RULES) if name in p.rules])
    own, bit = F.col("failures").bitwiseAND(F.col("_mask")), F.col("_bit")
    rows = lambda test: F.coalesce(F.sum(F.when(test, F.col("_n"))), F.lit(0))
    each = patterns.select("failures", "_n", F.inline(rules)).groupBy("policy", "rule")
    return each.agg(rows(own.bitwiseAND(bit) != 0).alias("n_failed"), rows(own == bit).alias("n_alone"), rows(own == 0).alias("n_kept"), rows((own == 0) | (own == bit)).alias("n_kept_without"))
