"""Quality rules as a ledger: measured once per text, one failure bit per rule, judged by versioned policies.

Everything is built from DataFrame functions. The ledger (measurements and ``failed_bits``) can be stored; policies and
ablations then never touch the texts again.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cohortflow.llm.text import SPACE_CLASS, SPACES

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bangs")


def _measured(docs: DataFrame, text: str) -> DataFrame:
    """All columns but the text, and the measurements. Each list is a column of its own, so that no lambda recomputes it."""
    taken = {text, "failed_bits", *MEASURES}
    rest = [F.col(c) for c in docs.columns if c not in taken]
    whole = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(whole, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    rows = docs.select(F.struct(*rest).alias("_rest"), whole.alias("_text"), words.alias("_words"), lines.alias("_lines"))
    n_words = F.size("_words")
    last = n_words - 3
    # a long per 3-word window next to its place; windows of the same words become neighbours
    places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    window = F.transform(
        places,
        lambda i: F.struct(
            F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("i")
        ),
    )
    rows = rows.select(
        "_rest",
        n_words.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.regexp_count("_text", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count("_text", F.lit("!!")).cast("long").alias("n_bangs"),
        F.sort_array(window).alias("_windows"),
    )

    def same(x: Column, other: Column) -> Column:
        return x["h"].eqNullSafe(F.get("_windows", other)["h"])

    repeated = F.filter("_windows", lambda x, i: same(x, i - 1) | same(x, i + 1))
    rows = rows.withColumn("_starts", F.sort_array(F.transform(repeated, lambda x: x["i"]))).drop("_windows")
    covered = F.transform(
        "_starts", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_starts", i + 1) - p, F.lit(3))).cast("long")
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.withColumn("n_repeat_words", total).select(*[F.col("_rest")[c].alias(c) for c in docs.columns if c not in taken], *MEASURES)


@dataclass(frozen=True)
class Rule:
    name: str
    #: True where the row fails.
    fails: str


#: The order gives each rule its bit; add new rules at the end, never reuse a bit.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", "n_lines >= 4 AND 10 * n_dup_lines > 3 * n_lines"),
    Rule("shouting", "2 * n_upper > word_chars"),
    Rule("exclamations", "10 * n_bangs > 3 * n_words"),
    Rule("many_words", "n_words > 1000000"),
)
BITS = {rule.name: 1 << at for at, rule in enumerate(RULES)}
BASE = ("few_words", "repeated_windows")
#: Policy version -> the rules that reject. A stored ledger can be judged by any of them.
POLICIES: Mapping[str, tuple[str, ...]] = {
    "1": BASE,
    "2": (*BASE, "short_words", "long_words", "symbols", "duplicate_lines", "shouting", "exclamations"),
}
CURRENT = "2"


def mask_of(rules: tuple[str, ...]) -> int:
    return sum(BITS[r] for r in rules)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row's other columns, its measurements and ``failed_bits``: each rule evaluated once.

    Null and empty texts have no words: they fail ``few_words`` and nothing else. Repeated rows stay. Columns of ``docs``
    named like a measurement are replaced by it.
    """
    bits = [F.when(F.expr(r.fails), F.lit(BITS[r.name])).otherwise(F.lit(0)).cast("long") for r in RULES]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return _measured(docs, text).withColumn("failed_bits", total)


def fails_any(mask: int, bits: str = "failed_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(mask).cast("long")) != 0


def apply_policy(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """The ledger's rows with ``kept`` under a policy version."""
    return rows.withColumn("kept", ~fails_any(mask_of(POLICIES[version])))


def ablation(rows: DataFrame) -> DataFrame:
    """policy, rule, rows, rejected, fails, only_this: what each rule adds to each policy.

    Equal bit sets are counted first, so the rest works on at most one row per combination of rules.
    """
    combos = rows.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    judged = [
        F.struct(F.lit(v).alias("policy"), F.lit(r).alias("rule"), F.lit(mask_of(names)).cast("long").alias("mask"), F.lit(BITS[r]).cast("long").alias("bit"))
        for v, names in POLICIES.items()
        for r in names
    ]
    wide = combos.select("failed_bits", "n", F.explode(F.array(*judged)).alias("p")).select("failed_bits", "n", "p.*")
    hit = F.col("failed_bits").bitwiseAND(F.col("mask"))
    count = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")
    return wide.groupBy("policy", "rule").agg(
        F.sum("n").alias("rows"),
        count(hit != 0).alias("rejected"),
        count(F.col("failed_bits").bitwiseAND(F.col("bit")) != 0).alias("fails"),
        count(hit == F.col("bit")).alias("only_this"),
    )


def keep_good(docs: DataFrame, version: str = CURRENT, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that the policy keeps.

    The verdict turns a row into a list of one or none. A plain filter would be pushed below the measurements, and every step of
    their lambdas would then measure anew; store a ledger before filtering it.
    """
    packed = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("text"))
    judged = apply_policy(ledger(packed), version)
    return judged.select(F.inline(F.when(F.col("kept"), F.array("_row"))))
