"""Rule bitmask ledger: every rule is evaluated once, policies are masks over the stored bits.

A ledger holds, per document, the measurements and one bit per failed rule. A policy is a mask of
the rules that reject; applying one, or asking what it would keep without one of its rules, reads
the bits only and never the text again.

Defined cases: a null or blank text has no words, so every count is 0 and rule ``few_words`` fails.
Repeated rows are judged each on its own. An empty table gives an empty ledger. Other columns of the
input are carried along; a column called like the ledger is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import SPACE_RUN, free_name, let, words_of

SYMBOLS = r"[#*$%&|<>]"

# Rule name -> condition over the measurements. The position in this list is the rule's bit.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "20 * n_symbols > word_chars"),
    ("duplicate_lines", "2 * n_dup_lines > n_lines"),
    ("capitals", "2 * n_capitals > word_chars"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("exclamations", "5 * n_exclamations > n_words"),
]
BITS = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A versioned choice of the rules that reject a document."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[r] for r in set(self.rules))


BASE = Policy("base", ("few_words", "repeated_windows"))
STRICT = Policy("strict-1", tuple(BITS))


def repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text, the first one included.

    Each window becomes one long: the high bits of its hash above its position. Sorted, equal windows
    are neighbours, which the whole 64-bit hashes confirm; the covered words follow from the gaps
    between the repeated positions. Linear memory, one sort per document, no shuffle.
    """

    def covered(starts: Column) -> Column:
        reach = F.transform(starts, lambda s, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - s, F.lit(3))))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x)

    def starts(hashes: Column, low: Column) -> Column:
        keys = F.sort_array(F.transform(hashes, lambda h, i: h.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))))

        def repeated(keys: Column) -> Column:
            def same(a: Column, b: Column) -> Column:
                at = lambda k: F.get(hashes, k.bitwiseAND(low).cast("int"))
                return F.coalesce(at(a) == at(b), F.lit(False))

            kept = F.filter(keys, lambda k, i: same(k, F.get(keys, i - 1)) | same(k, F.get(keys, i + 1)))
            return F.sort_array(F.transform(kept, lambda k: k.bitwiseAND(low)))

        return let(keys, repeated)

    def windows(w: Column) -> Column:
        return F.transform(F.slice(w, F.lit(1), F.size(w) - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    # All-one bits, as many as the positions need.
    low = lambda w: F.expr("bigint(1)").cast("long") * F.pow(F.lit(2), F.length(F.bin(F.size(w)))).cast("long") - 1
    return let(
        words,
        lambda w: F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(
            let(windows(w), lambda h: let(low(w), lambda m: let(starts(h, m), covered)))
        ),
    )


def measurements(text: Column) -> Column:
    """All measurements of one text as a struct of longs."""
    plain = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(plain, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    line_counts = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
    word_counts = let(
        words_of(plain), lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("r"))
    )
    return let(
        F.struct(line_counts.alias("l"), word_counts.alias("w"), plain.alias("t")),
        lambda s: F.struct(
            s["w"]["n"].cast("long").alias("n_words"),
            F.length(F.regexp_replace(s["t"], SPACE_RUN, "")).cast("long").alias("word_chars"),
            F.regexp_count(s["t"], F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            s["l"]["n"].cast("long").alias("n_lines"),
            (s["l"]["n"] - s["l"]["d"]).cast("long").alias("n_dup_lines"),
            s["w"]["r"].alias("n_repeat_words"),
            F.regexp_count(s["t"], F.lit("[A-Z]")).cast("long").alias("n_capitals"),
            F.regexp_count(s["t"], F.lit("!!")).cast("long").alias("n_exclamations"),
        ),
    )


def ledger(docs: DataFrame, text: str = "text", out: str = "ledger") -> DataFrame:
    """``docs`` with a struct column: the measurements and ``failed``, the bits of the failed rules."""
    made = free_name(docs, "measured")
    bits = [
        F.when(F.expr(_over(condition, made)), F.lit(BITS[name]).cast("long")).otherwise(F.lit(0).cast("long"))
        for name, condition in RULES
    ]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return (
        docs.withColumn(made, measurements(F.col(text)))
        .withColumn(out, F.struct(F.col(f"{made}.*"), total.alias("failed")))
        .drop(made)
    )


def _over(condition: str, column: str) -> str:
    return " ".join(f"{column}.{w}" if w.startswith(("n_", "word_")) else w for w in condition.split())


def passes(failed: Column, policy: Policy) -> Column:
    """True where none of the policy's rules failed."""
    return failed.bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def apply_policy(book: DataFrame, policy: Policy, out: str = "ledger") -> DataFrame:
    """The rows of a ledger that the policy keeps."""
    return book.where(passes(F.col(f"{out}.failed"), policy))


def ablations(book: DataFrame, policies: list[Policy], out: str = "ledger") -> DataFrame:
    """Per policy and rule: documents failing the rule, failing it alone, and kept without it.

    One aggregation to at most ``2 ** len(RULES)`` distinct bit patterns; the rest is bit arithmetic
    on those.
    """
    patterns = book.groupBy(F.col(f"{out}.failed").alias("failed")).agg(F.count("*").alias("n"))
    cases = [(p.version, r, BITS[r], p.mask) for p in policies for r in p.rules]
    rules = book.sparkSession.createDataFrame(cases, "version string, rule string, bit long, mask long")
    hit = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0)).alias
    failed, bit, mask = F.col("failed"), F.col("bit"), F.col("mask")
    own = failed.bitwiseAND(mask)
    return (
        patterns.join(F.broadcast(rules), F.lit(True))
        .groupBy("version", "rule")
        .agg(
            hit(failed.bitwiseAND(bit) != 0)("n_failed"),
            hit(own == bit)("n_failed_alone"),
            hit(own == 0)("n_kept"),
            hit(own.bitwiseAND(F.bitwise_not(bit)) == 0)("n_kept_without"),
        )
    )
