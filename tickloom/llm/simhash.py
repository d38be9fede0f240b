"""SimHash near-duplicates by the generalised pigeonhole principle.

Each text becomes a 64-bit fingerprint. The 64 bits are cut into partitions, and partition i gets a
threshold T_i >= -1 with sum(T_i + 1) = max_bits + 1: two fingerprints within ``max_bits`` then agree
in some partition up to T_i bits, whatever the cut and the thresholds. Correlated bits go into one
partition, since such a partition separates little and can then be left out (T_i = -1), and the
thresholds come from dynamic programming over estimated candidate counts. Probing looks a fingerprint
up under every value within T_i bits of its own; each candidate pair is verified on all 64 bits.

The plan decides the cost only, never the result, so it may rest on a bounded sample. Equal
fingerprints are one row throughout, so copies never make pairs. Buckets of more than ``HOT`` different
fingerprints are cut again on the bits outside their key, by the same principle with what is left of
the threshold, so that a crowded bucket does not emit all its pairs.

Components come from alternating star steps over tables in the shared folder.

Defined cases: a text without words, and null, has fingerprint 0 and links like any other; fewer words
than a shingle are one shingle; null ids do not name a component unless all its ids are null; repeated
rows share fingerprint and component; an empty table gives an empty table.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, small_batches, stored

BITS = 64
WORDS = 3  # per shingle
MAX_BITS = 2
SEED = 42
SAMPLE = 20_000  # fingerprints that the plan may rest on, at most
HOT = 64  # different fingerprints in a bucket, from which on it is cut again


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Majority of the shingle hashes, bit by bit, as an unsigned integer."""
    # bytes.lower() changes A-Z only and bytes.split() splits at the white space of the contract.
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = memoryview(b" ".join(tokens))
    ends = list(itertools.accumulate((len(t) + 1 for t in tokens)))
    starts = [0, *ends[:-1]]
    last = max(len(tokens) - words, 0)
    spans = zip(starts[: last + 1], ends[min(words, len(tokens)) - 1 :], strict=False)
    hash_of = xxhash.xxh64_intdigest
    hashes = np.fromiter((hash_of(joined[a : b - 1], SEED) for a, b in spans), np.uint64, last + 1)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * counts > len(hashes)).tolist())


def fingerprints(docs: DataFrame, text: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id, text_hash, fp: the fingerprint's bits as a signed long."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, words) for t in batch], np.uint64).astype(np.int64))

    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), of(F.col(text)).alias("fp"))


@dataclass(frozen=True)
class Plan:
    """Partitions (bit numbers) and their thresholds."""

    parts: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]


def group_bits(sample: np.ndarray, m: int) -> tuple[tuple[int, ...], ...]:
    """Cut the bits into ``m`` partitions, correlated bits together: greedy, from the strongest pair."""
    bits = np.unpackbits(sample.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    x = bits - bits.mean(axis=0)
    scale = np.sqrt((x * x).sum(axis=0)) + 1e-9
    tie = np.abs((x / scale).T @ (x / scale))
    np.fill_diagonal(tie, 0)
    left, parts = set(range(BITS)), []
    for i in range(m):
        width = len(left) // (m - i)
        rest = sorted(left)
        a, b = np.unravel_index(np.argmax(tie[np.ix_(rest, rest)]), (len(rest), len(rest)))
        part = list(dict.fromkeys([rest[a], rest[b]]))[:width]
        while len(part) < width:
            others = [b for b in rest if b not in part]
            part.append(others[int(np.argmax(tie[np.ix_(others, part)].sum(axis=1)))])
        left -= set(part)
        parts.append(tuple(sorted(part)))
    return tuple(parts)


def estimate(sample: np.ndarray, part: tuple[int, ...], threshold: int, total: int) -> float:
    """Estimated cost of probing one partition: candidate pairs among ``total`` fingerprints, plus probes."""
    if threshold < 0:
        return 0.0
    mask = np.uint64(sum(1 << b for b in part))
    values, counts = np.unique(sample & mask, return_counts=True)
    pairs = float((counts.astype(float) * (counts - 1)).sum()) / 2
    for r in range(1, threshold + 1):
        for flips in itertools.combinations(part, r):
            moved = values ^ np.uint64(sum(1 << b for b in flips))
            at = np.minimum(np.searchsorted(values, moved), len(values) - 1)
            pairs += float((counts * np.where(values[at] == moved, counts[at], 0)).sum()) / 2
    ball = sum(math.comb(len(part), r) for r in range(threshold + 1))
    chance = ball * float(total) ** 2 / 2 / 2.0 ** len(part)  # pairs that a small sample can't show
    return max(pairs * (total / max(len(sample), 1)) ** 2, chance) + 2.0 * ball * total


def allocate(costs: list[list[float]], units: int) -> tuple[float, tuple[int, ...]]:
    """Cheapest thresholds with sum(T_i + 1) = units; costs[i][u] is the cost of T_i = u - 1."""
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for row in costs:
        step: dict[int, tuple[float, tuple[int, ...]]] = {}
        for used, (cost, chosen) in best.items():
            for u in range(units - used + 1):
                new = (cost + row[u], (*chosen, u - 1))
                if used + u not in step or new < step[used + u]:
                    step[used + u] = new
        best = step
    return best[units]


def make_plan(sample: np.ndarray, total: int, max_bits: int = MAX_BITS) -> Plan:
    """The cheapest cut into 2 to ``max_bits + 2`` partitions with its thresholds."""
    if len(sample) == 0:
        sample = np.zeros(1, np.uint64)
    plans = []
    for m in range(2, max_bits + 3):
        parts = group_bits(sample, m)
        # Radius 2 in a third of the bits means hundreds of probes per fingerprint; sampled coarsely.
        coarse = sample[: max(1, len(sample) // 20)]
        costs = [[estimate(coarse if t > 1 else sample, p, t, total) for t in range(-1, max_bits + 1)] for p in parts]
        cost, thresholds = allocate(costs, max_bits + 1)
        plans.append((cost, m, Plan(parts, thresholds)))
    return min(plans, key=lambda x: x[:2])[2]


def _mask(part: tuple[int, ...]) -> int:
    value = sum(1 << b for b in part)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _signed(value: int) -> Column:
    return F.lit(value - (1 << BITS) if value >> (BITS - 1) else value).cast("long")


def _flips(part: tuple[int, ...], radius: int) -> Column:
    values = [sum(1 << b for b in c) for r in range(radius + 1) for c in itertools.combinations(part, r)]
    return F.array(*[_signed(v) for v in values])


def _thirds(part: tuple[int, ...], max_bits: int) -> list[int]:
    """Masks that cut the bits outside a partition into ``max_bits + 1`` pieces."""
    outside = [b for b in range(BITS) if b not in part]
    return [_mask(tuple(outside[i :: max_bits + 1])) for i in range(max_bits + 1)]


def links(distinct: DataFrame, plan: Plan, max_bits: int = MAX_BITS) -> DataFrame:
    """a, b: every pair of different fingerprints within ``max_bits``, a < b, once.

    ``distinct`` has one row per fingerprint in ``fp`` and should be a stored table.
    """
    found = []
    for part, radius in zip(plan.parts, plan.thresholds, strict=True):
        if radius < 0:
            continue
        mask = F.lit(_mask(part)).cast("long")
        data = distinct.select(F.col("fp").alias("b"), F.col("fp").bitwiseAND(mask).alias("key"))
        asked = distinct.select(F.col("fp").alias("a"), F.col("fp").bitwiseAND(mask).alias("own"))
        if radius:
            asked = asked.withColumn("flip", F.explode(_flips(part, radius))).select("a", F.col("own").bitwiseXOR(F.col("flip")).alias("key"))
        else:
            asked = asked.withColumnRenamed("own", "key")
        crowded = data.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("key", F.lit(True).alias("hot"))
        data, asked = (x.join(crowded, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False))) for x in (data, asked))
        # In a crowded bucket two near fingerprints also agree on one piece of the other bits.
        masks = F.array(*[F.lit(m).cast("long") for m in _thirds(part, max_bits)])

        def pieces(x: DataFrame, fp: str, masks=masks) -> DataFrame:
            whole = F.array(F.struct(F.lit(-1).alias("piece"), F.lit(0).cast("long").alias("value")))
            cut = F.transform(masks, lambda m, i: F.struct(i.alias("piece"), F.col(fp).bitwiseAND(m).alias("value")))
            return x.select(fp, "key", F.explode(F.when(F.col("hot"), cut).otherwise(whole)).alias("p")).select(fp, "key", "p.*")

        near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
        found.append(
            pieces(asked, "a").join(pieces(data, "b"), ["key", "piece", "value"]).where((F.col("a") < F.col("b")) & near).select("a", "b")
        )
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def roots(pairs: DataFrame) -> DataFrame:
    """node, root: every node of the pairs but the roots, with the least node of its component.

    Alternating large-star and small-star steps. Each round is a table in the shared folder, and two
    equal rounds end it; only counts and check sums reach the driver.
    """
    least = lambda e: e.groupBy("u").agg(F.min("v").alias("m"))
    edges = stored(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "links")
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = least(both).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        lowest = least(large)
        small = (
            large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lowest.select("u", F.col("m").alias("v")))
        )
        edges = stored(small.where("u != v").distinct(), "links")
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def groups(docs: DataFrame, text: str = "text", words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, text_hash, fp, component_id, kept: one row per document.

    ``component_id`` is the least doc_id reachable over links, the document's own included. ``kept``
    marks the component's representative: the least id (nulls last), then the least text hash.
    """
    marked = stored(fingerprints(docs, text, words), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    distinct = stored(marked.groupBy("fp").agg(F.min(first).alias("least")), "distinct")
    total = distinct.count()
    rows = distinct.select("fp").orderBy(F.xxhash64(F.lit("plan"), "fp")).limit(SAMPLE).collect()
    plan = make_plan(np.array([r.fp for r in rows], np.int64).astype(np.uint64), total, max_bits)
    found = roots(links(distinct.select("fp"), plan, max_bits))
    linked = (
        distinct.join(found, distinct["fp"] == found["node"], "left")
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    )
    named = linked.groupBy("root").agg(F.min("least").alias("first"))
    component = linked.join(named, "root").select(F.col("fp").alias("of"), "first")
    return marked.join(component, marked["fp"] == component["of"], "left").select(
        "doc_id", "text_hash", "fp", F.col("first.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))).alias("kept"),
    )


def deduplicate(docs: DataFrame, text: str = "text", words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that represent their component, each once."""
    found = stored(groups(docs, text, words, max_bits), "groups")
    # Stored, so that Spark knows the size: few removed documents are broadcast, and no text moves.
    gone = stored(found.where(~F.col("kept")).select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash")).distinct(), "removed")
    # Repeated rows of a representative are told apart by nothing; usually there are none.
    again = found.where("kept").groupBy("doc_id", "text_hash").count().where("count > 1")
    again = stored(again.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash")), "repeated")

    def same(x: DataFrame):
        return F.col("doc_id").eqNullSafe(x["of_id"]) & (F.xxhash64(text) == x["of_hash"])

    left = docs.join(gone, same(gone), "left_anti")
    if again.isEmpty():
        return left
    key = free_name(docs, "text_hash")
    once = left.join(again, same(again), "left_semi").withColumn(key, F.xxhash64(text)).dropDuplicates(["doc_id", key]).drop(key)
    return left.join(again, same(again), "left_anti").unionByName(once)


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
