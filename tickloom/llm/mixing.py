"""Mixing sources to target weights.

Words per source are aggregated, each source gets a target and with it a repetition rate, and each
document is taken floor(rate) times, plus once more with the fraction as probability. The coin is a
hash of the document id, so a rerun gives the same mix.

One coin per document leaves a source off its target by chance, most of all where a few long
documents hold much of it. The coins of all ``SEEDS`` seeds are therefore summed per source, and each
source uses the seed whose total comes nearest: still one seeded coin per document, but a better one.

Defined cases: a null source is a source of its own, ordered last; a null text has size 0; rows that
share an id share the coin; a source without words gets target 0 and rate 0; an empty table gives an
empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import count_words, free_name, stored

WEIGHTS = (1, 2, 3)
MOST = 3  # a source's target stops at so many times its size
SEEDS = 32


def coins(doc_id: Column) -> Column:
    """``SEEDS`` numbers in [0, 1) from the document's id; two from each digest."""
    text = F.coalesce(doc_id.cast("string"), F.lit("null"))

    def two(seed: int) -> list[Column]:
        digest = F.md5(F.concat(F.lit(f"{seed}:"), text).cast("binary"))
        part = lambda at: F.conv(F.substring(digest, at, 12), 16, 10).cast("double") / float(2**48)
        return [part(1), part(17)]

    return F.array(*[c for s in range(SEEDS // 2) for c in two(s)])


def sizes(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size: all the mix needs of a document, as a slim table that texts are read for once."""
    return stored(docs.select("doc_id", F.col(source).alias("source"), count_words(F.col(text)).alias("size")), "sizes")


def targets(sized: DataFrame) -> DataFrame:
    """source, source_size, target, rate: one row per source.

    Water-filling: sources are ordered by the level at which they reach ``MOST`` times their size;
    the first k of them stop there, and the level of the others follows from what is left. The
    windows here run over one row per source, after the aggregation.
    """
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    level = Window.orderBy("stops", "rank")
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    number = F.lit(0)
    for i, w in enumerate(WEIGHTS):
        number = F.when((F.col("rank") - 1) % len(WEIGHTS) == i, F.lit(w)).otherwise(number)
    return (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_source))
        .withColumn("weight", number.cast("long"))
        .withColumn("stops", MOST * F.col("source_size") / F.col("weight"))
        .withColumn("all", F.sum("source_size").over(everything))
        .withColumn("stopped", F.coalesce(F.sum(MOST * F.col("source_size")).over(before), F.lit(0)))
        .withColumn("share", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        # The level if exactly the sources before this one stop; the true one is the first that this
        # source does not exceed.
        .withColumn("level", (F.col("all") - F.col("stopped")).cast("double") / F.col("share"))
        .withColumn("found", F.min(F.when(F.col("level") <= F.col("stops"), F.struct("stops", "rank", "level"))).over(everything))
        .select(
            "source", "source_size",
            F.when(
                F.struct("stops", "rank") < F.struct(F.col("found.stops"), F.col("found.rank")),
                (MOST * F.col("source_size")).cast("double"),
            ).otherwise(F.col("found.level") * F.col("weight")).alias("target"),
        )
        .withColumn("rate", F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.col("target") / F.col("source_size")))
    )


def copies(rate: Column, coin: Column) -> Column:
    return (F.floor(rate) + F.when(coin < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def plan(sized: DataFrame) -> DataFrame:
    """source, source_size, target, rate, seed: one row per source.

    This and the targets are stored tables, so Spark knows their size before it joins documents with
    them: a few sources are broadcast and no document moves, very many are met by a skew-proof join.
    """
    goal = stored(targets(sized), "targets").withColumnRenamed("source", "goal_source")
    # One partial sum per source and task: a source with a third of all rows is combined before it moves.
    tried = (
        sized.join(goal, F.col("source").eqNullSafe(F.col("goal_source")), "inner")
        .withColumn("coins", coins(F.col("doc_id")))
        .groupBy("source")
        .agg(
            F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("rate").alias("rate"),
            *[F.sum(F.col("size") * copies(F.col("rate"), F.col("coins")[i])).alias(f"taken_{i}") for i in range(SEEDS)],
        )
    )
    misses = F.array(*[F.struct(F.abs(F.col(f"taken_{i}") - F.col("target")).alias("miss"), F.lit(i).alias("seed")) for i in range(SEEDS)])
    return stored(tried.select("source", "source_size", "target", "rate", F.array_min(misses)["seed"].alias("seed")), "plan")


def taken(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies: what the mix does with each document."""
    sized = sizes(docs, text, source)
    chosen = plan(sized).withColumnRenamed("source", "chosen_source")
    return (
        sized.join(chosen, F.col("source").eqNullSafe(F.col("chosen_source")), "left")
        .withColumn("copies", copies(F.col("rate"), coins(F.col("doc_id"))[F.col("seed")]))
        .select("doc_id", "source", "size", "source_size", "target", "rate", "copies")
    )


def mix(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """The mixed documents themselves: each row of ``docs`` as often as the mix takes it."""
    chosen = plan(sizes(docs, text, source)).select(
        F.col("source").alias("mix_source"), F.col("rate").alias("mix_rate"), F.col("seed").alias("mix_seed")
    )
    held, n = free_name(docs, "held"), free_name(docs, "copy")
    packed = docs.select(F.struct("*").alias(held))
    return (
        packed.join(chosen, F.col(f"{held}.{source}").eqNullSafe(F.col("mix_source")), "left")
        .withColumn("n_copies", copies(F.col("mix_rate"), coins(F.col(f"{held}.doc_id"))[F.col("mix_seed")]))
        .where("n_copies > 0")
        .select(F.col(f"{held}.*"), F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias(n))
    )
