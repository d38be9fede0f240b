"""Ordered computations over long series without one task per symbol.

``Window.partitionBy(symbol)`` puts a symbol's whole history into one task, so a symbol that holds
a third of the table stalls the job. Here only symbols larger than a threshold are cut, by time,
into slices of bounded size; smaller symbols stay whole and cost nothing extra. Neighbouring
slices are then reconnected exactly:

* a bounded frame (lag, lead, ROWS n PRECEDING) needs the last n rows before a slice and the first
  n after it; :func:`map_series` copies just those rows across the cut;
* a recurrence (EMA, running maximum) needs one small state per slice, see ``recurrence.py``.

The cut is decided first, by a job that counts rows per symbol and bucket in one pruned,
pre-aggregated scan. Its result is a bounded table that the plan then holds as a constant, so every
branch and every recomputed task sees the same cut, and data without heavy symbols gets the plain
window and nothing else.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tickloom.functions.scalars import bucket_start
from tickloom.schemas import DAY_MS

SLICE = "_slice"
HALO = "_halo"

# At most this many groups can each hold more than 1/MAX_PARTS of the rows, which is what bounds
# the size of the broadcast cut table: two small integers per entry, a few MB at the very most.
MAX_PARTS = 65_536
# Groups below this size are never cut.
MIN_ROWS = 1_000_000
# Quantiles of a slice that one job looks at; a slice of more than as many limits takes several jobs.
QUANTILES = 256


def cut_table(
    df: DataFrame, keys: Sequence[str], time: str, width: int, min_rows: int = MIN_ROWS
) -> DataFrame:
    """Symbols to be cut: ``keys, _parts, _limit``, ``_parts`` a map bucket -> its rows, first and last time.

    One column-pruned scan, pre-aggregated before its shuffle. Symbols of at most
    ``max(min_rows, total / MAX_PARTS)`` rows are absent. Both the rows and the map entries of the
    result are below ``MAX_PARTS``.
    """
    per_bucket = df.groupBy(*keys, bucket_start(time, width).alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(time).alias("_lo"), F.max(time).alias("_hi")
    )
    # All columns, so that the total reuses the shuffle of the table.
    total = per_bucket.agg(F.struct(F.sum("_n").alias("n"), F.min("_lo"), F.max("_hi"))).scalar()["n"]
    limit = F.greatest(F.lit(min_rows).cast("long"), F.ceil(total / F.lit(MAX_PARTS)))
    heavy = F.when(
        F.col("_n") > F.col("_limit"),
        F.struct(F.col("_b"), F.struct(F.col("_n").alias("n"), F.col("_lo").alias("lo"), F.col("_hi").alias("hi"))),
    )
    return (
        per_bucket.withColumn("_limit", limit)
        .groupBy(*keys)
        .agg(
            F.sum("_n").alias("_rows"),
            F.max("_limit").alias("_limit"),
            F.map_from_entries(F.collect_list(heavy)).alias("_parts"),
        )
        .filter(F.col("_rows") > F.col("_limit"))
        .select(*keys, "_parts", "_limit")
    )


@dataclass
class Cuts:
    """Where the slices of heavy symbols begin, as bounded constant tables that a row meets by equi joins.

    ``symbols`` has the heavy keys. ``even`` (keys, ``_b``) says from where on and how wide a bucket's even
    sub-buckets are. Each of ``levels`` (keys, ``_begin``) has the sorted times ``_at`` at which a slice
    made so far is cut again, at most a few hundred. ``ties`` (keys, ``_t``) has the values of ``sub`` at which
    rows of one time are cut. So a row looks at its own slice's entries, however many slices there are.
    """

    symbols: DataFrame
    even: DataFrame
    levels: list[DataFrame] = field(default_factory=list)
    ties: DataFrame | None = None
    scale: int = 1


def decided(
    df: DataFrame, keys: Sequence[str], time: str, width: int, min_rows: int = MIN_ROWS, sub: str | None = None
) -> Cuts | None:
    """The cut as constants; None if no symbol is to be cut.

    Heavy buckets get sub-buckets even in time between their first and last row, twice as many as the limit
    asks for, so that only a burst leaves a slice above the limit; one scan tells. Those are cut at as many
    quantiles of their times as their rows ask for, again and again until none is above it or all its
    rows have one time. Those are cut at quantiles of the integer column ``sub``, the next one of the
    order; without it, rows of one time stay together.
    """
    keys = list(keys)
    spark = df.sparkSession
    found = cut_table(df, keys, time, width, min_rows).collect()
    if not found:
        return None
    fields = list(df.select(*keys).schema)
    own = lambda r: tuple(r[k] for k in keys)
    long = lambda *names: [StructField(n, LongType()) for n in names]
    at = StructField("_at", ArrayType(LongType()))

    def table(rows: list, *columns: StructField) -> DataFrame:
        return spark.createDataFrame(rows, StructType([*fields, *columns]))

    def step(part, limit: int) -> int:
        return max(1, math.ceil((part["hi"] - part["lo"] + 1) / math.ceil(2 * part["n"] / limit)))

    even = [(*own(r), b, part["lo"], step(part, r["_limit"])) for r in found for b, part in r["_parts"].items()]
    limits = table([(*own(r), r["_limit"]) for r in found], *long("_limit"))
    cuts = Cuts(limits.select(*keys), table(even, *long("_b", "_lo", "_step")))

    def quantiles(rows: DataFrame, slices: list, value: str) -> list:
        """The slices with the values of a column that cut them into slices of at most the limit."""
        dense = table([(*own(r), r["_begin"], r["_n"], r["_limit"]) for r in slices], *long("_begin", "_n", "_limit"))
        split = [i / QUANTILES for i in range(1, QUANTILES)]
        wanted = F.least(F.lit(QUANTILES), F.ceil(2 * F.col("_n") / F.col("_limit")))
        told = (
            rows.join(F.broadcast(dense), [*keys, "_begin"]).groupBy(*keys, "_begin", "_n", "_limit")
            .agg(F.min(time).alias("_a"), F.percentile_approx(value, split, 20 * QUANTILES).alias("_at"))
        )
        # Evenly spaced quantiles of those that were taken, as many as the slice needs.
        some = F.filter("_at", lambda v, i: F.floor((i + 1) * wanted / QUANTILES) > F.floor(i * wanted / QUANTILES))
        return told.select(*keys, "_begin", "_a", some.alias("_at")).collect()

    for _ in range(64):
        rows = _begun(df.select(*keys, time), cuts, keys, time, width, "inner")
        sizes = rows.groupBy(*keys, "_begin").agg(F.count(F.lit(1)).alias("_n"), F.min(time).alias("_a"), F.max(time).alias("_z"))
        # No more than total / limit slices can be above the limit.
        above = sizes.join(F.broadcast(limits), keys).filter(F.col("_n") > F.col("_limit")).collect()
        dense = [r for r in above if r["_a"] != r["_z"]]
        if not dense:
            break
        level = []
        for r in quantiles(rows, dense, time):
            # A value that fills a whole quantile is cut off behind too; its slice then has one time.
            new = {v + d for v in r["_at"] for d in ((0, 1) if r["_at"].count(v) > 1 or v == r["_a"] else (0,))}
            level.append((*own(r), r["_begin"], sorted(new)))
        cuts.levels.append(table(level, *long("_begin"), at))
    tied = [r for r in above if r["_a"] == r["_z"]]
    if sub is not None and tied:
        rows = _begun(df.select(*keys, time, sub), cuts, keys, time, width, "inner")
        ties = [(*own(r), r["_a"], sorted(set(r["_at"] or []))) for r in quantiles(rows, tied, sub)]
        # Slices are numbered by their first time; those of one time need numbers in between.
        scale = 1 << max(len(r[-1]) for r in ties).bit_length()
        last = max(abs(r[-2]) for r in ties)
        last = max([last, *(abs(x) for r in found for p in r["_parts"].values() for x in (p["lo"], p["hi"]))])
        if (last + 2 * width) * scale < 1 << 62:
            cuts.ties, cuts.scale = table(ties, *long("_t"), at), scale
    return cuts


def _begun(df: DataFrame, cuts: Cuts, keys: Sequence[str], time: str, width: int, how: str) -> DataFrame:
    """``df`` with ``_cut``, true for a cut symbol, and the time ``_begin`` at which a row's slice begins."""
    keys, t = list(keys), F.col(time)
    rows = df.join(F.broadcast(cuts.symbols.withColumn("_cut", F.lit(True))), keys, how).withColumn("_b", bucket_start(t, width))
    rows = rows.join(F.broadcast(cuts.even), [*keys, "_b"], "left")
    inside = F.col("_lo") + bucket_start(t - F.col("_lo"), F.col("_step"))
    rows = rows.withColumn("_begin", F.greatest("_b", inside)).drop("_b", "_lo", "_step")
    for level in cuts.levels:
        rows = rows.join(F.broadcast(level), [*keys, "_begin"], "left")
        rows = rows.withColumn("_begin", F.greatest("_begin", F.array_max(F.filter("_at", lambda v: v <= t)))).drop("_at")
    return rows


def with_slices(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    width: int = DAY_MS,
    min_rows: int = MIN_ROWS,
    cut: bool = True,
    like: DataFrame | None = None,
    sub: str | None = None,
) -> DataFrame:
    """Add ``_slice``; rows of one (keys, _slice) are contiguous in ``time``, or in ``time`` and ``sub``.

    ``like`` is a frame with the same keys, times and ``sub`` that is cheaper to count than ``df``.
    """
    cuts = decided(like or df, keys, time, width, min_rows, sub) if cut else None
    if cuts is None:
        return df.withColumn(SLICE, F.lit(0).cast("long"))
    return sliced(df, cuts, keys, time, width, sub=sub)


def sliced(
    df: DataFrame, cuts: Cuts, keys: Sequence[str], time: str, width: int, how: str = "left", sub: str | None = None
) -> DataFrame:
    """Add the slice id, 0 for an uncut symbol; with ``how='inner'`` only rows of cut symbols."""
    rows = _begun(df, cuts, keys, time, width, how)
    begin = F.col("_begin")
    if sub is not None and cuts.ties is not None:
        rows = rows.withColumn("_t", F.col(time)).join(F.broadcast(cuts.ties), [*keys, "_t"], "left")
        behind = F.size(F.filter("_at", lambda v: v <= F.col(sub)))
        begin = begin * F.lit(cuts.scale).cast("long") + F.greatest(F.coalesce(behind, F.lit(0)), F.lit(0))
    begin = F.when(F.col("_cut").isNull(), F.lit(0)).otherwise(begin).cast("long")
    return rows.select(*df.columns, begin.alias(SLICE))


def second_of(df: DataFrame, order: Sequence[str]) -> str | None:
    """The second column of an order, if rows of one time can be cut by it."""
    return order[1] if len(order) > 1 and dict(df.dtypes)[order[1]] in ("tinyint", "smallint", "int", "bigint") else None


def _edge_rows(
    df: DataFrame,
    cuts: Cuts,
    keys: Sequence[str],
    order: Sequence[str],
    width: int,
    n: int,
    last: bool,
) -> DataFrame:
    """For every slice of a cut symbol, the ``n`` rows just before it (``last``) or just after it.

    Slices may be short, so the n rows can stem from several neighbours. Each slice offers its
    outermost min(n, size) rows; numbered consecutively over the symbol they get positions, and a
    slice whose own rows begin at position p wants exactly the positions p-n .. p-1. That makes
    the hand-over an equi join on (symbol, position), in which no key is heavy.
    """
    keys = list(keys)
    rows = sliced(df, cuts, keys, order[0], width, "inner", second_of(df, order))
    outward = [F.col(c).desc() if last else F.col(c).asc() for c in order]
    along = F.col(SLICE).asc() if last else F.col(SLICE).desc()
    sizes = rows.groupBy(*keys, SLICE).agg(F.least(F.count(F.lit(1)), F.lit(n)).alias("_size"))
    starts = sizes.withColumn(
        "_start", F.sum("_size").over(Window.partitionBy(*keys).orderBy(along)) - F.col("_size")
    )
    offered = (
        rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, SLICE).orderBy(*outward)))
        .filter(F.col("_r") <= n)
        .join(starts, keys + [SLICE])
        .withColumn("_p", F.col("_start") + F.col("_size") - F.col("_r"))
        .drop(SLICE, "_r", "_start", "_size")
    )
    wanted = starts.filter(F.col("_start") > 0).select(
        *keys,
        SLICE,
        F.explode(
            F.sequence(F.greatest(F.col("_start") - n, F.lit(0)), F.col("_start") - 1)
        ).alias("_p"),
    )
    return offered.join(wanted, keys + ["_p"]).drop("_p")


def map_series(
    df: DataFrame,
    fn: Callable[[DataFrame, WindowSpec], DataFrame],
    *,
    before: int = 0,
    after: int = 0,
    keys: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("openTime",),
    width: int = DAY_MS,
    min_rows: int = MIN_ROWS,
    cut: bool = True,
    like: DataFrame | None = None,
) -> DataFrame:
    """Apply window expressions that look at most ``before`` rows back and ``after`` rows ahead.

    ``fn(frame, window)`` adds columns over ``window`` (partitioned by the series, ordered by
    ``order``). ``order`` must be a total order within a series and start with an integer time.
    Chained expressions need the sum of their look-backs. The result equals
    ``fn(df, Window.partitionBy(keys).orderBy(order))`` row for row.

    Deciding the cut runs a job that counts ``df``, which is cheap for a scan but not for the result
    of an aggregation: give a frame with the same keys and order that is cheaper to count as ``like``, or
    pass ``cut=False`` where a series is bounded by construction, such as one
    row per time bucket; that is the plain window.
    """
    keys, order = list(keys), list(order)
    sub = second_of(df, order)
    cuts = decided(like or df, keys, order[0], width, min_rows, sub) if cut else None
    if cuts is None:
        return fn(df, Window.partitionBy(*keys).orderBy(*order))
    rows = sliced(df, cuts, keys, order[0], width, sub=sub).withColumn(HALO, F.lit(False))
    for n, last in ((before, True), (after, False)):
        if n:
            edge = _edge_rows(df, cuts, keys, order, width, n, last)
            rows = rows.unionByName(edge.withColumn(HALO, F.lit(True)))
    window = Window.partitionBy(*keys, SLICE).orderBy(*order)
    return fn(rows, window).filter(~F.col(HALO)).drop(SLICE, HALO)
