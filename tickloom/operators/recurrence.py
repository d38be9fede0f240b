"""Recurrences over long series: exponential averages, MACD and the running maximum.

A recurrence has no ROWS frame, but it can still be computed in parallel over time. An exponential
average maps the state before a block of rows affinely to the state after it, so each block is
first run from state zero, the block summaries are chained, and each row adds its block's incoming
state scaled by the decay. Blocks are at most ``BLOCK`` rows; chains run over runs of blocks, then per
slice, then per symbol over the slices (see ``series.py``), so no task sees a whole symbol's rows, and
the work is linear in the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.series import MIN_ROWS, SLICE, decided, second_of, sliced, with_slices
from tickloom.operators.stepwise import chunks
from tickloom.schemas import DAY_MS

# Rows per block. decay ** -BLOCK must stay a finite double: 3 ** 512 is about 1e244.
BLOCK = 512
# Blocks whose states are handed down together.
RUN = 256


@dataclass(frozen=True)
class _Ema:
    span: int

    @property
    def alpha(self) -> float:
        return 2.0 / (self.span + 1)

    @property
    def decay(self) -> float:
        return 1.0 - self.alpha

    def power(self, exponent: Column) -> Column:
        return F.pow(F.lit(self.decay), exponent)

    def from_zero(self, x: Column, i: Column, running) -> Column:
        """Average of a block's rows up to the i-th, started from state zero."""
        if self.decay == 0.0:
            return x
        weighted = F.sum(x * F.pow(F.lit(1.0 / self.decay), i)).over(running)
        return F.lit(self.alpha) * self.power(i) * weighted


def _numbered(df, keys, order, width, min_rows, cut, like) -> DataFrame:
    rows = with_slices(df, keys, order[0], width, min_rows, cut, like, second_of(df, order))
    position = F.row_number().over(Window.partitionBy(*keys, SLICE).orderBy(*order)) - 1
    return (
        rows.withColumn("_i", position)
        .withColumn("_blk", F.floor(F.col("_i") / BLOCK).cast("int"))
        .withColumn("_i", F.pmod(F.col("_i"), F.lit(BLOCK)))
    )


def _chained(
    rows: DataFrame,
    value: str,
    names: Sequence[str],
    advance: Callable[[Column, Column, Column], dict[str, Column]],
    initial: Callable[[Column], dict[str, Column]],
    keys: Sequence[str],
    per_key: DataFrame | None = None,
) -> DataFrame:
    """Join to each row ``_in``: the state and row offset with which its block begins."""
    keys = list(keys)
    state_type = "struct<" + ",".join(f"{n}:double" for n in names) + ",offset:bigint>"
    zero = F.struct(*[F.lit(0.0).alias(n) for n in names], F.lit(0).cast("long").alias("offset"))

    def step(state: Column, child: Column) -> Column:
        moved = advance(state, child["n"], child)
        return F.struct(*[moved[n].alias(n) for n in names], (state["offset"] + child["n"]).alias("offset"))

    def walk(children: Column, start: Column) -> Column:
        """Array of (at, state before the child) along ``children``."""
        entry = f"struct<at:bigint,st:{state_type}>"

        def some(acc: Column, part: Column) -> Column:
            end = F.aggregate(
                part,
                F.struct(acc["st"].alias("st"), F.array().cast(f"array<{entry}>").alias("seen")),
                lambda a, c: F.struct(
                    step(a["st"], c).alias("st"),
                    F.concat(a["seen"], F.array(F.struct(c["at"].alias("at"), a["st"].alias("st")))).alias("seen"),
                ),
            )
            # Computed once: the end is used twice.
            add = lambda e: F.struct(e["st"].alias("st"), F.concat(acc["seen"], F.array(e["seen"])).alias("seen"))
            return F.get(F.transform(F.array(end), add), F.lit(0))

        begin = F.struct(start.alias("st"), F.array().cast(f"array<array<{entry}>>").alias("seen"))
        return F.aggregate(chunks(children), begin, some, lambda acc: F.flatten(acc["seen"]))

    def folded(children: DataFrame, path: Sequence[str], at: str) -> DataFrame:
        """One row per ``path``: its children in order, and what they amount to from state zero."""
        child = F.struct(F.col(at).cast("long").alias("at"), "n", "first", *names)
        return (
            children.groupBy(*path).agg(F.array_sort(F.collect_list(child)).alias("children"))
            .withColumn("end", F.aggregate("children", zero, step))
            .select(
                *path, "children", F.col("end.offset").alias("n"), F.col("children")[0]["first"].alias("first"),
                *[F.col(f"end.{n}").alias(n) for n in names],
            )
        )

    def spread(parents: DataFrame, path: Sequence[str], at: str) -> DataFrame:
        """The state ``_st`` of each parent handed to its children: one row per child."""
        return parents.select(*path, *extra, F.explode(walk(F.col("children"), F.col("_st"))).alias("e")).select(
            *path, *extra, F.col("e.at").alias(at), F.col("e.st").alias("_st")
        )

    # No level holds more than a bounded number of children per row of the next: blocks in runs of RUN,
    # runs in slices, slices (at most MAX_PARTS) in a series. Rows meet one state each, by an equi join.
    in_slice, in_run = [*keys, SLICE], [*keys, SLICE, "_run"]
    blocks = rows.groupBy(*in_slice, "_blk").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(value, "_i").alias("first"),
        *[F.max_by(f"_z_{n}", "_i").alias(n) for n in names],
    )
    runs = folded(blocks.withColumn("_run", F.floor(F.col("_blk") / RUN)), in_run, "_blk")
    slices = folded(runs, in_slice, "_run")
    series = folded(slices, keys, SLICE)
    extra: list[str] = []
    if per_key is not None:
        extra = [c for c in per_key.columns if c not in keys]
        series = series.join(per_key, keys, "left")
    start = initial(F.col("first"))
    begin = F.struct(*[start[n].cast("double").alias(n) for n in names], F.lit(0).cast("long").alias("offset"))
    to_slices = spread(series.withColumn("_st", begin), keys, SLICE)
    to_runs = spread(slices.select(*in_slice, "children").join(to_slices, in_slice), in_slice, "_run")
    to_blocks = spread(runs.select(*in_run, "children").join(to_runs, in_run), in_run, "_blk")
    states = to_blocks.select(*in_slice, F.col("_blk").cast("int").alias("_blk"), *extra, F.col("_st").alias("_in"))
    return rows.join(states, [*in_slice, "_blk"])


def _block_window(keys, order):
    return (
        Window.partitionBy(*keys, SLICE, "_blk")
        .orderBy("_i")
        .rowsBetween(Window.unboundedPreceding, 0)
    )


def ema(
    df: DataFrame,
    value: str,
    spans: dict[str, int],
    seed: str = "first",
    *,
    keys: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("openTime",),
    width: int = DAY_MS,
    min_rows: int = MIN_ROWS,
    cut: bool = True,
    like: DataFrame | None = None,
) -> DataFrame:
    """Add one exponential average per entry of ``spans`` (column name -> span).

    ``seed='first'`` starts at the first value. ``seed='sma'`` is null before row n, equals the
    mean of the first n values there and recurs from it; a series shorter than n is all null.
    ``value`` must not be null. ``cut`` and ``like`` as in ``series.py``.
    """
    if seed not in ("first", "sma"):
        raise ValueError("seed must be 'first' or 'sma'")
    keys, order = list(keys), list(order)
    names = list(spans)
    emas = {n: _Ema(k) for n, k in spans.items()}
    rows = _numbered(df, keys, order, width, min_rows, cut, like)
    w = _block_window(keys, order)
    rows = rows.withColumns(
        {f"_z_{n}": e.from_zero(F.col(value), F.col("_i"), w) for n, e in emas.items()}
    )
    per_key = _seed_shift(df, value, emas, keys, order) if seed == "sma" else None
    out = _chained(
        rows,
        value,
        names,
        lambda st, n, z: {k: e.power(n) * st[k] + z[k] for k, e in emas.items()},
        lambda first: dict.fromkeys(names, first),
        keys,
        per_key,
    )
    position = F.col("_in.offset") + F.col("_i")
    for name, e in emas.items():
        plain = e.power(F.col("_i") + 1) * F.col(f"_in.{name}") + F.col(f"_z_{name}")
        if seed == "sma":
            after = position - (e.span - 1)
            plain = F.when(after >= 0, plain + e.power(after) * F.col(f"_shift_{name}"))
        out = out.withColumn(name, plain)
    return out.select(*df.columns, *names)


def _seed_shift(df, value, emas: dict[str, _Ema], keys, order) -> DataFrame:
    """Per symbol and span: mean of the first n values minus the first-seeded average there.

    Two solutions of the recurrence differ by a decaying multiple of their difference at one
    point, so this number turns the first-seeded average into the mean-seeded one.
    """
    longest = max(e.span for e in emas.values())
    head = (
        df.select(*keys, *order, F.col(value).alias("_x"))
        .withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        .filter(F.col("_r") <= longest)
        .groupBy(*keys)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "_x"))), lambda s: s["_x"]).alias("_h"))
    )

    def shift(e: _Ema) -> Column:
        values = F.slice("_h", 1, e.span)
        mean = F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / e.span
        plain = F.aggregate(values, values[0], lambda a, x: a * e.decay + x * e.alpha)
        return F.when(F.size("_h") >= e.span, mean - plain)

    return head.select(*keys, *[shift(e).alias(f"_shift_{n}") for n, e in emas.items()])


def macd(
    df: DataFrame,
    value: str,
    fast: int = 12,
    slow: int = 26,
    signal: int = 9,
    *,
    keys: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("openTime",),
    width: int = DAY_MS,
    min_rows: int = MIN_ROWS,
    cut: bool = True,
    like: DataFrame | None = None,
) -> DataFrame:
    """Add ``ema_<fast>``, ``ema_<slow>``, ``macd`` and ``macd_signal``, first-value seeds.

    The three averages form one linear recurrence, so a single chain serves all of them: the
    signal's block response to the incoming fast and slow states is a geometric sum.
    """
    keys, order = list(keys), list(order)
    f, s, g = _Ema(fast), _Ema(slow), _Ema(signal)
    rows = _numbered(df, keys, order, width, min_rows, cut, like)
    w = _block_window(keys, order)
    i = F.col("_i")
    rows = rows.withColumns(
        {"_z_f": f.from_zero(F.col(value), i, w), "_z_s": s.from_zero(F.col(value), i, w)}
    ).withColumn("_z_g", g.from_zero(F.col("_z_f") - F.col("_z_s"), i, w))

    def response(e: _Ema, steps: Column) -> Column:
        if e.decay == g.decay:
            return F.lit(g.alpha) * steps * e.power(steps)
        scale = g.alpha * e.decay / (g.decay - e.decay)
        return F.lit(scale) * (g.power(steps) - e.power(steps))

    def advance(st: Column, n: Column, z: Column) -> dict[str, Column]:
        return {
            "f": f.power(n) * st["f"] + z["f"],
            "s": s.power(n) * st["s"] + z["s"],
            "g": g.power(n) * st["g"] + response(f, n) * st["f"] - response(s, n) * st["s"] + z["g"],
        }

    out = _chained(
        rows,
        value,
        ["f", "s", "g"],
        advance,
        lambda first: {"f": first, "s": first, "g": F.lit(0.0)},
        keys,
    )
    now = advance(
        F.col("_in"), i + 1, F.struct(*[F.col(f"_z_{n}").alias(n) for n in ("f", "s", "g")])
    )
    return out.select(
        *df.columns,
        now["f"].alias(f"ema_{fast}"),
        now["s"].alias(f"ema_{slow}"),
        (now["f"] - now["s"]).alias("macd"),
        now["g"].alias("macd_signal"),
    )


def running_max_before(
    df: DataFrame,
    value: str,
    name: str,
    *,
    keys: Sequence[str],
    order: str,
    width: int,
    min_rows: int = MIN_ROWS,
    cut: bool = True,
) -> DataFrame:
    """Add the maximum of ``value`` over all rows of the series with a smaller ``order``.

    Rows with an equal ``order`` (the levels of one message) do not see each other. Per slice: the
    maximum of all earlier slices, chained over the slice summaries, and a frame inside the slice.
    """
    keys = list(keys)
    cuts = decided(df, keys, order, width, min_rows) if cut else None
    if cuts is None:
        before = Window.partitionBy(*keys).orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
        return df.withColumn(name, F.max(value).over(before))
    rows = sliced(df, cuts, keys, order, width)
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    prefix = (
        rows.groupBy(*keys, SLICE)
        .agg(F.max(value).alias("_top"))
        .select(*keys, SLICE, F.max("_top").over(earlier).alias("_before"))
    )
    inside = (
        Window.partitionBy(*keys, SLICE).orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.join(prefix, keys + [SLICE])
        .withColumn(name, F.greatest("_before", F.max(value).over(inside)))
        .drop(SLICE, "_before")
    )
