"""Rules whose next decision depends on the one before, in parallel over time.

Where a rule keeps one number per series, each row is a function from the number before it to the number
after it. The functions here are made of pieces, each a constant or the number plus a constant, and so
are their compositions. Rows are composed in blocks of at most ``BLOCK``, blocks in runs, runs in
slices (see ``series.py``) and slices in a series; then the numbers are handed down again, one row per
block, and each block is followed once from its own. No task sees a whole series, and the work is linear
in the rows as long as the pieces stay few; neighbouring pieces with one result are joined.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.series import MIN_ROWS, SLICE, second_of, with_slices

# Rows per block, and blocks per run.
BLOCK = 512
RUN = 256
# Entries that are appended one by one.
CHUNK = 256

# Numbers lie strictly between these; sums of a few of them still fit a long.
LOW, TOP = -(1 << 61), 1 << 61

PIECES = "array<struct<hi:bigint,keep:boolean,value:bigint>>"


def piece(hi: Column | int, keep: bool | Column, value: Column | int) -> Column:
    """Of the numbers up to ``hi`` and above the piece before: ``value``, or with ``keep`` the number plus ``value``."""
    column = lambda x, t: (x if isinstance(x, Column) else F.lit(x)).cast(t)
    return F.struct(column(hi, "bigint").alias("hi"), column(keep, "boolean").alias("keep"), column(value, "bigint").alias("value"))


def pieces(*of: Column) -> Column:
    """A function from its pieces, which must be in order and end with ``TOP``; empty ones may be null."""
    return F.filter(F.array(*of), lambda p: p.isNotNull()).cast(PIECES)


def identity() -> Column:
    return pieces(piece(TOP, True, 0))


def applied_to(f: Column, x: Column) -> Column:
    found = F.get(F.filter(f, lambda p: p["hi"] >= x), F.lit(0))
    return F.when(found["keep"], x + found["value"]).otherwise(found["value"])


def _lower(f: Column, i: Column) -> Column:
    return F.coalesce(F.get(f, i - 1)["hi"], F.lit(LOW))


def composed(f: Column, g: Column) -> Column:
    """First ``f``, then ``g``."""
    return _with(g, lambda once: _composed(f, once))


def _composed(f: Column, g: Column) -> Column:
    def after(p: Column, i: Column) -> Column:
        low, add = _lower(f, i), p["value"]
        met = F.filter(g, lambda q, j: (q["hi"] - add > low) & (_lower(g, j) - add < p["hi"]))
        moved = F.transform(
            met, lambda q: piece(F.least(q["hi"] - add, p["hi"]), q["keep"], F.when(q["keep"], q["value"] + add).otherwise(q["value"]))
        )
        return F.when(p["keep"], moved).otherwise(F.array(piece(p["hi"], False, applied_to(g, p["value"]))))

    every = F.flatten(F.transform(f, after))

    def differs(a: Column) -> Column:
        # A piece goes where the next one says the same; the last one has no next.
        same = lambda p, n: n.isNotNull() & (p["keep"] == n["keep"]) & (p["value"] == n["value"])
        return F.filter(a, lambda p, i: ~F.coalesce(same(p, F.get(a, i + 1)), F.lit(False)))

    return _with(every, differs).cast(PIECES)


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def gathered(children: DataFrame, path: Sequence[str], at: str) -> DataFrame:
    """One row per ``path``: its children's functions ``_f`` in order."""
    child = F.struct(F.col(at).alias("at"), F.col("_f").alias("f"))
    return children.groupBy(*path).agg(F.array_sort(F.collect_list(child)).alias("_children"))


def chunks(items: Column) -> Column:
    """``items`` as arrays of up to ``CHUNK``; appending to an array copies it, so long ones are made of short ones."""
    last = F.greatest(F.floor((F.size(items) - 1) / CHUNK), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * CHUNK + 1, CHUNK))


def followed(items: Column, x: Column, entry: Callable[[Column, Column], Column], function_of: Callable[[Column], Column]) -> Column:
    """Entries made of each item and the number before it."""
    empty = F.slice(F.array(entry(F.get(items, F.lit(0)), x)), 1, 0)

    def walk(some: Column, start: Column) -> Column:
        return F.aggregate(
            some,
            F.struct(start.alias("x"), empty.alias("seen")),
            lambda acc, item: F.struct(
                applied_to(function_of(item), acc["x"]).alias("x"), F.concat(acc["seen"], F.array(entry(item, acc["x"]))).alias("seen")
            ),
        )

    def add(acc: Column, some: Column) -> Column:
        return _with(walk(some, acc["x"]), lambda w: F.struct(w["x"].alias("x"), F.concat(acc["seen"], F.array(w["seen"])).alias("seen")))

    start = F.struct(x.alias("x"), F.slice(F.array(empty), 1, 0).alias("seen"))
    return F.aggregate(chunks(items), start, add, lambda acc: F.flatten(acc["seen"]))


def handed(parents: DataFrame, path: Sequence[str], at: str) -> DataFrame:
    """The number ``_x`` before each parent handed to its children: one row per child."""
    entry = lambda c, x: F.struct(c["at"].alias("at"), x.alias("x"))
    each = F.explode(followed(F.col("_children"), F.col("_x"), entry, lambda c: c["f"])).alias("e")
    return parents.select(*path, each).select(*path, F.col("e.at").alias(at), F.col("e.x").alias("_x"))


def slice_states(slices: DataFrame, start: DataFrame | None, initial: int | str, keys: Sequence[str]) -> DataFrame:
    """The number ``_x`` before each slice, from the slices' functions ``_f``; ``start`` as in ``states_before``."""
    series = gathered(slices, keys, SLICE)
    if start is None:
        series = series.withColumn("_x", F.lit(initial).cast("bigint"))
    else:
        series = series.join(start.select(*keys, F.col(initial).cast("bigint").alias("_x")), list(keys), "left")
        series = series.withColumn("_x", F.coalesce("_x", F.lit(0).cast("bigint")))
    return handed(series, keys, SLICE)


def states_before(
    rows: DataFrame,
    function: Callable[[Column], Column],
    start: DataFrame | None,
    initial: int | str,
    name: str,
    *,
    keys: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("seq",),
    width: int,
    min_rows: int = MIN_ROWS,
    cut: bool = True,
    like: DataFrame | None = None,
    fold: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """``rows`` with the number before each row in the column ``name``.

    ``function(row)`` is a row's function, built by :func:`pieces`. A series starts with the column of
    ``start`` (``keys`` and one number; null for none) called like ``initial``, or with the number
    ``initial``. ``order`` must be a total order and begin with an integer; ``cut`` and ``like`` as in
    ``series.py``. ``fold`` makes the function of an array of rows (entries ``row``, in order) where there is
    a quicker way than composing theirs.
    """
    keys, order = list(keys), list(order)
    in_slice, in_run, in_block = [*keys, SLICE], [*keys, SLICE, "_run"], [*keys, SLICE, "_run", "_blk"]
    position = F.row_number().over(Window.partitionBy(*in_slice).orderBy(*order)) - 1
    numbered = (
        with_slices(rows, keys, order[0], width, min_rows, cut, like, second_of(rows, order))
        .withColumn("_i", position)
        .withColumn("_blk", F.floor(F.col("_i") / BLOCK).cast("bigint"))
        .withColumn("_run", F.floor(F.col("_blk") / RUN).cast("bigint"))
    )
    row = F.struct("_i", F.struct(*[c for c in rows.columns if c not in keys]).alias("row"))
    blocks = numbered.groupBy(*in_block).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    by_row = lambda items: F.aggregate(items, identity(), lambda f, r: composed(f, function(r["row"])))
    blocks = blocks.withColumn("_f", (fold or by_row)(F.col("_rows")))

    def folded(children: DataFrame, path: list[str], at: str) -> DataFrame:
        together = gathered(children, path, at)
        return together.withColumn("_f", F.aggregate("_children", identity(), lambda f, c: composed(f, c["f"])))

    runs = folded(blocks.select(*in_block, "_f"), in_run, "_blk")
    slices = folded(runs, in_slice, "_run")
    to_slices = slice_states(slices, start, initial, keys)
    to_runs = handed(slices.select(*in_slice, "_children").join(to_slices, in_slice), in_slice, "_run")
    to_blocks = handed(runs.select(*in_run, "_children").join(to_runs, in_run), in_run, "_blk")
    entry = lambda r, x: F.struct(r["row"].alias("row"), x.alias("x"))
    each = F.explode(followed(F.col("_rows"), F.col("_x"), entry, lambda r: function(r["row"]))).alias("e")
    out = blocks.select(*in_block, "_rows").join(to_blocks, in_block).select(*keys, each)
    return out.select(*[F.col(c) if c in keys else F.col(f"e.row.{c}").alias(c) for c in rows.columns], F.col("e.x").alias(name))
