"""Order books: batch replay, depth curves and quotes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.recurrence import running_max_before
from tickloom.operators.series import MIN_ROWS, SLICE, map_series, second_of, with_slices
from tickloom.operators.stepwise import LOW, PIECES, TOP, applied_to, piece, pieces, slice_states, states_before
from tickloom.schemas import DAY_MS
from tickloom.sources.tables import first_per_key

# Sequence numbers per slice when a heavy symbol's updates are cut.
SEQ_WIDTH = 1 << 24
# What a replay reads of an update.
UPDATE = ["symbol", "side", "pos", "price", "qty", "u", "seq", "kind"]
# An id that is this many times smaller than the last one is of another numbering.
FAR = 100


def current_updates(updates: DataFrame, min_rows: int | None = None) -> DataFrame:
    """Drop the levels of stale messages: an id not above every earlier id of the symbol.

    A dropped message has an id at or below the running maximum, so leaving it in the maximum
    changes nothing and the rule needs no sequential state. It takes ids that are all there and of
    one numbering; :func:`decided_messages` knows the full rule.
    """
    extra = {} if min_rows is None else {"min_rows": min_rows}
    seen = running_max_before(
        updates, "u", "_seen", keys=["symbol"], order="seq", width=SEQ_WIDTH, **extra
    )
    return seen.filter(F.col("_seen").isNull() | (F.col("u") > F.col("_seen"))).drop("_seen")


def _far(u: Column) -> Column:
    """The largest last id beside which ``u`` still counts as old."""
    return F.least(F.coalesce(F.try_multiply(u, F.lit(FAR)), F.lit(TOP)), F.lit(TOP))


def _next_id(m: Column) -> Column:
    """The last id after a message as a function of the last id before it; 0 is none."""
    u = F.greatest(m["u"], F.lit(0))
    old = pieces(piece(u - 1, False, u), piece(_far(u), True, 0), F.when(_far(u) < TOP, piece(TOP, False, u)))
    counted = pieces(piece(0, False, 0), piece(TOP, True, 1))
    return F.when(m["u"].isNull(), counted).when(m["baseline"] | (u == 0), pieces(piece(TOP, False, u))).otherwise(old)


def _block_ids(rows: Column) -> Column:
    """The function of a run of messages, followed as what becomes of none, of low, middling and high last ids.

    Last ids between ``lo`` and ``hi`` are still what they were, plus ``add``. All below have become
    ``left``, which is also the least of those; those above have met a far smaller id, one of ``right``.
    """
    kept = "array<struct<hi:bigint,value:bigint>>"
    long = lambda x: (x if isinstance(x, Column) else F.lit(x)).cast("bigint")
    state = lambda zero, lo, hi, add, left, right: F.struct(
        long(zero).alias("zero"), long(lo).alias("lo"), long(hi).alias("hi"), long(add).alias("add"), long(left).alias("left"),
        right.cast(kept).alias("right"),
    )
    high = lambda hi, value: F.struct(long(hi).alias("hi"), long(value).alias("value"))

    def step(s: Column, entry: Column) -> Column:
        m = entry["row"]
        u = F.greatest(m["u"], F.lit(0))
        counted = lambda v: F.when(v == 0, v).otherwise(v + 1)
        told = lambda v: F.when((v > 0) & (u <= v) & (v <= _far(u)), v).otherwise(u)
        each = lambda f: F.transform(s["right"], lambda r: high(r["hi"], f(r["value"])))
        lo, hi = F.greatest(s["lo"], u - s["add"]), F.least(s["hi"], _far(u) - s["add"])
        none = hi < lo
        more = F.when(~none & (hi < s["hi"]), F.array(high(s["hi"], u))).otherwise(F.array().cast(kept))
        by_id = state(
            told(s["zero"]), F.when(none, s["hi"] + 1).otherwise(lo), F.when(none, s["hi"]).otherwise(hi), s["add"], told(s["left"]),
            F.concat(more, each(told)),
        )
        return (
            F.when(m["u"].isNull(), state(counted(s["zero"]), s["lo"], s["hi"], s["add"] + 1, counted(s["left"]), each(counted)))
            .when(m["baseline"] | (u == 0), state(u, TOP, TOP - 1, 0, u, F.array(high(TOP, u))))
            .otherwise(by_id)
        )

    def finished(s: Column) -> Column:
        low = F.when(s["lo"] > 1, piece(s["lo"] - 1, False, s["left"]))
        middle = F.when(s["hi"] >= s["lo"], piece(s["hi"], True, s["add"]))
        return F.concat(pieces(piece(0, False, s["zero"]), low, middle), F.transform(s["right"], lambda r: piece(r["hi"], False, r["value"])))

    return F.aggregate(rows, state(0, 1, TOP, 0, 0, F.array()), step, finished)


def decided_messages(
    updates: DataFrame, start: DataFrame | None = None, wait: bool = False, min_rows: int | None = None
) -> DataFrame:
    """symbol, seq, at, baseline, applied, last: each message's decision and the last id after it.

    A message without an id is applied and counts the last id up by one, if there is one. An id at or
    below the last one is old, unless it is below a hundredth of it, which is another numbering. A
    message of kind 'baseline' is always applied and sets the id. ``start`` (symbol, u) holds the last
    ids before the first message. With ``wait`` a symbol's messages up to its first baseline follow it if
    their ids are newer, or missing, and are dropped otherwise; without a baseline none is decided. ``at``
    is the place in the order that this makes, ``seq`` but for a first baseline (-1). Ids below zero count
    as zero, which is none.
    """
    baseline = F.coalesce(F.col("kind") == "baseline", F.lit(False)) if "kind" in updates.columns else F.lit(False)
    messages = updates.groupBy("symbol", "seq").agg(F.max("u").alias("u"), F.max(baseline).alias("baseline"))
    like = updates.select("symbol", F.col("seq").alias("at"))
    if wait:
        firsts = messages.filter("baseline").groupBy("symbol").agg(F.min("seq").alias("_b"), F.min_by("u", "seq").alias("_bu"))
        held = F.col("seq") < F.col("_b")
        messages = messages.join(firsts, "symbol").filter(~held | F.col("u").isNull() | (F.col("u") > F.coalesce("_bu", F.lit(0))))
        messages = messages.withColumn("at", F.when(F.col("seq") == F.col("_b"), F.lit(-1)).otherwise(F.col("seq"))).drop("_b", "_bu")
    else:
        messages = messages.withColumn("at", F.col("seq"))
    extra = {} if min_rows is None else {"min_rows": min_rows}
    told = states_before(
        messages, _next_id, start, 0 if start is None else "u", "_last", order=["at"], width=SEQ_WIDTH, like=like, fold=_block_ids, **extra
    )
    u, last = F.greatest("u", F.lit(0)), F.col("_last")
    old = (last > 0) & (u <= last) & (last <= _far(u))
    return told.select(
        "symbol", "seq", "at", "baseline", (F.col("baseline") | F.col("u").isNull() | ~old).alias("applied"),
        applied_to(_next_id(F.struct("u", "baseline")), last).alias("last"),
    )


def _plain_ids(updates: DataFrame) -> bool:
    """Whether the rule is a running maximum for sure: one pre-aggregated scan.

    So it is if all ids are there, none is a baseline's, and none is below a hundredth of an earlier one.
    Ids are compared by runs of messages, each with the largest id up to its end.
    """
    odd = F.col("u").isNull()
    if "kind" in updates.columns:
        odd = odd | F.coalesce(F.col("kind") == "baseline", F.lit(False))
    # Ids that have grown to a hundred times the first one count as odd only within one run.
    run = F.floor(F.log2(F.greatest(F.col("seq") + 2, F.lit(1)).cast("double")) * 4).cast("int")
    ids = updates.groupBy("symbol", run.alias("_run")).agg(F.min("u").alias("lo"), F.max("u").alias("hi"), F.max(odd).alias("odd"))
    top = F.max("hi").over(Window.partitionBy("symbol").orderBy("_run"))
    return not ids.select((F.col("odd") | (_far(F.col("lo")) < top)).alias("odd")).agg(F.max("odd")).first()[0]


def replay_book(
    updates: DataFrame, snapshot: DataFrame | None = None, min_rows: int | None = None, wait: bool = False, resumed: bool = False
) -> DataFrame:
    """Final book levels after applying updates in arrival order.

    ``updates``: symbol, side, pos, price, qty, u, seq (``seq`` the arrival number of the message,
    not negative) and optionally ``kind``: messages of kind 'diff' set levels, a 'baseline' first
    clears the symbol's book, all others just advance the id. ``snapshot``: symbol, side, price, qty, u;
    the book before the first message; messages that come before the first one newer than it, and are not
    newer themselves, are old whatever their numbering, unless the snapshot is ``resumed``, the state that
    earlier messages have left. Which messages are applied says :func:`decided_messages`; where
    all ids are there, growing or old, that is a running maximum, which is cheaper. Each update sets a
    level to an absolute quantity, so the book is the last applied quantity per level, minus zeros. A
    level without a readable price or quantity changes nothing. Updates are read by several jobs and steps:
    keep them first (``session.kept``) where they are dear to make.
    """
    rows, base = _rows_and_base(updates, snapshot)
    if base is not None and not resumed:
        rows = _newer(rows, _ids(snapshot))
    every = rows if base is None else base.unionByName(rows)
    if not wait and _plain_ids(every):
        return _book(current_updates(every, min_rows).withColumn("at", F.col("seq")))
    decided = decided_messages(rows, None if snapshot is None else _ids(snapshot), wait, min_rows)
    return _book(_applied(rows, base, decided, wait))


def replay_onwards(updates: DataFrame, snapshot: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Book and last ids after ``updates`` on the state ``snapshot`` that earlier messages have left.

    As :func:`replay_book` and :func:`last_update_id` give them, but messages are decided once for both. The third
    is those decisions, persisted; the caller unpersists them when both results are written. None if there was
    nothing to decide.
    """
    rows, base = _rows_and_base(updates, snapshot)
    every = base.unionByName(rows)
    if _plain_ids(every):
        book = _book(current_updates(every).withColumn("at", F.col("seq")))
        return book, every.groupBy("symbol").agg(F.max("u").alias("lastUpdateId")), None
    decided = decided_messages(rows, _ids(snapshot)).persist()
    return _book(_applied(rows, base, decided)), _last_ids(decided, snapshot), decided


def _rows_and_base(updates: DataFrame, snapshot: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """Updates and the snapshot's levels, which come before all of them, in the same columns."""
    rows = updates if "kind" in updates.columns else updates.withColumn("kind", F.lit("diff"))
    base = None
    if snapshot is not None:
        base = snapshot.withColumns({"pos": F.lit(0), "seq": F.lit(-1).cast("long"), "kind": F.lit("diff")}).select(*UPDATE)
    return rows.select(*UPDATE), base


def _applied(rows: DataFrame, base: DataFrame | None, decided: DataFrame, wait: bool = False) -> DataFrame:
    """The levels of applied messages from the symbol's last baseline on, with their place ``at``."""
    applied = rows.join(decided.filter("applied").select("symbol", "seq", "at"), ["symbol", "seq"])
    if base is not None:
        applied = applied.unionByName(base.withColumn("at", F.lit(-2).cast("long")))
    # A baseline is always applied, so this needs no decisions; the first one comes first if others wait for it.
    last = F.max("seq")
    if wait:
        last = F.when(last == F.min("seq"), F.lit(-1).cast("long")).otherwise(last)
    cleared = rows.filter(F.col("kind") == "baseline").groupBy("symbol").agg(last.alias("_cleared"))
    return applied.join(cleared, "symbol", "left").filter(F.col("_cleared").isNull() | (F.col("at") >= F.col("_cleared")))


def _book(applied: DataFrame) -> DataFrame:
    """The last quantity of every level, by the place ``at`` of its message, minus zeros."""
    # One sortable number per (message, position) keeps this a hash aggregate with map-side
    # partials. A decimal has room for any two longs, so no arrival number can overflow it.
    turn = F.col("at").cast("decimal(20,0)") * F.lit(2**32).cast("decimal(10,0)") + F.col("pos").cast("decimal(10,0)")
    return (
        applied.filter(F.col("kind").isin("diff", "baseline") & F.col("price").isNotNull() & F.col("qty").isNotNull())
        .groupBy("symbol", "side", "price")
        .agg(F.max_by("qty", turn).alias("qty"))
        .filter(F.col("qty") != 0)
    )


def _newer(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` without those that were held back for a snapshot and are not newer than it."""
    ids = ids.withColumnRenamed("u", "_u")
    starts = rows.join(ids, "symbol").filter(F.col("u") > F.col("_u")).groupBy("symbol").agg(F.min("seq").alias("_start"))
    held = (F.col("u") <= F.col("_u")) & (F.col("_start").isNull() | (F.col("seq") < F.col("_start")))
    told = rows.join(ids.join(starts, "symbol", "left"), "symbol", "left")
    return told.filter(~F.coalesce(held, F.lit(False))).select(*rows.columns)


def _ids(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy("symbol").agg(F.max("u").alias("u"))


def last_update_id(updates: DataFrame, snapshot: DataFrame | None = None, wait: bool = False) -> DataFrame:
    """The last id of every symbol after all updates; of rows without an arrival number, the largest."""
    if "seq" not in updates.columns:
        return updates.groupBy("symbol").agg(F.max("u").alias("lastUpdateId"))
    kind = F.col("kind") if "kind" in updates.columns else F.lit("diff")
    rows = updates.select("symbol", "seq", "u", kind.alias("kind"))
    every = rows
    if snapshot is not None:
        every = snapshot.select("symbol", F.lit(-1).cast("long").alias("seq"), "u", F.lit("diff").alias("kind")).unionByName(rows)
    if not wait and _plain_ids(every):
        return every.groupBy("symbol").agg(F.max("u").alias("lastUpdateId"))
    return _last_ids(decided_messages(rows, None if snapshot is None else _ids(snapshot), wait), snapshot)


def _last_ids(decided: DataFrame, snapshot: DataFrame | None) -> DataFrame:
    """The id after each symbol's last message; that of the snapshot where there was none."""
    after = decided.groupBy("symbol").agg(F.max_by("last", "at").alias("lastUpdateId"))
    if snapshot is None:
        return after
    before = _ids(snapshot).join(after, "symbol", "left_anti").withColumnRenamed("u", "lastUpdateId")
    return after.unionByName(before)


def _best_first():
    """Bids from the highest price, asks from the lowest."""
    return F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))


def top_levels(book: DataFrame, limit: int = 100) -> DataFrame:
    return first_per_key(book, ["symbol", "side"], [_best_first().asc()], limit)


def depth_cumulative(book: DataFrame, limit: int = 20) -> DataFrame:
    """Best ``limit`` levels per side with the running sum of qty x price away from the touch."""
    if not 1 <= limit <= 100:
        raise ValueError("limit must be between 1 and 100")
    w = Window.partitionBy("symbol", "side").orderBy("_best")
    return (
        book.withColumn("_best", _best_first())
        .withColumn("level", F.row_number().over(w))
        .filter(F.col("level") <= limit)
        .withColumn(
            "total",
            F.sum(F.col("qty") * F.col("price")).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .select("symbol", "side", "level", "price", F.col("qty").alias("quantity"), "total")
    )


def depth_share(depth: DataFrame) -> DataFrame:
    """Each level's total as a share of the largest total over both sides, in percent."""
    top = F.max("total").over(Window.partitionBy("symbol"))
    return depth.withColumn("share", F.try_divide("total", top) * 100)


def mid_price(book: DataFrame) -> DataFrame:
    """Middle of the best quotes; with one side only, that side's best."""
    best_bid = F.max(F.when(F.col("side") == "bid", F.col("price")))
    best_ask = F.min(F.when(F.col("side") == "ask", F.col("price")))
    return book.groupBy("symbol").agg(best_bid.alias("best_bid"), best_ask.alias("best_ask")).select(
        "symbol",
        "best_bid",
        "best_ask",
        F.coalesce((F.col("best_bid") + F.col("best_ask")) / 2, "best_bid", "best_ask").alias("mid_price"),
    )


def book_payload(book: DataFrame, ids: DataFrame, limit: int = 100) -> DataFrame:
    """Served book per symbol: best levels of both sides and the last update id."""
    def side(name):
        level = F.when(F.col("side") == name, F.struct("_best", "price", "qty"))
        return F.transform(
            F.array_sort(F.collect_list(level)), lambda l: F.struct(l["price"], l["qty"])
        )

    # Bounded groups: at most 2 x limit levels per symbol.
    return (
        top_levels(book, limit)
        .withColumn("_best", _best_first())
        .groupBy("symbol")
        .agg(side("bid").alias("bids"), side("ask").alias("asks"))
        .join(ids, "symbol")
        .select("symbol", "lastUpdateId", "bids", "asks")
    )


def throttle(emissions: DataFrame, every_ms: int = 100, time: str = "time", seq: Sequence[str] = ("seq",)) -> DataFrame:
    """Last emission per symbol and interval: the batch form of the write limit."""
    slot = F.col(time) - F.pmod(F.col(time), F.lit(every_ms))
    order = [F.col(time).desc(), *[F.col(c).desc() for c in seq]]
    return first_per_key(emissions.withColumn("slot", slot), ["symbol", "slot"], order)


def limit_rate(
    emissions: DataFrame, every_ms: int = 100, force_ms: int | None = 1000, time: str = "time", seq: Sequence[str] = ("seq",),
    width: int = DAY_MS, min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Emissions at least ``every_ms`` after the last one, as a publisher decides them one by one.

    A second clock, which starts at a symbol's first row, lets one more through whenever ``force_ms``
    have passed since the last one it let through; ``None`` leaves it out. The first clock does not see
    those of the second, so the two are one chain after the other. ``time`` and ``seq`` are a total order.

    Each row points at the first one a clock's interval later. What a slice makes of the last due time before
    it depends on the row it is entered at, one of those within the interval of its start; doubled pointers lead
    from each to the last one of the slice. These functions are followed slice by slice per symbol, first for
    the one clock, then, over the rows that it leaves, for the other; every slice is then walked once
    from its own entries. Slices have a bounded number of rows.
    """
    order, keys, columns = [time, *seq], ["symbol"], emissions.columns
    in_slice = [*keys, SLICE]
    cut = with_slices(emissions, keys, time, width, min_rows, True, emissions.select("symbol", *order), second_of(emissions, order))
    told = cut.select(*in_slice, F.col(time).cast("bigint").alias("_t"))
    out = f"symbol {dict(emissions.dtypes)['symbol']}, {SLICE} bigint, _f {PIECES}"

    def first(part: pa.Table) -> pa.Table:
        return _function_of(part, np.sort(part.column("_t").to_numpy()), every_ms)

    def second(part: pa.Table) -> pa.Table:
        times = np.sort(part.column("_t").to_numpy())
        return _function_of(part, times[~_due(times, part.column("_x")[0].as_py(), every_ms)], force_ms)

    def walk(part: pa.Table) -> pa.Table:
        part = part.sort_by([(c, "ascending") for c in order])
        times = part.column(time).to_numpy()
        due = _due(times, part.column("_x")[0].as_py(), every_ms)
        if force_ms is not None:
            left = np.flatnonzero(~due)
            due[left[_due(times[left], part.column("_y")[0].as_py(), force_ms)]] = True
        return part.select(columns).filter(pa.array(due))

    before = slice_states(told.groupBy(*in_slice).applyInArrow(first, out), None, LOW + 1, keys)
    if force_ms is not None:
        begin = emissions.groupBy("symbol").agg(F.min(time).alias("_begin"))
        slices = told.join(before, in_slice).groupBy(*in_slice).applyInArrow(second, out)
        before = before.join(slice_states(slices, begin, "_begin", keys).withColumnRenamed("_x", "_y"), in_slice)
    return cut.join(before, in_slice).groupBy(*in_slice).applyInArrow(walk, emissions.schema)


def _pointers(times: np.ndarray, gap: int) -> np.ndarray:
    """For each sorted time the place of the first one at least ``gap`` later."""
    return np.searchsorted(times, times + gap)


def _due(times: np.ndarray, x: int, gap: int) -> np.ndarray:
    """Which of the sorted times are at least ``gap`` after the last one that is due, ``x`` before the first."""
    ahead, due = _pointers(times, gap).tolist(), np.zeros(len(times), bool)
    at = int(np.searchsorted(times, x + gap))
    while at < len(times):
        due[at] = True
        at = ahead[at]
    return due


def _function_of(part: pa.Table, times: np.ndarray, gap: int) -> pa.Table:
    """What a slice of these sorted times makes of the last due time before it, as in ``stepwise.py``."""
    found = []
    if len(times):
        n, ahead = len(times), _pointers(times, gap)
        last = np.where(ahead < n, ahead, np.arange(n))
        while (last[last] != last).any():
            last = last[last]
        entries = np.unique(np.searchsorted(times, np.append(times[times < times[0] + gap], times[0] + gap)))
        entries = entries[entries < n]
        ends = times[last[entries]]
        # Entered up to the time less the gap; neighbours that end alike are one.
        split = np.append(ends[1:] != ends[:-1], True)
        found = [{"hi": int(t - gap), "keep": False, "value": int(e)} for t, e in zip(times[entries][split], ends[split], strict=True)]
    found.append({"hi": TOP, "keep": True, "value": 0})
    return pa.table({"symbol": part.column("symbol")[:1], SLICE: part.column(SLICE)[:1], "_f": pa.array([found], _FUNCTION)})


_FUNCTION = pa.list_(pa.struct([("hi", pa.int64()), ("keep", pa.bool_()), ("value", pa.int64())]))


def changed_only(emissions: DataFrame, value: str = "lastUpdateId", order: Sequence[str] = ("time", "seq"), **series) -> DataFrame:
    """Emissions whose id differs from the previous one; null and zero ids are never emitted.

    An id of null or zero neither passes nor resets the comparison.
    """
    usable = emissions.filter(F.col(value).isNotNull() & (F.col(value) != 0))

    def add(rows, w):
        return rows.withColumn("_prev", F.lag(value).over(w))

    return (
        map_series(usable, add, before=1, order=order, **series)
        .filter(~F.col(value).eqNullSafe(F.col("_prev")))
        .drop("_prev")
    )


def tick_change_pct(trades: DataFrame, order: Sequence[str] = ("time", "tradeId"), **series) -> DataFrame:
    """Change of each trade's price against the symbol's previous trade, if that was positive."""
    def add(rows, w):
        prev = F.lag("price").over(w)
        return rows.withColumn(
            "change_pct", F.when(prev > 0, F.try_divide(F.col("price") - prev, prev) * 100)
        )

    return map_series(trades, add, before=1, order=order, **series)
