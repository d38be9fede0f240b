"""Order books from streams of depth messages.

:func:`book_job` is relational: a batch is replayed on the stored book with the batch operator, so
a busy symbol is spread over tasks. :func:`stateful_books` follows one message after the other per
symbol, which can also publish each state of a book and wait for a baseline over several batches. Its
groups are bounded by the source's per-trigger limit.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tickloom.operators.book import FAR, last_update_id, replay_onwards
from tickloom.streaming.run import start, use_rocksdb
from tickloom.streaming.state import StateTable, by_symbol

BOOK_SCHEMA = "symbol STRING, side STRING, price DOUBLE, qty DOUBLE"
IDS_SCHEMA = "symbol STRING, lastUpdateId BIGINT"


def apply_updates(book: DataFrame, ids: DataFrame, updates: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Stored book and last ids plus new diff levels: the book and ids after them, and what to unpersist after use."""
    baseline = ids.select(
        "symbol",
        F.lit("bid").alias("side"),
        F.lit(None).cast("double").alias("price"),
        F.lit(0.0).alias("qty"),
        F.col("lastUpdateId").alias("u"),
    )
    # The empty level carries the id of a symbol whose book has no level left.
    stored = book.join(ids, "symbol").select(
        "symbol", "side", "price", "qty", F.col("lastUpdateId").alias("u")
    )
    snapshot = stored.unionByName(baseline)
    return replay_onwards(updates, snapshot)


def book_job(
    updates: DataFrame,
    base: str,
    snapshot: DataFrame | None = None,
    checkpoint: str | None = None,
    every: str | None = None,
) -> tuple[StreamingQuery, StateTable, StateTable]:
    """Maintain all books. ``updates`` as for ``replay_book``; ``snapshot`` seeds the state once."""
    spark = updates.sparkSession
    books = StateTable(spark, f"{base}/books", BOOK_SCHEMA, by_symbol())
    ids = StateTable(spark, f"{base}/ids", IDS_SCHEMA, by_symbol())
    if snapshot is not None:
        parts = ids.touched(snapshot)
        books.write(snapshot.select("symbol", "side", "price", "qty").filter("qty <> 0"), -1, parts)
        ids.write(last_update_id(snapshot), -1, parts)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        parts = ids.touched(batch)
        book, newest, decided = apply_updates(books.read(batch_id, parts), ids.read(batch_id, parts), batch)
        try:
            books.write(book, batch_id, parts)
            ids.write(newest, batch_id, parts)
        finally:
            if decided is not None:
                decided.unpersist()
        books.prune(batch_id)
        ids.prune(batch_id)

    return start(updates, on_batch, "append", checkpoint, every), books, ids


EMISSION = (
    "symbol STRING, time BIGINT, lastUpdateId BIGINT, "
    "bids ARRAY<STRUCT<price: DOUBLE, qty: DOUBLE>>, asks ARRAY<STRUCT<price: DOUBLE, qty: DOUBLE>>"
)

# Published books that a task holds before it hands them on; one may have hundreds of levels.
EMITTED = 256


class BookProcessor(StatefulProcessor):
    """One symbol's book, message by message, published at a limited rate.

    Input rows: symbol, seq, u, kind, bids, asks, received_at. A message is applied if it has no
    id, if its id is below 1 % of the current one (another numbering), or if its id is above the
    current one. Full-book messages move the id but no level. A change in the number of levels or
    in the id is published at most every ``every_ms``; a second clock lets one more through every
    ``force_ms``. A book with an empty side is not published, though its turn is used up.

    A message of kind 'baseline' replaces the book and sets the id. With ``wait``, messages are held
    back until the first baseline; then those newer than it are applied and the others dropped, as in
    ``decided_messages``, which decides the same for tables.
    """

    def __init__(self, limit: int = 100, every_ms: int = 100, force_ms: int = 1000, wait: bool = False):
        self.limit, self.every_ms, self.force_ms, self.wait = limit, every_ms, force_ms, wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.levels = handle.getMapState("levels", "side string, price double", "qty double")
        self.clock = handle.getValueState("clock", "id long, pushed long, forced long, synced boolean")
        self.held = handle.getListState("held", "message string")

    def _due(self, found: list[_Message], synced: bool) -> tuple[list, bool]:
        """The messages to apply now, in order, and whether a baseline has been seen."""
        first = next((i for i, m in enumerate(found) if m.kind == "baseline"), None)
        if synced or not self.wait:
            return found, synced or first is not None
        if first is None:
            for m in found:
                self.held.appendValue((json.dumps(m),))
            return [], False
        early = [_Message(*json.loads(text)) for (text,) in self.held.get()] if self.held.exists() else []
        self.held.clear()
        baseline = found[first]
        newer = [m for m in [*early, *found[:first]] if m.u is None or m.u > (baseline.u or 0)]
        return [baseline, *newer, *found[first + 1 :]], True

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Frames are taken one by one: only the messages themselves are held, to bring them into order.
        found = [
            _Message(m.seq, _id(m.u), m.kind, _levels(m.bids), _levels(m.asks), int(m.received_at))
            for frame in rows for m in frame.itertuples()
        ]
        found.sort(key=lambda m: (True, 0) if pd.isna(m.seq) else (False, m.seq))
        book = {"bid": {}, "ask": {}}
        for (side, price), (qty,) in self.levels.iterator():
            book[side][price] = qty
        held = self.clock.get() if self.clock.exists() else None
        last, pushed, forced, synced = held or (0, 0, found[0].received_at, False)
        due, synced = self._due(found, synced)
        touched: set[tuple[str, float]] = set()
        columns, out = ["symbol", "time", "lastUpdateId", "bids", "asks"], []
        for m in due:
            baseline = m.kind == "baseline"
            if not (m.bids or m.asks or baseline):
                continue
            if not baseline and m.u is not None and 0 < last and m.u <= last <= FAR * m.u:
                continue
            before = (len(book["bid"]), len(book["ask"]), last)
            if baseline:
                touched |= {(side, price) for side in book for price in book[side]}
                book = {"bid": {}, "ask": {}}
            if baseline or m.kind == "diff":
                for side, levels in (("bid", m.bids), ("ask", m.asks)):
                    touched |= _set_levels(book[side], side, levels)
            if m.u is not None:
                last = m.u
            elif last != 0:
                last += 1
            if (len(book["bid"]), len(book["ask"]), last) == before:
                continue
            now = m.received_at
            if now - pushed >= self.every_ms:
                pushed = now
            elif now - forced >= self.force_ms:
                forced = now
            else:
                continue
            if not (book["bid"] and book["ask"]):
                continue
            out.append((key[0], now, last, self._best(book["bid"], True), self._best(book["ask"], False)))
            if len(out) == EMITTED:
                yield pd.DataFrame(out, columns=columns)
                out = []
        for side, price in touched:
            if price in book[side]:
                self.levels.updateValue((side, price), (book[side][price],))
            elif self.levels.containsKey((side, price)):
                self.levels.removeKey((side, price))
        self.clock.update((last, pushed, forced, synced))
        yield pd.DataFrame(out, columns=columns)

    def _best(self, side: dict[float, float], descending: bool) -> list[dict]:
        prices = sorted(side, reverse=descending)[: self.limit]
        return [{"price": p, "qty": side[p]} for p in prices]

    def close(self) -> None:
        pass


class _Message(NamedTuple):
    seq: int
    u: int | None
    kind: str
    bids: list
    asks: list
    received_at: int


def _id(u) -> int | None:
    return None if pd.isna(u) else int(u)


def _levels(levels) -> list[list[str]]:
    return [] if levels is None else [list(level) for level in levels]


def _number(text) -> float | None:
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def _set_levels(side: dict[float, float], name: str, levels: list[list[str]]) -> set[tuple[str, float]]:
    """Set each level to its quantity, zero removing it; returns the levels touched.

    A level without a readable price or quantity changes nothing.
    """
    touched = set()
    for level in levels:
        price, qty = (_number(x) for x in level[:2]) if len(level) >= 2 else (None, None)
        if price is None or qty is None:
            continue
        touched.add((name, price))
        if qty == 0:
            side.pop(price, None)
        else:
            side[price] = qty
    return touched


def stateful_books(
    messages: DataFrame, limit: int = 100, every_ms: int = 100, force_ms: int = 1000, wait: bool = False
) -> DataFrame:
    """Published books from a stream of ``read_depth`` rows (with ``seq``).

    With ``wait`` a symbol's messages are held back until a row of kind 'baseline' arrives for it.
    """
    use_rocksdb(messages.sparkSession)
    rows = messages.select("symbol", "seq", "u", "kind", "bids", "asks", "received_at")
    return rows.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=BookProcessor(limit, every_ms, force_ms, wait),
        outputStructType=EMISSION,
        outputMode="append",
        timeMode="none",
    )
