"""Streams whose tasks hold a bounded number of rows."""

from datetime import datetime, timedelta

import pandas as pd
import pytest

from catalog import QUERIES, flows
from catalog.flows import bounded_batches
from tickloom.operators import book as bk
from tickloom.sources import testdata as td
from tickloom.streaming import books as sb
from tickloom.streaming.run import drain

T0 = 1_704_067_200_000


def test_published_books_are_handed_on_in_parts():
    """A task holds a bounded number of published books, however many a batch makes."""
    class Held:
        def __init__(self):
            self.clock = None

        exists = containsKey = lambda self, *key: False
        iterator = lambda self: iter(())
        update = updateValue = lambda self, *value: None

    books = sb.BookProcessor(every_ms=0)
    books.levels, books.clock, books.held = Held(), Held(), Held()
    n = 5 * sb.EMITTED + 7
    rows = [(i, i + 1, "diff", [["1", "1"]], [["2", str(i + 1)]], T0 + i) for i in reversed(range(n))]
    frame = pd.DataFrame(rows, columns=["seq", "u", "kind", "bids", "asks", "received_at"])
    parts = list(books.handleInputRows(("A",), iter([frame[:700], frame[700:]]), None))
    assert max(map(len, parts)) <= sb.EMITTED and pd.concat(parts).lastUpdateId.tolist() == list(range(1, n + 1))


def test_micro_batches_are_bounded_and_whole(spark, tmp_path):
    rows = [(i * i, None, 1, "a", float(i), '{"k": 1}') for i in range(1000)]
    spark.createDataFrame(rows, td.EVENTS_SCHEMA).write.parquet(str(tmp_path / "events.parquet"))
    sizes, ids = [], []

    def seen(batch, _):
        own = [r.tradeId for r in batch.select("tradeId").collect()]
        sizes.append(len(own))
        assert not ids or min(own) > max(ids)
        ids.extend(own)

    q = bounded_batches(spark, str(tmp_path), most=100).writeStream.foreachBatch(seen)
    drain(q.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    assert sorted(ids) == [i * i for i in range(1000)] and len(sizes) >= 10 and max(sizes) <= 120


def events_of(spark, tmp_path, n=600):
    rows = [(i, datetime(2024, 1, 1) + timedelta(seconds=i), 1, "ab"[i % 2], float(i % 9), f'{{"k": {i * 7 % 100}}}') for i in range(n)]
    spark.createDataFrame(rows, td.EVENTS_SCHEMA).write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["replay_mixed_book", "replay_mixed_book_cut", "replay_ruled_book", "replay_ruled_book_cut"])
def test_updates_are_made_once(spark, tmp_path, name):
    """The steps of a replay read kept levels; no message is parsed in them again."""
    text = optimized(QUERIES[name](spark, events_of(spark, tmp_path)))
    assert "Relation" in text and "from_json" not in text and "to_json" not in text


def test_messages_are_decided_once(spark):
    """The book takes the applied messages and its last baselines from one chain of decisions."""
    rows = [("A", "bid", 0, 1.0, 1.0, i + 5, i, "baseline" if i == 3 else "diff") for i in range(9)]
    df = spark.createDataFrame(rows, "symbol string, side string, pos int, price double, qty double, u long, seq long, kind string")
    once = optimized(bk.decided_messages(df)).count("row_number()")
    assert once and optimized(bk.replay_book(df)).count("row_number()") == once


def test_a_batch_of_messages_is_decided_once_for_book_and_ids(spark, monkeypatch):
    calls = []
    plain, decided = bk._plain_ids, bk.decided_messages
    monkeypatch.setattr(bk, "_plain_ids", lambda *a: calls.append("plain") or plain(*a))
    monkeypatch.setattr(bk, "decided_messages", lambda *a: calls.append("decided") or decided(*a))
    rows = [("A", "bid", 0, 1.0, 2.0, 8, 1, "diff"), ("A", "ask", 0, 3.0, 4.0, None, 2, "diff"), ("A", "ask", 0, 3.0, 9.0, 9, 3, "diff")]
    updates = spark.createDataFrame(rows, "symbol string, side string, pos int, price double, qty double, u long, seq long, kind string")
    book = spark.createDataFrame([("B", "bid", 1.0, 1.0)], sb.BOOK_SCHEMA)
    ids = spark.createDataFrame([("A", 7), ("B", 3)], sb.IDS_SCHEMA)
    after, newest, held = sb.apply_updates(book, ids, updates)
    assert sorted(tuple(r) for r in after.collect()) == [("A", "ask", 3.0, 4.0), ("A", "bid", 1.0, 2.0), ("B", "bid", 1.0, 1.0)]
    assert sorted(tuple(r) for r in newest.collect()) == [("A", 9), ("B", 3)]
    assert calls == ["plain", "decided"] and held.storageLevel.useMemory
    held.unpersist()


def test_large_micro_batches_have_more_files(spark, tmp_path, monkeypatch):
    """Tasks that read a micro-batch grow in number with its rows."""
    monkeypatch.setattr(flows, "FILE_ROWS", 10)
    d = events_of(spark, tmp_path)
    for stream in (flows.tick_batches(spark, d), flows.repeated_batches(spark, d)):
        sizes = []

        def seen(batch, _):
            sizes.append((batch.rdd.getNumPartitions(), batch.count()))

        drain(stream.writeStream.foreachBatch(seen).option("checkpointLocation", str(tmp_path / f"c{stream.columns[-1]}")).trigger(availableNow=True).start())
        assert len(sizes) == 4 and all(150 <= n <= 190 for _, n in sizes) and flows._files(150) == 15


def test_batches_of_repeated_candles_are_written_once(spark, tmp_path, monkeypatch):
    calls = []
    made = flows.repeated_batches
    monkeypatch.setattr(flows, "repeated_batches", lambda *a: calls.append(a) or made(*a))
    out = flows.stream_first_closed_batches(spark, events_of(spark, tmp_path, 200))
    assert len(calls) == 1 and out.where("closes = 1 AND arrivals = 1").count() == sum(i * 7 % 100 >= 10 for i in range(200))
