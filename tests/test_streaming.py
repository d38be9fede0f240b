"""Streams over several micro-batches must equal the batch operators on the same rows."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from test_book import LEVELS, fold, random_updates

from tickloom.operators.ranking import ranking
from tickloom.operators.serving import retain_last
from tickloom.schemas import DAY_MS, MINUTE_MS
from tickloom.sources import messages as ms
from tickloom.sources import streams as st
from tickloom.streaming import books as sb
from tickloom.streaming import rankings as sr
from tickloom.streaming import stores as ss
from tickloom.streaming.run import drain, publish_with_retry, start
from tickloom.streaming.state import StateTable

T0 = 1_704_067_200_000


def json_files(folder, batches):
    """One file per batch, older files first, so that one file is one micro-batch."""
    folder.mkdir()
    for i, batch in enumerate(batches):
        path = folder / f"{i:03}.json"
        path.write_text("\n".join(json.dumps(m) for m in batch))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


def klines(seed, n=300, batches=4):
    rng, out, t = random.Random(seed), [], T0
    for i in range(n):
        t += rng.choice([0, 20_000, 60_000])
        out.append(
            {"s": rng.choice(["A", "A", "A", "B"]), "i": "1m", "t": t, "T": t + 59_999, "o": "1", "h": "1", "l": "1",
             "c": str(rng.randint(1, 99)), "v": "1", "q": str(rng.randint(1, 9)), "n": i, "x": rng.random() < 0.9}
        )
    size = n // batches
    return [out[i * size:(i + 1) * size] for i in range(batches)]


def as_rows(df, *cols):
    return sorted(map(str, df.select(*cols).collect()))


RANKED = ["symbol", "price", "percent_change", "volume", "timestamp"]


def test_top_gainers_over_batches(spark, tmp_path):
    folder = json_files(tmp_path / "in", klines(1))
    parsed = ms.parse_klines(st.file_messages(spark, folder, 1))
    q, served = sr.top_gainers_job(parsed, str(tmp_path / "out"), horizon_ms=None)
    drain(q)
    assert len(q.recentProgress) >= 4
    batch = ms.valid_tick(ms.closed_only(ms.parse_klines(spark.read.text(folder))))
    assert as_rows(served.read(), *RANKED) == as_rows(ranking(batch, horizon_ms=None), *RANKED)


def test_top_gainers_with_horizon(spark, tmp_path):
    folder = json_files(tmp_path / "in", klines(2))
    parsed = ms.parse_klines(st.file_messages(spark, folder, 1))
    horizon = 30 * MINUTE_MS
    q, served = sr.top_gainers_job(parsed, str(tmp_path / "out"), horizon_ms=horizon)
    drain(q)
    batch = ms.valid_tick(ms.closed_only(ms.parse_klines(spark.read.text(folder))))
    assert as_rows(served.read(), *RANKED) == as_rows(ranking(batch, horizon_ms=horizon), *RANKED)
    left = {p.name for p in (tmp_path / "out/ranking").iterdir() if p.name.startswith("batch=")}
    assert len(left) <= 2  # the newest, and the one a replay would start from


def test_late_rows_are_dropped(spark, tmp_path):
    def k(t, close):
        return {"s": "A", "t": t, "c": close, "q": "1", "x": True}

    # Spark judges lateness by the watermark that the batch before the last one reached.
    folder = json_files(
        tmp_path / "in",
        [
            [k(T0, "1")],
            [k(T0 + 10 * MINUTE_MS, "2")],
            [k(T0 + 10 * MINUTE_MS + 1, "2")],
            [k(T0 + 1, "9"), k(T0 + 9 * MINUTE_MS, "3")],
        ],
    )
    closes = sr.stream_window_close(ms.parse_klines(st.file_messages(spark, folder, 1)))
    rows = []
    drain(start(closes, lambda b, i: rows.extend(b.collect()), "update"))
    got = {(r.window_start, r.close_price) for r in rows}
    assert (T0, 1.0) in got and (T0 + 9 * MINUTE_MS, 3.0) in got and (T0, 9.0) not in got


def test_candle_store(spark, tmp_path):
    batches = klines(3)
    folder = json_files(tmp_path / "in", batches)
    raw = st.file_messages(spark, folder, 1).withColumn("seq", F.get_json_object("value", "$.n").cast("long"))
    q, candles, latest = ss.candle_store_job(ms.parse_klines(raw, keep=["seq"]), str(tmp_path / "out"), None, DAY_MS)
    drain(q)
    want, last = {}, {}
    for m in (m for b in batches for m in b if m["x"]):
        want[(m["s"], m["t"])] = float(m["c"])
        last[m["s"]] = m["n"]
    assert {(r.symbol, r.openTime): r.close for r in candles.read().collect()} == want
    assert {r.symbol: r.seq for r in latest.read().collect()} == last


def test_live_candles(spark, tmp_path):
    batches = klines(4)
    folder = json_files(tmp_path / "in", batches)
    raw = st.file_messages(spark, folder, 1).withColumn("seq", F.get_json_object("value", "$.n").cast("long"))
    q, table = ss.live_candles_job(ms.parse_klines(raw, keep=["seq"]), str(tmp_path / "out"), keep=20)
    drain(q)
    want = {}
    for m in (m for b in batches for m in b):
        want.setdefault(m["s"], {})[m["t"]] = float(m["c"])
    want = {(s, t): c for s, d in want.items() for t, c in sorted(d.items())[-20:]}
    assert {(r.symbol, r.openTime): r.close for r in table.read().collect()} == want


def test_trade_tape(spark, tmp_path):
    rng = random.Random(6)
    trades = [
        {"s": rng.choice("AAAB"), "p": str(i), "q": "1", "T": T0 + rng.randint(0, 500), "t": i, "m": False} for i in range(400)
    ]
    folder = json_files(tmp_path / "in", [trades[i:i + 100] for i in range(0, 400, 100)])
    q, tape = ss.trade_tape_job(ms.parse_trades(st.file_messages(spark, folder, 1)), str(tmp_path / "out"), 30)
    drain(q)
    batch = retain_last(ms.parse_trades(spark.read.text(folder)), 30)
    assert as_rows(tape.read(), "symbol", "time", "tradeId") == as_rows(batch, "symbol", "time", "tradeId")
    assert ss.live_tape(tape.read(), T0 + DAY_MS).count() == 0
    assert ss.live_tape(tape.read(), T0 + 600).count() == 60


def test_book_over_batches(spark, tmp_path):
    rows = random_updates(9, 200)
    snapshot = [("HOT", "bid", float(p), 3.0, 20) for p in range(1, 20)]
    folder = tmp_path / "in"
    for i in range(4):
        part = [r for r in rows if r[6] % 200 // 50 == i]
        spark.createDataFrame(part, LEVELS).coalesce(1).write.mode("append").parquet(str(folder))
    # Files are read one per batch, oldest first.
    updates = st.parquet_stream(spark, str(folder), LEVELS, "*.parquet", 1)
    base = spark.createDataFrame(snapshot, "symbol string, side string, price double, qty double, u long")
    q, books, ids = sb.book_job(updates, str(tmp_path / "out"), base)
    drain(q)
    assert len([p for p in q.recentProgress if p["numInputRows"]]) >= 4
    assert sorted(tuple(r) for r in books.read().collect()) == fold(rows, snapshot)
    assert {r.symbol: r.lastUpdateId for r in ids.read().collect()} == {
        s: max(r[5] for r in rows if r[0] == s) for s in ("HOT", "B")
    }


def test_changed_only_across_batches(spark, tmp_path):
    rows = [{"symbol": "A", "time": T0 + i, "seq": i, "lastUpdateId": v} for i, v in enumerate([5, 5, 6, 0, 6, 6, 7, 7])]
    folder = json_files(tmp_path / "in", [rows[:2], rows[2:4], rows[4:6], rows[6:]])
    stream = st.file_messages(spark, folder, 1).select(
        F.inline(F.array(F.from_json("value", "symbol string, time long, seq long, lastUpdateId long")))
    )
    q, out, _ = ss.changed_only_job(stream, str(tmp_path / "out"))
    drain(q)
    assert sorted(r.seq for r in out.read().collect()) == [0, 2, 6]


def test_csv_ticks(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("timestamp,ticker,price,volume\n2025-01-01 00:00:01,X,1.5,2\n2025-01-01 00:00:02,X,2.5,2\nbad,Y,9,1\n")
    latest = sr.stream_latest_ticker(st.csv_tick_stream(spark, str(folder)))
    schema = "ticker STRING, latest_price DOUBLE, updated_at TIMESTAMP"
    q, table = sr.complete_job(latest, str(tmp_path / "out"), schema)
    drain(q)
    assert {r.ticker: r.latest_price for r in table.read().collect()} == {"X": 2.5, "Y": None}


def test_state_table_replay_and_empty_parts(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "t"), "k LONG, v LONG", F.col("k"))
    rows = lambda *r: spark.createDataFrame(list(r), "k long, v long")
    assert table.read().count() == 0
    table.merge(rows((1, 1), (2, 1)), 0, lambda old, new: old.unionByName(new))
    for _ in range(2):  # a replay of batch 1 starts from batch 0 again
        table.merge(rows((1, 5)), 1, lambda old, new: old.unionByName(new))
        assert sorted(map(tuple, table.read().collect())) == [(1, 1), (1, 5), (2, 1)]
    table.write(rows((1, 9)).limit(0), 2, [1])
    assert sorted(map(tuple, table.read().collect())) == [(2, 1)]
    table.prune(2)
    assert sorted(map(tuple, table.read(2).collect())) == [(1, 1), (1, 5), (2, 1)]
    # An unfinished batch does not count.
    rows((2, 7)).withColumn("part", F.lit(2)).write.partitionBy("part").parquet(str(tmp_path / "t/batch=3"))
    assert sorted(map(tuple, table.read().collect())) == [(2, 1)]


def test_publish_with_retry(spark):
    calls = []

    def flaky(batch, batch_id):
        calls.append(batch_id)
        if len(calls) < 3:
            raise OSError("down")

    full = spark.range(1)
    publish_with_retry(flaky, delay_s=0)(full, 4)
    assert calls == [4, 4, 4]
    publish_with_retry(flaky, delay_s=0)(full.limit(0), 5)
    assert len(calls) == 3

    def broken(batch, batch_id):
        raise OSError("gone")

    with pytest.raises(OSError):
        publish_with_retry(broken, delay_s=0)(full, 1)


def sequential_book(messages, every=100, force=1000):
    """The sequential rule with its two escapes; returns (time, id, levels per side) published."""
    book, last, pushed, forced, out = {"b": {}, "a": {}}, 0, 0, messages[0]["received_at"], []
    for m in messages:
        u = m.get("u")
        if not any(m.get(k) for k in ("b", "a", "bids", "asks")):
            continue
        if u is not None and last > 0 and not u / last < 0.01 and u <= last:
            continue
        before = (len(book["b"]), len(book["a"]), last)
        for side in ("b", "a"):
            for price, qty in [x for x in m.get(side) or [] if len(x) == 2 and x[0] != "broken"]:
                if float(qty) == 0:
                    book[side].pop(price, None)
                else:
                    book[side][price] = float(qty)
        if u is not None:
            last = u
        elif last:
            last += 1
        if (len(book["b"]), len(book["a"]), last) == before:
            continue
        now = m["received_at"]
        if now - pushed >= every:
            pushed = now
        elif now - forced >= force:
            forced = now
        else:
            continue
        if book["b"] and book["a"]:
            out.append((now, last, len(book["b"]), len(book["a"])))
    return out


def published(spark, tmp_path, emitted):
    q = (
        emitted.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    drain(q)
    return spark.read.parquet(str(tmp_path / "out")).orderBy("time").collect()


def test_stateful_book_with_escapes(spark, tmp_path):
    rng, t, messages = random.Random(11), T0, []
    for i in range(160):
        t += rng.choice([10, 60, 130])
        levels = [[str(rng.randint(1, 9)), str(rng.choice([0, 1, 2]))], ["broken", "1"], ["7"]]
        asks = [[str(rng.randint(10, 12)), str(rng.choice([0, 1]))]] if rng.random() < 0.4 else []
        m = {"s": "A", "received_at": t, "b": levels, "a": asks}
        kind = rng.random()
        if kind < 0.6:
            m["u"] = 100_000 + i * 3 + rng.randint(-9, 9)
        elif kind < 0.7:
            m["u"] = rng.randint(1, 500)  # another numbering
        elif kind < 0.8:
            m = {"s": "A", "received_at": t, "lastUpdateId": 100_000 + i * 3, "bids": [["1", "1"]], "asks": [["2", "1"]]}
        messages.append(m)
    plain = [{**m, "u": m.get("u", m.get("lastUpdateId"))} for m in messages]
    folder = json_files(tmp_path / "in", [messages[:80], messages[80:]])
    raw = st.file_messages(spark, folder, 1).withColumn("seq", F.get_json_object("value", "$.received_at").cast("long"))
    emitted = sb.stateful_books(ms.read_depth(raw, keep=["seq"]))
    got = [(r.time, r.lastUpdateId, len(r.bids), len(r.asks)) for r in published(spark, tmp_path, emitted)]
    want = sequential_book(plain)
    assert got == want and 0 < len(want) < len(messages)


DEPTH_ROW = "symbol string, seq long, u long, kind string, bids array<array<string>>, asks array<array<string>>, received_at long"


def test_books_wait_for_their_baseline(spark, tmp_path):
    def m(seq, u, kind, bid, ask, symbol="A"):
        level = lambda p: [] if p is None else [[str(p), "1"]]
        return (symbol, seq, u, kind, level(bid), level(ask), T0 + 1000 * seq)

    batches = [
        [m(1, 10, "diff", 1, None), m(2, 20, "diff", 2, 8)],  # held back
        [m(3, 15, "baseline", 5, 9), m(4, 25, "diff", 3, None), m(5, 24, "diff", 4, None)],  # 24 is stale
        [m(6, 26, "snapshot", 7, 7), m(7, 30, "baseline", 6, 6), m(1, 5, "diff", 1, 2, "B")],
    ]
    for rows in batches:
        spark.createDataFrame(rows, DEPTH_ROW).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = st.parquet_stream(spark, str(tmp_path / "in"), DEPTH_ROW, "*.parquet", 1)
    got = published(spark, tmp_path, sb.stateful_books(stream, every_ms=0, wait=True))
    # In arrival order: the baseline, what was held back and is newer, then the rest.
    assert sorted((r.lastUpdateId, [p for p, _ in r.bids], [p for p, _ in r.asks]) for r in got if r.symbol == "A") == [
        (15, [5.0], [9.0]), (20, [5.0, 2.0], [8.0, 9.0]), (25, [5.0, 3.0, 2.0], [8.0, 9.0]),
        (26, [5.0, 3.0, 2.0], [8.0, 9.0]), (30, [6.0], [6.0]),
    ]
    assert not [r for r in got if r.symbol == "B"]


def folders(path):
    return sorted(p.name for p in path.iterdir() if p.name.startswith("batch="))


def test_one_symbol_rewrites_one_part_and_folders_stay_few(spark, tmp_path):
    trade = lambda s, i: {"s": s, "p": "1", "q": "1", "T": T0 + i, "m": True, "t": i}
    symbols = [f"S{i}" for i in range(40)]
    batches = [[trade(s, i) for i, s in enumerate(symbols)]] + [[trade("S7", 100 + i)] for i in range(20)]
    folder = json_files(tmp_path / "in", batches)
    q, tape = ss.trade_tape_job(ms.parse_trades(st.file_messages(spark, folder, 1)), str(tmp_path / "out"), 5)
    drain(q)
    names = folders(tmp_path / "out")
    assert len(names) <= 3 and names[0] == "batch=0"
    newest = tmp_path / "out" / max(names, key=lambda n: int(n.split("=")[1]))
    assert len([p for p in newest.iterdir() if p.name.startswith("part=")]) == 1
    rows = tape.read().groupBy("symbol").count().collect()
    assert {r.symbol: r["count"] for r in rows} == {s: 5 if s == "S7" else 1 for s in symbols}


def test_gains_keep_a_retention(spark, tmp_path):
    rows = [{"symbol": "A", "price": 1.0, "time": T0 + d * DAY_MS} for d in range(6)]
    folder = json_files(tmp_path / "in", [rows[:2], rows[2:4], rows[4:]])
    stream = st.file_messages(spark, folder, 1).select(F.inline(F.array(F.from_json("value", "symbol string, price double, time long"))))
    q, table = sr.gains_job(stream, str(tmp_path / "out"), retention_ms=DAY_MS)
    drain(q)
    assert min(r.window_start for r in table.read().collect()) >= T0 + 3 * DAY_MS
