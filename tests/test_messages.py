import json

from pyspark.sql import functions as F

from tickloom.sources import messages as ms
from tickloom.sources.streams import kafka_options


def texts(spark, *messages):
    rows = [(i, m if isinstance(m, str) else json.dumps(m)) for i, m in enumerate(messages)]
    return spark.createDataFrame(rows, "seq long, value string")


def test_klines(spark):
    good = {"s": "A", "i": "5m", "t": 1, "T": 2, "o": "1.5", "h": "2", "l": "1", "c": "1.75", "v": "3", "q": "4", "n": 7, "x": True}
    sparse = {"s": "B", "t": 5, "c": "oops"}
    df = ms.parse_klines(texts(spark, good, "{not json", {"c": "1"}, sparse), keep=["seq"])
    rows = {r.symbol: r for r in df.collect()}
    assert set(rows) == {"A", "B"}
    a, b = rows["A"], rows["B"]
    assert (a.interval, a.openTime, a.closeTime, a.open, a.close, a.trades, a.x) == ("5m", 1, 2, 1.5, 1.75, 7, True)
    assert (b.interval, b.closeTime, b.open, b.close, b.x, b.seq) == ("1m", None, 0.0, None, False, 3)
    assert ms.closed_only(df).count() == 1
    assert [r.symbol for r in ms.valid_tick(df).collect()] == ["A"]


def test_unwrap(spark):
    k = {"s": "A", "t": 1}
    df = texts(spark, {"stream": "a@kline", "data": {"k": k}}, {"k": k}, {"data": {"k": {}}}, {"data": {}})
    out = ms.unwrap_kline(df, keep=["seq"])
    assert sorted(r.seq for r in out.collect()) == [0, 1]


def test_trades(spark):
    df = ms.parse_trades(
        texts(
            spark,
            {"s": "A", "p": "1.5", "q": "2", "T": 9, "t": 4, "m": True, "received_at": 10},
            {"s": "A", "p": "1.5", "received_at": 10},
            {"s": "UNKNOWN", "p": "1"},
            {"p": "1"},
        )
    )
    full, sparse = sorted(df.collect(), key=lambda r: r.time)
    assert tuple(full) == ("A", 1.5, 2.0, 9, True, 4)
    assert tuple(sparse) == ("A", 1.5, 0.0, 10, False, None)


def test_depth(spark):
    diff = {"s": "btcusdt", "u": 5, "b": [["100.10", "1"], ["99"]], "a": [["101", "0"]], "received_at": 3}
    full = {"s": "X", "lastUpdateId": 8, "bids": [["1", "2"]], "asks": []}
    df = ms.parse_depth(texts(spark, diff, full, {"s": ""}, "junk", {"s": "unknown", "b": [["1", "1"]]}))
    rows = sorted(map(tuple, df.collect()))
    assert rows == [
        ("BTCUSDT", "ask", 0, 101.0, 0.0, 5, "diff", 3),
        ("BTCUSDT", "bid", 0, 100.1, 1.0, 5, "diff", 3),
        ("X", "bid", 0, 1.0, 2.0, 8, "snapshot", None),
    ]


def test_snapshot_view(spark):
    full = {"s": "X", "bids": [["10", "2"], ["9"], ["8", "1"]], "asks": [["11", "1"]], "received_at": 4}
    one_sided = {"s": "X", "bids": [["10", "2"]], "asks": []}
    rows = ms.snapshot_view(texts(spark, full, one_sided, {"s": "X", "b": [["1", "1"]]})).collect()
    assert len(rows) == 1
    assert [tuple(l) for l in rows[0].bids] == [(10.0, 2.0, 20.0), (8.0, 1.0, 28.0)]
    limited = ms.snapshot_view(texts(spark, full), limit=1).first()
    assert len(limited.bids) == 1


def test_route(spark):
    df = texts(
        spark,
        {"stream": "btcusdt@depth@1000ms", "data": {"s": "btcusdt", "u": 1, "b": [["1", "2"]]}},
        {"stream": "btcusdt@trade", "data": {"s": "btcusdt", "p": "1"}},
        {"stream": "btcusdt@trade", "data": {"p": "1"}},
        {"stream": "btcusdt@ticker", "data": {"s": "btcusdt"}},
    )
    rows = {r.route: r for r in ms.route(df, F.lit(77)).collect()}
    assert set(rows) == {"orderbook", "trades"}
    value = json.loads(rows["orderbook"].value)
    assert value == {"s": "btcusdt", "u": 1, "b": [["1", "2"]], "stream": "btcusdt@depth@1000ms", "received_at": 77}
    assert rows["trades"].key == "BTCUSDT"


def test_rest_klines(spark):
    raw = spark.createDataFrame(
        [("A", "1h", '[1704067200000,"1","2","0.5","1.5","10",1704070799999,"15",3,"x"]'), ("A", "1h", "[1]")],
        "symbol string, interval string, value string",
    )
    row = ms.decode_rest_klines(raw).first()
    assert (row.openTime, row.open, row.high, row.low, row.close) == (1704067200000, 1.0, 2.0, 0.5, 1.5)
    assert (row.volume, row.quoteVolume, row.trades) == (10.0, 15.0, 3)
    assert row.openTimeISO == "2024-01-01T00:00:00+00:00"
    assert row.closeTimeISO == "2024-01-01T00:59:59.999000+00:00"


def test_prices(spark):
    df = ms.parse_prices(texts(spark, {"symbol": "A", "price": 1.5, "quantity": 2, "event_time": 3}, "x"))
    assert [tuple(r) for r in df.collect()] == [("A", 1.5, 2.0, 3)]


def test_kafka_options():
    assert kafka_options("b:9092", "t") == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "t", "startingOffsets": "latest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "1000",
    }


def test_routed_streams_are_escaped(spark):
    stream = 'a"b\\@trade'
    df = spark.createDataFrame([(json.dumps({"stream": stream, "data": {"s": "x"}}),)], "value string")
    row = ms.route(df, F.lit(1)).first()
    assert json.loads(row.value) == {"s": "x", "stream": stream, "received_at": 1}
