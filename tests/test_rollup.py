import math
import random
import struct
import sys
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tickloom.functions import scalars as sc
from tickloom.operators import rollup as ru
from tickloom.plans import jobs
from tickloom.schemas import DAY_MS, HOUR_MS, MINUTE_MS
from tickloom.streaming import rankings as sr

MIDNIGHT = 1_704_067_200_000


def candles(spark, rows):
    cols = "symbol string, openTime long, close double, volume double"
    df = spark.createDataFrame(rows, cols)
    return df.select(
        "symbol", F.lit("1m").alias("interval"), "openTime", (F.col("openTime") + 59_999).alias("closeTime"),
        F.col("close").alias("open"), (F.col("close") + 1).alias("high"), (F.col("close") - 1).alias("low"),
        "close", "volume", (F.col("close") * F.col("volume")).alias("quoteVolume"), F.lit(1).alias("trades"),
    )


@pytest.fixture(scope="module")
def day(spark):
    rows = [("A", MIDNIGHT + i * MINUTE_MS, float(100 + (i * 37) % 50), float(i % 7)) for i in range(2 * 1440)]
    return candles(spark, rows[::-1]).repartition(5).cache()


def key(df):
    return sorted(map(str, df.drop("interval").collect()))


def test_rollups_compose(day):
    direct = ru.rollup_ohlc(day, "1h")
    stepped = ru.rollup_ohlc(ru.rollup_ohlc(day, "5m"), "1h")
    assert key(direct) == key(stepped)
    assert key(ru.rollup_ohlc(direct, "1d")) == key(ru.rollup_ohlc(day, "1d"))


def test_open_and_close_follow_time_not_arrival(spark):
    bars = ru.rollup_ohlc(candles(spark, [("A", MIDNIGHT + 120_000, 3.0, 1.0), ("A", MIDNIGHT, 1.0, 1.0)]), "5m")
    bar = bars.first()
    assert (bar.open, bar.close, bar.openTime, bar.closeTime) == (1.0, 3.0, MIDNIGHT, MIDNIGHT + 179_999)
    assert bar.trades == 2 and bar.quoteVolume == 4.0


def test_bucket_edges(spark):
    df = spark.createDataFrame([(0,), (299_999,), (300_000,), (-1,)], "t long")
    got = [r[0] for r in df.select(sc.bucket_start("t", 300_000)).collect()]
    assert got == [0, 0, 300_000, -300_000]


def test_five_hour_buckets_run_over_midnight(spark):
    start = 5 * HOUR_MS * (MIDNIGHT // (5 * HOUR_MS))
    assert start < MIDNIGHT
    rows = [("A", t, 1.0, 1.0) for t in range(MIDNIGHT - HOUR_MS, MIDNIGHT + 5 * HOUR_MS, HOUR_MS)]
    got = {r.window_start: r.trades for r in ru.rollup_ohlc(candles(spark, rows), "5h").collect()}
    assert sum(got.values()) == 6 and len(got) == 2


@pytest.mark.parametrize(
    "interval,start,end",
    [
        ("5m", (9, 40), (9, 45)), ("1h", (8, 0), (9, 0)), ("4h", (4, 0), (8, 0)), ("5h", (0, 0), (5, 0)),
    ],
)
def test_job_window(interval, start, end):
    now = datetime(2024, 1, 1, 9, 47, 12, 5, tzinfo=timezone.utc)
    got = ru.job_window(now, interval)
    want = [int(now.replace(hour=h, minute=m, second=0, microsecond=0).timestamp() * 1000) for h, m in (start, end)]
    assert list(got) == want


def test_job_window_day():
    assert ru.job_window(datetime(2024, 1, 2, 0, 0, 1, tzinfo=timezone.utc), "1d") == (MIDNIGHT, MIDNIGHT + DAY_MS)


def test_rollup_job_reads_half_open_and_replaces(spark, day):
    now = datetime.fromtimestamp((MIDNIGHT + HOUR_MS + 7 * MINUTE_MS) / 1000, timezone.utc)
    five = jobs.rollup_job(day, "5m", now, symbols=None)
    bar = five.first()
    assert five.count() == 1 and bar.trades == 5 and bar.openTime == MIDNIGHT + HOUR_MS
    stale = five.withColumn("close", F.lit(-1.0))
    assert jobs.rollup_job(day, "5m", now, stale, symbols=None).first().close == bar.close
    assert jobs.rollup_job(day, "5m", now, stale, symbols=None, replace=False).count() == 0
    assert jobs.rollup_job(day, "5m", now).count() == 1  # no list of symbols means all of them


def test_symbol_summary(spark):
    t0 = 1_609_459_200_000
    rows = [
        ("BTCUSDT", 50000.0, 100.5), ("BTCUSDT", 50100.0, 150.2), ("BTCUSDT", 50200.0, 200.3),
        ("ETHUSDT", 3000.0, 500.1), ("ETHUSDT", 3010.0, 600.5), ("ETHUSDT", 3020.0, 700.8),
    ]
    df = spark.createDataFrame([(*r, t0) for r in rows], "symbol string, price double, volume double, timestamp long")
    got = {r.symbol: r for r in ru.symbol_summary(df).collect()}
    assert got["BTCUSDT"].total_volume == pytest.approx(451.0)
    assert got["BTCUSDT"].avg_price == 50100.0
    assert (got["ETHUSDT"].max_price, got["ETHUSDT"].min_price) == (3020.0, 3000.0)


def test_window_close_breaks_ties_by_close_then_volume(spark):
    df = spark.createDataFrame(
        [("A", 10, 5.0, 1.0), ("A", 10, 7.0, 1.0), ("A", 10, 7.0, 2.0), ("A", 9, 99.0, 9.0)],
        "symbol string, openTime long, close double, quoteVolume double",
    )
    row = ru.window_close(df).first()
    assert (row.close_price, row.timestamp, row.volume) == (7.0, 10, 13.0)


def test_scalars(spark):
    df = spark.createDataFrame(
        [("BTCUSDT", 0.0, 5.0, None), ("USDTX", 4.0, 5.0, True), ("ETHUSDT", 4.0, 4.0, False)],
        "symbol string, open double, close double, x boolean",
    )
    got = df.select(
        sc.base_asset().alias("base"), sc.pair_label().alias("label"), sc.candle_change_pct().alias("pct"),
        sc.candle_up().alias("up"), sc.event_type().alias("type"),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("BTC", "BTC/USDT", 0.0, True, "update"),
        ("USDTX", "USDTX", 25.0, True, "realtime"),
        ("ETH", "ETH/USDT", 0.0, True, "update"),
    ]
    iso = spark.range(1).select(sc.utc_iso(F.lit(MIDNIGHT)), sc.utc_iso(F.lit(MIDNIGHT + 7)), sc.utc_text(F.lit(MIDNIGHT)))
    assert tuple(iso.first()) == (
        "2024-01-01T00:00:00+00:00", "2024-01-01T00:00:00.007000+00:00", "2024-01-01 00:00:00",
    )


def test_utc_text_ignores_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert spark.range(1).select(sc.utc_text(F.lit(MIDNIGHT))).first()[0] == "2024-01-01 00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def bits(x):
    """The order of doubles as a whole number."""
    if math.isnan(x):
        return (2047 << 52) + 1
    size = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -size if x < 0 else size


def test_total_order_is_that_of_doubles(spark):
    rng = random.Random(4)
    xs = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    powers = [2.0**e for e in range(-1074, 1024)]
    xs += [s * v for s in (1, -1) for p in powers for v in (p, math.nextafter(p, 0), math.nextafter(p, math.inf))]
    xs += [0.0, -0.0, math.inf, -math.inf, math.nan, sys.float_info.max, 5e-324]
    df = spark.createDataFrame([(x,) for x in [*xs, None]], "x double")
    got = df.select("x", sc.total_order("x").alias("b"), sc.turn(F.lit(2**62 - 1), "x").alias("t")).collect()
    assert all(r.b == bits(r.x) and int(r.t) == (2**62 - 1) * 2**64 + bits(r.x) for r in got if r.x is not None)
    assert [r.b for r in got if r.x is None] == [None] and len(got) == len(xs) + 1


EXTREME = [1e300, math.nextafter(1e300, 0), 5e-324, 1e-310, -1e12, math.nextafter(-1e12, 0), 2e9, 2e9 + 1e-6, 3e9]


def test_window_prices_at_one_time_are_the_extremes(spark):
    """Ties between prices of any size are settled the same way in a batch and in a stream."""
    rows = [("A", 60_000 * w + t, p, p) for w in range(3) for t in (5, 7) for p in EXTREME[w : w + 7]]
    df = spark.createDataFrame(rows, "symbol string, time long, price double, close double").withColumn("openTime", F.col("time"))
    df = df.withColumn("quoteVolume", F.lit(1.0)).repartition(4)
    want = {60_000 * w: (min(EXTREME[w : w + 7]), max(EXTREME[w : w + 7])) for w in range(3)}
    gains = {r.window_start: (r.open_price, r.close_price) for r in ru.window_gain(df).collect()}
    closes = {r.window_start: r.close_price for r in ru.window_close(df).collect()}
    assert gains == want and closes == {w: p[1] for w, p in want.items()}
    stream = sr.stream_window_gain(df.drop("openTime", "close"))  # the same plan over a bounded table
    assert {r.window_start: (r.open_price, r.close_price) for r in stream.collect()} == want


def test_null_prices_are_none(spark):
    df = spark.createDataFrame([("A", 1, 2.0), ("A", 2, None), ("B", 3, None)], "symbol string, time long, price double")
    got = {r.symbol: (r.open_price, r.close_price, r.trade_count) for r in ru.window_gain(df).collect()}
    assert got == {"A": (2.0, 2.0, 2), "B": (None, None, 1)}
