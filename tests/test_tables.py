import pytest
from pyspark.sql import functions as F

from tickloom.operators import serving as sv
from tickloom.plans import jobs
from tickloom.schemas import DAY_MS, HOUR_MS, MINUTE_MS
from tickloom.sources import tables as tb

NOW = 1_704_153_600_000  # 2024-01-02


def keyed(spark, rows):
    df = spark.createDataFrame(rows, "symbol string, openTime long, close double, seq long")
    return df.select("symbol", F.lit("1h").alias("interval"), "openTime", "close", "seq")


def closes(df):
    return sorted((r.symbol, r.openTime, r.close) for r in df.collect())


def test_upsert_last_write_wins(spark):
    old = keyed(spark, [("A", 1, 1.0, 0), ("A", 2, 2.0, 0)])
    new = keyed(spark, [("A", 2, 9.0, 1), ("A", 2, 8.0, 2), ("A", 3, 3.0, 1)])
    assert closes(tb.upsert(old, new, arrival="seq")) == [("A", 1, 1.0), ("A", 2, 8.0), ("A", 3, 3.0)]
    report = tb.upsert_report(old, new, values=["close"], arrival="seq").first()
    assert (report.inserted, report.modified, report.skipped) == (1, 1, 1)
    same = tb.upsert_report(old, old, values=["close"]).first()
    assert (same.inserted, same.modified, same.skipped) == (0, 0, 2)


def test_insert_if_absent_first_write_wins(spark):
    old = keyed(spark, [("A", 1, 1.0, 0)])
    new = keyed(spark, [("A", 1, 9.0, 1), ("A", 2, 2.0, 2), ("A", 2, 3.0, 1)])
    assert closes(tb.insert_if_absent(old, new, arrival="seq")) == [("A", 2, 3.0)]


def test_merge_pages_keeps_loaded_rows(spark):
    loaded, page = keyed(spark, [("A", 2, 1.0, 0)]), keyed(spark, [("A", 2, 5.0, 0), ("A", 1, 4.0, 0)])
    assert closes(tb.merge_pages(page, loaded)) == [("A", 1, 4.0), ("A", 2, 1.0)]


def test_copies_of_one_key(spark):
    """A key holding nearly all rows still yields one row."""
    copies = spark.range(20_000).select(
        F.when(F.col("id") < 19_990, "HOT").otherwise(F.concat(F.lit("S"), F.col("id").cast("string"))).alias("symbol"),
        F.lit(1).cast("long").alias("openTime"), F.col("id").cast("double").alias("close"), F.col("id").alias("seq"),
    )
    rows = {r.symbol: r.close for r in tb.dedup_last(copies, ["symbol", "openTime"], "seq").collect()}
    assert len(rows) == 11 and rows["HOT"] == 19_989.0


def candle_rows(spark, times, symbol="A"):
    df = spark.createDataFrame([(symbol, t) for t in times], "symbol string, openTime long")
    c = F.col("openTime").cast("double")
    return df.select(
        "symbol", F.lit("1h").alias("interval"), "openTime", (F.col("openTime") + 1).alias("closeTime"),
        *[c.alias(n) for n in ("open", "high", "low", "close", "volume", "quoteVolume")], F.lit(1).alias("trades"),
    )


def test_partitioned_table_upsert_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "candles")
    first = candle_rows(spark, [NOW, NOW + HOUR_MS, NOW + DAY_MS])
    tb.write_candles(first, path)
    untouched = {p.name for p in (tmp_path / "candles/interval=1h/date=2024-01-03").iterdir()}
    tb.upsert_into(spark, path, candle_rows(spark, [NOW, NOW + 2 * HOUR_MS]).withColumn("close", F.lit(-1.0)))
    got = {r.openTime: r.close for r in tb.read_candles(spark, path).collect()}
    assert got == {NOW: -1.0, NOW + HOUR_MS: NOW + HOUR_MS, NOW + 2 * HOUR_MS: -1.0, NOW + DAY_MS: NOW + DAY_MS}
    assert {p.name for p in (tmp_path / "candles/interval=1h/date=2024-01-03").iterdir()} == untouched


def test_scan_bounds(spark):
    df = candle_rows(spark, [1, 2, 3])
    assert tb.scan_candles(df, ["A"], "1h", 1, 3).count() == 2
    assert tb.scan_candles(df, ["A"], "1h", 1, 3, end_inclusive=True).count() == 3
    assert tb.scan_candles(df, start=2).count() == 2
    assert tb.scan_candles(df, ["B"]).count() == 0


def test_normalize(spark):
    raw = spark.createDataFrame([("A", "12", "x", "1.5")], "symbol string, openTime string, open string, close string")
    row = tb.normalize_candles(raw).first()
    assert (row.openTime, row.open, row.close) == (12, None, 1.5)


def test_recent_or_latest_k(spark):
    times = [NOW - i * 5 * MINUTE_MS for i in range(60)]
    df = candle_rows(spark, times).unionByName(candle_rows(spark, [1, 2], "OLD"))
    recent = tb.recent_or_latest_k(df, NOW, 40)
    assert recent.count() == 41 and recent.filter("symbol = 'OLD'").count() == 0
    fallback = tb.recent_or_latest_k(df, NOW + DAY_MS, 40)
    assert fallback.filter("symbol = 'A'").count() == 40 and fallback.filter("symbol = 'OLD'").count() == 2


def test_latest_view_expires(spark):
    df = keyed(spark, [("A", 10, 1.0, 0), ("A", 20, 2.0, 1), ("B", 5, 3.0, 2)])
    view = tb.latest_view(df, ["symbol"], ["openTime"], 10)
    assert closes(tb.alive(view, 15)) == [("A", 20, 2.0)]
    assert tb.alive(view, 30).count() == 0


def test_cache_or_history(spark):
    cols = "symbol string, prediction_time string, p double"
    history = spark.createDataFrame([("A", "1", 1.0), ("A", "2", 2.0), ("B", "1", 3.0)], cols)
    cache = spark.createDataFrame([("A", "1", 9.0, 100), ("B", "0", 8.0, 10)], cols + ", expires_at long")
    got = {r.symbol: (r.p, r.source) for r in tb.cache_or_history(cache, history, 50).collect()}
    assert got == {"A": (9.0, "cache"), "B": (3.0, "history")}


def test_completeness_and_gaps(spark):
    df = candle_rows(spark, [0, HOUR_MS, 4 * HOUR_MS])
    targets = spark.createDataFrame([("A",), ("NONE",)], "symbol string")
    rows = {r.symbol: r for r in tb.completeness(df, "1h", 0, 5 * HOUR_MS, targets=targets).collect()}
    assert (rows["A"].fetched, rows["A"].missing, rows["A"].incomplete) == (3, 2, True)
    assert rows["NONE"].missing == 5 and rows["NONE"].incomplete
    assert not tb.completeness(df, "1h", 0, 2 * HOUR_MS).first().incomplete
    assert [tuple(r) for r in tb.gaps(df, "1h").collect()] == [("A", 2 * HOUR_MS, 4 * HOUR_MS, 2)]
    assert tb.gaps(df, "1h", min_rows=1, width=HOUR_MS).count() == 1


def test_resume_and_pages(spark):
    stored = candle_rows(spark, [NOW - DAY_MS * 3]).unionByName(
        candle_rows(spark, [NOW - DAY_MS * 3]).withColumn("interval", F.lit("1m"))
    )
    targets = spark.createDataFrame([("A", "1h"), ("A", "1m"), ("B", "1d")], "symbol string, interval string")
    points = tb.resume_point(stored, targets, NOW)
    got = {(r.symbol, r.interval): r.start for r in points.collect()}
    assert got == {
        ("A", "1h"): NOW - 3 * DAY_MS + 1, ("A", "1m"): NOW - DAY_MS, ("B", "1d"): NOW - 365 * DAY_MS,
    }
    pages = tb.plan_ranges(points).orderBy("symbol", "interval", "page_start").collect()
    minute = [(r.page_start, r.page_end) for r in pages if r.interval == "1m"]
    assert minute == [(NOW - DAY_MS, NOW - DAY_MS + 60_000_000), (NOW - DAY_MS + 60_000_000, NOW)]
    four = spark.createDataFrame([("A", "4h", 0, 3_600_000_001)], "symbol string, interval string, start long, end long")
    assert tb.plan_ranges(four).count() == 2  # an unlisted interval pages by the hour


def test_duplicate_keys(spark):
    df = keyed(spark, [("A", 1, 1.0, 0), ("A", 1, 2.0, 1), ("B", 1, 2.0, 1)])
    assert [tuple(r) for r in tb.duplicate_keys(df).collect()] == [("A", "1h", 1, 2)]


def test_serving_queries(spark):
    df = candle_rows(spark, list(range(1, 11))).withColumn("x", F.col("openTime") != 9)
    times = lambda q: [r.openTime for r in q.collect()]
    assert times(sv.ohlc_query(df, "A", "1h", 2, 8, 3)) == [6, 7, 8]
    assert times(sv.candles_before(df, "A", 5, 2)) == [3, 4]
    assert times(sv.candles_until(df, "A", 8, 3)) == [1, 2, 3]
    assert times(sv.candles_until(df, "A", 9, 2, keep="newest")) == [7, 8]
    assert times(sv.latest_candles(df, "A", 3)) == [7, 8, 10]
    assert times(sv.latest_candle(df, "A")) == [10]
    assert sv.latest_candle(df, "NONE").count() == 0
    point = sv.chart_point(df).orderBy("openTime").first()
    assert point.y == [1.0, 1.0, 1.0, 1.0]
    with pytest.raises(ValueError):
        sv.ohlc_query(df, "A", "1h", limit=2001)


def test_live_list(spark):
    rows = [("A", 1, 1.0, 0), ("A", 3, 3.0, 1), ("A", 2, 2.0, 2), ("A", 3, 4.0, 3), ("A", 2, 2.5, 4)]
    df = keyed(spark, rows).drop("interval")
    assert closes(sv.merge_live(df, "seq")) == [("A", 1, 1.0), ("A", 2, 2.5), ("A", 3, 4.0)]
    assert closes(sv.merge_live(df, "seq", keep=2)) == [("A", 2, 2.5), ("A", 3, 4.0)]
    assert closes(sv.merge_live(df, "seq", drop_late=True)) == [("A", 1, 1.0), ("A", 3, 4.0)]
    assert closes(sv.merge_live(df, "seq", drop_late=True, min_rows=1, cut=True)) == [("A", 1, 1.0), ("A", 3, 4.0)]


def test_resync_cache(spark):
    cols = "symbol string, openTime long, close double, predicted_price double, predicted_change_pct double, direction string, prediction_time string, target_time string"
    history = spark.createDataFrame(
        [("A", 1, 1.0, 1.1, -2.0, "DOWN", "t1", "x"), ("A", 2, 2.0, 2.1, 3.0, "UP", "t2", "y")], cols
    )
    row = jobs.resync_cache(history, 1000).first()
    assert (row.current_price, row.confidence_score, row.expires_at) == (2.0, 3.0, 301_000)
    summary = sv.prediction_summary(history).first()
    assert (summary.up_count, summary.down_pct, summary.max_loss) == (1, 50.0, -2.0)
    assert sv.prediction_summary(history.limit(0)).first().up_pct is None
