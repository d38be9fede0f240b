"""End-to-end jobs over candles built from the events table."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from catalog.bars import BAR_SQL, tick_bars
from catalog.base import CANDLES, LAST_DAY, aligned_cte, bars_cte, r, register, rounded
from catalog.forecasts import PREDICTION, PUBLISHED, ROUNDED, RUN_TIME, predictions_cte
from catalog.indicators import MACD, MACD_COLS, RSI, RSI_STEPS, _LOW, _UP, feature_sql, rows
from tickloom.operators.ml import split_random
from tickloom.operators.rollup import job_window
from tickloom.plans import jobs
from tickloom.schemas import DAY_MS, HOUR_MS
from tickloom.session import run_dir
from tickloom.sources import streams as st
from tickloom.sources import testdata as td
from tickloom.streaming import rankings as sr
from tickloom.streaming.run import drain

NOW = datetime(2024, 1, 20, 9, 47, tzinfo=timezone.utc)
HOURS = "WITH" + CANDLES + bars_cte("h1", "candles", HOUR_MS, "seq")


def _last_window(interval):
    start, end = job_window(NOW, interval)
    sql = (
        HOURS + f', w AS (SELECT * FROM h1 WHERE "openTime" >= {start} AND "openTime" < {end})'
        + bars_cte("x", "w", {"1h": HOUR_MS, "4h": 4 * HOUR_MS, "1d": DAY_MS, "5h": 5 * HOUR_MS}[interval])
        + f" SELECT symbol, '{interval}' AS interval, {BAR_SQL} FROM x"
    )

    @register(f"rollup_job_{interval}", sql)
    def query(spark, d):
        source = tick_bars(spark, d, "1h").withColumn("interval", F.lit(jobs.ROLLUP_SOURCE[interval]))
        bars = jobs.rollup_job(source, interval, NOW)
        return rounded(bars, "quoteVolume", digits=4)


for _interval in ("1h", "4h", "1d", "5h"):
    _last_window(_interval)


@register(
    "rollup_job_upsert",
    HOURS + bars_cte("d1", "h1", DAY_MS) + f" SELECT symbol, '1d' AS interval, {BAR_SQL} FROM d1",
)
def rollup_job_upsert(spark, d):
    """The daily job for one day over a table that already has every bar: nothing may change."""
    hours = tick_bars(spark, d, "1h")
    stored = jobs.backfill_rollup(hours, "1d", 0, 2 * LAST_DAY)
    return rounded(jobs.rollup_job(hours, "1d", NOW, stored, symbols=None), "quoteVolume", digits=4)


BARS = HOURS + aligned_cte("bars", "h1", HOUR_MS)


@register(
    "prediction_job",
    f"""{BARS}, recent AS (SELECT * FROM bars WHERE "openTime" >= {LAST_DAY} - 12000000),
    enough AS (SELECT count(*) >= 40 AS ok FROM recent),
    latest AS (SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "openTime" DESC) <= 40),
    source AS (SELECT r.* FROM recent r, enough WHERE ok UNION ALL SELECT l.* FROM latest l, enough WHERE NOT ok),
    {feature_sql('source', '"openTime"')},
    newest AS (SELECT * FROM features QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "openTime" DESC) = 1)
    {predictions_cte(HOUR_MS, 'newest')} SELECT {PREDICTION} FROM predictions""",
)
def prediction_job(spark, d):
    out = jobs.predict(
        tick_bars(spark, d, "1h", align=True), PUBLISHED, LAST_DAY, 40, RUN_TIME, "1h", symbols=None
    )
    return rounded(out, *ROUNDED)


_ALL = ["ema_12", "ema_26", "macd", "macd_signal", "sma_14", "rsi_14", "bollinger_upper_20", "bollinger_lower_20"]


@register(
    "indicator_job_hourly",
    (
        f"""{MACD}, {RSI_STEPS} SELECT symbol, "openTime", close, {MACD_COLS},
        {r(f'avg(close) OVER {rows(14)}', 'sma_14')}, {r(RSI, 'rsi_14')}, {r(_UP, 'bollinger_upper_20')},
        {r(_LOW, 'bollinger_lower_20')} FROM moves JOIN (SELECT seq, rn FROM numbered) USING (seq)
        JOIN macds USING (symbol, rn) JOIN sig USING (symbol, rn)"""
    ).replace(
        "numbered AS MATERIALIZED",
        "trades_ AS (SELECT * FROM candles), hours AS (SELECT symbol, \"openTime\" - \"openTime\" % 3600000"
        " AS \"openTime\", arg_max(close, seq) AS close, max(seq) AS seq FROM trades_ GROUP BY 1, 2),"
        " numbered AS MATERIALIZED",
    ).replace("OVER (PARTITION BY symbol ORDER BY \"openTime\", seq) AS rn FROM candles", "OVER (PARTITION BY symbol ORDER BY \"openTime\", seq) AS rn FROM hours")
    .replace("0) AS step FROM candles", "0) AS step FROM hours"),
)
def indicator_job_hourly(spark, d):
    bars = tick_bars(spark, d, "1h", align=True).select("symbol", "openTime", "close")
    return rounded(jobs.indicator_job(bars, cut=False).drop("close_price_num"), *_ALL)


@register("random_split", "SELECT count(*) AS rows, true AS four_fifths FROM events")
def random_split(spark, d):
    """The random 80/20 split: nothing is lost or doubled, and the shares are near enough."""
    train, test = split_random(td.ticks(spark, d).select("symbol", "time"))
    sides = train.withColumn("part", F.lit(1)).unionByName(test.withColumn("part", F.lit(0)))
    return sides.agg(F.count(F.lit(1)).alias("rows"), F.avg("part").between(0.75, 0.85).alias("four_fifths"))


@register(
    "stream_csv_latest",
    """SELECT event_type AS ticker, arg_max(value, ts) AS latest_price, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS updated_at
    FROM events GROUP BY 1""",
)
def stream_csv_latest(spark, d):
    """Trades written as CSV files, streamed back: newest price per ticker."""
    base = run_dir(spark, "csv")
    td.events(spark, d).select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("event_type").alias("ticker"), F.col("value").alias("price"),
        F.from_json("props", "k BIGINT")["k"].cast("double").alias("volume"),
    ).write.option("header", "true").csv(f"{base}/in")
    schema = "ticker STRING, latest_price DOUBLE, updated_at TIMESTAMP"
    latest = sr.stream_latest_ticker(st.csv_tick_stream(spark, f"{base}/in"))
    q, table = sr.complete_job(latest, f"{base}/out", schema)
    drain(q)
    return table.read().select("ticker", "latest_price", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("updated_at"))
