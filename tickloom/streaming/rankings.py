"""Rankings over streams of candle updates and trades."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.scalars import bucket_start, change_pct, ms_to_ts, turn
from tickloom.operators.ranking import change_of_parts, part_sums, top_gainers
from tickloom.operators.rollup import latest_price, max_price
from tickloom.schemas import DAY_MS, HOUR_MS
from tickloom.sources.messages import closed_only, valid_tick
from tickloom.sources.tables import upsert
from tickloom.streaming.run import publish_with_retry, start
from tickloom.streaming.state import StateTable

WINDOWS_SCHEMA = "symbol STRING, window_start BIGINT, close_price DOUBLE, timestamp BIGINT, volume DOUBLE"
GAINS_SCHEMA = (
    "symbol STRING, window_start BIGINT, open_price DOUBLE, close_price DOUBLE, "
    "percent_change DOUBLE, trade_count BIGINT"
)
RANKING_SCHEMA = (
    "symbol STRING, price DOUBLE, percent_change DOUBLE, volume DOUBLE, market_cap DOUBLE, "
    "timestamp BIGINT, expires_at BIGINT"
)
SUMS_SCHEMA = (
    "symbol STRING, part_start BIGINT, counted BOOLEAN, n BIGINT, volume DOUBLE, first_start BIGINT, first_volume DOUBLE, "
    "last_start BIGINT, last_close DOUBLE, before_last DOUBLE, timestamp BIGINT"
)
PRICES_SCHEMA = "symbol STRING, latest_price DOUBLE, trade_count BIGINT, updated_at TIMESTAMP"


def _event_time(stream: DataFrame, time: str, late: str) -> DataFrame:
    return stream.withColumn("event_ts", ms_to_ts(time)).withWatermark("event_ts", late)


def stream_latest_price(stream: DataFrame, price: str = "price", time: str = "time") -> DataFrame:
    """Newest price and count per symbol, for complete mode; state is one row per symbol."""
    return (
        latest_price(stream, price, time)
        .withColumn("updated_at", F.current_timestamp())
        .orderBy(F.col("latest_price").desc())
    )


def stream_latest_ticker(ticks: DataFrame) -> DataFrame:
    """Newest price per ticker of a CSV stream, dearest first, for complete mode."""
    return (
        ticks.groupBy("ticker")
        .agg(F.max_by("price", "timestamp").alias("latest_price"), F.max("timestamp").alias("updated_at"))
        .orderBy(F.col("latest_price").desc())
    )


def stream_max_price(stream: DataFrame, price: str = "price") -> DataFrame:
    return max_price(stream, price).orderBy(F.col("latest_price").desc())


def stream_window_close(stream: DataFrame, width: str = "1 minute", late: str = "2 minutes") -> DataFrame:
    """Last close and quote volume per event-time window; the watermark bounds the state."""
    return (
        _event_time(stream, "openTime", late)
        .groupBy(F.window("event_ts", width), "symbol")
        .agg(
            F.max_by("close", turn("openTime", "close")).alias("close_price"),
            F.max("openTime").alias("timestamp"),
            F.sum("quoteVolume").alias("volume"),
        )
        .select("symbol", F.unix_millis("window.start").alias("window_start"), "close_price", "timestamp", "volume")
    )


def stream_window_gain(
    stream: DataFrame, width: str = "1 minute", late: str = "2 minutes", price: str = "price", time: str = "time"
) -> DataFrame:
    """First and last price, change and count per event-time window."""
    order = turn(time, price)
    return (
        _event_time(stream, time, late)
        .groupBy(F.window("event_ts", width), "symbol")
        .agg(
            F.min_by(price, order).alias("open_price"),
            F.max_by(price, order).alias("close_price"),
            F.count("symbol").alias("trade_count"),
        )
        .select(
            "symbol",
            F.unix_millis("window.start").alias("window_start"),
            "open_price",
            "close_price",
            change_pct("close_price", "open_price").alias("percent_change"),
            "trade_count",
        )
    )


def ranked_gains(gains: DataFrame) -> DataFrame:
    return gains.orderBy(F.col("percent_change").desc(), "symbol", "window_start")


def _upserted(old: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(old, new, ("symbol", "window_start"))


def gains_job(
    stream: DataFrame, base: str, width: str = "1 minute", late: str = "2 minutes", part_ms: int = HOUR_MS,
    retention_ms: int | None = DAY_MS, checkpoint: str | None = None, every: str | None = None,
) -> tuple[StreamingQuery, StateTable]:
    """Window gains in update mode, kept in a table by time; windows older than the retention are dropped."""
    spark = stream.sparkSession
    table = StateTable(spark, base, GAINS_SCHEMA, bucket_start("window_start", part_ms))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        table.merge(batch, batch_id, _upserted)
        oldest = None
        if retention_ms is not None:
            oldest = batch.agg(F.max("window_start")).first()[0] - retention_ms - part_ms
        table.prune(batch_id, oldest)

    return start(stream_window_gain(stream, width, late), on_batch, "update", checkpoint, every), table


def top_gainers_job(
    klines: DataFrame,
    base: str,
    n: int = 10_000,
    width: str = "1 minute",
    late: str = "2 minutes",
    horizon_ms: int | None = DAY_MS,
    ttl_ms: int = 60_000,
    part_ms: int = HOUR_MS,
    checkpoint: str | None = None,
    every: str | None = None,
) -> tuple[StreamingQuery, StateTable]:
    """Closed candles to a served ranking.

    Spark's state holds only windows the watermark still allows to change. Finished windows live in a
    table cut by ``part_ms``, beside a table of what each (symbol, part) adds to a ranking. A batch
    rewrites the parts it touches in both, and ranks from the sums; of the other parts' windows it reads
    only the two that the ends of the horizon cut. Returns the query and the ranking table.
    """
    spark = klines.sparkSession
    part = bucket_start("window_start", part_ms)
    windows = StateTable(spark, f"{base}/windows", WINDOWS_SCHEMA, part)
    sums = StateTable(spark, f"{base}/sums", SUMS_SCHEMA, F.col("part_start"))
    served = StateTable(spark, f"{base}/ranking", RANKING_SCHEMA)

    def publish(batch: DataFrame, batch_id: int) -> None:
        parts = windows.touched(batch)
        windows.merge(batch, batch_id, _upserted)
        fresh = part_sums(windows.read(parts=parts), part).withColumnRenamed("part", "part_start")
        sums.write(fresh, batch_id, parts)
        told = sums.read()
        oldest = None
        if horizon_ms is not None:
            newest = told.agg(F.max("last_start")).first()[0]
            # Two horizons are kept so that the first window inside has its predecessor.
            since, oldest = newest - horizon_ms, newest - 2 * horizon_ms
            edges = {t - t % part_ms for t in (since, oldest)}
            cut = part_sums(windows.read(parts=edges).filter(F.col("window_start") > oldest), part, since)
            whole = told.filter(~F.col("part_start").isin(*edges) & (F.col("part_start") > oldest))
            whole = whole.withColumn("counted", F.col("part_start") > since)
            told = whole.unionByName(cut.withColumnRenamed("part", "part_start"))
        ranked = top_gainers(change_of_parts(told), n)
        expiry = (F.unix_millis(F.current_timestamp()) + ttl_ms).alias("expires_at")
        served.write(ranked.select("*", expiry), batch_id, [0])
        served.prune(batch_id)
        for table in (windows, sums):
            table.prune(batch_id, None if oldest is None else oldest - part_ms)

    closed = valid_tick(closed_only(klines))
    changed = stream_window_close(closed, width, late)
    return start(changed, publish_with_retry(publish), "update", checkpoint, every), served


def complete_job(
    aggregated: DataFrame, base: str, schema: str, checkpoint: str | None = None, every: str | None = None
) -> tuple[StreamingQuery, StateTable]:
    """Keep the newest complete result of a streaming aggregation as a table."""
    table = StateTable(aggregated.sparkSession, base, schema)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        table.write(batch, batch_id, [0])
        table.prune(batch_id)

    return start(aggregated, on_batch, "complete", checkpoint, every), table
