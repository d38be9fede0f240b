"""Candle roll-ups and windowed price aggregates.

Everything here is a hash aggregate with map-side partials (numeric ``min_by``/``max_by``), so a
heavy symbol or bucket reaches the shuffle as one row per task.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import bucket_start, change_pct, turn
from tickloom.schemas import INTERVAL_MS, MINUTE_MS


def rollup_ohlc(
    df: DataFrame,
    interval: str | int,
    order: Column | str = "openTime",
    label: str | None = None,
    align: bool = False,
) -> DataFrame:
    """Roll candles up to a wider interval.

    ``open``/``close`` follow ``order``; give a column that is unique within a symbol when several
    candles share an openTime. openTime and closeTime are those of the first and last candle, or
    with ``align`` the bounds of the bucket. ``interval`` is a name or any width in milliseconds.
    """
    width = INTERVAL_MS[interval] if isinstance(interval, str) else interval
    out = df.groupBy("symbol", bucket_start("openTime", width).alias("window_start")).agg(
        F.min_by("open", order).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", order).alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("quoteVolume").alias("quoteVolume"),
        F.sum("trades").alias("trades"),
        F.min("openTime").alias("openTime"),
        F.max_by("closeTime", order).alias("closeTime"),
    )
    if align:
        out = out.withColumns(
            {"openTime": F.col("window_start"), "closeTime": F.col("window_start") + (width - 1)}
        )
    return out.select(
        "symbol",
        F.lit(label or (interval if isinstance(interval, str) else f"{width}ms")).alias("interval"),
        "window_start",
        "openTime",
        "closeTime",
        "open",
        "high",
        "low",
        "close",
        "volume",
        "quoteVolume",
        "trades",
    )


def job_window(now: datetime, interval: str) -> tuple[int, int]:
    """Last complete window before ``now`` in ms, half open.

    The 5h window counts its five hours from midnight, so it need not match an epoch bucket.
    """
    now = now.astimezone(timezone.utc)
    width = INTERVAL_MS[interval]
    midnight = now.replace(hour=0, minute=0, second=0, microsecond=0)
    if interval == "1d":
        end = midnight
    else:
        passed = (now - midnight) // timedelta(milliseconds=width)
        end = midnight + passed * timedelta(milliseconds=width)
    end_ms = int(end.timestamp() * 1000)
    return end_ms - width, end_ms


def symbol_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("symbol").agg(
        F.sum("volume").alias("total_volume"),
        F.avg("price").alias("avg_price"),
        F.max("price").alias("max_price"),
        F.min("price").alias("min_price"),
    )


def latest_price(df: DataFrame, price: str = "price", time: Column | str = "time") -> DataFrame:
    """Newest price and row count per symbol."""
    return df.groupBy("symbol").agg(
        F.max_by(price, time).alias("latest_price"), F.count("symbol").alias("trade_count")
    )


def max_price(df: DataFrame, price: str = "price") -> DataFrame:
    return df.groupBy("symbol").agg(F.max(price).alias("latest_price"))


def window_close(df: DataFrame, width: int = MINUTE_MS) -> DataFrame:
    """Last close and total quote volume per (window, symbol) of closed candles.

    Of candles with the same time the one with the largest close is the last; null closes are none.
    """
    start = bucket_start("openTime", width)
    return df.groupBy("symbol", start.alias("window_start")).agg(
        F.max_by("close", turn(F.col("openTime") - start, "close")).alias("close_price"),
        F.max("openTime").alias("timestamp"),
        F.sum("quoteVolume").alias("volume"),
    )


def window_gain(df: DataFrame, width: int = MINUTE_MS, price: str = "price", time: str = "time") -> DataFrame:
    """First and last price, percentage change and trade count per (window, symbol).

    At one time the least price is the first and the largest the last; null prices are none.
    """
    start = bucket_start(time, width)
    order = turn(F.col(time) - start, price)
    return (
        df.groupBy("symbol", start.alias("window_start"))
        .agg(
            F.min_by(price, order).alias("open_price"),
            F.max_by(price, order).alias("close_price"),
            F.count("symbol").alias("trade_count"),
        )
        .select(
            "symbol", "window_start", "open_price", "close_price",
            change_pct("close_price", "open_price").alias("percent_change"), "trade_count",
        )
    )


def counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("symbol").alias("symbols"))


__all__ = [
    "counts", "job_window", "latest_price", "max_price", "rollup_ohlc",
    "symbol_summary", "window_close", "window_gain",
]
