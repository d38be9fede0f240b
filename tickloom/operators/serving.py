"""Queries a dashboard asks of the tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import _c
from tickloom.operators.recurrence import running_max_before
from tickloom.sources.tables import first_per_key, scan_candles


# Arrival numbers per slice if a list of first arrivals is cut.
SEQ_WIDTH = 1 << 24


def _limit(n: int, most: int) -> int:
    if not 1 <= n <= most:
        raise ValueError(f"limit must be between 1 and {most}")
    return n


def chart_point(df: DataFrame, keep: Sequence[str] = ("symbol",)) -> DataFrame:
    return df.select(*keep, "openTime", F.array("open", "high", "low", "close").alias("y"), "volume")


def _newest(df: DataFrame, limit: int, order: Sequence[str]) -> DataFrame:
    newest = df.orderBy(*[F.col(c).desc() for c in order]).limit(limit)
    return newest.orderBy(*order)


def ohlc_query(
    df: DataFrame,
    symbol: str,
    interval: str,
    start: int | None = None,
    end: int | None = None,
    limit: int = 200,
    order: Sequence[str] = ("openTime",),
) -> DataFrame:
    """Newest ``limit`` candles with start <= openTime <= end, in ascending order."""
    rows = scan_candles(df, [symbol], interval, start, end, end_inclusive=True)
    return _newest(rows, _limit(limit, 2000), order)


def _closed(df: DataFrame) -> DataFrame:
    return df.filter(F.coalesce(F.col("x"), F.lit(False))) if "x" in df.columns else df


def candles_before(df: DataFrame, symbol: str, start: int, limit: int = 200, order: Sequence[str] = ("openTime",)) -> DataFrame:
    """Newest ``limit`` closed candles strictly before ``start``, ascending."""
    rows = _closed(df.filter((F.col("symbol") == symbol) & (F.col("openTime") < start)))
    return _newest(rows, _limit(limit, 2000), order)


def candles_until(
    df: DataFrame, symbol: str, end: int, limit: int = 200, keep: str = "oldest", order: Sequence[str] = ("openTime",)
) -> DataFrame:
    """``limit`` closed candles with openTime <= end: the oldest ones, or with keep='newest' the last."""
    rows = _closed(df.filter((F.col("symbol") == symbol) & (F.col("openTime") <= end)))
    if keep == "newest":
        return _newest(rows, _limit(limit, 2000), order)
    return rows.orderBy(*order).limit(_limit(limit, 2000))


def latest_candles(df: DataFrame, symbol: str, limit: int = 200, order: Sequence[str] = ("openTime",)) -> DataFrame:
    return _newest(_closed(df.filter(F.col("symbol") == symbol)), _limit(limit, 2000), order)


def latest_candle(df: DataFrame, symbol: str | None = None, order: Sequence[str] = ("openTime",)) -> DataFrame:
    """Newest closed candle per symbol. A symbol without one yields no row."""
    rows = df if symbol is None else df.filter(F.col("symbol") == symbol)
    return first_per_key(_closed(rows), ["symbol"], [F.col(c).desc() for c in order])


def recent_trades(trades: DataFrame, symbol: str, limit: int = 50, order: Sequence[str] = ("time", "tradeId")) -> DataFrame:
    """Newest trades, newest first."""
    rows = trades.filter(F.col("symbol") == symbol)
    return rows.orderBy(*[F.col(c).desc() for c in order]).limit(_limit(limit, 100))


def retain_last(trades: DataFrame, k: int = 100, order: Sequence[str] = ("time", "tradeId")) -> DataFrame:
    return first_per_key(trades, ["symbol"], [F.col(c).desc() for c in order], k)


def merge_live(
    candles: DataFrame, arrival: str, keep: int = 200, drop_late: bool = False, **series
) -> DataFrame:
    """Candle list after live updates: replaced by openTime, newest ``keep`` per symbol.

    With ``drop_late`` a new openTime older than one already shown is ignored, which is decided
    on the first arrival of each openTime against all earlier arrivals (one row per openTime, so
    a series bounded by time).
    """
    if drop_late:
        firsts = candles.groupBy("symbol", "openTime").agg(F.min(arrival).alias("_first"))
        shown = running_max_before(
            firsts, "openTime", "_shown", keys=["symbol"], order="_first", width=SEQ_WIDTH,
            **{"cut": False, **series},
        )
        in_time = shown.filter(F.col("_shown").isNull() | (F.col("openTime") >= F.col("_shown")))
        candles = candles.join(in_time.select("symbol", "openTime"), ["symbol", "openTime"], "left_semi")
    latest = first_per_key(candles, ["symbol", "openTime"], [F.col(arrival).desc()])
    return first_per_key(latest, ["symbol"], [F.col("openTime").desc()], keep)


def latest_prediction(predictions: DataFrame) -> DataFrame:
    return first_per_key(predictions, ["symbol"], [F.col("prediction_time").desc(), F.col("openTime").desc()])


def predictions_by_change(predictions: DataFrame) -> DataFrame:
    return predictions.orderBy(F.col("predicted_change_pct").desc(), "symbol")


def all_predictions(predictions: DataFrame) -> DataFrame:
    """Newest forecast per symbol, most confident first."""
    return (
        latest_prediction(predictions)
        .withColumn("confidence_score", F.abs("predicted_change_pct"))
        .orderBy(F.col("confidence_score").desc(), "symbol")
    )


def served_prediction(predictions: DataFrame) -> DataFrame:
    return predictions.select(
        "symbol",
        F.col("close").alias("current_price"),
        "predicted_price",
        F.col("predicted_change_pct").alias("predicted_change"),
        "direction",
        "prediction_time",
        "target_time",
        F.abs("predicted_change_pct").alias("confidence_score"),
    )


def sample_predictions(scored: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows by all columns, nulls first: the same sample in every run."""
    return scored.orderBy(*scored.columns).limit(n)


def direction_counts(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("direction").agg(F.count(F.lit(1)).alias("count"))


def prediction_summary(predictions: DataFrame) -> DataFrame:
    change = _c("predicted_change_pct")
    up = F.count_if(F.col("direction") == "UP")
    total = F.count(F.lit(1))

    def pct(part: Column) -> Column:
        return F.try_divide(part * 100.0, total)

    return predictions.agg(
        up.alias("up_count"),
        pct(up).alias("up_pct"),
        (total - up).alias("down_count"),
        pct(total - up).alias("down_pct"),
        F.avg(change).alias("avg_change"),
        F.max(change).alias("max_gain"),
        F.min(change).alias("max_loss"),
    )
