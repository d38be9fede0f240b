"""Rankings by price change."""

from pyspark.sql import functions as F

from catalog.base import CANDLES, USER_CANDLES, r, register, rounded
from tickloom.operators import ranking as rk
from tickloom.operators import rollup as ru
from tickloom.schemas import DAY_MS, HOUR_MS
from tickloom.sources import messages as ms
from tickloom.sources import testdata as td


def change_sql(width: int, where: str = "") -> str:
    return f""",
windows AS (
  SELECT symbol, "openTime" - "openTime" % {width} AS window_start,
         arg_max(close, ROW("openTime", close, "quoteVolume")) AS close_price,
         max("openTime") AS "timestamp", sum("quoteVolume") AS volume
  FROM candles {where} GROUP BY 1, 2),
lagged AS (
  SELECT *, lag(close_price) OVER w AS prev_close, lag("timestamp") OVER w AS prev_timestamp
  FROM windows WINDOW w AS (PARTITION BY symbol ORDER BY window_start)),
changes AS (
  SELECT *, (close_price - prev_close) / nullif(prev_close, 0) * 100 AS percent_change
  FROM lagged WHERE prev_close IS NOT NULL)"""


def ranked_sql(horizon: int | None) -> str:
    volume = "volume"
    if horizon is not None:
        volume = f"CASE WHEN window_start > (SELECT max(window_start) FROM windows) - {horizon} THEN volume END"
    return f""",
ranked AS (
  SELECT symbol, arg_max(close_price, window_start) AS price,
         arg_max(percent_change, window_start) AS percent_change,
         coalesce(sum({volume}), 0) AS volume, CAST(NULL AS DOUBLE) AS market_cap,
         arg_max("timestamp", window_start) AS "timestamp"
  FROM changes GROUP BY 1)"""


SHOWN = f"""symbol, price, {r('percent_change', 'percent_change')}, {r('volume', 'volume', 4)},
  market_cap, "timestamp" """


def _show(df):
    return rounded(rounded(df, "percent_change"), "volume", digits=4)


@register(
    "rolling_window_change",
    f"""WITH {CANDLES} {change_sql(HOUR_MS)} SELECT symbol, window_start, close_price, "timestamp",
    {r('volume', 'volume', 4)}, prev_close, prev_timestamp, {r('percent_change', 'percent_change')}
    FROM changes""",
)
def rolling_window_change(spark, d):
    windows = ru.window_close(td.tick_candles(td.ticks(spark, d)), HOUR_MS)
    return _show(rk.rolling_window_change(windows))


@register(
    "top_gainers",
    f"""WITH {USER_CANDLES} {change_sql(HOUR_MS)} {ranked_sql(DAY_MS)}
    SELECT {SHOWN} FROM ranked ORDER BY ranked.percent_change DESC, symbol LIMIT 1000""",
)
def top_gainers(spark, d):
    """Flagship: closed candles to hourly windows, their change, the newest per symbol, ranked."""
    return _show(rk.ranking(td.tick_candles(td.ticks(spark, d, "user_id")), 1000, HOUR_MS))


@register(
    "top_losers",
    f"""WITH {USER_CANDLES} {change_sql(HOUR_MS)} {ranked_sql(None)}, top AS (
      SELECT * FROM ranked ORDER BY percent_change DESC, symbol LIMIT 10000)
    SELECT {SHOWN} FROM top ORDER BY top.percent_change, symbol LIMIT 20""",
)
def top_losers(spark, d):
    ranked = rk.ranking(td.tick_candles(td.ticks(spark, d, "user_id")), 10_000, HOUR_MS, None)
    return _show(rk.top_losers(ranked, 20))


@register(
    "rank_positions",
    f"""WITH {USER_CANDLES} {change_sql(HOUR_MS)} {ranked_sql(None)}, top AS (
      SELECT *, row_number() OVER (ORDER BY percent_change DESC, symbol) AS position FROM ranked)
    SELECT {SHOWN}, position FROM top WHERE position <= 100""",
)
def rank_positions(spark, d):
    ranked = rk.ranking(td.tick_candles(td.ticks(spark, d, "user_id")), 10_000, HOUR_MS, None)
    return _show(rk.rank_position(ranked, 100)).withColumn("position", F.col("position").cast("bigint"))


@register(
    "gainers_from_messages",
    f"""WITH {CANDLES} {change_sql(60_000, 'WHERE volume >= 10')} {ranked_sql(None)}
    SELECT {SHOWN} FROM ranked ORDER BY ranked.percent_change DESC, symbol LIMIT 10000""",
)
def gainers_from_messages(spark, d):
    """The batch form of the streaming job: JSON candle updates to one-minute windows to ranking."""
    klines = ms.parse_klines(td.kline_messages(td.ticks(spark, d)))
    return _show(rk.ranking(ms.valid_tick(ms.closed_only(klines)), horizon_ms=None))
