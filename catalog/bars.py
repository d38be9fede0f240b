"""Roll-ups and windowed price aggregates."""

from pyspark.sql import functions as F

from catalog.base import CANDLES, TICKS, USER_CANDLES, bars_cte, r, register, rounded
from tickloom.operators import rollup as ru
from tickloom.schemas import DAY_MS, HOUR_MS, INTERVAL_MS, MINUTE_MS
from tickloom.sources import testdata as td

BAR_SQL = (
    '"openTime", "closeTime", open, high, low, close, volume, '
    + r('"quoteVolume"', "quoteVolume", 4)
    + ", trades"
)


def tick_bars(spark, d, interval, symbol="event_type", align=False):
    """First-level bars straight from trades; the trade id orders trades of one millisecond."""
    candles = td.tick_candles(td.ticks(spark, d, symbol))
    return ru.rollup_ohlc(candles, interval, order="seq", align=align)


def _shown(df):
    return rounded(df, "quoteVolume", digits=4)


# 1m bars from trades, then the chain 1m -> 5m -> 1h -> {4h, 5h, 1d}.
CHAIN = (
    "WITH" + CANDLES
    + bars_cte("m1", "candles", MINUTE_MS, "seq")
    + bars_cte("m5", "m1", 5 * MINUTE_MS)
    + bars_cte("h1", "m5", HOUR_MS)
)


def chain(spark, d, interval):
    df = tick_bars(spark, d, "1m")
    for step in ("5m", "1h"):
        df = ru.rollup_ohlc(df, step)
        if step == interval:
            return df
    return ru.rollup_ohlc(df, interval)


def _chain_query(interval, source):
    def query(spark, d):
        return _shown(chain(spark, d, interval))

    if source is None:
        sql = f"{CHAIN} SELECT symbol, '{interval}' AS interval, window_start, {BAR_SQL} FROM "
        sql += {"5m": "m5", "1h": "h1"}[interval]
    else:
        sql = (
            CHAIN
            + bars_cte("x", source, INTERVAL_MS[interval])
            + f" SELECT symbol, '{interval}' AS interval, window_start, {BAR_SQL} FROM x"
        )
    register(f"rollup_{interval}", sql)(query)


for _interval, _source in (("5m", None), ("1h", None), ("4h", "h1"), ("1d", "h1"), ("5h", "h1")):
    _chain_query(_interval, _source)


@register(
    "rollup_1m_by_user",
    "WITH" + USER_CANDLES + bars_cte("m1", "candles", MINUTE_MS, "seq")
    + f" SELECT symbol, '1m' AS interval, window_start, {BAR_SQL} FROM m1",
)
def rollup_1m_by_user(spark, d):
    return _shown(tick_bars(spark, d, "1m", "user_id"))


@register(
    "rollup_1d_by_supplier",
    """
WITH sales AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol, epoch_ms(l_shipdate) AS day,
         l_extendedprice / l_quantity AS price, l_quantity AS volume, l_extendedprice AS quote,
         ROW(l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS ord
  FROM lineitem)
SELECT symbol, day - day % 86400000 AS window_start, arg_min(price, ord) AS open,
       max(price) AS high, min(price) AS low, arg_max(price, ord) AS close, sum(volume) AS volume,
       round(sum(quote), 2) AS "quoteVolume", CAST(count(*) AS BIGINT) AS trades
FROM sales GROUP BY 1, 2""",
)
def rollup_1d_by_supplier(spark, d):
    t = td.lineitem_ticks(spark, d)
    candles = t.select(
        "symbol",
        F.col("time").alias("openTime"),
        F.col("time").alias("closeTime"),
        *[F.col("price").alias(c) for c in ("open", "high", "low", "close")],
        F.col("quantity").alias("volume"),
        (F.col("price") * F.col("quantity")).alias("quoteVolume"),
        F.lit(1).alias("trades"),
        "seq",
    )
    # A bar holds one day here, so the number of the sale orders its rows.
    bars = ru.rollup_ohlc(candles, "1d", order="seq").drop("interval", "openTime", "closeTime")
    return rounded(bars, "quoteVolume", digits=2)


@register(
    "symbol_summary",
    f"""WITH {TICKS} SELECT symbol, sum(quantity) AS total_volume, {r('avg(price)', 'avg_price')},
    max(price) AS max_price, min(price) AS min_price FROM ticks GROUP BY 1""",
)
def symbol_summary(spark, d):
    t = td.ticks(spark, d).withColumnRenamed("quantity", "volume")
    return rounded(ru.symbol_summary(t), "avg_price")


@register(
    "latest_price_ranking",
    f"""WITH {TICKS} SELECT symbol, arg_max(price, "tradeId") AS latest_price,
    count(*) AS trade_count FROM ticks GROUP BY 1 ORDER BY 2 DESC""",
)
def latest_price_ranking(spark, d):
    out = ru.latest_price(td.ticks(spark, d), time="tradeId")
    return out.orderBy(F.col("latest_price").desc())


@register(
    "latest_price_by_user",
    f"""WITH {TICKS.replace('event_type AS symbol', 'CAST(user_id AS VARCHAR) AS symbol')}
    SELECT symbol, arg_max(price, "tradeId") AS latest_price,
    count(*) AS trade_count FROM ticks GROUP BY 1 ORDER BY 2 DESC""",
)
def latest_price_by_user(spark, d):
    out = ru.latest_price(td.ticks(spark, d, "user_id"), time="tradeId")
    return out.orderBy(F.col("latest_price").desc())


@register(
    "max_price_ranking",
    f"WITH {TICKS} SELECT symbol, max(price) AS latest_price FROM ticks GROUP BY 1 ORDER BY 2 DESC",
)
def max_price_ranking(spark, d):
    return ru.max_price(td.ticks(spark, d)).orderBy(F.col("latest_price").desc())


@register(
    "row_and_symbol_counts",
    f"WITH {TICKS} SELECT count(*) AS rows, count(DISTINCT symbol) AS symbols FROM ticks",
)
def row_and_symbol_counts(spark, d):
    return ru.counts(td.ticks(spark, d))


WINDOW_CLOSE = f"""
windows AS (
  SELECT symbol, "openTime" - "openTime" % {MINUTE_MS} AS window_start,
         max(ROW("openTime", close, "quoteVolume")) AS p, sum("quoteVolume") AS volume
  FROM candles GROUP BY 1, 2)"""


@register(
    "window_close",
    f"""WITH {CANDLES}, {WINDOW_CLOSE.replace('max(ROW("openTime", close, "quoteVolume")) AS p',
    'arg_max(close, ROW("openTime", close, "quoteVolume")) AS close_price, max("openTime") AS "timestamp"')}
    SELECT symbol, window_start, close_price, "timestamp", {r('volume', 'volume', 4)} FROM windows""",
)
def window_close(spark, d):
    return rounded(ru.window_close(td.tick_candles(td.ticks(spark, d))), "volume", digits=4)


@register(
    "window_gain",
    f"""WITH {TICKS}, g AS (
      SELECT symbol, "time" - "time" % {HOUR_MS} AS window_start,
             arg_min(price, ROW("time", price)) AS open_price,
             arg_max(price, ROW("time", price)) AS close_price, count(*) AS trade_count
      FROM ticks GROUP BY 1, 2)
    SELECT symbol, window_start, open_price, close_price, trade_count,
           {r('(close_price - open_price) / nullif(open_price, 0) * 100', 'percent_change')} FROM g""",
)
def window_gain(spark, d):
    return rounded(ru.window_gain(td.ticks(spark, d), HOUR_MS), "percent_change")


@register(
    "rollup_custom_width",
    "WITH" + CANDLES + bars_cte("b", "candles", 7 * DAY_MS, "seq")
    + f" SELECT symbol, '7d' AS interval, window_start, {BAR_SQL} FROM b",
)
def rollup_custom_width(spark, d):
    candles = td.tick_candles(td.ticks(spark, d))
    return _shown(ru.rollup_ohlc(candles, 7 * DAY_MS, order="seq", label="7d"))
