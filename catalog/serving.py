"""Dashboard queries over tick candles and hourly bars."""

from pyspark.sql import functions as F

from catalog.base import (
    AFTER_END, CANDLES, LAST_DAY, MID_MONTH, TICKS, bars_cte, r, register, rounded,
)
from tickloom.operators import serving as sv
from tickloom.operators.book import tick_change_pct as tick_change
from tickloom.operators.rollup import rollup_ohlc
from tickloom.schemas import HOUR_MS
from tickloom.sources import tables as tb
from tickloom.sources import testdata as td

ORDER = ["openTime", "seq"]
HOURS = "WITH" + CANDLES + bars_cte("h", "candles", HOUR_MS, "seq")
POINT = '"openTime", open AS y0, high AS y1, low AS y2, close AS y3, volume'


def _hours(spark, d):
    return rollup_ohlc(td.tick_candles(td.ticks(spark, d)), "1h", order="seq")


def _candles(spark, d):
    """Tick candles with the closed flag of the message feed."""
    return td.tick_candles(td.ticks(spark, d)).withColumn("x", F.col("volume") >= 10)


def _point(df):
    p = sv.chart_point(df)
    return p.select("symbol", "openTime", *[F.col("y")[i].alias(f"y{i}") for i in range(4)], "volume")


@register(
    "scan_half_open",
    f"""WITH {TICKS} SELECT * FROM ticks WHERE symbol IN ('click', 'view', 'purchase')
    AND "time" >= {MID_MONTH} AND "time" < {LAST_DAY}""",
)
def scan_half_open(spark, d):
    symbols = ["click", "view", "purchase"]
    return tb.scan_candles(td.ticks(spark, d), symbols, None, MID_MONTH, LAST_DAY, time="time")


@register(
    "scan_inclusive",
    f"""{HOURS} SELECT symbol, '1h' AS interval, window_start, close FROM h
    WHERE window_start BETWEEN {MID_MONTH} AND {LAST_DAY}""",
)
def scan_inclusive(spark, d):
    hours = tb.scan_candles(
        _hours(spark, d), None, "1h", MID_MONTH, LAST_DAY, end_inclusive=True, time="window_start"
    )
    return hours.select("symbol", "interval", "window_start", "close")


_LATEST_K = """SELECT symbol, "openTime", seq, close FROM (SELECT *, row_number() OVER (
  PARTITION BY symbol ORDER BY "openTime" DESC, seq DESC) AS rk FROM candles) WHERE rk <= 40"""


@register("latest_k_per_symbol", f"WITH {CANDLES} {_LATEST_K}")
def latest_k_per_symbol(spark, d):
    c = td.tick_candles(td.ticks(spark, d)).select("symbol", "openTime", "seq", "close")
    return tb.latest_k_per_symbol(c, 40, order=ORDER)


@register(
    "recent_candles",
    f"""WITH {CANDLES} SELECT symbol, "openTime", seq, close FROM candles
    WHERE "openTime" >= {LAST_DAY} - 12000000""",
)
def recent_candles(spark, d):
    c = td.tick_candles(td.ticks(spark, d)).select("symbol", "openTime", "seq", "close")
    return tb.recent_or_latest_k(c, LAST_DAY, 40, order=ORDER)


@register("recent_candles_fallback", f"WITH {CANDLES} {_LATEST_K}")
def recent_candles_fallback(spark, d):
    c = td.tick_candles(td.ticks(spark, d)).select("symbol", "openTime", "seq", "close")
    return tb.recent_or_latest_k(c, AFTER_END, 40, order=ORDER)


@register(
    "ohlc_query",
    f"""{HOURS} SELECT * FROM (SELECT symbol, {POINT} FROM h WHERE symbol = 'click'
    AND "openTime" >= {MID_MONTH} AND "openTime" <= {LAST_DAY} ORDER BY "openTime" DESC LIMIT 200)
    ORDER BY "openTime" """,
)
def ohlc_query(spark, d):
    return _point(sv.ohlc_query(_hours(spark, d), "click", "1h", MID_MONTH, LAST_DAY, 200))


_CLOSED = f"SELECT symbol, {POINT}, seq FROM candles WHERE symbol = 'view' AND volume >= 10"


def _served(order: str, bound: str = "", n: int = 200) -> str:
    return f"""WITH {CANDLES} SELECT * EXCLUDE (seq) FROM (
    {_CLOSED} {bound} ORDER BY "openTime" {order}, seq {order} LIMIT {n})"""


@register("candles_before", _served("DESC", f'AND "openTime" < {MID_MONTH}'))
def candles_before(spark, d):
    return _point(sv.candles_before(_candles(spark, d), "view", MID_MONTH, 200, ORDER))


@register("candles_until_oldest", _served("ASC", f'AND "openTime" <= {LAST_DAY}'))
def candles_until_oldest(spark, d):
    return _point(sv.candles_until(_candles(spark, d), "view", LAST_DAY, 200, order=ORDER))


@register("latest_candles", _served("DESC"))
def latest_candles(spark, d):
    return _point(sv.latest_candles(_candles(spark, d), "view", 200, ORDER))


@register(
    "latest_candle",
    f"""WITH {CANDLES} SELECT symbol, arg_max("openTime", seq) AS "openTime",
    arg_max(close, seq) AS close, max(seq) AS seq FROM candles WHERE volume >= 10 GROUP BY 1""",
)
def latest_candle(spark, d):
    return sv.latest_candle(_candles(spark, d), order=ORDER).select("symbol", "openTime", "close", "seq")


@register(
    "recent_trades",
    f"""WITH {TICKS} SELECT * FROM ticks WHERE symbol = 'click'
    ORDER BY "time" DESC, "tradeId" DESC LIMIT 50""",
)
def recent_trades(spark, d):
    return sv.recent_trades(td.ticks(spark, d), "click", 50)


@register(
    "retain_last_trades",
    f"""WITH {TICKS} SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (
    PARTITION BY symbol ORDER BY "time" DESC, "tradeId" DESC) AS rk FROM ticks) WHERE rk <= 100""",
)
def retain_last_trades(spark, d):
    return sv.retain_last(td.ticks(spark, d), 100)


@register(
    "tick_change_pct",
    f"""WITH {TICKS}, p AS (SELECT *, lag(price) OVER (
      PARTITION BY symbol ORDER BY "time", "tradeId") AS prev FROM ticks)
    SELECT symbol, "time", "tradeId", price,
      {r('CASE WHEN prev > 0 THEN (price - prev) / prev * 100 END', 'change_pct')} FROM p""",
)
def tick_change_pct(spark, d):
    t = td.ticks(spark, d).select("symbol", "time", "tradeId", "price")
    return rounded(tick_change(t), "change_pct")


@register(
    "merge_live_candles",
    f"""WITH {CANDLES}, l AS (SELECT symbol, "openTime" - "openTime" % {HOUR_MS} AS "openTime",
      arg_max(close, seq) AS close, max(seq) AS seq FROM candles GROUP BY 1, 2),
    n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "openTime" DESC) AS rk FROM l)
    SELECT symbol, "openTime", close, seq FROM n WHERE rk <= 200""",
)
def merge_live_candles(spark, d):
    c = td.tick_candles(td.ticks(spark, d))
    live = c.select("symbol", (F.col("openTime") - F.pmod("openTime", F.lit(HOUR_MS))).alias("openTime"), "close", "seq")
    return sv.merge_live(live, "seq", 200)


# Arrival order differs from time order here: the quantity shifts some candles back by two hours.
_LATE = f"""WITH {CANDLES}, a AS (
  SELECT symbol, "openTime" - "openTime" % {HOUR_MS} - CASE WHEN volume < 20 THEN {2 * HOUR_MS} ELSE 0 END
    AS "openTime", close, seq FROM candles),
firsts AS (SELECT symbol, "openTime", min(seq) AS f FROM a GROUP BY 1, 2),
shown AS (SELECT *, max("openTime") OVER (PARTITION BY symbol ORDER BY f
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM firsts),
kept AS (SELECT symbol, "openTime" FROM shown WHERE top IS NULL OR "openTime" >= top),
l AS (SELECT a.symbol, a."openTime", arg_max(close, seq) AS close, max(seq) AS seq
  FROM a JOIN kept USING (symbol, "openTime") GROUP BY 1, 2),
n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "openTime" DESC) AS rk FROM l)
SELECT symbol, "openTime", close, seq FROM n WHERE rk <= 200"""


@register("merge_live_drop_late", _LATE)
def merge_live_drop_late(spark, d):
    c = td.tick_candles(td.ticks(spark, d))
    late = F.when(F.col("volume") < 20, 2 * HOUR_MS).otherwise(0)
    start = F.col("openTime") - F.pmod("openTime", F.lit(HOUR_MS)) - late
    return sv.merge_live(c.select("symbol", start.alias("openTime"), "close", "seq"), "seq", 200, drop_late=True)
