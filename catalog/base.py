"""Registration and the SQL reading of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERIES: dict = {}
SQL: dict[str, str] = {}

# Start of the last full day in the events table, and a time after its end (ms).
LAST_DAY = 1_706_572_800_000
AFTER_END = 1_706_745_600_000
MID_MONTH = 1_705_276_800_000

# The ticks CTE mirrors sources/testdata.py: microseconds are cut to whole milliseconds.
TICKS = """
ticks AS (
  SELECT event_type AS symbol, epoch_us(ts) // 1000 AS "time", event_id AS "tradeId", value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
         CAST(json_extract_string(props, '$.k') AS BIGINT) < 50 AS "isBuyerMaker"
  FROM events)"""

USER_TICKS = TICKS.replace("event_type AS symbol", "CAST(user_id AS VARCHAR) AS symbol")


def candles_of(ticks: str) -> str:
    return ticks + """,
candles AS (
  SELECT symbol, "time" AS "openTime", "time" AS "closeTime", price AS open, price AS high,
         price AS low, price AS close, quantity AS volume, price * quantity AS "quoteVolume",
         1 AS trades, "tradeId" AS seq
  FROM ticks)"""


CANDLES = candles_of(TICKS)
USER_CANDLES = candles_of(USER_TICKS)


def bars_cte(name: str, source: str, width: int, order: str = '"openTime"') -> str:
    """A roll-up CTE with the same meaning as operators/rollup.py."""
    return f""",
{name} AS (
  SELECT symbol, "openTime" - "openTime" % {width} AS window_start,
         min("openTime") AS "openTime", arg_max("closeTime", {order}) AS "closeTime",
         arg_min(open, {order}) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, {order}) AS close, sum(volume) AS volume,
         sum("quoteVolume") AS "quoteVolume", CAST(sum(trades) AS BIGINT) AS trades
  FROM {source} GROUP BY 1, 2)"""


def aligned_cte(name: str, bars: str, width: int) -> str:
    return f""",
{name} AS (
  SELECT symbol, window_start AS "openTime", window_start + {width - 1} AS "closeTime",
         open, high, low, close, volume, "quoteVolume", trades
  FROM {bars})"""


def r(expr: str, alias: str, digits: int = 6) -> str:
    """Rounded column without a negative zero."""
    return f'round({expr}, {digits}) + 0.0 AS "{alias}"'


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def register(name: str, sql: str | None = None):
    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return keep
