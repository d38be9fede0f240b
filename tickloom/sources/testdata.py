"""The given ``events`` and ``lineitem`` tables read as ticks, candles, messages and book updates.

events: symbol = event_type, time = ts in ms, price = value, quantity = props.k, id = event_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalars import utc_millis

EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def ticks_of(events_df: DataFrame, symbol: str = "event_type") -> DataFrame:
    """Trades: symbol, time, tradeId, price, quantity, isBuyerMaker. Works on streams too."""
    k = F.from_json("props", "k BIGINT")["k"]
    return events_df.select(
        F.col(symbol).cast("string").alias("symbol"),
        utc_millis("ts").alias("time"),
        F.col("event_id").alias("tradeId"),
        F.col("value").alias("price"),
        k.cast("double").alias("quantity"),
        (k < 50).alias("isBuyerMaker"),
    )


def ticks(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    return ticks_of(events(spark, sf_dir), symbol)


def tick_candles(trades: DataFrame, interval: str = "tick") -> DataFrame:
    """Each trade as a one-trade candle; ``seq`` breaks ties in openTime."""
    p = F.col("price")
    return trades.select(
        "symbol",
        F.lit(interval).alias("interval"),
        F.col("time").alias("openTime"),
        F.col("time").alias("closeTime"),
        p.alias("open"),
        p.alias("high"),
        p.alias("low"),
        p.alias("close"),
        F.col("quantity").alias("volume"),
        (p * F.col("quantity")).alias("quoteVolume"),
        F.lit(1).alias("trades"),
        F.col("tradeId").alias("seq"),
    )


def kline_messages(trades: DataFrame) -> DataFrame:
    """A candle-update JSON message per trade; quantities below 10 mark a forming candle."""
    p = F.col("price").cast("string")
    message = F.struct(
        F.col("symbol").alias("s"),
        F.lit("1m").alias("i"),
        F.col("time").alias("t"),
        (F.col("time") + 59_999).alias("T"),
        p.alias("o"),
        p.alias("h"),
        p.alias("l"),
        p.alias("c"),
        F.col("quantity").cast("string").alias("v"),
        (F.col("price") * F.col("quantity")).cast("string").alias("q"),
        F.lit(1).alias("n"),
        (F.col("quantity") >= 10).alias("x"),
    )
    return trades.select(F.col("tradeId").alias("seq"), F.to_json(message).alias("value"))


def trade_messages(trades: DataFrame) -> DataFrame:
    message = F.struct(
        F.col("symbol").alias("s"),
        F.col("price").cast("string").alias("p"),
        F.col("quantity").cast("string").alias("q"),
        F.col("time").alias("T"),
        F.col("isBuyerMaker").alias("m"),
        F.col("tradeId").alias("t"),
    )
    return trades.select(F.col("tradeId").alias("seq"), F.to_json(message).alias("value"))


def depth_messages(trades: DataFrame) -> DataFrame:
    """A one-level book update per trade: price level floor(price), quantity k mod 10 (0 deletes)."""
    level = F.array(
        F.array(
            F.floor("price").cast("string"),
            F.pmod(F.col("quantity").cast("int"), F.lit(10)).cast("string"),
        )
    )
    none = F.array().cast("array<array<string>>")
    message = F.struct(
        F.col("symbol").alias("s"),
        F.col("tradeId").alias("u"),
        F.when(F.col("isBuyerMaker"), level).otherwise(none).alias("b"),
        F.when(F.col("isBuyerMaker"), none).otherwise(level).alias("a"),
        F.col("time").alias("received_at"),
    )
    return trades.select(F.col("tradeId").alias("seq"), F.to_json(message).alias("value"))


def mixed_depth_messages(trades: DataFrame) -> DataFrame:
    """Book messages of several levels: diffs with deletions, and every seventh one a full book.

    A trade sets two neighbouring levels of its side and one of the other; ids are the arrival number
    plus k, so that some messages are stale.
    """
    k = F.col("quantity").cast("int")
    level = lambda add, plus: F.array((F.floor("price") + add).cast("string"), F.pmod(k + plus, F.lit(10)).cast("string"))
    own, other = F.array(level(0, 0), level(1, 3)), F.array(level(5, 1))
    bids = F.when(F.col("isBuyerMaker"), own).otherwise(other)
    asks = F.when(F.col("isBuyerMaker"), other).otherwise(own)
    full = F.col("tradeId") % 7 == 0
    u = F.col("tradeId") + k
    message = F.struct(
        F.col("symbol").alias("s"),
        F.when(~full, u).alias("u"), F.when(~full, bids).alias("b"), F.when(~full, asks).alias("a"),
        F.when(full, u).alias("lastUpdateId"), F.when(full, asks).alias("bids"), F.when(full, bids).alias("asks"),
        F.col("time").alias("received_at"),
    )
    return trades.select(F.col("tradeId").alias("seq"), F.to_json(message).alias("value"))


def lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per supplier as trades; ``seq`` orders the sales of a day.

    ``seq`` is one number made of order, line, part and price in cents, so that aggregates ordered
    by it stay hash aggregates.
    """
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    digits = lambda c, n: F.lpad(c.cast("bigint").cast("string"), n, "0")
    sale = F.concat(
        digits(F.col("l_orderkey"), 12), digits(F.col("l_linenumber"), 3), digits(F.col("l_partkey"), 11),
        digits(F.round(F.col("l_extendedprice") * 100), 12),
    ).cast("decimal(38,0)")
    return li.select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        utc_millis("l_shipdate").alias("time"),
        sale.alias("seq"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
    )
