"""Exchange messages (JSON text) to typed rows. Every function works on batches and streams.

Field names differ only by case ('t' and 'T'), which struct access cannot tell apart, so flat
messages are read with ``json_tuple``: one pass, case sensitive, all fields as text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import utc_iso
from tickloom.schemas import DEPTH_MESSAGE, PRICE_MESSAGE

KLINE_FIELDS = ["s", "i", "t", "T", "o", "h", "l", "c", "v", "q", "n", "x"]
TRADE_FIELDS = ["s", "p", "q", "T", "m", "t", "received_at"]


def _fields(df: DataFrame, value: str, names: list[str], keep: Sequence[str]) -> DataFrame:
    """Columns f0, f1, ... hold the named fields as text."""
    json = F.col(value).cast("string")
    return df.select(*keep, F.json_tuple(json, *names).alias(*[f"f{n}" for n in range(len(names))]))


def _parsed(value: str, schema: str) -> Column:
    """Generator of the message's fields as columns.

    As a generator it runs once per message; as a plain struct column it would be copied into
    every filter on a field, and the text parsed again there.
    """
    return F.inline(F.array(F.from_json(F.col(value).cast("string"), schema)))


def _number(text: str, kind: str, missing=None) -> Column:
    """Absent -> ``missing``; present but malformed -> null."""
    col = F.col(text)
    if missing is None:
        return col.try_cast(kind)
    return F.when(col.isNull(), F.lit(missing).cast(kind)).otherwise(col.try_cast(kind))


def parse_klines(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Candle updates. Unparsable messages (null symbol) are dropped, absent numbers become 0."""
    f = dict(zip(KLINE_FIELDS, (f"f{n}" for n in range(len(KLINE_FIELDS)))))
    return (
        _fields(df, value, KLINE_FIELDS, keep)
        .filter(F.col(f["s"]).isNotNull())
        .select(
            *keep,
            F.col(f["s"]).alias("symbol"),
            F.coalesce(F.col(f["i"]), F.lit("1m")).alias("interval"),
            _number(f["t"], "bigint").alias("openTime"),
            _number(f["T"], "bigint").alias("closeTime"),
            _number(f["o"], "double", 0).alias("open"),
            _number(f["h"], "double", 0).alias("high"),
            _number(f["l"], "double", 0).alias("low"),
            _number(f["c"], "double", 0).alias("close"),
            _number(f["v"], "double", 0).alias("volume"),
            _number(f["q"], "double", 0).alias("quoteVolume"),
            _number(f["n"], "int", 0).alias("trades"),
            F.coalesce(F.col(f["x"]).try_cast("boolean"), F.lit(False)).alias("x"),
        )
    )


def closed_only(df: DataFrame, flag: str = "x") -> DataFrame:
    return df.filter(F.coalesce(F.col(flag), F.lit(False)))


def valid_tick(
    df: DataFrame, price: str = "close", symbol: str = "symbol", time: str = "openTime"
) -> DataFrame:
    return df.filter(F.col(price).isNotNull() & F.col(symbol).isNotNull() & F.col(time).isNotNull())


def parse_trades(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Trade tape rows; the arrival time stands in for an absent trade time."""
    f = dict(zip(TRADE_FIELDS, (f"f{n}" for n in range(len(TRADE_FIELDS)))))
    symbol = F.col(f["s"])
    return (
        _fields(df, value, TRADE_FIELDS, keep)
        .filter(symbol.isNotNull() & (symbol != "UNKNOWN"))
        .select(
            *keep,
            symbol.alias("symbol"),
            _number(f["p"], "double", 0).alias("price"),
            _number(f["q"], "double", 0).alias("quantity"),
            F.coalesce(_number(f["T"], "bigint"), _number(f["received_at"], "bigint")).alias("time"),
            F.coalesce(F.col(f["m"]).try_cast("boolean"), F.lit(False)).alias("isBuyerMaker"),
            _number(f["t"], "bigint").alias("tradeId"),
        )
    )


def parse_prices(df: DataFrame, value: str = "value") -> DataFrame:
    """The small price message: symbol, price, quantity, event_time."""
    return df.select(_parsed(value, PRICE_MESSAGE)).filter(F.col("symbol").isNotNull())


def read_depth(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per book message, arrays kept: symbol, u, bids, asks, kind, received_at.

    ``kind`` is 'diff' for incremental messages (b/a) and 'snapshot' for full ones (bids/asks).
    """
    diff = F.col("b").isNotNull() | F.col("a").isNotNull()
    return (
        df.select(*keep, _parsed(value, DEPTH_MESSAGE))
        .filter(~F.upper(F.coalesce("s", F.lit(""))).isin("", "UNKNOWN"))
        .select(
            *keep,
            F.upper("s").alias("symbol"),
            F.coalesce("u", "lastUpdateId").alias("u"),
            F.when(diff, F.col("b")).otherwise(F.col("bids")).alias("bids"),
            F.when(diff, F.col("a")).otherwise(F.col("asks")).alias("asks"),
            F.when(diff, "diff").otherwise("snapshot").alias("kind"),
            "received_at",
        )
    )


def parse_depth(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per level: symbol, side, pos, price, qty, u, kind, received_at.

    Levels with fewer than two entries are skipped. Prices are compared as numbers, so "100.10"
    and "100.1" are one level.
    """
    def side(name: str, levels: str) -> Column:
        return F.transform(
            F.coalesce(F.col(levels), F.array().cast("array<array<string>>")),
            lambda level, pos: F.struct(
                F.lit(name).alias("side"), pos.alias("pos"), level.alias("level")
            ),
        )

    return (
        read_depth(df, value, keep)
        .select(
            *keep,
            "symbol",
            "u",
            "kind",
            "received_at",
            F.explode(F.concat(side("bid", "bids"), side("ask", "asks"))).alias("l"),
        )
        .filter(F.size("l.level") >= 2)
        .select(
            *keep,
            "symbol",
            F.col("l.side").alias("side"),
            F.col("l.pos").alias("pos"),
            F.col("l.level")[0].try_cast("double").alias("price"),
            F.col("l.level")[1].try_cast("double").alias("qty"),
            "u",
            "kind",
            "received_at",
        )
    )


def snapshot_view(df: DataFrame, limit: int = 20, value: str = "value") -> DataFrame:
    """Full-book messages as served: the best ``limit`` levels with running totals per side.

    Incremental messages and messages with an empty side are dropped. The levels of one message
    arrive best first, so the running total is a fold over the message's own short arrays.
    """
    def totals(levels: str) -> Column:
        entry = "array<struct<price:double,quantity:double,total:double>>"
        usable = F.filter(
            F.slice(F.col(levels), 1, limit), lambda l: F.size(l) >= 2
        )
        return F.aggregate(
            usable,
            F.struct(F.lit(0.0).alias("sum"), F.array().cast(entry).alias("out")),
            lambda acc, l: F.struct(
                (acc["sum"] + l[0].try_cast("double") * l[1].try_cast("double")).alias("sum"),
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            l[0].try_cast("double").alias("price"),
                            l[1].try_cast("double").alias("quantity"),
                            (acc["sum"] + l[0].try_cast("double") * l[1].try_cast("double")).alias("total"),
                        )
                    ),
                ).alias("out"),
            ),
            lambda acc: acc["out"],
        )

    return (
        read_depth(df, value)
        .filter((F.col("kind") == "snapshot") & (F.size("bids") > 0) & (F.size("asks") > 0))
        .select(
            "symbol",
            totals("bids").alias("bids"),
            totals("asks").alias("asks"),
            F.col("received_at").alias("timestamp"),
        )
        .filter((F.size("bids") > 0) & (F.size("asks") > 0))
    )


def unwrap_kline(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Candle payload of an envelope ``{stream, data: {k}}`` or of the bare ``{k}``."""
    json = F.col(value).cast("string")
    payload = F.coalesce(F.get_json_object(json, "$.data.k"), F.get_json_object(json, "$.k"))
    return df.select(*keep, payload.alias("value")).filter(
        F.col("value").isNotNull() & (F.col("value") != "{}")
    )


def route(df: DataFrame, received_at: Column | str, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Split ``{stream, data}`` envelopes: route ('orderbook' or 'trades'), key, enriched value.

    The value is the payload with ``stream`` and ``received_at`` added; the key is the upper-case
    symbol. Other streams and empty symbols are dropped.
    """
    json = F.col(value).cast("string")
    arrived = F.col(received_at) if isinstance(received_at, str) else received_at
    stream, data = F.col("stream"), F.col("data")
    symbol = F.upper(F.get_json_object(data, "$.s"))
    body = F.substring(data, F.lit(1), F.length(data) - 1)
    added = F.to_json(F.struct("stream", "received_at"))
    enriched = F.concat(body, F.lit(","), F.substring(added, F.lit(2), F.length(added)))
    return (
        df.select(
            *keep, F.json_tuple(json, "stream", "data").alias("stream", "data"), arrived.alias("received_at")
        )
        .withColumn(
            "route",
            F.when(stream.contains("@depth"), "orderbook").when(stream.contains("@trade"), "trades"),
        )
        .withColumn("key", symbol)
        .filter(F.col("route").isNotNull() & (F.coalesce(F.col("key"), F.lit("")) != ""))
        .select(*keep, "route", "key", enriched.alias("value"), "stream", "received_at")
    )


def decode_rest_klines(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Positional candle arrays to candles. ``df`` has symbol and interval beside the array text."""
    a = F.col("a")
    return (
        df.select(
            *keep,
            "symbol",
            "interval",
            F.from_json(F.col(value).cast("string"), "array<string>").alias("a"),
        )
        .filter(F.size("a") >= 9)
        .select(
            *keep,
            "symbol",
            "interval",
            a[0].try_cast("bigint").alias("openTime"),
            a[6].try_cast("bigint").alias("closeTime"),
            a[1].try_cast("double").alias("open"),
            a[2].try_cast("double").alias("high"),
            a[3].try_cast("double").alias("low"),
            a[4].try_cast("double").alias("close"),
            a[5].try_cast("double").alias("volume"),
            a[7].try_cast("double").alias("quoteVolume"),
            a[8].try_cast("int").alias("trades"),
        )
        .withColumns({"openTimeISO": utc_iso("openTime"), "closeTimeISO": utc_iso("closeTime")})
    )
