"""Message parsing and typed ingest. The messages are built from the events table."""

from pyspark.sql import functions as F

from catalog.base import CANDLES, TICKS, r, register, rounded
from tickloom.functions import scalars as sc
from tickloom.sources import messages as ms
from tickloom.sources import tables as tb
from tickloom.sources import testdata as td

KLINE_COLS = """symbol, '1m' AS interval, "time" AS "openTime", "time" + 59999 AS "closeTime",
  price AS open, price AS high, price AS low, price AS close, quantity AS volume"""
QUOTE = r("price * quantity", "quoteVolume", 4)


def _klines(spark, d):
    return td.kline_messages(td.ticks(spark, d))


@register(
    "parse_klines",
    f"""WITH {TICKS} SELECT {KLINE_COLS}, {QUOTE}, CAST(1 AS INTEGER) AS trades, quantity >= 10 AS x,
    CASE WHEN quantity >= 10 THEN 'realtime' ELSE 'update' END AS type FROM ticks""",
)
def parse_klines(spark, d):
    out = ms.parse_klines(_klines(spark, d)).withColumn("type", sc.event_type())
    return rounded(out, "quoteVolume", digits=4)


@register(
    "closed_klines",
    f"""WITH {TICKS} SELECT {KLINE_COLS}, {QUOTE}, CAST(1 AS INTEGER) AS trades, true AS x
    FROM ticks WHERE quantity >= 10""",
)
def closed_klines(spark, d):
    out = ms.valid_tick(ms.closed_only(ms.parse_klines(_klines(spark, d))))
    return rounded(out, "quoteVolume", digits=4)


@register(
    "unwrap_kline_envelope",
    f"""WITH {TICKS} SELECT {KLINE_COLS}, {QUOTE}, CAST(1 AS INTEGER) AS trades,
    quantity >= 10 AS x FROM ticks""",
)
def unwrap_kline_envelope(spark, d):
    k = _klines(spark, d)
    wrapped = k.select(
        F.concat(F.lit('{"stream":"kline_1m","data":{"e":"kline","k":'), "value", F.lit("}}")).alias("value")
    )
    return rounded(ms.parse_klines(ms.unwrap_kline(wrapped)), "quoteVolume", digits=4)


@register(
    "parse_trades",
    f"""WITH {TICKS} SELECT symbol, price, quantity, "time", "isBuyerMaker", "tradeId",
    CASE WHEN "isBuyerMaker" THEN 'SELL' ELSE 'BUY' END AS side FROM ticks""",
)
def parse_trades(spark, d):
    out = ms.parse_trades(td.trade_messages(td.ticks(spark, d)))
    return out.withColumn("side", sc.trade_side())


@register(
    "parse_trades_arrival_time",
    """SELECT event_type AS symbol, value AS price, CAST(0 AS DOUBLE) AS quantity,
    epoch_us(ts) // 1000 AS "time", false AS "isBuyerMaker", CAST(NULL AS BIGINT) AS "tradeId" FROM events""",
)
def parse_trades_arrival_time(spark, d):
    sparse = F.struct(
        F.col("symbol").alias("s"), F.col("price").cast("string").alias("p"),
        F.col("time").alias("received_at"),
    )
    return ms.parse_trades(td.ticks(spark, d).select(F.to_json(sparse).alias("value")))


@register(
    "parse_prices",
    f'WITH {TICKS} SELECT symbol, price, quantity, "time" AS event_time FROM ticks',
)
def parse_prices(spark, d):
    message = F.struct("symbol", "price", "quantity", F.col("time").alias("event_time"))
    return ms.parse_prices(td.ticks(spark, d).select(F.to_json(message).alias("value")))


@register(
    "parse_depth",
    f"""WITH {TICKS} SELECT "tradeId" AS seq, upper(symbol) AS symbol,
    CASE WHEN "isBuyerMaker" THEN 'bid' ELSE 'ask' END AS side, CAST(0 AS INTEGER) AS pos,
    floor(price) AS price, CAST(quantity AS BIGINT) % 10 + 0.0::DOUBLE AS qty, "tradeId" AS u,
    'diff' AS kind, "time" AS received_at FROM ticks""",
)
def parse_depth(spark, d):
    return ms.parse_depth(td.depth_messages(td.ticks(spark, d)), keep=["seq"])


@register(
    "route_messages",
    f"""WITH {TICKS}, m AS (
      SELECT *, CASE WHEN "isBuyerMaker" THEN 'depth@1000ms' ELSE 'trade' END AS kind FROM ticks)
    SELECT CASE WHEN "isBuyerMaker" THEN 'orderbook' ELSE 'trades' END AS route,
      upper(symbol) AS key,
      '{{"s":"' || symbol || '","t":' || "tradeId" || ',"stream":"' || symbol || '@' || kind
        || '","received_at":' || "time" || '}}' AS value,
      symbol || '@' || kind AS stream, "time" AS received_at FROM m""",
)
def route_messages(spark, d):
    kind = F.when(F.col("isBuyerMaker"), "depth@1000ms").otherwise("trade")
    t = td.ticks(spark, d).withColumn("stream", F.concat("symbol", F.lit("@"), kind))
    data = F.struct(F.col("symbol").alias("s"), F.col("tradeId").alias("t"))
    envelope = t.select("time", F.to_json(F.struct("stream", data.alias("data"))).alias("value"))
    return ms.route(envelope, "time")


@register(
    "decode_rest_klines",
    f"""WITH {TICKS} SELECT symbol, '1m' AS interval, "time" AS "openTime",
      "time" - "time" % 60000 + 59999 AS "closeTime", price AS open, price AS high, price AS low,
      price AS close, quantity AS volume, {QUOTE}, CAST(1 AS INTEGER) AS trades,
      strftime(make_timestamp("time" * 1000), '%Y-%m-%dT%H:%M:%S')
        || CASE WHEN "time" % 1000 = 0 THEN '' ELSE '.' || lpad(CAST("time" % 1000 AS VARCHAR), 3, '0') || '000' END
        || '+00:00' AS "openTimeISO",
      strftime(make_timestamp(("time" - "time" % 60000 + 59999) * 1000), '%Y-%m-%dT%H:%M:%S')
        || '.999000+00:00' AS "closeTimeISO"
    FROM ticks""",
)
def decode_rest_klines(spark, d):
    t = td.ticks(spark, d)
    p = F.col("price").cast("string")
    cells = [
        F.col("time").cast("string"), p, p, p, p, F.col("quantity").cast("string"),
        (sc.bucket_start("time", 60_000) + 59_999).cast("string"),
        (F.col("price") * F.col("quantity")).cast("string"), F.lit("1"),
    ]
    raw = t.select("symbol", F.lit("1m").alias("interval"), F.to_json(F.array(*cells)).alias("value"))
    return rounded(ms.decode_rest_klines(raw), "quoteVolume", digits=4)


@register(
    "snapshot_view",
    f"""WITH {TICKS} SELECT upper(symbol) AS symbol, floor(price) AS bid, quantity AS bid_qty,
      floor(price) * quantity AS bid_total, floor(price) + 1 AS ask, quantity + 1 AS ask_qty,
      (floor(price) + 1) * (quantity + 1) AS ask_total, "time" AS "timestamp" FROM ticks""",
)
def snapshot_view(spark, d):
    def level(price, qty):
        return F.array(F.array(price.cast("string"), qty.cast("string")))

    p, q = F.floor("price"), F.col("quantity")
    message = F.struct(
        F.col("symbol").alias("s"), level(p, q).alias("bids"), level(p + 1, q + 1).alias("asks"),
        F.col("time").alias("received_at"),
    )
    out = ms.snapshot_view(td.ticks(spark, d).select(F.to_json(message).alias("value")))
    b, a = F.col("bids")[0], F.col("asks")[0]
    return out.select(
        "symbol", b["price"].alias("bid"), b["quantity"].alias("bid_qty"), b["total"].alias("bid_total"),
        a["price"].alias("ask"), a["quantity"].alias("ask_qty"), a["total"].alias("ask_total"), "timestamp",
    )


@register(
    "normalize_candles",
    f"""WITH {CANDLES} SELECT symbol, CAST(NULL AS BIGINT) AS "closeTime", "openTime",
      open, CAST(NULL AS DOUBLE) AS high, low, close, volume, CAST(1 AS INTEGER) AS trades FROM candles""",
)
def normalize_candles(spark, d):
    c = td.tick_candles(td.ticks(spark, d))
    raw = c.select(
        "symbol", F.col("openTime").cast("string").alias("openTime"), F.lit("n/a").alias("closeTime"),
        F.col("open").cast("string").alias("open"), F.concat(F.lit("$"), F.col("high").cast("string")).alias("high"),
        F.col("low").cast("string").alias("low"), F.col("close").cast("string").alias("close"),
        F.col("volume").cast("int").alias("volume"), F.col("trades").cast("string").alias("trades"),
    )
    return tb.normalize_candles(raw)


@register(
    "bucket_starts",
    f"""WITH {TICKS} SELECT "tradeId", "time" - "time" % 300000 AS m5, "time" - "time" % 3600000 AS h1,
      "time" - "time" % 18000000 AS h5, "time" - "time" % 86400000 AS d1,
      strftime(make_timestamp("time" * 1000), '%Y-%m-%d %H:%M:%S') AS at FROM ticks""",
)
def bucket_starts(spark, d):
    t = td.ticks(spark, d)
    return t.select(
        "tradeId",
        *[sc.bucket_start("time", w).alias(n) for n, w in (("m5", 300_000), ("h1", 3_600_000), ("h5", 18_000_000), ("d1", 86_400_000))],
        sc.utc_text("time").alias("at"),
    )


@register(
    "event_timestamps",
    """SELECT event_id, epoch_ms(date_trunc('milliseconds', ts)) AS ms,
      CAST(microsecond(ts) // 1000 AS BIGINT) AS millis FROM events""",
)
def event_timestamps(spark, d):
    t = td.ticks(spark, d).withColumn("ts", sc.ms_to_ts("time"))
    return t.select(
        F.col("tradeId").alias("event_id"), F.unix_millis("ts").alias("ms"),
        F.pmod(F.unix_millis("ts"), F.lit(60_000)).alias("millis"),
    )


@register(
    "pair_labels",
    f"""WITH {TICKS} SELECT upper(symbol) || 'USDT' AS pair, upper(symbol) AS base,
      upper(symbol) || '/USDT' AS label, symbol AS plain_label, count(*) AS n FROM ticks
    GROUP BY 1, 2, 3, 4""",
)
def pair_labels(spark, d):
    t = td.ticks(spark, d).withColumn("pair", F.concat(F.upper("symbol"), F.lit("USDT")))
    out = t.select(
        "pair", sc.base_asset("pair").alias("base"), sc.pair_label("pair").alias("label"),
        sc.pair_label("symbol").alias("plain_label"),
    )
    return out.groupBy("pair", "base", "label", "plain_label").agg(F.count(F.lit(1)).alias("n"))


_MODES = "['realtime', '7day', '30day', '6month', '1year']"
_TABLES = "['5m_kline', '1h_kline', '4h_kline', '1d_kline', 'other']"


@register(
    "interval_lookups",
    f"""WITH {TICKS}, m AS (SELECT *, CASE symbol WHEN 'click' THEN 1
      WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END AS i FROM ticks)
    SELECT ({_MODES})[i] AS mode, (['1m', '5m', '1h', '4h', '1d'])[i] AS by_mode,
      ({_TABLES})[i] AS tbl, (['5m', '1h', '4h', '1d', '5m'])[i] AS by_table,
      count(*) AS n, CAST(([60000, 300000, 3600000, 14400000, 86400000])[i] AS BIGINT) AS ms
    FROM m GROUP BY i""",
)
def interval_lookups(spark, d):
    kinds = F.array(*[F.lit(k) for k in ("click", "view", "purchase", "signup", "error")])
    i = F.array_position(kinds, F.col("symbol")).cast("int")

    def pick(names):
        return F.element_at(F.array(*[F.lit(n) for n in names]), i)

    t = td.ticks(spark, d).select(
        pick(["realtime", "7day", "30day", "6month", "1year"]).alias("mode"),
        pick(["5m_kline", "1h_kline", "4h_kline", "1d_kline", "other"]).alias("tbl"),
    )
    out = t.groupBy("mode", "tbl").agg(F.count(F.lit(1)).alias("n"))
    return out.withColumns(
        {"by_mode": sc.range_to_interval("mode"), "by_table": sc.collection_to_interval("tbl")}
    ).withColumn("ms", sc.interval_ms("by_mode").cast("bigint"))
