"""Record layouts and fixed domain values."""

from pyspark.sql import types as T

MINUTE_MS = 60_000
HOUR_MS = 60 * MINUTE_MS
DAY_MS = 24 * HOUR_MS

# Candle widths in milliseconds.
INTERVAL_MS = {
    "1m": MINUTE_MS,
    "5m": 5 * MINUTE_MS,
    "1h": HOUR_MS,
    "4h": 4 * HOUR_MS,
    "5h": 5 * HOUR_MS,
    "1d": DAY_MS,
}

# Default trading pairs.
DEFAULT_SYMBOLS = [
    "BTCUSDT", "ETHUSDT", "BNBUSDT", "SOLUSDT", "ADAUSDT",
    "XRPUSDT", "DOGEUSDT", "DOTUSDT", "MATICUSDT", "AVAXUSDT",
    "LINKUSDT", "UNIUSDT", "LTCUSDT", "ATOMUSDT", "ETCUSDT",
]

# Model inputs, in coefficient order.
FEATURES = [
    "return_1", "return_2",
    "price_to_ma5", "price_to_ma20",
    "volatility_5", "volatility_10",
    "volume_ratio",
    "rsi",
    "price_range", "body_size",
]

CANDLE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("interval", T.StringType()),
    T.StructField("openTime", T.LongType()),
    T.StructField("closeTime", T.LongType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("quoteVolume", T.DoubleType()),
    T.StructField("trades", T.IntegerType()),
])

TRADE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("time", T.LongType()),
    T.StructField("isBuyerMaker", T.BooleanType()),
    T.StructField("tradeId", T.LongType()),
])

PREDICTION = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("openTime", T.LongType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("predicted_price", T.DoubleType()),
    T.StructField("predicted_change_pct", T.DoubleType()),
    T.StructField("direction", T.StringType()),
    T.StructField("prediction_time", T.StringType()),
    T.StructField("target_time", T.StringType()),
    T.StructField("return_1", T.DoubleType()),
    T.StructField("rsi", T.DoubleType()),
    T.StructField("volatility_5", T.DoubleType()),
    T.StructField("volume_ratio", T.DoubleType()),
])

PRICE_MESSAGE = "symbol STRING, price DOUBLE, quantity DOUBLE, event_time BIGINT"
CSV_TICK = "timestamp STRING, ticker STRING, price DOUBLE, volume DOUBLE"

LEVELS = "ARRAY<ARRAY<STRING>>"
DEPTH_MESSAGE = (
    f"s STRING, u BIGINT, lastUpdateId BIGINT, b {LEVELS}, a {LEVELS}, "
    f"bids {LEVELS}, asks {LEVELS}, received_at BIGINT"
)
