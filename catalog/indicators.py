"""Window analytics over tick candles: every trade of the table is a candle of its symbol."""

from pyspark.sql import functions as F

from catalog.base import CANDLES, USER_CANDLES, r, register, rounded
from tickloom.operators import indicators as ind
from tickloom.operators.features import drop_null_features, feature_table
from tickloom.schemas import FEATURES
from tickloom.sources import testdata as td

ORDER = ["openTime", "seq"]
W = 'PARTITION BY symbol ORDER BY "openTime", seq'
KEYS = 'symbol, "openTime", seq, close'


def rows(n: int) -> str:
    return f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def full(expr: str, n: int) -> str:
    return f"CASE WHEN count(close) OVER {rows(n)} = {n} THEN {expr} END"


def _closes(spark, d, symbol="event_type"):
    return td.tick_candles(td.ticks(spark, d, symbol)).select("symbol", "openTime", "seq", "close")


@register(
    "price_lags",
    f"""WITH {CANDLES} SELECT {KEYS}, lag(close, 1) OVER ({W}) AS close_lag1,
    lag(close, 2) OVER ({W}) AS close_lag2, lag(close, 3) OVER ({W}) AS close_lag3 FROM candles""",
)
def price_lags(spark, d):
    return ind.lags(_closes(spark, d), order=ORDER)


@register(
    "sma_partial",
    f"WITH {CANDLES} SELECT {KEYS}, {r(f'avg(close) OVER {rows(14)}', 'sma_14')} FROM candles",
)
def sma_partial(spark, d):
    return rounded(ind.sma(_closes(spark, d), "close", {"sma_14": 14}, order=ORDER), "sma_14")


@register(
    "sma_full",
    f"WITH {CANDLES} SELECT {KEYS}, "
    + ", ".join(r(full(f"avg(close) OVER {rows(n)}", n), f"sma_{n}") for n in (7, 25, 99))
    + " FROM candles",
)
def sma_full(spark, d):
    periods = {"sma_7": 7, "sma_25": 25, "sma_99": 99}
    out = ind.sma(_closes(spark, d), "close", periods, partial=False, order=ORDER)
    return rounded(out, *periods)


def _band(n, k, fn):
    mean, spread = f"avg(close) OVER {rows(n)}", f"{fn}(close) OVER {rows(n)}"
    return full(f"{mean} + {k} * {spread}", n), full(f"{mean} - {k} * {spread}", n), full(mean, n)


_UP, _LOW, _MID = _band(20, 2, "stddev_samp")


@register(
    "bollinger_sample",
    f"""WITH {CANDLES} SELECT {KEYS}, {r(_UP, 'bollinger_upper_20')},
    {r(_LOW, 'bollinger_lower_20')} FROM candles""",
)
def bollinger_sample(spark, d):
    out = ind.bollinger(_closes(spark, d), "close", order=ORDER)
    return rounded(out, "bollinger_upper_20", "bollinger_lower_20")


_UP0, _LOW0, _ = _band(20, 2, "stddev_pop")


@register(
    "bollinger_population",
    f"""WITH {CANDLES} SELECT {KEYS}, {r(_UP0, 'bollinger_upper_20')},
    {r(_LOW0, 'bollinger_lower_20')}, {r(_MID, 'bollinger_middle_20')} FROM candles""",
)
def bollinger_population(spark, d):
    out = ind.bollinger(_closes(spark, d), "close", ddof=0, middle=True, order=ORDER)
    return rounded(out, "bollinger_upper_20", "bollinger_lower_20", "bollinger_middle_20")


RSI_STEPS = f"""
steps AS (SELECT *, coalesce(close - lag(close) OVER ({W}), 0) AS step FROM candles),
moves AS (
  SELECT *, count(close) OVER {rows(14)} AS n,
         avg(greatest(step, 0)) OVER {rows(14)} AS gain,
         avg(greatest(-step, 0)) OVER {rows(14)} AS loss
  FROM steps)"""
RSI = """CASE WHEN n = 14 AND loss > 0 THEN 100 - 100 / (1 + gain / loss)
              WHEN n = 14 AND gain > 0 THEN 100.0 END"""


@register(
    "rsi_price", f"WITH {CANDLES}, {RSI_STEPS} SELECT {KEYS}, {r(RSI, 'rsi_14')} FROM moves"
)
def rsi_price(spark, d):
    return rounded(ind.rsi_price(_closes(spark, d), "close", order=ORDER), "rsi_14")


def numbered(candles: str) -> str:
    return f"""WITH RECURSIVE {candles},
numbered AS MATERIALIZED (
  SELECT {KEYS}, row_number() OVER ({W}) AS rn FROM candles)"""


def ema_cte(name: str, n: int, source: str = "numbered", value: str = "close") -> str:
    """First-value seed, one recursion step per row number."""
    a = 2.0 / (n + 1)
    return f""",
{name} AS (
  SELECT symbol, rn, {value} AS e FROM {source} WHERE rn = 1
  UNION ALL
  SELECT t.symbol, t.rn, {a!r} * t.{value} + {1 - a!r} * p.e
  FROM {name} p JOIN {source} t ON t.symbol = p.symbol AND t.rn = p.rn + 1)"""


@register(
    "ema_first_seed",
    numbered(CANDLES) + ema_cte("e12", 12)
    + f" SELECT {KEYS}, {r('e', 'ema_12')} FROM numbered JOIN e12 USING (symbol, rn)",
)
def ema_first_seed(spark, d):
    return rounded(ind.ema(_closes(spark, d), "close", {"ema_12": 12}, order=ORDER), "ema_12")


def sma_seed_cte(name: str, n: int) -> str:
    a = 2.0 / (n + 1)
    return f""",
{name} AS (
  SELECT symbol, CAST({n} AS BIGINT) AS rn, avg(close) AS e FROM numbered
  WHERE rn <= {n} GROUP BY symbol HAVING count(*) = {n}
  UNION ALL
  SELECT t.symbol, t.rn, (t.close - p.e) * {a!r} + p.e
  FROM {name} p JOIN numbered t ON t.symbol = p.symbol AND t.rn = p.rn + 1)"""


@register(
    "ema_mean_seed",
    numbered(USER_CANDLES) + sma_seed_cte("a", 12) + sma_seed_cte("b", 26) + sma_seed_cte("c", 50)
    + f""" SELECT {KEYS}, {r('a.e', 'ema_12')}, {r('b.e', 'ema_26')}, {r('c.e', 'ema_50')}
    FROM numbered LEFT JOIN a USING (symbol, rn) LEFT JOIN b USING (symbol, rn)
    LEFT JOIN c USING (symbol, rn)""",
)
def ema_mean_seed(spark, d):
    spans = {"ema_12": 12, "ema_26": 26, "ema_50": 50}
    out = ind.ema(_closes(spark, d, "user_id"), "close", spans, seed="sma", order=ORDER)
    return rounded(out, *spans)


MACD = (
    numbered(CANDLES) + ema_cte("e12", 12) + ema_cte("e26", 26)
    + """,
macds AS MATERIALIZED (
  SELECT symbol, rn, e12.e AS fast, e26.e AS slow, e12.e - e26.e AS macd
  FROM e12 JOIN e26 USING (symbol, rn))"""
    + ema_cte("sig", 9, "macds", "macd")
)
MACD_COLS = ", ".join(
    (r("fast", "ema_12"), r("slow", "ema_26"), r("macd", "macd"), r("sig.e", "macd_signal"))
)


@register(
    "macd",
    f"{MACD} SELECT {KEYS}, {MACD_COLS} FROM numbered "
    "JOIN macds USING (symbol, rn) JOIN sig USING (symbol, rn)",
)
def macd(spark, d):
    out = ind.macd(_closes(spark, d), "close", order=ORDER)
    return rounded(out, "ema_12", "ema_26", "macd", "macd_signal")


@register(
    "indicator_table",
    f"""{MACD}, {RSI_STEPS}
    SELECT {KEYS}, {MACD_COLS}, {r(f'avg(close) OVER {rows(14)}', 'sma_14')},
           {r(RSI, 'rsi_14')}, {r(_UP, 'bollinger_upper_20')}, {r(_LOW, 'bollinger_lower_20')}
    FROM moves JOIN (SELECT seq, rn FROM numbered) USING (seq)
    JOIN macds USING (symbol, rn) JOIN sig USING (symbol, rn)""",
)
def indicator_table(spark, d):
    out = ind.indicator_table(_closes(spark, d), order=ORDER)
    added = [c for c in out.columns if c not in ("symbol", "openTime", "seq", "close")]
    return rounded(out, *added)


def feature_sql(source: str = "candles", order: str = '"openTime", seq') -> str:
    """CTEs ending in ``features``: every feature and the target of each row of ``source``.

    A change against a zero price is null, as in the operators.
    """
    w = f"PARTITION BY symbol ORDER BY {order}"

    def f(n):
        return f"({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"

    return f"""
base AS (
  SELECT *, high - low AS price_range, close - open AS body_size,
         high - greatest(open, close) AS upper_shadow, least(open, close) - low AS lower_shadow,
         lag(close, 1) OVER ({w}) AS close_lag1, lag(close, 2) OVER ({w}) AS close_lag2,
         lag(close, 3) OVER ({w}) AS close_lag3, lead(close) OVER ({w}) AS next_close,
         avg(close) OVER {f(5)} AS ma5, avg(close) OVER {f(10)} AS ma10,
         avg(close) OVER {f(20)} AS ma20, stddev_samp(close) OVER {f(5)} AS volatility_5,
         stddev_samp(close) OVER {f(10)} AS volatility_10, avg(volume) OVER {f(5)} AS volume_ma5
  FROM {source}),
rets AS (
  SELECT *, CASE WHEN close_lag1 IS NULL THEN 0
           ELSE (close - close_lag1) / nullif(close_lag1, 0) * 100 END AS return_1,
         CASE WHEN close_lag2 IS NULL THEN 0
           ELSE (close - close_lag2) / nullif(close_lag2, 0) * 100 END AS return_2,
         CASE WHEN volume_ma5 > 0 THEN volume / volume_ma5 ELSE 1.0 END AS volume_ratio,
         CASE WHEN ma5 > 0 THEN (close - ma5) / ma5 * 100 ELSE 0 END AS price_to_ma5,
         CASE WHEN ma20 > 0 THEN (close - ma20) / ma20 * 100 ELSE 0 END AS price_to_ma20,
         (next_close - close) / nullif(close, 0) * 100 AS target
  FROM base),
moved AS (
  SELECT *, avg(greatest(return_1, 0)) OVER {f(14)} AS avg_gain,
         avg(greatest(-return_1, 0)) OVER {f(14)} AS avg_loss
  FROM rets),
features AS (
  SELECT *, CASE WHEN avg_loss > 0 THEN 100 - 100 / (1 + avg_gain / avg_loss)
                 WHEN avg_gain > 0 THEN 100.0 ELSE 50.0 END AS rsi
  FROM moved)"""


SHOWN = FEATURES + [
    "upper_shadow", "lower_shadow", "close_lag1", "close_lag2", "close_lag3", "ma5", "ma10",
    "ma20", "volume_ma5", "avg_gain", "avg_loss", "next_close", "target",
]


@register(
    "feature_table",
    f"WITH {CANDLES}, {feature_sql()} SELECT {KEYS}, "
    + ", ".join(r(c, c) for c in SHOWN) + " FROM features",
)
def feature_table_query(spark, d):
    out = feature_table(td.tick_candles(td.ticks(spark, d)), order=ORDER)
    return rounded(out.select("symbol", "openTime", "seq", "close", *SHOWN), *SHOWN)


@register(
    "training_rows",
    f"WITH {CANDLES}, {feature_sql()} SELECT {KEYS}, {r('target', 'target')}, "
    + ", ".join(r(c, c) for c in FEATURES)
    + " FROM features WHERE target IS NOT NULL AND "
    + " AND ".join(f"{c} IS NOT NULL" for c in FEATURES),
)
def training_rows(spark, d):
    out = drop_null_features(feature_table(td.tick_candles(td.ticks(spark, d)), order=ORDER), True)
    return rounded(out.select("symbol", "openTime", "seq", "close", "target", *FEATURES), "target", *FEATURES)


@register(
    "candle_geometry",
    f"""WITH {CANDLES} SELECT {KEYS}, {r('high - low', 'price_range')},
    {r('close - open', 'body_size')}, {r('high - greatest(open, close)', 'upper_shadow')},
    {r('least(open, close) - low', 'lower_shadow')},
    {r('CASE WHEN open > 0 THEN (close - open) / open * 100 ELSE 0 END', 'change_pct')},
    close >= open AS up FROM (
      SELECT symbol, min("openTime") AS "openTime", min(seq) AS seq, arg_min(open, seq) AS open,
             max(high) AS high, min(low) AS low, arg_max(close, seq) AS close
      FROM candles GROUP BY symbol, "openTime" - "openTime" % 3600000)""",
)
def candle_geometry(spark, d):
    from tickloom.functions.scalars import bucket_start, candle_change_pct, candle_up, geometry

    candles = td.tick_candles(td.ticks(spark, d))
    bars = candles.groupBy("symbol", bucket_start("openTime", 3_600_000)).agg(
        F.min("openTime").alias("openTime"), F.min("seq").alias("seq"),
        F.min_by("open", "seq").alias("open"), F.max("high").alias("high"),
        F.min("low").alias("low"), F.max_by("close", "seq").alias("close"),
    )
    out = bars.withColumns({**geometry(), "change_pct": candle_change_pct(), "up": candle_up()})
    cols = [*geometry(), "change_pct"]
    return rounded(out.select("symbol", "openTime", "seq", "close", *cols, "up"), *cols)
