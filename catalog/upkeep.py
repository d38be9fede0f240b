"""Keyed writes, latest views, checks and backfill planning."""

from pyspark.sql import functions as F

from catalog.bars import BAR_SQL, tick_bars
from catalog.base import AFTER_END, CANDLES, LAST_DAY, MID_MONTH, TICKS, bars_cte, register, rounded
from catalog.forecasts import HOURLY_PREDICTIONS, PREDICTION, ROUNDED, forecasts
from tickloom.operators.rollup import rollup_ohlc
from tickloom.schemas import DAY_MS, HOUR_MS
from tickloom.session import run_dir
from tickloom.sources import tables as tb
from tickloom.sources import testdata as td

# Two overlapping versions of the hourly candles: all of the month from trades of at least ten
# units, and from mid-month from every trade.
H = f'"openTime" - "openTime" % {HOUR_MS}'
VERSIONS = f"""{CANDLES},
stored AS (SELECT symbol, '1h' AS interval, {H} AS "openTime", arg_max(close, seq) AS close,
  sum(volume) AS volume FROM candles WHERE volume >= 10 GROUP BY 1, 2, 3),
fresh AS (SELECT symbol, '1h' AS interval, {H} AS "openTime", arg_max(close, seq) AS close,
  sum(volume) AS volume FROM candles WHERE "openTime" >= {MID_MONTH} GROUP BY 1, 2, 3)"""


def _version(df):
    start = F.col("openTime") - F.pmod("openTime", F.lit(HOUR_MS))
    return df.groupBy("symbol", F.lit("1h").alias("interval"), start.alias("openTime")).agg(
        F.max_by("close", "seq").alias("close"), F.sum("volume").alias("volume")
    )


def versions(spark, d):
    c = td.tick_candles(td.ticks(spark, d))
    return _version(c.filter("volume >= 10")), _version(c.filter(F.col("openTime") >= MID_MONTH))


@register(
    "upsert_candles",
    f"""WITH {VERSIONS} SELECT * FROM fresh UNION ALL
    SELECT * FROM stored ANTI JOIN fresh USING (symbol, interval, "openTime")""",
)
def upsert_candles(spark, d):
    return tb.upsert(*versions(spark, d))


@register(
    "upsert_report",
    f"""WITH {VERSIONS}, j AS (SELECT s.symbol IS NULL AS new,
      (s.close, s.volume) IS DISTINCT FROM (f.close, f.volume) AS differs
      FROM fresh f LEFT JOIN stored s USING (symbol, interval, "openTime"))
    SELECT count(*) FILTER (new) AS inserted, count(*) FILTER (NOT new AND differs) AS modified,
      count(*) FILTER (NOT new AND NOT differs) AS skipped FROM j""",
)
def upsert_report(spark, d):
    return tb.upsert_report(*versions(spark, d), values=["close", "volume"])


@register(
    "insert_if_absent",
    f"""WITH {VERSIONS} SELECT * FROM fresh ANTI JOIN stored USING (symbol, interval, "openTime")""",
)
def insert_if_absent(spark, d):
    return tb.insert_if_absent(*versions(spark, d))


@register(
    "merge_pages",
    f"""WITH {VERSIONS} SELECT * FROM stored UNION ALL
    SELECT * FROM fresh ANTI JOIN stored USING (symbol, "openTime") ORDER BY symbol, "openTime" """,
)
def merge_pages(spark, d):
    stored, fresh = versions(spark, d)
    return tb.merge_pages(fresh, stored).orderBy("symbol", "openTime")


@register(
    "dedup_closed",
    f"""WITH {CANDLES} SELECT symbol, {H} AS "openTime", arg_max(close, seq) AS close, max(seq) AS seq
    FROM candles GROUP BY 1, 2""",
)
def dedup_closed(spark, d):
    c = td.tick_candles(td.ticks(spark, d))
    start = F.col("openTime") - F.pmod("openTime", F.lit(HOUR_MS))
    rows = c.select("symbol", start.alias("openTime"), "close", "seq")
    return tb.dedup_last(rows, ["symbol", "openTime"], "seq")


@register(
    "latest_view",
    f"""WITH {TICKS}, l AS (SELECT symbol, max("time") AS "time", arg_max(price, "tradeId") AS price,
      max("tradeId") AS "tradeId" FROM ticks GROUP BY 1)
    SELECT *, "time" + 1800000 AS expires_at FROM l
    WHERE (SELECT max("time") FROM ticks) < "time" + 1800000""",
)
def latest_view(spark, d):
    t = td.ticks(spark, d).select("symbol", "time", "price", "tradeId")
    view = tb.latest_view(t, ["symbol"], ["time", "tradeId"], 1_800_000)
    return tb.alive(view, t.select(F.max("time").alias("m")).scalar())


@register(
    "fetch_indexed",
    f"""WITH {CANDLES}, v AS (SELECT symbol, {H} AS "openTime", arg_max(close, seq) AS close,
      max("openTime") + {DAY_MS} AS expires_at FROM candles GROUP BY 1, 2),
    i AS (SELECT DISTINCT symbol, {H} AS "openTime" FROM candles)
    SELECT symbol, "openTime", close, expires_at FROM i JOIN v USING (symbol, "openTime")
    WHERE {LAST_DAY} < expires_at""",
)
def fetch_indexed(spark, d):
    c = td.tick_candles(td.ticks(spark, d))
    start = (F.col("openTime") - F.pmod("openTime", F.lit(HOUR_MS))).alias("openTime")
    index = c.select("symbol", start).distinct()
    values = c.groupBy("symbol", start).agg(
        F.max_by("close", "seq").alias("close"), (F.max(c["openTime"]) + DAY_MS).alias("expires_at")
    )
    return tb.fetch_indexed(index, values, LAST_DAY)


@register(
    "key_value_rows",
    f"""WITH {TICKS}, l AS (SELECT symbol, count(*) AS trade_count, max("tradeId") AS last_id
      FROM ticks GROUP BY 1)
    SELECT symbol AS key, '{{"s":"' || symbol || '","trade_count":' || trade_count || ',"last_id":'
      || last_id || '}}' AS value FROM l""",
)
def key_value_rows(spark, d):
    t = td.ticks(spark, d).groupBy(F.col("symbol").alias("s")).agg(
        F.count(F.lit(1)).alias("trade_count"), F.max("tradeId").alias("last_id")
    )
    return tb.to_kv(t, "s", ["s", "trade_count", "last_id"])


@register(
    "duplicate_keys",
    f"""WITH {VERSIONS}, a AS (SELECT * FROM stored UNION ALL SELECT * FROM fresh)
    SELECT symbol, interval, "openTime", count(*) AS copies FROM a GROUP BY 1, 2, 3 HAVING count(*) > 1""",
)
def duplicate_keys(spark, d):
    stored, fresh = versions(spark, d)
    return tb.duplicate_keys(stored.unionByName(fresh))


@register(
    "completeness",
    f"""WITH {CANDLES}, h AS (SELECT DISTINCT symbol, {H} AS t FROM candles)
    SELECT symbol, count(*) AS fetched, CAST(360 AS BIGINT) AS expected,
      greatest(360 - count(*), 0) AS missing, count(*) < 324 AS incomplete
    FROM h WHERE t >= {MID_MONTH} AND t < {MID_MONTH + 15 * DAY_MS} GROUP BY 1""",
)
def completeness(spark, d):
    hours = tick_bars(spark, d, "1h", align=True)
    return tb.completeness(hours, "1h", MID_MONTH, MID_MONTH + 15 * DAY_MS)


@register(
    "candle_gaps",
    f"""WITH {CANDLES}, h AS (SELECT DISTINCT symbol, {H} AS t FROM candles),
    l AS (SELECT *, lag(t) OVER (PARTITION BY symbol ORDER BY t) AS p FROM h)
    SELECT symbol, p + {HOUR_MS} AS gap_start, t AS gap_end, (t - p) // {HOUR_MS} - 1 AS missing
    FROM l WHERE t - p > {HOUR_MS}""",
)
def candle_gaps(spark, d):
    return tb.gaps(tick_bars(spark, d, "1h", align=True), "1h", cut=False)


def _targets(spark):
    pairs = [(s, i) for s in ("click", "view", "purchase", "signup", "error", "absent") for i in ("1m", "1h")]
    return spark.createDataFrame(pairs, "symbol string, interval string")


_RESUME = f"""{CANDLES}, newest AS (SELECT symbol, '1h' AS interval, max({H}) AS m FROM candles GROUP BY 1
  UNION ALL SELECT symbol, '1m', max("openTime" - "openTime" % 60000) FROM candles
  WHERE volume >= 10 GROUP BY 1),
targets AS (SELECT * FROM (VALUES ('click'), ('view'), ('purchase'), ('signup'), ('error'), ('absent')) s(symbol),
  (VALUES ('1m'), ('1h')) i(interval)),
resume AS (SELECT symbol, interval, CASE WHEN m IS NOT NULL AND (interval <> '1m' OR m >= {AFTER_END - DAY_MS})
    THEN m + 1 WHEN interval = '1m' THEN {AFTER_END - DAY_MS} ELSE {AFTER_END - 365 * DAY_MS} END AS start,
  CAST({AFTER_END} AS BIGINT) AS "end" FROM targets LEFT JOIN newest USING (symbol, interval))"""


def _resume(spark, d):
    c = td.tick_candles(td.ticks(spark, d))
    hours = rollup_ohlc(c, "1h", order="seq", align=True)
    minutes = rollup_ohlc(c.filter("volume >= 10"), "1m", order="seq", align=True)
    return tb.resume_point(hours.unionByName(minutes), _targets(spark), AFTER_END)


@register("resume_points", f"WITH {_RESUME} SELECT * FROM resume")
def resume_points(spark, d):
    return _resume(spark, d)


@register(
    "request_pages",
    f"""WITH {_RESUME}, w AS (SELECT *, CASE interval WHEN '1m' THEN 60000000 ELSE 3600000000 END AS w FROM resume),
    p AS (SELECT *, unnest(range(start, "end", w)) AS page_start FROM w)
    SELECT symbol, interval, page_start, least(page_start + w, "end") AS page_end FROM p""",
)
def request_pages(spark, d):
    return tb.plan_ranges(_resume(spark, d))


_TABLE = "WITH" + CANDLES + bars_cte("h1", "candles", HOUR_MS, "seq")


@register("candle_table_round_trip", f"""{_TABLE} SELECT symbol, '1h' AS interval, window_start, {BAR_SQL},
  strftime(make_timestamp("openTime" * 1000), '%Y-%m-%d') AS date FROM h1""")
def candle_table_round_trip(spark, d):
    """Hourly bars written as a partitioned table and read back."""
    path = run_dir(spark, "candles")
    tb.write_candles(tick_bars(spark, d, "1h"), path)
    out = tb.read_candles(spark, path).withColumn("date", F.col("date").cast("string"))
    return rounded(out, "quoteVolume", digits=4)


@register(
    "candle_table_upsert",
    f"""WITH {VERSIONS}, a AS (SELECT * FROM fresh UNION ALL
      SELECT * FROM stored ANTI JOIN fresh USING (symbol, interval, "openTime"))
    SELECT *, strftime(make_timestamp("openTime" * 1000), '%Y-%m-%d') AS date FROM a""",
)
def candle_table_upsert(spark, d):
    """Write one version, upsert the other: only the touched date partitions are rewritten."""
    path = run_dir(spark, "candles")
    stored, fresh = versions(spark, d)
    tb.write_candles(stored, path)
    tb.upsert_into(spark, path, fresh)
    return tb.read_candles(spark, path).withColumn("date", F.col("date").cast("string"))


@register("appended_predictions", f"{HOURLY_PREDICTIONS} SELECT {PREDICTION} FROM predictions")
def appended_predictions(spark, d):
    path = run_dir(spark, "predictions")
    rows = forecasts(spark, d)
    tb.append_predictions(rows.filter("direction = 'UP'"), path)
    tb.append_predictions(rows.filter("direction <> 'UP'"), path)
    return rounded(tb.read_parquet(spark, path), *ROUNDED)


@register("table_round_trip", f"WITH {TICKS} SELECT * FROM ticks")
def table_round_trip(spark, d):
    """Overwrite and read a named collection through a connector."""
    path = run_dir(spark, "ticks")
    tb.write_table(td.ticks(spark, d), "orc", path)
    return tb.read_table(spark, "orc", path)


