"""Streaming jobs over the events file, run to the end; each must equal its batch twin."""

from pyspark.sql import functions as F

from catalog.base import CANDLES, TICKS, USER_TICKS, r, register, rounded
from catalog.books import _PARSED, MIXED, RULED, mixed_updates, ruled_updates
from catalog.rankings import SHOWN, _show, change_sql, ranked_sql
from tickloom.schemas import DAY_MS, HOUR_MS
from tickloom.session import run_dir
from tickloom.sources import messages as ms
from tickloom.sources import streams as st
from tickloom.sources import testdata as td
from tickloom.streaming import books as sb
from tickloom.streaming import rankings as sr
from tickloom.streaming import stores as ss
from tickloom.streaming.run import drain


def tick_stream(spark, d):
    return td.ticks_of(st.parquet_stream(spark, d, td.EVENTS_SCHEMA, "events.parquet"))


# Files of a micro-batch at least, and rows from which on it gets more; each is written and read by a task of its own.
FILES = 4
FILE_ROWS = 125_000


def _files(rows):
    """How many files a micro-batch of about so many rows gets."""
    return max(FILES, -(-rows // FILE_ROWS))


def _written(part, folder, files=FILES):
    """``part`` as so many files, the unit that a stream over the folder reads at once."""
    part.repartition(files).write.mode("append").parquet(folder)


def tick_batches(spark, d, batches=4, symbol="event_type"):
    """The same trades in ``batches`` equal ranges of ids, one per micro-batch."""
    folder = run_dir(spark, "split")
    events = td.events(spark, d)
    top, rows = events.agg(F.max("event_id"), F.count(F.lit(1))).first()
    files = _files(rows // batches)
    for i in range(batches):
        _written(events.filter(F.floor(F.col("event_id") * batches / (top + 1)) == i), folder, files)
    return td.ticks_of(st.parquet_stream(spark, folder, td.EVENTS_SCHEMA, "*.parquet", files), symbol)


# Rows of a micro-batch of a stream whose tasks hold a symbol's messages of one batch.
MOST = 1_000_000


def bounded_batches(spark, d, batches=4, most=MOST):
    """The trades in ranges of ids of about ``most`` rows, and at least ``batches`` of them, one per micro-batch."""
    events = td.events(spark, d).filter("event_id IS NOT NULL")
    batches = max(batches, -(-events.count() // most))
    cuts = events.agg(F.percentile_approx("event_id", [i / batches for i in range(1, batches)], 100 * batches)).first()[0] or []
    cuts = sorted(set(cuts))
    # Split in one pass, so that the work does not grow with the number of batches times the rows.
    split, folder = run_dir(spark, "parts"), run_dir(spark, "split")
    part = F.size(F.filter(F.lit(cuts).cast("array<bigint>"), lambda c: c < F.col("event_id"))).alias("part")
    events.select("*", part).repartition((len(cuts) + 1) * FILES, "part", F.pmod("event_id", F.lit(FILES))).write.partitionBy("part").parquet(split)
    parts = spark.read.parquet(split)
    for i in range(len(cuts) + 1):
        _written(parts.filter(F.col("part") == i).select(*events.columns), folder)
    return td.ticks_of(st.parquet_stream(spark, folder, td.EVENTS_SCHEMA, "*.parquet", FILES))


def kline_batches(spark, d):
    return ms.parse_klines(td.kline_messages(tick_batches(spark, d)), keep=["seq"])


def kline_stream(spark, d):
    return ms.parse_klines(td.kline_messages(tick_stream(spark, d)), keep=["seq"])


@register(
    "stream_latest_price",
    f"""WITH {TICKS} SELECT symbol, arg_max(price, "tradeId") AS latest_price,
    count(*) AS trade_count FROM ticks GROUP BY 1""",
)
def stream_latest_price(spark, d):
    prices = sr.stream_latest_price(tick_stream(spark, d), time="tradeId")
    q, table = sr.complete_job(prices, run_dir(spark, "prices"), sr.PRICES_SCHEMA)
    drain(q)
    return table.read().drop("updated_at")


@register(
    "stream_max_price",
    f"WITH {TICKS} SELECT symbol, max(price) AS latest_price FROM ticks GROUP BY 1",
)
def stream_max_price(spark, d):
    schema = "symbol STRING, latest_price DOUBLE"
    q, table = sr.complete_job(sr.stream_max_price(tick_stream(spark, d)), run_dir(spark, "max"), schema)
    drain(q)
    return table.read()


@register(
    "stream_window_gain",
    f"""WITH {TICKS}, g AS (
      SELECT symbol, "time" - "time" % {HOUR_MS} AS window_start,
             arg_min(price, ROW("time", price)) AS open_price,
             arg_max(price, ROW("time", price)) AS close_price, count(*) AS trade_count
      FROM ticks GROUP BY 1, 2)
    SELECT symbol, window_start, open_price, close_price, trade_count,
           {r('(close_price - open_price) / nullif(open_price, 0) * 100', 'percent_change')} FROM g""",
)
def stream_window_gain(spark, d):
    q, table = sr.gains_job(tick_stream(spark, d), run_dir(spark, "gains"), "1 hour", part_ms=7 * DAY_MS, retention_ms=None)
    drain(q)
    return rounded(sr.ranked_gains(table.read()), "percent_change")


@register(
    "stream_top_gainers",
    f"""WITH {CANDLES} {change_sql(60_000, 'WHERE volume >= 10')} {ranked_sql(None)}
    SELECT {SHOWN} FROM ranked""",
)
def stream_top_gainers(spark, d):
    q, table = sr.top_gainers_job(kline_stream(spark, d), run_dir(spark, "gainers"), horizon_ms=None, part_ms=7 * DAY_MS)
    drain(q)
    return _show(table.read().drop("expires_at"))


@register(
    "stream_candle_store",
    f"""WITH {CANDLES} SELECT symbol, "openTime", arg_max(close, seq) AS close, max(seq) AS seq
    FROM candles WHERE volume >= 10 GROUP BY 1, 2""",
)
def stream_candle_store(spark, d):
    q, candles, _ = ss.candle_store_job(kline_stream(spark, d), run_dir(spark, "store"), None, 7 * DAY_MS)
    drain(q)
    return candles.read().select("symbol", "openTime", "close", "seq")


@register(
    "stream_latest_candle",
    f"""WITH {CANDLES} SELECT symbol, arg_max("openTime", seq) AS "openTime", arg_max(close, seq) AS close,
    max(seq) AS seq FROM candles WHERE volume >= 10 GROUP BY 1""",
)
def stream_latest_candle(spark, d):
    q, _, latest = ss.candle_store_job(kline_stream(spark, d), run_dir(spark, "store"), None, 7 * DAY_MS)
    drain(q)
    return latest.read().select("symbol", "openTime", "close", "seq")


@register(
    "stream_trade_tape",
    f"""WITH {TICKS} SELECT symbol, price, quantity, "time", "isBuyerMaker", "tradeId" FROM ticks
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "time" DESC, "tradeId" DESC) <= 100""",
)
def stream_trade_tape(spark, d):
    trades = ms.parse_trades(td.trade_messages(tick_stream(spark, d)))
    q, tape = ss.trade_tape_job(trades, run_dir(spark, "tape"))
    drain(q)
    return tape.read()


@register(
    "stream_live_candles",
    f"""WITH {CANDLES}, l AS (SELECT symbol, "openTime", arg_max(close, seq) AS close, max(seq) AS seq
      FROM candles GROUP BY 1, 2)
    SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "openTime" DESC) <= 200""",
)
def stream_live_candles(spark, d):
    q, table = ss.live_candles_job(kline_stream(spark, d), run_dir(spark, "live"))
    drain(q)
    return table.read().select("symbol", "openTime", "close", "seq")


@register("stream_book", f"WITH {_PARSED} SELECT symbol, side, price, qty FROM book")
def stream_book(spark, d):
    updates = ms.parse_depth(td.depth_messages(tick_stream(spark, d)), keep=["seq"])
    q, books, _ = sb.book_job(updates, run_dir(spark, "books"))
    drain(q)
    return books.read()


@register(
    "stream_changed_only",
    f"""WITH {TICKS}, e AS (SELECT symbol, "time", "tradeId" AS seq, floor(price) AS id FROM ticks
      WHERE floor(price) <> 0),
    l AS (SELECT *, lag(id) OVER (PARTITION BY symbol ORDER BY "time", seq) AS prev FROM e)
    SELECT symbol, "time", seq, CAST(id AS BIGINT) AS "lastUpdateId" FROM l
    WHERE prev IS NULL OR prev <> id""",
)
def stream_changed_only(spark, d):
    emissions = tick_stream(spark, d).select(
        "symbol", "time", F.col("tradeId").alias("seq"), F.floor("price").cast("bigint").alias("lastUpdateId")
    )
    q, out, _ = ss.changed_only_job(emissions, run_dir(spark, "changed"))
    drain(q)
    return out.read().drop("batch")


@register("stream_mixed_book", f"WITH {MIXED} SELECT symbol, side, price, qty FROM mixed_book")
def stream_mixed_book(spark, d):
    q, books, _ = sb.book_job(mixed_updates(tick_stream(spark, d)), run_dir(spark, "books"))
    drain(q)
    return books.read()


# Publications as a fold over the applied messages: two clocks, and no book with an empty side.
_PUBLISHED = f"""{MIXED}, ends AS (
  SELECT symbol, seq, side, price, arg_max(qty, pos) <> 0 AS held FROM levels GROUP BY ALL),
steps AS (
  SELECT symbol, seq, side, CAST(held AS INT) - CAST(coalesce(lag(held) OVER (
    PARTITION BY symbol, side, price ORDER BY seq), false) AS INT) AS step FROM ends),
sizes AS (
  SELECT symbol, seq, coalesce(sum(step) FILTER (side = 'bid'), 0) AS bid_step,
         coalesce(sum(step) FILTER (side = 'ask'), 0) AS ask_step FROM steps GROUP BY ALL),
moments AS MATERIALIZED (
  SELECT a.symbol, a.u, a."time" AS t, row_number() OVER w AS rn,
         sum(coalesce(bid_step, 0)) OVER w > 0 AND sum(coalesce(ask_step, 0)) OVER w > 0 AS whole
  FROM applied a LEFT JOIN sizes s ON a.symbol = s.symbol AND a.seq = s.seq
  WINDOW w AS (PARTITION BY a.symbol ORDER BY a.seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
walk AS (
  SELECT symbol, rn, t AS pushed, t AS forced, true AS due, u, whole FROM moments WHERE rn = 1
  UNION ALL
  SELECT m.symbol, m.rn, CASE WHEN m.t - w.pushed >= 100 THEN m.t ELSE w.pushed END,
         CASE WHEN m.t - w.pushed < 100 AND m.t - w.forced >= 1000 THEN m.t ELSE w.forced END,
         m.t - w.pushed >= 100 OR m.t - w.forced >= 1000, m.u, m.whole
  FROM walk w JOIN moments m ON m.symbol = w.symbol AND m.rn = w.rn + 1)"""


@register(
    "stream_stateful_book",
    f"""WITH RECURSIVE {_PUBLISHED} SELECT symbol, count(*) AS publications, max(u) AS "lastUpdateId"
    FROM walk WHERE due AND whole GROUP BY 1""",
)
def stream_stateful_book(spark, d):
    """Message by message with per-symbol state, over bounded micro-batches; publications and the last id per symbol."""
    messages = ms.read_depth(td.mixed_depth_messages(bounded_batches(spark, d)), keep=["seq"])
    emitted = sb.stateful_books(messages)
    base = run_dir(spark, "emitted")
    q = (
        emitted.writeStream.format("parquet").outputMode("append")
        .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True).start()
    )
    drain(q)
    out = spark.read.parquet(f"{base}/out")
    return out.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("publications"), F.max("lastUpdateId").alias("lastUpdateId")
    )


# ---- several micro-batches ---------------------------------------------------------------------

_RECENT = f"""WITH {CANDLES} {change_sql(60_000, 'WHERE volume >= 10')}""".replace(
    "lagged AS (", f"kept AS (SELECT * FROM windows WHERE window_start > (SELECT max(window_start) FROM windows) - {2 * DAY_MS}),\nlagged AS ("
).replace("FROM windows WINDOW w", "FROM kept WINDOW w")


@register("stream_top_gainers_batches", f"{_RECENT} {ranked_sql(DAY_MS)} SELECT {SHOWN} FROM ranked")
def stream_top_gainers_batches(spark, d):
    """The served ranking over four micro-batches, with the 24-hour horizon and what it drops."""
    q, table = sr.top_gainers_job(kline_batches(spark, d), run_dir(spark, "gainers"), part_ms=DAY_MS)
    drain(q)
    return _show(table.read().drop("expires_at"))


@register("stream_mixed_book_batches", f"WITH {MIXED} SELECT symbol, side, price, qty FROM mixed_book")
def stream_mixed_book_batches(spark, d):
    q, books, _ = sb.book_job(mixed_updates(tick_batches(spark, d)), run_dir(spark, "books"))
    drain(q)
    return books.read()


@register("stream_ruled_book_batches", f"WITH RECURSIVE {RULED} SELECT symbol, side, price, qty FROM ruled_book")
def stream_ruled_book_batches(spark, d):
    """Ids that are missing, on another scale or reset by a baseline, over four micro-batches."""
    q, books, _ = sb.book_job(ruled_updates(tick_batches(spark, d)), run_dir(spark, "books"))
    drain(q)
    return books.read()


@register(
    "stream_candle_store_batches",
    f"""WITH {CANDLES}, c AS (SELECT symbol, "openTime", arg_max(close, seq) AS close, max(seq) AS seq
      FROM candles WHERE volume >= 10 GROUP BY 1, 2)
    SELECT * FROM c WHERE "openTime" > (SELECT max("openTime") FROM c) - {DAY_MS}""",
)
def stream_candle_store_batches(spark, d):
    """Candles merged over four micro-batches and kept for a day."""
    q, candles, _ = ss.candle_store_job(kline_batches(spark, d), run_dir(spark, "store"), part_ms=DAY_MS)
    drain(q)
    rows = candles.read()
    newest = rows.select(F.max("openTime").alias("t")).scalar()
    return ss.retained(rows, newest).select("symbol", "openTime", "close", "seq")


@register(
    "stream_trade_tape_batches",
    f"""WITH {TICKS} SELECT symbol, price, quantity, "time", "isBuyerMaker", "tradeId" FROM ticks
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "time" DESC, "tradeId" DESC) <= 100""",
)
def stream_trade_tape_batches(spark, d):
    q, tape = ss.trade_tape_job(ms.parse_trades(td.trade_messages(tick_batches(spark, d))), run_dir(spark, "tape"))
    drain(q)
    return tape.read()


@register(
    "stream_changed_only_batches",
    f"""WITH {TICKS}, e AS (SELECT symbol, "time", "tradeId" AS seq, floor(price) AS id FROM ticks
      WHERE floor(price) <> 0),
    l AS (SELECT *, lag(id) OVER (PARTITION BY symbol ORDER BY "time", seq) AS prev FROM e)
    SELECT symbol, "time", seq, CAST(id AS BIGINT) AS "lastUpdateId" FROM l
    WHERE prev IS NULL OR prev <> id""",
)
def stream_changed_only_batches(spark, d):
    emissions = tick_batches(spark, d).select(
        "symbol", "time", F.col("tradeId").alias("seq"), F.floor("price").cast("bigint").alias("lastUpdateId")
    )
    q, out, _ = ss.changed_only_job(emissions, run_dir(spark, "changed"))
    drain(q)
    return out.read().drop("batch")


# Rows of the first hour of the table come again at its end, when their windows are closed.
LATE = 3_600_000


@register(
    "stream_late_rows",
    f"""WITH {TICKS}, g AS (
      SELECT symbol, "time" - "time" % {HOUR_MS} AS window_start, count(*) AS trade_count FROM ticks GROUP BY 1, 2)
    SELECT * FROM g""",
)
def stream_late_rows(spark, d):
    """Window counts do not change when rows older than the watermark arrive once more."""
    folder = run_dir(spark, "late")
    events = td.events(spark, d)
    first = events.agg(F.min("ts")).first()[0]
    late = events.filter(F.unix_micros(F.col("ts").cast("timestamp")) < F.unix_micros(F.lit(first).cast("timestamp")) + LATE * 1000)
    # The watermark moves after a batch, so the late rows come two batches after the last one.
    _written(events, folder)
    for _ in range(FILES):
        events.filter("false").coalesce(1).write.mode("append").parquet(folder)
    _written(late, folder)
    stream = td.ticks_of(st.parquet_stream(spark, folder, td.EVENTS_SCHEMA, "*.parquet", FILES))
    q, table = sr.gains_job(stream, run_dir(spark, "gains"), "1 hour", part_ms=7 * DAY_MS, retention_ms=None)
    drain(q)
    return table.read().select("symbol", "window_start", "trade_count")


# A user's trades expire after thirty hours of silence.
SILENCE = 30 * HOUR_MS


@register(
    "stream_trade_tape_expiry",
    f"""WITH {USER_TICKS}, paused AS (
      SELECT *, CASE WHEN "time" - lag("time") OVER w >= {SILENCE} THEN "time" END AS pause
      FROM ticks WINDOW w AS (PARTITION BY symbol ORDER BY "time", "tradeId")),
    told AS (
      SELECT *, max(pause) OVER (PARTITION BY symbol) AS begin, max("time") OVER (PARTITION BY symbol) AS last FROM paused)
    SELECT symbol, price, quantity, "time", "isBuyerMaker", "tradeId" FROM told
    WHERE (begin IS NULL OR "time" >= begin) AND last + {SILENCE} > (SELECT max("time") FROM ticks)
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "time" DESC, "tradeId" DESC) <= 50""",
)
def stream_trade_tape_expiry(spark, d):
    """Four micro-batches of many symbols; those that fall silent leave the stored tape."""
    trades = ms.parse_trades(td.trade_messages(tick_batches(spark, d, symbol="user_id")))
    q, tape = ss.trade_tape_job(trades, run_dir(spark, "tape"), 50, ttl_ms=SILENCE)
    drain(q)
    return tape.read()


def repeated_batches(spark, d, batches=4):
    """Candle updates in micro-batches, each with the last hours of the one before it and some of the first one again."""
    folder = run_dir(spark, "again")
    events = td.events(spark, d)
    low, high, rows = events.agg(F.min("event_id"), F.max("event_id"), F.count(F.lit(1))).first()
    size, files = (high - low + batches) // batches, _files(rows // batches)
    for i in range(batches):
        begin = low + i * size
        part = events.filter((F.col("event_id") >= begin) & (F.col("event_id") < begin + size))
        if i:
            near = events.filter((F.col("event_id") >= begin - 20) & (F.col("event_id") < begin))
            part = part.unionByName(near)
        if i == batches - 1:
            part = part.unionByName(events.filter(F.col("event_id") < low + 20))  # far behind the watermark
        _written(part, folder, files)
    ticks = td.ticks_of(st.parquet_stream(spark, folder, td.EVENTS_SCHEMA, "*.parquet", files))
    return ms.parse_klines(td.kline_messages(ticks), keep=["seq"])


@register(
    "stream_first_closed_batches",
    f"""WITH {CANDLES} SELECT DISTINCT symbol, "openTime", 1::BIGINT AS closes, 1::BIGINT AS arrivals FROM candles
    WHERE volume >= 10""",
)
def stream_first_closed_batches(spark, d):
    """Closed candles once, though the next batch and one past the watermark bring some of them again."""
    klines = repeated_batches(spark, d)
    q, first = ss.first_closed_job(klines, run_dir(spark, "first"), "2 days")
    drain(q)
    # The stored table beside it has the last write of every candle.
    q, candles, _ = ss.candle_store_job(klines, run_dir(spark, "store"), None, 7 * DAY_MS)
    drain(q)
    seen = first.read().groupBy("symbol", "openTime").agg(F.count(F.lit(1)).alias("arrivals"))
    kept = candles.read().groupBy("symbol", "openTime").agg(F.count_distinct("close").alias("closes"))
    return seen.join(kept, ["symbol", "openTime"], "full")


@register(
    "stream_text_messages",
    f"""WITH {TICKS} SELECT symbol, price, quantity, "time", "isBuyerMaker", "tradeId" FROM ticks""",
)
def stream_text_messages(spark, d):
    """Trades from a stream of binary values, as a message broker delivers them."""
    folder = run_dir(spark, "values")
    td.trade_messages(td.ticks(spark, d)).select(F.col("value").cast("binary").alias("value")).write.parquet(folder)
    raw = st.parquet_stream(spark, folder, "value BINARY", "*.parquet", FILES)
    q, out = ss.append_job(ms.parse_trades(st.text_messages(raw)), run_dir(spark, "trades"), ss.TAPE_SCHEMA)
    drain(q)
    return out.read().drop("batch")
