"""Tables kept up to date from message streams: candles, trade tape, live candles, emissions.

Each batch is merged with the stored rows by the batch operators, so the merge is partitioned and
pre-aggregated by Spark and a symbol with very many new rows is cut down before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.scalars import bucket_start, ms_to_ts
from tickloom.operators.book import changed_only
from tickloom.operators.serving import retain_last
from tickloom.schemas import DAY_MS, HOUR_MS
from tickloom.sources.messages import closed_only, valid_tick
from tickloom.sources.tables import dedup_last, first_per_key, upsert
from tickloom.streaming.run import start
from tickloom.streaming.state import StateTable, by_symbol

CANDLES_SCHEMA = (
    "symbol STRING, interval STRING, openTime BIGINT, closeTime BIGINT, open DOUBLE, high DOUBLE, "
    "low DOUBLE, close DOUBLE, volume DOUBLE, quoteVolume DOUBLE, trades INT, x BOOLEAN, seq BIGINT"
)
TAPE_SCHEMA = (
    "symbol STRING, price DOUBLE, quantity DOUBLE, time BIGINT, isBuyerMaker BOOLEAN, tradeId BIGINT"
)
CANDLE_KEY = ("symbol", "openTime")


def candle_store_job(
    klines: DataFrame,
    base: str,
    retention_ms: int | None = DAY_MS,
    part_ms: int = HOUR_MS,
    checkpoint: str | None = None,
    every: str | None = None,
) -> tuple[StreamingQuery, StateTable, StateTable]:
    """Closed candles by (symbol, openTime), the later arrival winning, and the latest per symbol.

    ``klines`` has the arrival number ``seq``. Returns the query, the candles and the latest view.
    """
    spark = klines.sparkSession
    candles = StateTable(spark, f"{base}/candles", CANDLES_SCHEMA, bucket_start("openTime", part_ms))
    latest = StateTable(spark, f"{base}/latest", CANDLES_SCHEMA + ", expires_at BIGINT", by_symbol())

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        candles.merge(batch, batch_id, lambda old, new: upsert(old, new, CANDLE_KEY, "seq"))
        # The view is written by arrival, as a cache would be: the last closed candle seen.
        expiry = F.unix_millis(F.current_timestamp()) + DAY_MS
        seen = dedup_last(batch, ["symbol"], "seq").withColumn("expires_at", expiry)
        latest.merge(seen, batch_id, lambda old, new: upsert(old, new, ("symbol",)))
        latest.prune(batch_id)
        oldest = None
        if retention_ms is not None:
            oldest = batch.agg(F.max("openTime")).first()[0] - retention_ms - part_ms
        candles.prune(batch_id, oldest)

    closed = valid_tick(closed_only(klines))
    return start(closed, on_batch, "append", checkpoint, every), candles, latest


def retained(candles: DataFrame, now_ms: int, retention_ms: int = DAY_MS) -> DataFrame:
    return candles.filter(F.col("openTime") > now_ms - retention_ms)


def trade_tape_job(
    trades: DataFrame, base: str, k: int = 100, checkpoint: str | None = None, every: str | None = None, ttl_ms: int | None = None
) -> tuple[StreamingQuery, StateTable]:
    """The newest k trades per symbol. State is at most k rows per symbol.

    With ``ttl_ms`` a symbol's trades expire when that long has passed since its last one, by the clock of
    the newest trade of any symbol: they leave the stored table in the batch that shows it, and
    trades before such a pause do not come back with the next ones.
    """
    tape = StateTable(trades.sparkSession, base, TAPE_SCHEMA, by_symbol())
    columns = [c.split()[0] for c in TAPE_SCHEMA.split(", ")]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        if ttl_ms is None:
            tape.merge(batch, batch_id, lambda old, new: retain_last(old.unionByName(new), k))
        else:
            held = tape.read(batch_id)
            last = held.groupBy("symbol").agg(F.max("time").alias("time"))
            now = max(t for t in (batch.agg(F.max("time")).first()[0], last.agg(F.max("time")).first()[0]) if t is not None)
            # Parts without new trades are rewritten only if one of their symbols has gone silent.
            parts = sorted({*tape.touched(batch), *tape.touched(last.filter(F.col("time") + ttl_ms <= now))})
            merged = retain_last(tape.read(batch_id, parts).unionByName(batch.select(*columns)), k)
            tape.write(live_tape(since_pause(merged, ttl_ms), now, ttl_ms), batch_id, parts)
        tape.prune(batch_id)

    return start(trades, on_batch, "append", checkpoint, every), tape


def since_pause(tape: DataFrame, ttl_ms: int) -> DataFrame:
    """A symbol's trades after its last pause of ``ttl_ms`` or more; a tape has few rows per symbol."""
    own = Window.partitionBy("symbol")
    pause = F.col("time") - F.lag("time").over(own.orderBy("time", "tradeId")) >= ttl_ms
    rows = tape.withColumn("_pause", F.when(pause, F.col("time")))
    begin = F.max("_pause").over(own)
    return rows.withColumn("_begin", begin).filter(F.col("_begin").isNull() | (F.col("time") >= F.col("_begin"))).drop("_pause", "_begin")


def live_tape(tape: DataFrame, now_ms: int, ttl_ms: int = 30 * 60_000) -> DataFrame:
    """Symbols whose last trade is older than the time to live are gone."""
    last = tape.groupBy("symbol").agg(F.max("time").alias("_last"))
    return (
        tape.join(last, "symbol").filter(F.col("_last") + ttl_ms > F.lit(now_ms)).drop("_last")
    )


def first_closed(klines: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Each closed candle once, by (symbol, openTime), at its first arrival.

    The watermark bounds the state: a copy that comes within ``late`` of the newest candle is known, a
    later one is older than the watermark and dropped as late.
    """
    closed = valid_tick(closed_only(klines)).withColumn("_at", ms_to_ts("openTime"))
    return closed.withWatermark("_at", late).dropDuplicatesWithinWatermark([*CANDLE_KEY]).drop("_at")


def append_job(
    rows: DataFrame, base: str, schema: str, checkpoint: str | None = None, every: str | None = None
) -> tuple[StreamingQuery, StateTable]:
    """Every batch as a part of its own, which a replay replaces; ``schema`` names the columns that are kept."""
    table = StateTable(rows.sparkSession, base, schema + ", batch BIGINT", F.col("batch"))
    columns = [c.split()[0] for c in schema.split(", ")]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            table.write(batch.select(*columns, F.lit(batch_id).cast("long").alias("batch")), batch_id, [batch_id])

    return start(rows, on_batch, "append", checkpoint, every), table


def first_closed_job(
    klines: DataFrame, base: str, late: str = "10 minutes", checkpoint: str | None = None, every: str | None = None
) -> tuple[StreamingQuery, StateTable]:
    """Closed candles as they are first seen; :func:`candle_store_job` keeps the last write."""
    return append_job(first_closed(klines, late), base, CANDLES_SCHEMA, checkpoint, every)


def live_candles_job(
    klines: DataFrame, base: str, keep: int = 200, checkpoint: str | None = None, every: str | None = None
) -> tuple[StreamingQuery, StateTable]:
    """Forming and closed candles as a chart shows them: replaced by openTime, newest ``keep``."""
    table = StateTable(klines.sparkSession, base, CANDLES_SCHEMA, by_symbol())

    def newest(old: DataFrame, new: DataFrame) -> DataFrame:
        return first_per_key(upsert(old, new, CANDLE_KEY, "seq"), ["symbol"], [F.col("openTime").desc()], keep)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        table.merge(batch, batch_id, newest)
        table.prune(batch_id)

    return start(valid_tick(klines), on_batch, "append", checkpoint, every), table


def changed_only_job(
    emissions: DataFrame,
    base: str,
    checkpoint: str | None = None,
    every: str | None = None,
) -> tuple[StreamingQuery, StateTable, StateTable]:
    """Emissions (symbol, time, seq, lastUpdateId) whose id differs from the previous one.

    Only the last id per symbol is carried from batch to batch, as a row before the new ones. What
    passed is never revised, so each batch adds a part of its own to ``out``, which a replay replaces.
    """
    spark = emissions.sparkSession
    schema = "symbol STRING, time BIGINT, seq BIGINT, lastUpdateId BIGINT"
    last = StateTable(spark, f"{base}/last", schema, by_symbol())
    out = StateTable(spark, f"{base}/out", schema + ", batch BIGINT", F.col("batch"))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        parts = last.touched(batch)
        held = last.read(batch_id, parts)
        marked = held.withColumn("_new", F.lit(False)).unionByName(batch.withColumn("_new", F.lit(True)))
        fresh = changed_only(marked).filter("_new").drop("_new")
        out.write(fresh.withColumn("batch", F.lit(batch_id).cast("long")), batch_id, [batch_id])
        usable = batch.filter(F.coalesce("lastUpdateId", F.lit(0)) != 0)
        newest = first_per_key(
            held.unionByName(usable), ["symbol"], [F.col("time").desc(), F.col("seq").desc()]
        )
        last.write(newest, batch_id, parts)
        last.prune(batch_id)

    emissions = emissions.select("symbol", "time", "seq", "lastUpdateId")
    return start(emissions, on_batch, "append", checkpoint, every), out, last
