"""Candle tables: scans, keyed writes, latest views and data checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.operators.series import map_series
from tickloom.schemas import DAY_MS, HOUR_MS, INTERVAL_MS, MINUTE_MS

KEY = ("symbol", "interval", "openTime")


# ---- scans -------------------------------------------------------------------------------------

def scan_candles(
    df: DataFrame,
    symbols: Sequence[str] | None = None,
    interval: str | None = None,
    start: int | None = None,
    end: int | None = None,
    end_inclusive: bool = False,
    time: str = "openTime",
) -> DataFrame:
    """Plain predicates, so they reach the Parquet scan and prune partitions."""
    if symbols is not None:
        df = df.filter(F.col("symbol").isin(*symbols))
    if interval is not None:
        df = df.filter(F.col("interval") == interval)
    if start is not None:
        df = df.filter(F.col(time) >= start)
    if end is not None:
        df = df.filter(F.col(time) <= end if end_inclusive else F.col(time) < end)
    return df


def first_per_key(df: DataFrame, keys: Sequence[str], best_first: Sequence[Column], k: int = 1) -> DataFrame:
    """The k best rows per key. Catalyst drops worse rows before the shuffle (group limit), so a
    key with very many copies sends at most k rows per task."""
    w = Window.partitionBy(*keys).orderBy(*best_first)
    return df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= k).drop("_rk")


def latest_k_per_symbol(
    df: DataFrame, k: int = 40, keys: Sequence[str] = ("symbol",), order: Sequence[str] = ("openTime",)
) -> DataFrame:
    return first_per_key(df, keys, [F.col(c).desc() for c in order], k)


def recent_or_latest_k(
    df: DataFrame, now: int | Column, periods: int = 40, order: Sequence[str] = ("openTime",)
) -> DataFrame:
    """Rows of the last ``periods`` five-minute steps; if there are fewer than ``periods`` of them
    over all symbols, the newest max(periods, 40) rows of each symbol instead.

    Which of the two is decided first, by a job that stops at ``periods`` recent rows; the plan that
    comes back then scans the source once, for the rows it returns.
    """
    since = F.lit(now) - 5 * MINUTE_MS * periods
    recent = df.filter(F.col(order[0]) >= since)
    if recent.select(order[0]).limit(periods).count() >= periods:
        return recent
    return latest_k_per_symbol(df, max(periods, 40), order=order)


def normalize_candles(df: DataFrame) -> DataFrame:
    """Typed candle columns; a value that cannot be cast becomes null instead of failing."""
    types = {
        "symbol": "string", "interval": "string",
        "openTime": "bigint", "closeTime": "bigint",
        "open": "double", "high": "double", "low": "double", "close": "double",
        "volume": "double", "quoteVolume": "double", "trades": "int",
    }
    return df.select(*[F.col(c).try_cast(t).alias(c) for c, t in types.items() if c in df.columns])


# ---- keyed writes ------------------------------------------------------------------------------

def dedup_last(df: DataFrame, keys: Sequence[str], arrival: str | Sequence[str]) -> DataFrame:
    """The last-arrived row per key."""
    cols = [arrival] if isinstance(arrival, str) else arrival
    return first_per_key(df, keys, [F.col(c).desc() for c in cols])


def upsert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = KEY, arrival: str | None = None
) -> DataFrame:
    """Last write wins: incoming over existing, and later arrival over earlier within incoming."""
    old = existing.withColumn("_src", F.lit(0))
    new = incoming.withColumn("_src", F.lit(1))
    order = [F.col("_src").desc()] + ([F.col(arrival).desc()] if arrival else [])
    merged = old.unionByName(new, allowMissingColumns=True)
    return first_per_key(merged, keys, order).drop("_src")


def upsert_report(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str] = KEY,
    values: Sequence[str] = (),
    arrival: str | None = None,
) -> DataFrame:
    """One row: inserted, modified and skipped counts of an upsert.

    A row equal to what is stored, or overwritten by a later incoming row of its key, is skipped.
    """
    keys = list(keys)
    order = [F.col(arrival).desc()] if arrival else [F.col(c) for c in values]
    w = Window.partitionBy(*keys).orderBy(*order)
    kept = incoming.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") == 1).drop("_rk")
    old = existing.select(*keys, F.struct(*values).alias("_old"))
    total = incoming.select(F.count(F.lit(1)).alias("n")).scalar()
    joined = kept.select(*keys, F.struct(*values).alias("_new")).join(old, keys, "left")
    counts = joined.agg(
        F.count_if(F.col("_old").isNull()).alias("inserted"),
        F.count_if(F.col("_old").isNotNull() & ~F.col("_old").eqNullSafe(F.col("_new"))).alias("modified"),
    )
    return counts.withColumn("skipped", total - F.col("inserted") - F.col("modified"))


def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = KEY, arrival: str | None = None
) -> DataFrame:
    """First write wins: the incoming rows that may be appended."""
    if arrival:
        incoming = first_per_key(incoming, keys, [F.col(arrival).asc()])
    return incoming.join(existing.select(*keys), list(keys), "left_anti")


def merge_pages(new: DataFrame, existing: DataFrame, keys: Sequence[str] = ("symbol", "openTime")) -> DataFrame:
    """Concatenate an older page with the loaded rows; loaded rows win on equal keys."""
    both = new.withColumn("_src", F.lit(1)).unionByName(existing.withColumn("_src", F.lit(0)))
    return first_per_key(both, keys, [F.col("_src").asc()]).drop("_src")


def with_date(df: DataFrame) -> DataFrame:
    from tickloom.functions.scalars import utc_text

    return df.withColumn("date", F.substring(utc_text("openTime"), 1, 10))


def write_candles(df: DataFrame, path: str, mode: str = "append") -> None:
    """Parquet partitioned by interval and date, sorted by key.

    Rebalancing writes few files per partition and splits a partition with very many rows.
    """
    (
        with_date(df)
        .hint("rebalance", "interval", "date")
        .sortWithinPartitions("interval", "date", "symbol", "openTime")
        .write.mode(mode)
        .partitionBy("interval", "date")
        .parquet(path)
    )


def read_candles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def upsert_into(spark: SparkSession, path: str, incoming: DataFrame, arrival: str | None = None) -> None:
    """Upsert into a candle table, reading and rewriting only the (interval, date) partitions touched.

    The list of touched partitions is fetched first: a literal filter is certain to prune the scan
    of a large table, a join on the partition columns is not.
    """
    incoming = with_date(incoming)
    touched = incoming.groupBy("interval").agg(F.collect_set("date").alias("dates")).collect()
    if not touched:
        return
    hit = F.lit(False)
    for row in touched:
        hit = hit | ((F.col("interval") == row.interval) & F.col("date").cast("string").isin(row.dates))
    existing = spark.read.parquet(path).filter(hit)
    existing = existing.withColumn("date", F.col("date").cast("string"))
    (
        upsert(existing, incoming, KEY, arrival)
        .select(*existing.columns)
        .hint("rebalance", "interval", "date")
        .sortWithinPartitions("interval", "date", "symbol", "openTime")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("interval", "date")
        .parquet(path)
    )


def append_predictions(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, fmt: str = "parquet", path: str | None = None, **options: str) -> DataFrame:
    """A named collection through any connector on the class path."""
    return spark.read.format(fmt).options(**options).load(path)


def write_table(df: DataFrame, fmt: str = "parquet", path: str | None = None, mode: str = "overwrite", **options: str) -> None:
    df.write.format(fmt).mode(mode).options(**options).save(path)


# ---- latest views ------------------------------------------------------------------------------

def latest_view(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ttl_ms: int, written: str | None = None
) -> DataFrame:
    """Newest row per key with ``expires_at`` = written + ttl."""
    newest = first_per_key(df, keys, [F.col(c).desc() for c in order])
    return newest.withColumn("expires_at", F.col(written or order[0]) + F.lit(ttl_ms).cast("long"))


def alive(view: DataFrame, now: int | Column) -> DataFrame:
    """What a reader at ``now`` may see."""
    return view.filter(F.lit(now) < F.col("expires_at"))


def fetch_indexed(index: DataFrame, values: DataFrame, now: int | Column, keys: Sequence[str] = ("symbol", "openTime")) -> DataFrame:
    """Values behind the entries of a time index; entries whose value has expired are skipped."""
    return index.select(*keys).join(alive(values, now), list(keys))


def cache_or_history(cache: DataFrame, history: DataFrame, now: int | Column, key: str = "symbol", order: Sequence[str] = ("prediction_time",)) -> DataFrame:
    """Per key the cached row if it is alive, else the newest of the history."""
    live = alive(cache, now).drop("expires_at").withColumn("source", F.lit("cache"))
    past = history.withColumn("source", F.lit("history"))
    both = live.unionByName(past)
    return first_per_key(both, [key], [F.col("source").asc(), *[F.col(c).desc() for c in order]])


def to_kv(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*cols)).alias("value"))


# ---- checks and backfill planning --------------------------------------------------------------

def duplicate_keys(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Violations of the unique key; empty for a sound table."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def completeness(
    df: DataFrame,
    interval: str,
    start: int,
    end: int,
    tolerance: float = 0.9,
    time: str = "openTime",
    targets: DataFrame | None = None,
) -> DataFrame:
    """Per symbol: rows found, rows expected in [start, end), missing, and whether that is too few.

    ``targets`` (symbol) lists the symbols to report, including those without any row.
    """
    expected = (end - start) / INTERVAL_MS[interval]
    found = (
        df.filter((F.col(time) >= start) & (F.col(time) < end))
        .groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("fetched"))
    )
    if targets is not None:
        found = targets.select("symbol").join(found, "symbol", "left").na.fill(0, ["fetched"])
    whole = F.lit(int(expected)).cast("long")
    return found.select(
        "symbol",
        "fetched",
        whole.alias("expected"),
        F.greatest(whole - F.col("fetched"), F.lit(0)).alias("missing"),
        (F.col("fetched") < expected * tolerance).alias("incomplete"),
    )


def gaps(df: DataFrame, interval: str, keys: Sequence[str] = ("symbol",), time: str = "openTime", **series) -> DataFrame:
    """Stretches without candles: the first missing time, the next present one, rows missing."""
    step = INTERVAL_MS[interval]

    def previous(rows, w):
        return rows.withColumn("_prev", F.lag(time).over(w))

    return (
        map_series(df.select(*keys, time), previous, before=1, keys=keys, order=[time], **series)
        .filter(F.col(time) - F.col("_prev") > step)
        .select(
            *keys,
            (F.col("_prev") + step).alias("gap_start"),
            F.col(time).alias("gap_end"),
            (F.floor((F.col(time) - F.col("_prev")) / step) - 1).cast("long").alias("missing"),
        )
    )


def resume_point(df: DataFrame, targets: DataFrame, now: int, years: int = 1) -> DataFrame:
    """Where to continue a backfill, per (symbol, interval) of ``targets``.

    One past the newest candle if there is one (for 1m only if it lies within the last day), else
    the horizon: one day back for 1m, 365 days times ``years`` otherwise.
    """
    newest = df.groupBy("symbol", "interval").agg(F.max("openTime").alias("newest"))
    horizon = F.when(F.col("interval") == "1m", now - DAY_MS).otherwise(now - 365 * years * DAY_MS)
    usable = F.col("newest").isNotNull() & (
        (F.col("interval") != "1m") | (F.col("newest") >= F.col("horizon"))
    )
    return (
        targets.join(newest, ["symbol", "interval"], "left")
        .withColumn("horizon", horizon.cast("long"))
        .select(
            "symbol",
            "interval",
            F.when(usable, F.col("newest") + 1).otherwise(F.col("horizon")).alias("start"),
            F.lit(now).cast("long").alias("end"),
        )
    )


# Page step per candle by interval; any other interval pages by the hour.
PAGE_STEP_MS = {"1m": MINUTE_MS, "5m": 5 * MINUTE_MS, "1h": HOUR_MS, "5h": 5 * HOUR_MS, "1d": DAY_MS}


def plan_ranges(resume: DataFrame, limit: int = 1000) -> DataFrame:
    """Split each [start, end) into request pages of ``limit`` candles."""
    step = F.coalesce(
        *[F.when(F.col("interval") == k, F.lit(v)) for k, v in PAGE_STEP_MS.items()], F.lit(HOUR_MS)
    ).cast("long")
    return (
        resume.filter(F.col("start") < F.col("end"))
        .withColumn("_page", step * limit)
        .withColumn("page_start", F.explode(F.sequence("start", F.col("end") - 1, "_page")))
        .select(
            "symbol",
            "interval",
            "page_start",
            F.least(F.col("page_start") + F.col("_page"), F.col("end")).alias("page_end"),
        )
    )
