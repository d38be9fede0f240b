"""Rankings by price change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import bucket_start, change_pct
from tickloom.operators.rollup import window_close
from tickloom.operators.series import map_series
from tickloom.schemas import DAY_MS, MINUTE_MS


def rolling_window_change(windows: DataFrame, **series) -> DataFrame:
    """Change of each window's close against the symbol's previous window; first window dropped.

    A symbol has one row per window, so its series is bounded by time and need not be cut.
    """
    def add(rows, w):
        return rows.withColumns(
            {
                "prev_close": F.lag("close_price").over(w),
                "prev_timestamp": F.lag("timestamp").over(w),
            }
        )

    return (
        map_series(windows, add, before=1, order=["window_start"], **{"cut": False, **series})
        .filter(F.col("prev_close").isNotNull())
        .withColumn("percent_change", change_pct("close_price", "prev_close"))
    )


def latest_change(changes: DataFrame, as_of: int | Column | None = None, horizon_ms: int = DAY_MS) -> DataFrame:
    """Newest window per symbol, with the quote volume of its windows.

    Given ``as_of`` (a window start), only windows of the horizon that ends there count.
    """
    volume = F.col("volume")
    if as_of is not None:
        volume = F.when(F.col("window_start") > F.lit(as_of) - horizon_ms, volume)
    t = "window_start"
    return changes.groupBy("symbol").agg(
        F.max_by("close_price", t).alias("price"),
        F.max_by("percent_change", t).alias("percent_change"),
        F.coalesce(F.sum(volume), F.lit(0.0)).alias("volume"),
        F.lit(None).cast("double").alias("market_cap"),
        F.max_by("timestamp", t).alias("timestamp"),
    )


def part_sums(windows: DataFrame, part: Column, since: int | Column | None = None) -> DataFrame:
    """What a ranking needs of the windows of each (symbol, part), one row each; ``part`` grows with time.

    A part that ``since`` cuts gives two rows; ``counted`` tells the windows after ``since`` from the others.
    """
    counted = F.lit(True) if since is None else F.col("window_start") > F.lit(since)
    rows = windows.withColumns({"part": part.cast("bigint"), "counted": counted})
    t = "window_start"
    own = Window.partitionBy("symbol", "part", "counted").orderBy(t)
    return rows.withColumn("_prev", F.lag("close_price").over(own)).groupBy("symbol", "part", "counted").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("volume"), F.lit(0.0)).alias("volume"),
        F.min(t).alias("first_start"),
        F.coalesce(F.min_by("volume", t), F.lit(0.0)).alias("first_volume"),
        F.max(t).alias("last_start"),
        F.max_by("close_price", t).alias("last_close"),
        F.max_by("_prev", t).alias("before_last"),
        F.max_by("timestamp", t).alias("timestamp"),
    )


def change_of_parts(sums: DataFrame) -> DataFrame:
    """:func:`latest_change` of :func:`rolling_window_change`, from part sums instead of windows.

    A symbol's first window has no change and does not count.
    """
    own = Window.partitionBy("symbol").orderBy("first_start")
    rows = sums.withColumn("_last", F.lag("last_close").over(own)).withColumn("_first", F.row_number().over(own) == 1)
    volume = F.col("volume") - F.when(F.col("_first"), F.col("first_volume")).otherwise(0.0)
    before = F.when(F.col("n") > 1, F.col("before_last")).otherwise(F.col("_last"))
    t = "last_start"
    return (
        rows.groupBy("symbol")
        .agg(
            F.max_by("last_close", t).alias("price"),
            F.max_by(before, t).alias("_before"),
            F.coalesce(F.sum(F.when(F.col("counted"), volume)), F.lit(0.0)).alias("volume"),
            F.max_by("timestamp", t).alias("timestamp"),
        )
        .filter(F.col("_before").isNotNull())
        .select(
            "symbol", "price", change_pct("price", "_before").alias("percent_change"), "volume",
            F.lit(None).cast("double").alias("market_cap"), "timestamp",
        )
    )


def top_gainers(df: DataFrame, n: int = 1000) -> DataFrame:
    return df.orderBy(F.col("percent_change").desc(), "symbol").limit(n)


def top_losers(df: DataFrame, n: int = 1000) -> DataFrame:
    return df.orderBy(F.col("percent_change").asc(), "symbol").limit(n)


def rank_position(df: DataFrame, n: int = 1000, kind: str = "gainers") -> DataFrame:
    """1-based place in the served order. The list is cut to n rows first, so the single-task
    numbering is bounded by n. 'volume' shows the gainers' order."""
    losers = kind == "losers"
    served = top_losers(df, n) if losers else top_gainers(df, n)
    change = F.col("percent_change")
    order = Window.orderBy(change.asc() if losers else change.desc(), "symbol")
    return served.withColumn("position", F.row_number().over(order))


def ranking(
    closed: DataFrame, n: int = 10_000, width: int = MINUTE_MS, horizon_ms: int | None = DAY_MS, **series
) -> DataFrame:
    """Closed candles to the ranking rows: window closes, their change, newest per symbol, top n.

    The 24 h volume covers the horizon up to the newest window of the input; None covers it all.
    """
    newest = None
    if horizon_ms is not None:
        newest = closed.select(F.max(bucket_start("openTime", width)).alias("m")).scalar()
    changes = rolling_window_change(window_close(closed, width), **series)
    return top_gainers(latest_change(changes, newest, horizon_ms or 0), n)
