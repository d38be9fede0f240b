"""The platform's batch jobs, end to end over tables. Nothing is collected on the driver."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators import ml
from tickloom.operators.features import drop_null_features, feature_table
from tickloom.operators.indicators import indicator_table
from tickloom.operators.rollup import job_window, rollup_ohlc
from tickloom.operators.serving import latest_prediction, served_prediction
from tickloom.schemas import DAY_MS, FEATURES
from tickloom.session import run_dir
from tickloom.sources.tables import (
    insert_if_absent, latest_k_per_symbol, latest_view, recent_or_latest_k, scan_candles, upsert,
)

# The interval each roll-up reads.
ROLLUP_SOURCE = {"5m": "1m", "1h": "5m", "4h": "1h", "5h": "1h", "1d": "1h"}


def rollup_job(
    candles: DataFrame,
    interval: str,
    now: datetime,
    existing: DataFrame | None = None,
    symbols: Sequence[str] | None = None,
    replace: bool = True,
) -> DataFrame:
    """Bars of the last complete window before ``now``.

    Reads half-open, so no candle of the next window slips in. With ``existing`` bars: an upsert
    returns the whole table with late corrections applied, ``replace=False`` the bars to append
    because none is stored yet.
    """
    start, end = job_window(now, interval)
    source = scan_candles(candles, symbols, ROLLUP_SOURCE[interval], start, end)
    bars = rollup_ohlc(source, interval).drop("window_start")
    if existing is None:
        return bars
    return upsert(existing, bars) if replace else insert_if_absent(existing, bars)


def backfill_rollup(candles: DataFrame, interval: str, start: int, end: int, symbols: Sequence[str] | None = None) -> DataFrame:
    """All bars of a period in one job instead of one job per window."""
    source = scan_candles(candles, symbols, ROLLUP_SOURCE[interval], start, end)
    return rollup_ohlc(source, interval).drop("window_start")


def training_rows(
    candles: DataFrame, now: int, days: int = 30, symbols: Sequence[str] | None = None, **series
) -> DataFrame:
    """Complete feature rows with target of the last ``days`` days, both ends included."""
    recent = scan_candles(candles, symbols, "5m", now - days * DAY_MS, now, end_inclusive=True)
    return drop_null_features(feature_table(recent, **series), with_target=True)


def train(rows: DataFrame, pipeline: bool = True) -> tuple[object | None, ml.ModelParams]:
    """Fit on four fifths of the keys, evaluate on both folds, and keep the numbers with the model.

    Without ``pipeline`` there is no pipeline model, only its parameters, from one pass of moments. Scaling, solving and evaluating each pass over the rows, so the features are computed once and
    stored in the shared folder, where they also survive the loss of an executor.
    """
    spark = rows.sparkSession
    path = run_dir(spark, "training")
    kept = rows.select("symbol", "openTime", "target", *FEATURES)
    kept.withColumn("fold", ml.hash_fold("symbol", "openTime")).write.parquet(path)
    folds = spark.read.parquet(path)
    fold = folds.filter(F.col("fold") == "train")
    model = ml.fit(fold) if pipeline else None
    params = ml.model_params(model) if pipeline else ml.fit_params(fold)
    for r in ml.evaluate(ml.score(folds, params), by=("fold",)).collect():
        params.metrics |= {f"{r.fold}_{m}": r[m] for m in ("rmse", "mae", "r2")}
        setattr(params, f"{r.fold}_samples", r.rows)
    return model, params


def predict(
    candles: DataFrame,
    params: ml.ModelParams,
    now: int | Column,
    periods: int = 40,
    run_time: str | None = None,
    interval: str = "5m",
    symbols: Sequence[str] | None = None,
) -> DataFrame:
    """One forecast per symbol from its newest candle; the candles read per symbol are few."""
    source = scan_candles(candles, symbols, interval)
    recent = recent_or_latest_k(source, now, periods)
    newest = latest_k_per_symbol(feature_table(recent, with_target=False, cut=False), 1)
    scored = ml.score(drop_null_features(newest), params)
    return ml.forecast_columns(scored, run_time, interval)


def resync_cache(history: DataFrame, written: int, ttl_ms: int = 300_000) -> DataFrame:
    """Rebuild the served forecasts from the stored ones, with the shorter time to live."""
    newest = served_prediction(latest_prediction(history)).withColumn("written", F.lit(written).cast("long"))
    return latest_view(newest, ["symbol"], ["prediction_time"], ttl_ms, "written").drop("written")


def indicator_job(candles: DataFrame, **series) -> DataFrame:
    """Every indicator of the history job for each candle with a readable close."""
    typed = candles.withColumn("close_price_num", F.col("close").try_cast("double"))
    usable = typed.filter(F.col("close_price_num").isNotNull())
    return indicator_table(usable, "close_price_num", **series)


__all__ = [
    "backfill_rollup", "indicator_job", "predict", "resync_cache", "rollup_job",
    "train", "training_rows",
]
