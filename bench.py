"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalog import QUERIES  # noqa: E402
from tickloom.session import local_session  # noqa: E402

HEADLINE = [
    "rollup_5m", "rollup_1h", "rollup_1d", "rollup_1m_by_user", "rollup_1d_by_supplier",
    "latest_price_by_user", "window_close", "rolling_window_change", "top_gainers",
    "gainers_from_messages", "sma_full", "rsi_price", "bollinger_population", "ema_first_seed", "macd",
    "indicator_table", "feature_table", "forecast_all_ticks", "forecast_latest",
    "prediction_history", "evaluate_forecast", "fitted_model_params", "replay_book",
    "depth_cumulative", "parse_klines", "parse_depth", "upsert_candles", "insert_if_absent",
    "tick_change_pct", "retain_last_trades", "counter_rate", "latency_quantile",
    "stream_top_gainers", "stream_book", "stream_trade_tape",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    QUERIES["symbol_summary"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        best = None
        for _ in range(2):
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - begin
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name,
            }
        )
    )


if __name__ == "__main__":
    main()
