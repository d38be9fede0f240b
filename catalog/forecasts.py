"""Training rows, scoring with fixed parameters, evaluation and forecast history."""

from pyspark.sql import functions as F

from catalog.bars import tick_bars
from catalog.base import CANDLES, MID_MONTH, aligned_cte, bars_cte, r, register, rounded
from catalog.indicators import ORDER, feature_sql
from tickloom.operators import ml
from tickloom.operators import serving as sv
from tickloom.operators.features import drop_null_features, feature_table
from tickloom.plans import jobs
from tickloom.schemas import FEATURES, HOUR_MS
from tickloom.session import run_dir
from tickloom.sources import tables as tb
from tickloom.sources import testdata as td

# The parameters of the published model.
PUBLISHED = ml.ModelParams(
    intercept=-0.0019660044946657766,
    coefficients={
        "return_1": -0.0020438715926529264,
        "return_2": -0.0028421925147323526,
        "price_to_ma5": 0.0007276541712806056,
        "price_to_ma20": 0.003762098494480344,
        "volatility_5": 0.0004979508488919883,
        "volatility_10": 0.00015095762098578562,
        "volume_ratio": -0.0013173951615727565,
        "rsi": -0.0008163926874471569,
        "price_range": 0.0003938088117340127,
        "body_size": 0.00039777011037546455,
    },
    scaler_mean={
        "return_1": -0.0017439112046041658,
        "return_2": -0.0033205935636654886,
        "price_to_ma5": -0.0038647417928426046,
        "price_to_ma20": -0.018169201532824465,
        "volatility_5": 8.071006404013865,
        "volatility_10": 11.129816694400603,
        "volume_ratio": 1.0072129374854897,
        "rsi": 49.38937378348659,
        "price_range": 13.107378614212447,
        "body_size": -0.039512987532565214,
    },
    scaler_std={
        "return_1": 0.2336822176047568,
        "return_2": 0.3272200441012612,
        "price_to_ma5": 0.2530921744447732,
        "price_to_ma20": 0.5925556249230207,
        "volatility_5": 37.08101418041705,
        "volatility_10": 50.38961228982285,
        "volume_ratio": 0.6209768611367956,
        "rsi": 16.0489444204529,
        "price_range": 58.134711810389916,
        "body_size": 38.01102333921282,
    },
)
RUN_TIME = "2024-01-31T00:00:00+00:00"
USABLE = " AND ".join(f"{f} IS NOT NULL" for f in FEATURES)


def score_sql() -> str:
    p = PUBLISHED
    terms = [
        f"({f} - ({p.scaler_mean[f]!r})) / {p.scaler_std[f]!r} * ({p.coefficients[f]!r})" for f in FEATURES
    ]
    return f"({p.intercept!r}) + " + " + ".join(terms)


def predictions_cte(interval_ms: int, source: str = "features") -> str:
    return f""",
predictions AS (
  SELECT symbol, "openTime", close, p AS predicted_change_pct, close * (1 + p / 100) AS predicted_price,
         CASE WHEN p > 0 THEN 'UP' ELSE 'DOWN' END AS direction, '{RUN_TIME}' AS prediction_time,
         strftime(make_timestamp(("openTime" + {interval_ms}) * 1000), '%Y-%m-%d %H:%M:%S') AS target_time,
         return_1, rsi, volatility_5, volume_ratio
  FROM (SELECT *, {score_sql()} AS p FROM {source} WHERE {USABLE}))"""


ROUNDED = ["predicted_price", "predicted_change_pct", "return_1", "rsi", "volatility_5", "volume_ratio"]
PREDICTION = (
    'symbol, "openTime", close, direction, prediction_time, target_time, '
    + ", ".join(r(c, c) for c in ROUNDED)
)

# Forecasts for every hourly bar: bars from trades, features, score.
HOURLY = (
    "WITH" + CANDLES + bars_cte("b", "candles", HOUR_MS, "seq") + aligned_cte("bars", "b", HOUR_MS)
    + "," + feature_sql("bars", '"openTime"')
)
HOURLY_PREDICTIONS = HOURLY + predictions_cte(HOUR_MS)


def bars(spark, d):
    return tick_bars(spark, d, "1h", align=True)


def hourly_features(spark, d, with_target=True):
    # One bar per hour and symbol: bounded series, no need to cut.
    return drop_null_features(feature_table(bars(spark, d), with_target, cut=False))


def forecasts(spark, d):
    scored = ml.score(hourly_features(spark, d, False), PUBLISHED)
    return ml.forecast_columns(scored, RUN_TIME, "1h")


@register("forecast_all_bars", f"{HOURLY_PREDICTIONS} SELECT {PREDICTION} FROM predictions")
def forecast_all_bars(spark, d):
    return rounded(forecasts(spark, d), *ROUNDED)


@register(
    "forecast_all_ticks",
    f"WITH {CANDLES}, {feature_sql()} {predictions_cte(300_000)} SELECT {PREDICTION} FROM predictions",
)
def forecast_all_ticks(spark, d):
    """Every trade of the table scored as a five-minute candle."""
    features = feature_table(td.tick_candles(td.ticks(spark, d)), False, order=ORDER)
    scored = ml.score(drop_null_features(features), PUBLISHED)
    return rounded(ml.forecast_columns(scored, RUN_TIME), *ROUNDED)


_LATEST = f"""{HOURLY}, newest AS (SELECT * FROM features QUALIFY row_number() OVER (
  PARTITION BY symbol ORDER BY "openTime" DESC) = 1) {predictions_cte(HOUR_MS, 'newest')}"""


@register(
    "forecast_latest",
    f"""{_LATEST} SELECT {PREDICTION}, {r('abs(predicted_change_pct)', 'confidence_score')}
    FROM predictions ORDER BY predictions.predicted_change_pct DESC""",
)
def forecast_latest(spark, d):
    """The inference job: features, the newest row per symbol, score, order by predicted change."""
    features = feature_table(bars(spark, d), False, cut=False)
    newest = drop_null_features(tb.latest_k_per_symbol(features, 1))
    out = ml.forecast_columns(ml.score(newest, PUBLISHED), RUN_TIME, "1h")
    out = sv.predictions_by_change(out.withColumn("confidence_score", F.abs("predicted_change_pct")))
    return rounded(out, *ROUNDED, "confidence_score")


@register(
    "forecast_from_recent",
    f"""WITH {CANDLES}, recent AS (SELECT * FROM candles QUALIFY row_number() OVER (
      PARTITION BY symbol ORDER BY "openTime" DESC, seq DESC) <= 40), {feature_sql('recent')},
    newest AS (SELECT * FROM features QUALIFY row_number() OVER (
      PARTITION BY symbol ORDER BY "openTime" DESC, seq DESC) = 1) {predictions_cte(300_000, 'newest')}
    SELECT {PREDICTION} FROM predictions""",
)
def forecast_from_recent(spark, d):
    """As scheduled: only the newest 40 candles per symbol are read into the features."""
    recent = tb.latest_k_per_symbol(td.tick_candles(td.ticks(spark, d)), 40, order=ORDER)
    newest = tb.latest_k_per_symbol(feature_table(recent, False, order=ORDER, cut=False), 1, order=ORDER)
    scored = ml.score(drop_null_features(newest), PUBLISHED)
    return rounded(ml.forecast_columns(scored, RUN_TIME), *ROUNDED)


@register(
    "all_predictions",
    f"""{HOURLY_PREDICTIONS} SELECT {PREDICTION}, {r('abs(predicted_change_pct)', 'confidence_score')}
    FROM predictions QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "openTime" DESC) = 1""",
)
def all_predictions(spark, d):
    return rounded(sv.all_predictions(forecasts(spark, d)), *ROUNDED, "confidence_score")


@register(
    "served_predictions",
    f"""{HOURLY_PREDICTIONS} SELECT symbol, close AS current_price, {r('predicted_price', 'predicted_price')},
      {r('predicted_change_pct', 'predicted_change')}, direction, prediction_time, target_time,
      {r('abs(predicted_change_pct)', 'confidence_score')} FROM predictions""",
)
def served_predictions(spark, d):
    out = sv.served_prediction(forecasts(spark, d))
    return rounded(out, "predicted_price", "predicted_change", "confidence_score")


@register("direction_counts", f"{HOURLY_PREDICTIONS} SELECT direction, count(*) AS count FROM predictions GROUP BY 1")
def direction_counts(spark, d):
    return sv.direction_counts(forecasts(spark, d))


@register(
    "prediction_summary",
    f"""{HOURLY_PREDICTIONS}, s AS (SELECT count(*) AS n, count(*) FILTER (direction = 'UP') AS up,
      avg(predicted_change_pct) AS a, max(predicted_change_pct) AS hi, min(predicted_change_pct) AS lo
      FROM predictions)
    SELECT up AS up_count, {r('100.0 * up / n', 'up_pct')}, n - up AS down_count,
      {r('100.0 * (n - up) / n', 'down_pct')}, {r('a', 'avg_change')}, {r('hi', 'max_gain')},
      {r('lo', 'max_loss')} FROM s""",
)
def prediction_summary(spark, d):
    out = sv.prediction_summary(forecasts(spark, d))
    return rounded(out, "up_pct", "down_pct", "avg_change", "max_gain", "max_loss")


@register(
    "prediction_history",
    f"""{HOURLY_PREDICTIONS}, joined AS (
      SELECT p.*, b.close AS actual_price, (b.close - p.close) / nullif(p.close, 0) * 100 AS actual_change
      FROM predictions p LEFT JOIN bars b ON b.symbol = p.symbol AND b."openTime" = p."openTime" + {HOUR_MS})
    SELECT symbol, "openTime", prediction_time, {r('predicted_price', 'predicted_price')},
      {r('predicted_change_pct', 'predicted_change')}, actual_price, {r('actual_change', 'actual_change')},
      (predicted_change_pct > 0) = (actual_change > 0) AS direction_hit,
      {r('abs(predicted_change_pct - actual_change)', 'abs_error')},
      {r('''CASE WHEN actual_change <> 0 THEN greatest(0,
          100 * (1 - abs(predicted_change_pct - actual_change) / abs(actual_change))) END''', 'accuracy')}
    FROM joined""",
)
def prediction_history(spark, d):
    out = ml.prediction_history(forecasts(spark, d), bars(spark, d), "1h")
    return rounded(out, "predicted_price", "predicted_change", "actual_change", "abs_error", "accuracy")


FOLD = """CASE WHEN substr(md5(symbol || '|' || CAST("openTime" AS VARCHAR)), 1, 8) < 'cccccccc'
  THEN 'train' ELSE 'test' END"""


@register(
    "hash_split",
    f"""{HOURLY} SELECT {FOLD} AS fold, count(*) AS rows, {r('avg(target)', 'mean_target')}
    FROM features WHERE target IS NOT NULL AND {USABLE} GROUP BY 1""",
)
def hash_split(spark, d):
    rows = drop_null_features(feature_table(bars(spark, d), cut=False), True)
    out = rows.groupBy(ml.hash_fold("symbol", "openTime").alias("fold")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg("target").alias("mean_target")
    )
    return rounded(out, "mean_target")


@register(
    "evaluate_forecast",
    f"""{HOURLY}, s AS (SELECT {FOLD} AS fold, target AS y, {score_sql()} AS p FROM features
      WHERE target IS NOT NULL AND {USABLE}),
    e AS (SELECT fold, count(*) AS rows, sqrt(avg((y - p) ** 2)) AS rmse, avg(abs(y - p)) AS mae,
      1 - sum((y - p) ** 2) / (var_pop(y) * count(*)) AS r2 FROM s GROUP BY 1)
    SELECT fold, rows, {r('rmse', 'rmse', 4)}, {r('mae', 'mae', 4)}, {r('r2', 'r2')} FROM e""",
)
def evaluate_forecast(spark, d):
    rows = drop_null_features(feature_table(bars(spark, d), cut=False), True)
    scored = ml.score(rows.withColumn("fold", ml.hash_fold("symbol", "openTime")), PUBLISHED)
    return rounded(rounded(ml.evaluate(scored, by=("fold",)), "rmse", "mae", digits=4), "r2")


def _training_rows(spark, d):
    return drop_null_features(feature_table(td.tick_candles(td.ticks(spark, d)), order=ORDER), True)


_TRAINING = f"""WITH {CANDLES}, {feature_sql()}, rows_ AS (
  SELECT *, {FOLD} AS fold FROM features WHERE target IS NOT NULL AND {USABLE})"""
_SCALERS = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {r(f'avg({f})', 'mean')}, {r(f'stddev_samp({f})', 'std')}, "
    f"{r('avg(target)', 'intercept', 4)}, 0.0::DOUBLE AS residual FROM rows_ WHERE fold = 'train'"
    for f in FEATURES
)


@register("fitted_model_params", f"{_TRAINING} {_SCALERS}")
def fitted_model_params(spark, d):
    """Training on the hash fold: scalers, intercept, and how far the coefficients are from solving it.

    The residual of the ridge's normal equation of each feature, in deviations of the label, is zero
    for the solution and for nothing else.
    """
    rows = _training_rows(spark, d)
    _, params = jobs.train(rows, pipeline=False)
    train = ml.score(rows.withColumn("fold", ml.hash_fold("symbol", "openTime")), params).filter("fold = 'train'")
    miss = F.col("prediction") - F.col("target")
    # A feature that never changes has no deviation and no equation.
    z = {f: (F.col(f) - params.scaler_mean[f]) / (params.scaler_std[f] or float("inf")) for f in FEATURES}
    deviation = F.stddev_samp("target")
    equations = train.agg(
        *[((F.avg(z[f] * miss) + 0.1 * params.coefficients[f] / deviation) / deviation).alias(f) for f in FEATURES]
    )
    residual = equations.unpivot([], FEATURES, "feature", "residual")
    out = params.frame(spark).select("feature", "mean", "std", "intercept").join(residual, "feature")
    out = out.withColumn("residual", F.round("residual", 2) + 0.0)
    return rounded(rounded(out, "mean", "std"), "intercept", digits=4)


@register(
    "fitted_model_quality",
    f"{_TRAINING} SELECT fold, count(*) AS rows, true AS explains FROM rows_ GROUP BY 1",
)
def fitted_model_quality(spark, d):
    """Fit, then score every row by the column expression and evaluate per fold."""
    rows = _training_rows(spark, d)
    _, params = jobs.train(rows, pipeline=False)
    folds = rows.withColumn("fold", ml.hash_fold("symbol", "openTime"))
    found = ml.evaluate(ml.score(folds, params), by=("fold",))
    return found.select("fold", "rows", ((F.col("r2") > 0) & (F.col("r2") <= 1) & (F.col("mae") <= F.col("rmse"))).alias("explains"))


@register(
    "score_by_stored_model",
    f"WITH {CANDLES}, {feature_sql()} {predictions_cte(300_000)} SELECT {PREDICTION} FROM predictions",
)
def score_by_stored_model(spark, d):
    """The published parameters written, read back and applied to every trade."""
    path = run_dir(spark, "model")
    ml.save_model(spark, path, PUBLISHED)
    features = feature_table(td.tick_candles(td.ticks(spark, d)), False, order=ORDER)
    scored = ml.score(drop_null_features(features), ml.load_params(spark, path))
    return rounded(ml.forecast_columns(scored, RUN_TIME), *ROUNDED)


@register(
    "time_split",
    f"""{HOURLY} SELECT CASE WHEN "openTime" < {MID_MONTH} THEN 'train' ELSE 'test' END AS fold, count(*) AS rows,
    min("openTime") AS first, max("openTime") AS last FROM features WHERE target IS NOT NULL AND {USABLE} GROUP BY 1""",
)
def time_split(spark, d):
    rows = drop_null_features(feature_table(bars(spark, d), cut=False), True)
    train, test = ml.split_time(rows, MID_MONTH)
    sides = train.withColumn("fold", F.lit("train")).unionByName(test.withColumn("fold", F.lit("test")))
    return sides.groupBy("fold").agg(
        F.count(F.lit(1)).alias("rows"), F.min("openTime").alias("first"), F.max("openTime").alias("last")
    )


@register(
    "sample_predictions",
    f"""{HOURLY}, s AS (SELECT symbol, close, target, {score_sql()} AS p FROM features WHERE {USABLE})
    SELECT symbol, close, {r('target', 'target')}, {r('p', 'prediction')} FROM s
    ORDER BY symbol NULLS FIRST, close NULLS FIRST, target NULLS FIRST, p NULLS FIRST LIMIT 10""",
)
def sample_predictions(spark, d):
    scored = ml.score(hourly_features(spark, d), PUBLISHED)
    out = sv.sample_predictions(scored.select("symbol", "close", "target", "prediction"))
    return rounded(out, "target", "prediction")


@register(
    "cache_or_history",
    f"""{HOURLY_PREDICTIONS}, h AS (SELECT *, 'history' AS source, "openTime" AS written FROM predictions),
    c AS (SELECT *, 'cache' AS source, "openTime" AS written FROM predictions
      QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "openTime" DESC) = 1),
    now AS (SELECT max("openTime") AS t FROM predictions),
    u AS (SELECT c.* FROM c, now WHERE now.t < c."openTime" + 1800000 AND symbol <> 'click'
      UNION ALL SELECT * FROM h)
    SELECT symbol, "openTime", source, close, {r('predicted_price', 'predicted_price')} FROM u
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY source, "openTime" DESC) = 1""",
)
def cache_or_history(spark, d):
    """Served forecasts: a live cache entry first, else the newest stored one. One symbol is uncached."""
    history = forecasts(spark, d)
    cache = tb.latest_view(history.filter("symbol <> 'click'"), ["symbol"], ["openTime"], 1_800_000)
    now = history.select(F.max("openTime").alias("t")).scalar()
    out = tb.cache_or_history(cache, history, now, order=("openTime",))
    return rounded(out.select("symbol", "openTime", "source", "close", "predicted_price"), "predicted_price")
