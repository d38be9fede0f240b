"""Training, scoring and evaluation of the next-candle forecast."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalars import change_pct, utc_text
from tickloom.schemas import FEATURES, INTERVAL_MS

MIN_TRAINING_ROWS = 100


@dataclass
class ModelParams:
    """What scoring needs: one coefficient, mean and deviation per feature, and the intercept."""

    intercept: float
    coefficients: dict[str, float]
    scaler_mean: dict[str, float]
    scaler_std: dict[str, float]
    features: list[str] = field(default_factory=lambda: list(FEATURES))
    metrics: dict[str, float] = field(default_factory=dict)
    train_samples: int = 0
    test_samples: int = 0

    def to_json(self) -> str:
        return json.dumps({"model_type": "LinearRegression", **self.__dict__})

    @classmethod
    def from_json(cls, text: str) -> ModelParams:
        raw = json.loads(text)
        return cls(**{k: v for k, v in raw.items() if k in cls.__dataclass_fields__})

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (f, self.coefficients.get(f, 0.0), self.scaler_mean.get(f, 0.0), self.scaler_std.get(f, 1.0), self.intercept)
            for f in self.features
        ]
        return spark.createDataFrame(
            rows, "feature string, coefficient double, mean double, std double, intercept double"
        )


def split_random(df: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """80/20; repeatable only for one partitioning and row order of the input."""
    train, test = df.randomSplit([0.8, 0.2], seed=seed)
    return train, test


def split_time(df: DataFrame, boundary: int, time: str = "openTime") -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(time) < boundary), df.filter(F.col(time) >= boundary)


def hash_fold(*cols: str) -> Column:
    """'train' for four fifths of the keys, 'test' for the rest, the same in every run."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in cols]))
    return F.when(F.substring(digest, 1, 8) < "cccccccc", "train").otherwise("test")


def fit(train: DataFrame, label: str = "target", features: list[str] | None = None) -> PipelineModel:
    """Standardised ridge regression; refuses fewer than 100 rows."""
    features = features or FEATURES
    if train.limit(MIN_TRAINING_ROWS).count() < MIN_TRAINING_ROWS:
        raise ValueError(f"need at least {MIN_TRAINING_ROWS} training rows")
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=features, outputCol="features_raw"),
            StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
            LinearRegression(
                featuresCol="features", labelCol=label, maxIter=100, regParam=0.1, elasticNetParam=0.0
            ),
        ]
    ).fit(train)


def moments(rows: DataFrame, columns: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of complete rows, means, and sample covariances of ``columns``, in one pass.

    Every task keeps centred sums, which are merged pairwise, so large offsets cost no precision; one row
    reaches the driver.
    """
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    row = rows.dropna(subset=columns).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[(F.min(c) < F.max(c)).alias(f"v{i}") for i, c in enumerate(columns)],
        *[F.covar_samp(columns[i], columns[j]).alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    means = np.array([row[f"m{i}"] or 0.0 for i in range(len(columns))])
    spread = np.zeros((len(columns), len(columns)))
    for i, j in pairs:
        # Merged sums of a constant may differ in the last bit, which is no variation.
        spread[i, j] = spread[j, i] = row[f"c{i}_{j}"] or 0.0 if row[f"v{i}"] and row[f"v{j}"] else 0.0
    return row["n"], means, spread


def fit_params(train: DataFrame, label: str = "target", features: list[str] | None = None, penalty: float = 0.1) -> ModelParams:
    """The parameters of :func:`fit` from one pass of moments and one solve.

    The ridge's normal equations in features and label of unit deviation; a feature that never changes has
    coefficient zero.
    """
    features = list(features or FEATURES)
    n, means, spread = moments(train, [*features, label])
    if n < MIN_TRAINING_ROWS:
        raise ValueError(f"need at least {MIN_TRAINING_ROWS} training rows")
    std = np.sqrt(np.maximum(np.diag(spread), 0.0))
    live = np.flatnonzero(std[:-1] > 0)
    coefficients, own = np.zeros(len(features)), std[-1]
    if own > 0 and len(live):
        scaled = spread[np.ix_(live, live)] / np.outer(std[live], std[live])
        target = spread[live, -1] / (std[live] * own)
        # The penalty is per deviation of the label, which is taken over n here and over n - 1 elsewhere.
        ridge = penalty / (own * np.sqrt((n - 1) / n)) * np.eye(len(live))
        coefficients[live] = np.linalg.solve(scaled + ridge, target) * own
    named = lambda values: dict(zip(features, map(float, values), strict=True))
    return ModelParams(float(means[-1]), named(coefficients), named(means[:-1]), named(std[:-1]), features)


def model_params(model: PipelineModel, features: list[str] | None = None) -> ModelParams:
    features = list(features or FEATURES)
    scaler, regression = model.stages[1], model.stages[2]
    named = lambda values: dict(zip(features, map(float, values)))
    return ModelParams(
        intercept=float(regression.intercept),
        coefficients=named(regression.coefficients.toArray()),
        scaler_mean=named(scaler.mean.toArray()),
        scaler_std=named(scaler.std.toArray()),
        features=features,
    )


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def save_model(spark: SparkSession, path: str, params: ModelParams, model: PipelineModel | None = None) -> None:
    """Parameters as one line of JSON and, if given, the fitted pipeline."""
    if model is not None:
        model.write().overwrite().save(f"{path}/pipeline")
    frame = spark.createDataFrame([(params.to_json(),)], "value string")
    frame.write.mode("overwrite").text(f"{path}/params")


def load_params(spark: SparkSession, path: str) -> ModelParams:
    p, fs = _hadoop_path(spark, f"{path}/params")
    if not fs.exists(p):
        raise FileNotFoundError(f"no model at {path}")
    return ModelParams.from_json(spark.read.text(f"{path}/params").first()[0])


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/pipeline")


def score(df: DataFrame, params: ModelParams, name: str = "prediction") -> DataFrame:
    """Linear score as one column expression; a feature with zero deviation contributes nothing."""
    total = F.lit(float(params.intercept))
    for f in params.features:
        std = params.scaler_std.get(f, 1.0)
        if std != 0.0:
            z = (F.col(f) - params.scaler_mean.get(f, 0.0)) / std
            total = total + z * params.coefficients.get(f, 0.0)
    return df.withColumn(name, total)


def forecast_columns(scored: DataFrame, run_time: str | None = None, interval: str = "5m") -> DataFrame:
    """Forecast rows from a ``prediction`` column (% change). ``run_time`` is an ISO text."""
    p = F.col("prediction")
    run = F.lit(run_time) if run_time else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssxxx")
    return scored.withColumns(
        {
            "predicted_change_pct": p,
            "predicted_price": F.col("close") * (1 + p / 100),
            "direction": F.when(p > 0, "UP").otherwise("DOWN"),
            "prediction_time": run,
            "target_time": utc_text(F.col("openTime") + INTERVAL_MS[interval]),
        }
    ).select(
        "symbol", "openTime", "close", "predicted_price", "predicted_change_pct", "direction",
        "prediction_time", "target_time", "return_1", "rsi", "volatility_5", "volume_ratio",
    )


def evaluate(scored: DataFrame, label: str = "target", by: tuple[str, ...] = ()) -> DataFrame:
    """RMSE, MAE and R2 in one aggregate pass; the spread is a running variance, which doesn't cancel."""
    y, p = F.col(label), F.col("prediction")
    n = F.count(F.lit(1))
    sse = F.sum((y - p) * (y - p))
    return scored.groupBy(*by).agg(
        n.alias("rows"),
        F.sqrt(sse / n).alias("rmse"),
        (F.sum(F.abs(y - p)) / n).alias("mae"),
        (1 - F.try_divide(sse, F.var_pop(y) * n)).alias("r2"),
    )


def prediction_history(predictions: DataFrame, candles: DataFrame, interval: str = "5m") -> DataFrame:
    """Each forecast beside what happened in its target candle, if that exists.

    accuracy = max(0, 100 (1 - |predicted - actual| / |actual|)) of the percentage changes, null
    for no actual change; direction_hit compares the signs, 0 counting as down.
    """
    actual = candles.select(
        "symbol",
        (F.col("openTime") - INTERVAL_MS[interval]).alias("openTime"),
        F.col("close").alias("actual_price"),
    )
    change, predicted = F.col("actual_change"), F.col("predicted_change_pct")
    error = F.abs(predicted - change)
    return (
        predictions.join(actual, ["symbol", "openTime"], "left")
        .withColumn("actual_change", change_pct("actual_price", "close"))
        .select(
            "symbol",
            "openTime",
            "prediction_time",
            "predicted_price",
            predicted.alias("predicted_change"),
            "actual_price",
            "actual_change",
            ((predicted > 0) == (change > 0)).alias("direction_hit"),
            error.alias("abs_error"),
            F.when(
                change != 0, F.greatest(F.lit(0.0), 100 * (1 - F.try_divide(error, F.abs(change))))
            ).alias("accuracy"),
        )
    )
