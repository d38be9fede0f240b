import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog.forecasts import PUBLISHED
from tickloom.operators import ml
from tickloom.operators.ranking import rank_position, ranking, top_gainers, top_losers
from tickloom.plans import jobs
from tickloom.schemas import FEATURES, MINUTE_MS


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, len(FEATURES))) * 3 + 1
    y = x @ np.linspace(-1, 1, len(FEATURES)) + 0.5 + rng.normal(size=400) * 0.1
    data = [("S%d" % (i % 7), i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    cols = "symbol string, openTime long, " + ", ".join(f"{f} double" for f in FEATURES) + ", target double"
    return spark.createDataFrame(data, cols).cache()


def test_fit_equals_the_normal_equations(rows):
    params = ml.model_params(ml.fit(rows))
    pdf = rows.toPandas()
    x, y = pdf[FEATURES].to_numpy(), pdf["target"].to_numpy()
    mean, std = x.mean(0), x.std(0, ddof=1)
    z, n = (x - mean) / std, len(x)
    # Ridge as Spark defines it: features and label scaled to unit deviation, penalty 0.1.
    sy, sz = y.std(ddof=1), z.std(0, ddof=1)
    a = (z / sz).T @ (z / sz) / n + 0.1 / sy * np.eye(len(FEATURES))
    b = (z / sz).T @ ((y - y.mean()) / sy) / n
    coef = np.linalg.solve(a, b) * sy / sz
    assert np.allclose([params.coefficients[f] for f in FEATURES], coef, rtol=0.02)
    assert params.intercept == pytest.approx(y.mean(), abs=1e-6)
    assert np.allclose([params.scaler_mean[f] for f in FEATURES], mean)
    assert np.allclose([params.scaler_std[f] for f in FEATURES], std)


def test_expression_equals_pipeline_and_round_trip(spark, rows, tmp_path):
    model, params = jobs.train(rows)
    assert params.train_samples + params.test_samples == 400
    assert params.metrics["test_r2"] > 0.9
    path = str(tmp_path / "model")
    ml.save_model(spark, path, params, model)
    loaded = ml.load_params(spark, path)
    assert loaded == params
    a = ml.score(rows, loaded, "by_expression").select("openTime", "by_expression")
    b = ml.load_pipeline(path).transform(rows).select("openTime", "prediction")
    gap = a.join(b, "openTime").agg(F.max(F.abs(F.col("by_expression") - F.col("prediction")))).first()[0]
    assert gap < 1e-9
    with pytest.raises(FileNotFoundError):
        ml.load_params(spark, str(tmp_path / "nothing"))


@pytest.mark.parametrize("offset", [0.0, 1e7])
def test_moments_give_the_pipelines_parameters(rows, offset):
    """One pass of moments against the pipeline's passes, also far from zero and with a constant feature."""
    moved = rows.withColumns({f: F.col(f) + offset for f in FEATURES}).withColumn(FEATURES[3], F.lit(7.0))
    a, b = ml.fit_params(moved), ml.model_params(ml.fit(moved))
    for x, y in ((a.coefficients, b.coefficients), (a.scaler_mean, b.scaler_mean), (a.scaler_std, b.scaler_std)):
        assert np.allclose([x[f] for f in FEATURES], [y[f] for f in FEATURES], rtol=1e-4, atol=1e-4)
    assert a.intercept == pytest.approx(b.intercept, abs=1e-6) and a.coefficients[FEATURES[3]] == 0.0
    with pytest.raises(ValueError):
        ml.fit_params(rows.limit(99))


def test_training_needs_rows(rows):
    with pytest.raises(ValueError):
        ml.fit(rows.limit(99))


def test_splits(rows):
    train, test = ml.split_random(rows)
    assert train.count() + test.count() == 400
    early, late = ml.split_time(rows, 320)
    assert (early.count(), late.count()) == (320, 80)
    folds = {r.fold: r["count"] for r in rows.groupBy(ml.hash_fold("symbol", "openTime").alias("fold")).count().collect()}
    assert 280 < folds["train"] < 360


def test_score_ignores_constant_features(spark):
    params = ml.ModelParams(1.0, {"a": 2.0, "b": 5.0}, {"a": 3.0, "b": 0.0}, {"a": 2.0, "b": 0.0}, ["a", "b"])
    df = spark.createDataFrame([(5.0, 9.0)], "a double, b double")
    assert ml.score(df, params).first().prediction == 3.0
    assert params.frame(spark).count() == 2
    assert len(PUBLISHED.coefficients) == len(FEATURES)


def test_forecast_and_history(spark):
    cols = "symbol string, openTime long, close double, prediction double, return_1 double, rsi double, volatility_5 double, volume_ratio double"
    t0 = 1_704_067_200_000
    scored = spark.createDataFrame(
        [("A", t0, 100.0, 2.0, 0.0, 50.0, 1.0, 1.0), ("B", t0, 100.0, 0.0, 0.0, 50.0, 1.0, 1.0), ("C", t0, 1.0, 1.0, 0.0, 50.0, 1.0, 1.0)],
        cols,
    )
    out = ml.forecast_columns(scored, "now")
    rows = {r.symbol: r for r in out.collect()}
    assert rows["A"].predicted_price == 102.0 and rows["A"].target_time == "2024-01-01 00:05:00"
    assert rows["B"].direction == "DOWN"
    actual = spark.createDataFrame(
        [("A", t0 + 300_000, 104.0), ("B", t0 + 300_000, 100.0)], "symbol string, openTime long, close double"
    )
    h = {r.symbol: r for r in ml.prediction_history(out, actual).collect()}
    assert (h["A"].actual_change, h["A"].accuracy, h["A"].direction_hit) == (4.0, 50.0, True)
    assert h["B"].accuracy is None and h["B"].abs_error == 0.0
    assert h["C"].actual_price is None and h["C"].accuracy is None


def test_evaluate(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 3.0)], "target double, prediction double")
    row = ml.evaluate(df).first()
    assert row.rmse == pytest.approx((1 / 3) ** 0.5) and row.mae == pytest.approx(1 / 3)
    assert row.r2 == pytest.approx(0.5)


def test_ranking(spark):
    rows = []
    for s, closes in (("UP", [1, 2, 4]), ("DOWN", [4, 2, 1]), ("NEW", [5])):
        rows += [(s, (i + 1) * MINUTE_MS, float(c), 10.0) for i, c in enumerate(closes)]
    df = spark.createDataFrame(rows, "symbol string, openTime long, close double, quoteVolume double")
    got = ranking(df).collect()
    assert [(r.symbol, r.percent_change, r.volume) for r in got] == [("UP", 100.0, 20.0), ("DOWN", -50.0, 20.0)]
    assert ranking(df, horizon_ms=MINUTE_MS).first().volume == 10.0
    assert [r.symbol for r in top_losers(ranking(df), 1).collect()] == ["DOWN"]
    assert [r.symbol for r in top_gainers(ranking(df), 1).collect()] == ["UP"]
    assert [(r.symbol, r.position) for r in rank_position(ranking(df), 5, "losers").orderBy("position").collect()] == [("DOWN", 1), ("UP", 2)]


def test_r2_of_large_values_does_not_cancel(spark):
    y = [1e9 + i * 0.01 for i in range(1000)]
    p = [v + (0.001 if i % 2 else -0.001) for i, v in enumerate(y)]
    df = spark.createDataFrame(list(zip(y, p)), "target double, prediction double")
    got = ml.evaluate(df).first().r2
    assert got == pytest.approx(1 - sum((a - b) ** 2 for a, b in zip(y, p)) / (np.var(y) * len(y)), abs=1e-6) and got <= 1
