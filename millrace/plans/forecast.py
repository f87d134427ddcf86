"""Next-bin demand forecast per zone: grid, features, training, scoring."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from millrace.functions.scalars import floor_to
from millrace.operators.aggregates import newest_per_key
from millrace.operators.series import time_grid, with_lags, with_rolling_means
from millrace.session import checkpointed

# Fixed values.
BIN_SECONDS = 1800
LAGS = {"y_next": -1, "lag_30m": 1, "lag_60m": 2, "lag_24h": 47, "lag_7d": 335}
ROLLING = {"roll_mean_1h": 2, "roll_mean_2h": 4}
FEATURES = ["zone_id", "hour", "dow", "is_weekend", "is_holiday", "demand", "lag_30m", "lag_60m",
            "lag_24h", "lag_7d", "roll_mean_1h", "roll_mean_2h", "rain_mm_h", "temperature_c"]
NO_RAIN, USUAL_TEMP_C = 0.0, 28.0
TRAIN_SHARE = 0.8
R2_TARGET = 0.70
MODELS = ("linear_regression", "random_forest")
FOREST = {"numTrees": 150, "maxDepth": 16, "minInstancesPerNode": 3, "seed": 42}


def demand_grid(requests: DataFrame, zone: str = "zone_id", time: str = "request_time",
                seconds: int = BIN_SECONDS) -> DataFrame:
    """Requests per zone and bin, zero where there were none."""
    counts = (requests.where(F.col(zone).isNotNull() & F.col(time).isNotNull())
              .groupBy(F.col(zone).alias("zone_id"), floor_to(F.col(time), seconds).alias("bin"))
              .agg(F.count(F.lit(1)).alias("demand")))
    return time_grid(counts, "zone_id", "bin", "demand", seconds)


def with_calendar(grid: DataFrame, holidays: list[str] | None = None) -> DataFrame:
    """Hour, weekday from Monday = 0, weekend and holiday flags."""
    day = F.date_format("bin", "yyyy-MM-dd")
    return grid.withColumns({
        "hour": F.hour("bin").cast("bigint"), "dow": F.weekday("bin").cast("bigint"),
        "is_weekend": (F.weekday("bin") >= 5).cast("bigint"),
        "is_holiday": (day.isin(holidays) if holidays else F.lit(False)).cast("bigint")})


def with_weather(grid: DataFrame, weather: DataFrame | None) -> DataFrame:
    """Hourly weather of each bin: no reading means no rain and the median temperature."""
    if weather is None:
        return grid.withColumns({"rain_mm_h": F.lit(NO_RAIN), "temperature_c": F.lit(USUAL_TEMP_C)})
    hourly = weather.select(F.col("hour_ts").alias("_hour"), F.col("rain_mm").alias("rain_mm_h"),
                            F.col("temp_c").alias("temperature_c"))
    hourly = checkpointed(hourly)  # one row per hour, read for the median and for the join
    rows = grid.withColumn("_hour", F.date_trunc("hour", "bin")).join(hourly, "_hour", "left").drop("_hour")
    median = rows.agg(F.percentile("temperature_c", 0.5).alias("m")).scalar()
    return rows.withColumns({"rain_mm_h": F.coalesce("rain_mm_h", F.lit(NO_RAIN)),
                             "temperature_c": F.coalesce("temperature_c", median)})


def features(requests: DataFrame, weather: DataFrame | None = None, holidays: list[str] | None = None,
             zone: str = "zone_id", time: str = "request_time", seconds: int = BIN_SECONDS) -> DataFrame:
    """All model inputs and the next bin's demand ``y_next``; nothing looks ahead but the target."""
    grid = demand_grid(requests, zone, time, seconds)
    def bins(counted: dict[str, int]) -> dict[str, int]:
        """Numbers of half hours as numbers of bins, one at least: a lag stays a time whatever the bins' width."""
        return {name: n if abs(n) == 1 else max(1, round(n * BIN_SECONDS / seconds)) for name, n in counted.items()}

    grid = with_lags(grid, "zone_id", "bin", "demand", bins(LAGS), seconds)
    grid = with_rolling_means(grid, "zone_id", "bin", "demand", bins(ROLLING), seconds)
    return with_weather(with_calendar(grid, holidays), weather)


def complete(rows: DataFrame, target: bool = True) -> DataFrame:
    return rows.dropna(subset=[*FEATURES, "y_next"] if target else FEATURES)


def time_split(rows: DataFrame, share: float = TRAIN_SHARE) -> DataFrame:
    """``rows`` with ``is_train``: bins up to the quantile train, later ones test."""
    cut = rows.agg(F.percentile(F.unix_timestamp("bin"), share).alias("c")).scalar()
    return rows.withColumn("is_train", F.unix_timestamp("bin") <= cut)


@dataclass(frozen=True)
class Trained:
    name: str
    model: PipelineModel
    metrics: dict[str, dict[str, float]]
    target_met: bool


def train(rows: DataFrame, forest: dict | None = None, models: Sequence[str] = MODELS) -> Trained:
    """Fit the regressors on the earlier bins and keep the one with the best R² on the later."""
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    common = {"featuresCol": "features", "labelCol": "y_next"}
    known = {"linear_regression": LinearRegression(**common),
             "random_forest": RandomForestRegressor(**common, **(forest or FOREST))}
    candidates = {name: known[name] for name in models}
    metrics, fitted = {}, {}
    # One row per zone and bin, read by every iteration.
    split = checkpointed(time_split(complete(rows)))
    fit_rows, test_rows = split.where("is_train"), split.where("NOT is_train")
    for name, regressor in candidates.items():
        fitted[name] = Pipeline(stages=[assembler, regressor]).fit(fit_rows)
        scored = fitted[name].transform(test_rows)
        metrics[name] = {m: RegressionEvaluator(labelCol="y_next", metricName=m).evaluate(scored)
                         for m in ("r2", "mae", "rmse")}
    best = max(metrics, key=lambda n: metrics[n]["r2"])
    return Trained(best, fitted[best], metrics, metrics[best]["r2"] >= R2_TARGET)


def latest_bins(rows: DataFrame) -> DataFrame:
    return newest_per_key(rows, ["zone_id"], [F.desc("bin")])


def score(rows: DataFrame, trained: Trained) -> DataFrame:
    """Predicted demand of the next bin for every zone, never negative, one decimal."""
    inputs = complete(latest_bins(rows), target=False)
    return trained.model.transform(inputs).select(
        "zone_id", F.col("bin").alias("as_of"),
        F.bround(F.greatest(F.col("prediction"), F.lit(0.0)), 1).alias("predicted_demand_next_30m"),
        F.col("demand").alias("recent_lag_30m"), F.lit(trained.name).alias("model"),
        F.current_timestamp().alias("forecast_generated_at"))


def forecast_for(scored: DataFrame, zones: DataFrame, zone_id: int) -> DataFrame:
    """One zone's forecast beside its recent actual; no row when there is none."""
    return (scored.where(F.col("zone_id") == zone_id)
            .join(zones.select("zone_id", "zone_name"), "zone_id", "left")
            .select("zone_id", "zone_name", "predicted_demand_next_30m", "recent_lag_30m", "as_of", "model"))
