"""Demand features, forecast models, scores, recursion and staffing: X1-X10.

Frames hold one row per series and business date; ``series`` names the key columns and is empty
for a single series.  Windows run per series over its dates, so their size is bounded by the
calendar, not by the orders behind the counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import aggregate, divided, mean
from tallyhouse.sources.workdir import settle

# The columns of a day's context, the features made of them, and the names of the models.
CONTEXT_COLUMNS = [
    "business_date",
    "day_name",
    "is_weekend",
    "is_public_holiday",
    "is_city_event",
    "promotion_name",
    "temperature_c",
    "rain_mm",
]
NUMERIC_FEATURES = [
    "is_weekend",
    "is_public_holiday",
    "is_city_event",
    "has_promotion",
    "temperature_c",
    "rain_mm",
    "previous_day_orders",
    "previous_week_orders",
    "rolling_7day_avg",
]
CATEGORICAL_FEATURES = ["day_name", "month"]
FEATURE_COLUMNS = ["business_date", *CATEGORICAL_FEATURES, *NUMERIC_FEATURES, "order_count"]

NAIVE = "Naive (previous week)"
MOVING_AVERAGE = "Moving average (7-day)"
LINEAR = "Linear regression"
FOREST = "Random forest"

TEST_DAYS = 60
FORECAST_DAYS = 7


def _over(series: Sequence[str], order: str = "business_date", frame: str = "") -> str:
    partition = ", ".join(series) or "0"
    return f"over (partition by {partition} order by {order} {frame})"


# --- X1, X2 ----------------------------------------------------------------------------------


def with_lags(daily: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Counts one and seven rows back, and the mean of the seven rows before this one."""
    orders = "double(order_count)"
    past = _over(series, frame="rows between 7 preceding and 1 preceding")
    return daily.selectExpr(
        "*",
        f"lag({orders}, 1) {_over(series)} as previous_day_orders",
        f"lag({orders}, 7) {_over(series)} as previous_week_orders",
        f"if(count(order_count) {past} = 7, avg({orders}) {past}, null) as rolling_7day_avg",
    )


def feature_frame(daily: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Model inputs per day; days without a full week of history are dropped.

    The rolling mean stops at the day before, so a day's own count never reaches its features.
    """
    derived = {"month": "month(business_date)", "has_promotion": "promotion_name is not null"}
    columns = [f"{derived[c]} as {c}" if c in derived else c for c in FEATURE_COLUMNS]
    return (
        with_lags(daily, series)
        .where("previous_week_orders is not null and rolling_7day_avg is not null")
        .selectExpr(*series, *columns)
    )


def mark_holdout(features: DataFrame, series: Sequence[str] = (), test_days: int = TEST_DAYS) -> DataFrame:
    """Flags the last ``test_days`` rows of each series as the test part."""
    return features.selectExpr("*", f"row_number() {_over(series, 'business_date desc')} <= {test_days} as is_test")


def chronological_split(
    features: DataFrame, series: Sequence[str] = (), test_days: int = TEST_DAYS
) -> tuple[DataFrame, DataFrame]:
    """Train and test parts; refuses a test part that leaves a series nothing to train on.

    The check is one small job: the length of the shortest series.
    """
    shortest = features.groupBy(*series).count().agg(F.min("count")).first()[0] or 0
    if test_days >= shortest:
        raise ValueError(f"test_days ({test_days}) must be smaller than the shortest series ({shortest} rows)")
    marked = mark_holdout(features, series, test_days)
    return marked.where("not is_test").drop("is_test"), marked.where("is_test").drop("is_test")


# --- X3: scores ------------------------------------------------------------------------------


def score_columns(actual: str = "order_count", predicted: str = "prediction") -> list[str]:
    """MAE, RMSE and MAPE in percent; a zero actual has no percentage and is left out of MAPE."""
    error = f"({actual} - {predicted})"
    return [
        f"{mean(f'abs({error})')} as mae",
        f"sqrt({mean(f'{error} * {error}')}) as rmse",
        f"{mean(f'abs({divided(error, actual)})')} * 100 as mape",
    ]


# --- X4-X7: models ---------------------------------------------------------------------------

Model = Callable[[DataFrame], DataFrame]


def previous_week_model(features: DataFrame) -> DataFrame:
    """X4."""
    return features.withColumn("prediction", F.col("previous_week_orders"))


def moving_average_model(features: DataFrame) -> DataFrame:
    """X5."""
    return features.withColumn("prediction", F.col("rolling_7day_avg"))


def _design(features: DataFrame) -> DataFrame:
    numbers = [f"double({c}) as {c}_value" for c in NUMERIC_FEATURES]
    labels = [f"string({c}) as {c}_label" for c in CATEGORICAL_FEATURES]
    return features.selectExpr("*", *numbers, *labels, "double(order_count) as _target")


_DESIGN_COLUMNS = ["_target", "_features"] + [
    name
    for c in NUMERIC_FEATURES + CATEGORICAL_FEATURES
    for name in (f"{c}_value", f"{c}_label", f"{c}_index", f"{c}_flags")
]


def _encoding(series: Sequence[str]) -> list:
    """One-hot columns fixed at fit time; a category unseen there becomes all zeros."""
    labels = [f"{c}_label" for c in CATEGORICAL_FEATURES] + list(series)
    index = [f"{c}_index" for c in CATEGORICAL_FEATURES] + [f"{c}_index" for c in series]
    flags = [f"{c}_flags" for c in CATEGORICAL_FEATURES] + [f"{c}_flags" for c in series]
    return [
        StringIndexer(inputCols=labels, outputCols=index, handleInvalid="keep"),
        OneHotEncoder(inputCols=index, outputCols=flags, handleInvalid="keep", dropLast=True),
        VectorAssembler(
            inputCols=[f"{c}_value" for c in NUMERIC_FEATURES] + flags,
            outputCol="_features",
            handleInvalid="keep",
        ),
    ]


def _fit(estimator, train: DataFrame, series: Sequence[str]) -> Model:
    complete = train.dropna(subset=[*NUMERIC_FEATURES, "order_count"])
    fitted: PipelineModel = Pipeline(stages=[*_encoding(series), estimator]).fit(_design(complete))
    drop = _DESIGN_COLUMNS + [f"{c}_{part}" for c in series for part in ("index", "flags")]

    def predict(features: DataFrame) -> DataFrame:
        scored = fitted.transform(_design(features)).drop(*drop)
        return scored.withColumn("prediction", F.nullif("prediction", F.lit(float("nan"))))

    return predict


def _products(centre: list[float]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Per task, the products of all centred columns with one another, summed over its rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(centre), len(centre)))
        for batch in batches:
            rows = np.array(batch["_row"].tolist()).reshape(-1, len(centre)) - centre
            total += rows.T @ rows
        yield pd.DataFrame({"sums": [total.ravel()]})

    return run


def least_squares(rows: DataFrame) -> tuple[list[float], float]:
    """Weights and constant that minimise the squared error of ``_target`` over the array ``_features``.

    Two passes: means of all columns, then sums of the products of centred columns, per task and then over all.  The driver
    gets as many numbers as pairs of columns, whatever the rows, and solves the normal equations once; of several solutions
    it takes the shortest.  No rows give zeros.
    """
    table = rows.selectExpr("concat(_features, array(_target)) as _row")
    means = table.selectExpr("posexplode(_row) as (place, value)").groupBy("place").agg(F.avg("value")).collect()
    if not means:
        return [], 0.0
    centre = [m for _, m in sorted((r[0], r[1]) for r in means)]
    sums = table.mapInPandas(_products(centre), "sums array<double>").selectExpr("posexplode(sums) as (place, value)")
    flat = dict(sums.groupBy("place").agg(F.sum("value")).collect())
    gram = np.array([flat[k] for k in range(len(centre) ** 2)]).reshape(len(centre), -1)
    weights = np.linalg.lstsq(gram[:-1, :-1], gram[:-1, -1], rcond=1e-12)[0]
    return weights.tolist(), centre[-1] - float(weights @ centre[:-1])


def fit_linear_regression(train: DataFrame, series: Sequence[str] = ()) -> Model:
    """Least squares on nine numbers and one-hot weekday and month.

    Several series are fitted as one pooled model with the series one-hot, never one fit per
    series.  Rows with a missing number are not fitted on, and their prediction is NULL.
    """
    design = _design(train.dropna(subset=[*NUMERIC_FEATURES, "order_count"]))
    encoding = Pipeline(stages=_encoding(series)).fit(design)
    features_as_array = vector_to_array("_features").alias("_features")
    weights, constant = least_squares(encoding.transform(design).select(features_as_array, "_target"))
    drop = _DESIGN_COLUMNS + [f"{c}_{part}" for c in series for part in ("index", "flags")] + ["_weights"]

    def predict(features: DataFrame) -> DataFrame:
        coded = encoding.transform(_design(features)).withColumn("_features", vector_to_array("_features"))
        weighted = coded.withColumn("_weights", F.lit(weights).cast("array<double>"))
        products = "zip_with(_features, _weights, (x, w) -> x * w)"
        sums = F.expr(f"aggregate({products}, double({constant!r}), (a, x) -> a + x)")
        return weighted.withColumn("prediction", F.nullif(sums, F.lit(float("nan")))).drop(*drop)

    return predict


def fit_random_forest(
    train: DataFrame, series: Sequence[str] = (), trees: int = 200, seed: int = 42, depth: int = 10, features: str = "auto"
) -> Model:
    """Same inputs; the trees differ from other libraries' for the same seed.

    ``depth`` may be up to 30, the deepest Spark allows, and ``features="all"`` tries every feature at each split, as
    unlimited trees would; on a few thousand days with 200 trees that took minutes, so the defaults are shallower.
    """
    estimator = RandomForestRegressor(
        featuresCol="_features", labelCol="_target", predictionCol="prediction", numTrees=trees, seed=seed, maxDepth=depth,
        featureSubsetStrategy=features,
    )
    return _fit(estimator, train, series)


FITTERS: dict[str, Callable[..., Model]] = {
    NAIVE: lambda train, series=(): previous_week_model,
    MOVING_AVERAGE: lambda train, series=(): moving_average_model,
    LINEAR: fit_linear_regression,
    FOREST: fit_random_forest,
}


def fit_models(train: DataFrame, series: Sequence[str] = (), names: Sequence[str] | None = None) -> dict[str, Model]:
    return {name: FITTERS[name](train, series) for name in names or FITTERS}


# --- X8 --------------------------------------------------------------------------------------


def stacked_predictions(models: dict[str, Model], test: DataFrame) -> DataFrame:
    """Every model's predictions for the test rows, one row per model and day."""
    merged = None
    for name, model in models.items():
        part = model(test).withColumn("model", F.lit(name))
        merged = part if merged is None else merged.unionByName(part)
    return merged


def score_models(models: dict[str, Model], test: DataFrame) -> DataFrame:
    """One row of scores per model, from one aggregate over the stacked predictions."""
    return aggregate(stacked_predictions(models, test), ["model"], *score_columns())


def best_model(scores: DataFrame) -> str:
    """Name of the model with the lowest MAE; ties by name.  Fetches one row."""
    return scores.orderBy(F.col("mae").asc_nulls_last(), "model").select("model").first()[0]


# --- X9 --------------------------------------------------------------------------------------


def forecast(
    daily: DataFrame,
    future: DataFrame,
    model: Model,
    series: Sequence[str] = (),
    days: int = FORECAST_DAYS,
) -> DataFrame:
    """Predictions for the days after the history, each feeding the next day's lags.

    ``future`` holds the coming calendar rows (per series, if any).  The loop is over the horizon
    only; each step predicts its day for all series at once.  A step needs just the last seven
    days of each series, and the frame is written between steps to keep the plan short.
    """
    keys = [*series, "business_date"]
    recent = (
        daily.selectExpr(
            *series,
            *CONTEXT_COLUMNS,
            "double(order_count) as order_count",
            f"row_number() {_over(series, 'business_date desc')} as _age",
        )
        .where("_age <= 7")
        .selectExpr(*series, *CONTEXT_COLUMNS, "order_count", "0 as _step")
    )
    pending = future.selectExpr(
        *series, *CONTEXT_COLUMNS, "cast(null as double) as order_count", f"row_number() {_over(series)} as _step"
    ).where(f"_step <= {days}")
    known = settle(recent.unionByName(pending), "forecast-step")
    for step in range(1, days + 1):
        today = known.where(f"_step = {step}").selectExpr(*keys)
        candidate = feature_frame(known.where(f"_step <= {step}"), series).join(today, keys, "left_semi")
        predicted = model(candidate).selectExpr(*keys, "prediction as _predicted")
        known = (
            known.join(predicted, keys, "left")
            .selectExpr(*keys, *CONTEXT_COLUMNS[1:], "coalesce(order_count, _predicted) as order_count", "_step")
        )
        known = settle(known, "forecast-step")
    return known.where("_step > 0").selectExpr(*keys, "day_name", "order_count as predicted_orders")


# --- X10 -------------------------------------------------------------------------------------


def staffing_benchmarks(labour: DataFrame, shifts: DataFrame) -> DataFrame:
    """Orders per hour on Balanced slots (median) and mean worked shift length, as one row.

    The labour mart has one row per slot of the calendar, which bounds the median's buffer.
    """
    rates = aggregate(
        labour.where("staffing_level_flag = 'Balanced'"),
        [],
        "median(orders_per_kitchen_labour_hour) as _kitchen_rate",
        "median(orders_per_front_of_house_labour_hour) as _front_rate",
    )
    lengths = {"_kitchen_length": "Kitchen", "_front_length": "Front of House"}
    worked = shifts.where("not is_absent")
    return rates.withColumns(
        {
            name: aggregate(worked.where(F.col("department") == department), [], mean("actual_hours")).scalar()
            for name, department in lengths.items()
        }
    )


def recommend_staffing(predictions: DataFrame, labour: DataFrame, shifts: DataFrame) -> DataFrame:
    """Labour hours and headcount per department for each predicted day."""
    benchmark = staffing_benchmarks(labour, shifts).selectExpr("struct(*)").scalar()
    hours = predictions.withColumn("_b", benchmark).selectExpr(
        "*",
        f"{divided('predicted_orders', '_b._kitchen_rate')} as kitchen_hours",
        f"{divided('predicted_orders', '_b._front_rate')} as front_of_house_hours",
    )
    return hours.selectExpr(
        *predictions.columns,
        "kitchen_hours",
        "front_of_house_hours",
        f"ceil({divided('kitchen_hours', '_b._kitchen_length')}) as kitchen_headcount",
        f"ceil({divided('front_of_house_hours', '_b._front_length')}) as front_of_house_headcount",
    )
