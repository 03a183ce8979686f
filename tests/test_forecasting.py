"""Features, split, scores, models, recursion and staffing on hand-built frames."""

from datetime import date, timedelta

import numpy as np
import pytest

from tallyhouse.operators import forecasting as fc

SCHEMA = (
    "business_date date, day_name string, is_weekend boolean, is_public_holiday boolean, is_city_event boolean, "
    "promotion_name string, temperature_c double, rain_mm double, order_count int"
)


def _rows(days: int, start=date(2026, 1, 1), count=lambda i: 100 + 5 * i):
    rows = []
    for i in range(days):
        day = start + timedelta(days=i)
        promotion = None if i % 2 == 0 else "Test Promo"
        rows.append((day, day.strftime("%A"), day.weekday() >= 5, False, False, promotion, 20.0 + i % 5, float(i % 3), count(i)))
    return rows


@pytest.fixture(scope="module")
def daily(spark):
    return spark.createDataFrame(_rows(21), SCHEMA)


def test_features_drop_the_first_week_and_do_not_leak(daily):
    rows = fc.feature_frame(daily).orderBy("business_date").collect()
    assert len(rows) == 14
    first = rows[0]
    assert first.business_date == date(2026, 1, 8)
    assert (first.previous_day_orders, first.previous_week_orders) == (130, 100)
    assert first.rolling_7day_avg == pytest.approx(sum(100 + 5 * i for i in range(7)) / 7)
    assert [r.has_promotion for r in rows] == [i % 2 == 1 for i in range(7, 21)]


def test_split_is_chronological(daily):
    features = fc.feature_frame(daily)
    train, test = fc.chronological_split(features, test_days=5)
    assert (train.count(), test.count()) == (9, 5)
    assert train.agg({"business_date": "max"}).first()[0] < test.agg({"business_date": "min"}).first()[0]
    with pytest.raises(ValueError, match="test_days"):
        fc.chronological_split(features, test_days=14)


def test_scores_by_hand(spark):
    frame = spark.createDataFrame([(100, 90.0), (110, 110.0), (90, 100.0)], "order_count int, prediction double")
    row = frame.selectExpr(*fc.score_columns()).first()
    assert row.mae == pytest.approx(20 / 3)
    assert row.rmse == pytest.approx(np.sqrt(200 / 3))
    assert row.mape == pytest.approx((10 / 100 + 10 / 90) / 3 * 100)


def _matrix(rows, days, months):
    columns = [[float(r[c]) for c in fc.NUMERIC_FEATURES] for r in rows]
    flags = [[float(r.day_name == d) for d in days] + [float(r.month == m) for m in months] for r in rows]
    return np.hstack([np.array(columns), np.array(flags)])


def test_linear_regression_equals_least_squares(spark):
    rng = np.random.default_rng(3)
    noisy = spark.createDataFrame(_rows(120, count=lambda i: int(100 + 20 * (i % 7 > 4) + rng.normal(0, 6))), SCHEMA)
    train, test = fc.chronological_split(fc.feature_frame(noisy).cache(), test_days=20)
    train_rows, test_rows = train.orderBy("business_date").collect(), test.orderBy("business_date").collect()
    days, months = sorted({r.day_name for r in train_rows}), sorted({r.month for r in train_rows})
    x, y = _matrix(train_rows, days, months), np.array([float(r.order_count) for r in train_rows])
    weights, *_ = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=None)
    wanted = (_matrix(train_rows, days, months) - x.mean(0)) @ weights + y.mean()
    model = fc.fit_linear_regression(train)
    got = [r.prediction for r in model(train).orderBy("business_date").collect()]
    assert got == pytest.approx(list(wanted), abs=1e-6)
    assert model(test).where("prediction is null").count() == 0 and len(test_rows) == 20


def test_least_squares_takes_the_shortest_of_equal_solutions(spark):
    rows = [([float(i), float(i), 1.0], 4.0 * i + 3.0) for i in range(7)]
    frame = spark.createDataFrame(rows, "_features array<double>, _target double")
    weights, constant = fc.least_squares(frame.repartition(3))
    assert weights == pytest.approx([2.0, 2.0, 0.0]) and constant == pytest.approx(3.0)
    assert fc.least_squares(frame.limit(0)) == ([], 0.0)
    assert fc.least_squares(frame.limit(1))[0] == pytest.approx([0.0, 0.0, 0.0])


def test_a_row_with_a_missing_number_is_kept_with_a_null_prediction(spark, daily):
    features = fc.feature_frame(daily)
    model = fc.fit_linear_regression(features)
    holed = features.selectExpr(
        *[f"if(business_date = date '2026-01-10', null, {c}) as {c}" if c == "rain_mm" else c for c in features.columns]
    )
    rows = {r.business_date: r.prediction for r in model(holed).collect()}
    assert len(rows) == 14 and rows[date(2026, 1, 10)] is None and rows[date(2026, 1, 11)] is not None


def test_every_model_gets_one_score_row(daily):
    train, test = fc.chronological_split(fc.feature_frame(daily).cache(), test_days=5)
    models = {n: fc.FITTERS[n](train) for n in (fc.NAIVE, fc.MOVING_AVERAGE, fc.LINEAR)}
    models[fc.FOREST] = fc.fit_random_forest(train, trees=5)
    scores = fc.score_models(models, test).collect()
    assert {s.model for s in scores} == set(fc.FITTERS) and all(s.mae >= 0 and s.rmse >= s.mae - 1e-9 for s in scores)


@pytest.fixture(scope="module")
def future(spark):
    return spark.createDataFrame(_rows(7, start=date(2026, 1, 22)), SCHEMA).drop("order_count")


def test_naive_forecast_is_the_week_before(daily, future):
    got = fc.forecast(daily, future, fc.previous_week_model).orderBy("business_date").collect()
    assert [r.business_date for r in got] == [date(2026, 1, 22) + timedelta(days=i) for i in range(7)]
    assert [r.predicted_orders for r in got] == [100 + 5 * i for i in range(14, 21)]


def test_forecast_feeds_on_its_own_predictions(daily, future):
    def yesterday(features):
        return features.selectExpr("*", "previous_day_orders as prediction")

    got = fc.forecast(daily, future, yesterday, days=3).collect()
    assert [r.predicted_orders for r in got] == [200.0] * 3


def test_series_are_forecast_apart(spark, daily, future):
    two = daily.selectExpr("'a' as s", "*").unionByName(daily.selectExpr("'b' as s", "* except (order_count)", "10 as order_count"))
    coming = future.selectExpr("explode(array('a', 'b')) as s", "*")
    got = fc.forecast(two, coming, fc.moving_average_model, ["s"]).where("s = 'b'").collect()
    assert len(got) == 7 and all(r.predicted_orders == 10 for r in got)


def test_staffing_by_hand(spark):
    labour = spark.createDataFrame(
        [("Balanced", 2.0, 5.0), ("Balanced", 4.0, 5.0), ("Overstaffed", 100.0, 100.0)],
        "staffing_level_flag string, orders_per_kitchen_labour_hour double, orders_per_front_of_house_labour_hour double",
    )
    shifts = spark.createDataFrame(
        [("Kitchen", 5.0, False), ("Kitchen", 0.0, True), ("Front of House", 5.0, False)],
        "department string, actual_hours double, is_absent boolean",
    )
    row = fc.recommend_staffing(spark.createDataFrame([(90.0,)], "predicted_orders double"), labour, shifts).first()
    assert (row.kitchen_hours, row.kitchen_headcount) == (30.0, 6)
    assert (row.front_of_house_hours, row.front_of_house_headcount) == (18.0, 4)
