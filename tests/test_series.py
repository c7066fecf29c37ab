import math
from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cotejo.operators import reshape, series

SCHEMA = "s string, Date date, Value double"


def data():
    rng = np.random.default_rng(5)
    months = pd.date_range("2020-01-01", periods=30, freq="MS")
    rows = []
    for name, take in (("full", months), ("early", months[:20]), ("gaps", months[::3]), ("last", months[-1:]), ("two", months[-2:])):
        for m in take:
            for _ in range(rng.integers(1, 3)):
                rows.append((name, m.date(), float(rng.integers(0, 1000)) / 4))
    return rows


def dense_by_pandas(rows):
    frame = pd.DataFrame(rows, columns=["s", "Date", "Value"])
    frame["Date"] = pd.to_datetime(frame["Date"])
    last = frame["Date"].max()
    out = {}
    for name, part in frame.groupby("s"):
        index = pd.date_range(part["Date"].min(), last, freq="MS")
        out[name] = part.groupby("Date")["Value"].sum().reindex(index, fill_value=0.0)
    return out


def test_densify_extends_every_series_to_the_last_month(spark):
    rows = data()
    got = reshape.densify_months(spark.createDataFrame(rows, SCHEMA), ["s"], "Date", "Value").toPandas()
    expected = dense_by_pandas(rows)
    assert len(got) == sum(len(v) for v in expected.values())
    for name, part in got.groupby("s"):
        part = part.sort_values("Date")
        assert list(part["Value"]) == list(expected[name])
        assert list(pd.to_datetime(part["Date"])) == list(expected[name].index)


def predict(y, targets):
    """Line over the positions and mean residual of the calendar month, by numpy."""
    t = np.arange(len(y))
    slope, level = (np.polyfit(t, y, 1) if len(y) > 1 else (0.0, y[0]))
    residual = y - level - slope * t
    out = []
    for target in targets:
        same = residual[(target - t) % 12 == 0]
        out.append(level + slope * target + (same.mean() if len(same) else 0.0))
    return out


def test_forecast_equals_numpy(spark):
    rows = data()
    got = series.forecast(spark.createDataFrame(rows, SCHEMA), ["s"]).toPandas()
    for name, dense in dense_by_pandas(rows).items():
        part = got[got["s"] == name].sort_values("Date")
        n = len(dense)
        assert len(part) == n + 3
        y = dense.to_numpy()
        assert list(part["Value"][:n]) == list(y) and part["Value"][n:].isna().all()
        assert part["Prediction"][: n - 1].isna().all()
        holdout = part["Prediction"].iloc[n - 1]
        if n == 1:
            assert math.isnan(holdout) and not part["isOutlier"].any()
        else:
            assert holdout == math.ceil(round(predict(y[:-1], [n - 1])[0], 6))
            assert part["isOutlier"].iloc[n - 1] == (holdout > 1.1 * y[-1] or holdout < 0.9 * y[-1])
        assert np.allclose(part["Prediction"][n:], predict(y, [n, n + 1, n + 2]))
        assert not part["isOutlier"][n:].any()


def test_stale_series_has_value_zero_and_is_flagged(spark):
    got = series.forecast(spark.createDataFrame(data(), SCHEMA), ["s"])
    row = got.filter("s = 'early' AND Value IS NOT NULL").orderBy(F.desc("Date")).first()
    assert row["Value"] == 0.0 and row["isOutlier"] == (row["Prediction"] > 0 or row["Prediction"] < 0)


def test_no_join_no_window(spark):
    plan = series.forecast(spark.createDataFrame(data(), SCHEMA), ["s"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


@pytest.mark.parametrize("value,prediction,expected", [
    (10.0, 11.0, False), (10.0, 11.01, True), (10.0, 8.9, True), (10.0, 9.0, False), (0.0, 1.0, True),
    (0.0, 0.0, False), (None, 1.0, False), (1.0, None, False),
])
def test_outlier_rule(spark, value, prediction, expected):
    df = spark.createDataFrame([(value, prediction)], "v double, p double")
    assert df.select(series.outlier("v", "p")).first()[0] is expected


def test_model_of_the_caller(spark):
    rows = data()

    def mean_model(train, target):
        return pd.Series([train["value"].mean()] * len(target))

    got = series.forecast_with(spark.createDataFrame(rows, SCHEMA), ["s"], mean_model).toPandas()
    for name, dense in dense_by_pandas(rows).items():
        part = got[got["s"] == name].sort_values("Date")
        n, y = len(dense), dense.to_numpy()
        assert len(part) == n + 3
        assert np.allclose(part["Prediction"].iloc[n:], y.mean())
        if n > 1:
            assert part["Prediction"].iloc[n - 1] == math.ceil(y[:-1].mean())


def test_series_of(spark):
    assert series.series_of(spark.createDataFrame(data(), SCHEMA), ["s"]).count() == 5
