"""Bounds on the raw date column keep the rows that bounds on its month keep."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from cotejo.functions.arrays import spread, spread_structs
from cotejo.functions.dates import month_start
from cotejo.operators import filters, quality, refresh
from cotejo.sources import snapshot_store as store


def days(spark, seed, kind):
    rng = random.Random(seed)
    start = datetime.date(2023, 1, 1)
    rows = [(i, start + datetime.timedelta(days=rng.randrange(500)), rng.choice("abcd")) for i in range(300)] + [(999, None, "a")]
    df = spark.createDataFrame(rows, "i int, day date, k string")
    if kind != "date":
        df = df.withColumn("day", (F.col("day").cast("timestamp") + F.expr("interval 13 hours")).cast(kind))
    return df.withColumn("Date", month_start("day")).withColumn("month", F.date_format("day", "yyyy-MM"))


def ids(df):
    return sorted(r.i for r in df.select("i").collect())


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_bounds_on_days_and_on_months_agree(spark, kind):
    df = days(spark, 1, kind)
    assert ids(filters.last_n_months(df, "day", 4)) == ids(filters.last_n_periods(df, "Date", 4))
    for n in (1, 3, 40):
        assert ids(store.nth_newest(df, n, "month", raw="day")) == ids(store.nth_newest(df, n, "month"))
        assert ids(store.keep_newest(df, n, "month", raw="day")) == ids(store.keep_newest(df, n, "month"))
    by_day = quality.period_membership(df, ["k", "i"], "day", days=True)
    by_month = quality.period_membership(df, ["k", "i"], "Date")
    assert sorted(map(tuple, by_day.collect())) == sorted(map(tuple, by_month.collect()))
    some = datetime.date(2023, 9, 1)
    given = [quality.period_membership(df, ["k", "i"], c, current=F.lit(some), days=c == "day") for c in ("day", "Date")]
    assert sorted(map(tuple, given[0].collect())) == sorted(map(tuple, given[1].collect()))


@pytest.mark.parametrize("first", ["2023-07-01", "2023-07-17", "2022-01-01", "2030-01-01"])
def test_refresh_bounds(spark, first):
    df = days(spark, 2, "date")
    latest = spark.createDataFrame([(-1, datetime.date.fromisoformat(first))], "i int, Date date")
    plain = refresh.window_refresh(df.select("i", "Date"), latest, "Date")
    raw = refresh.window_refresh(df.select("i", "Date", "day"), latest, "Date", raw="day")
    assert raw.columns == plain.columns and sorted(map(str, raw.collect())) == sorted(map(str, plain.collect()))


def test_rows_out_of_arrays_and_maps(spark):
    df = spark.sql(
        "select * from values (1, array('a', null, 'c'), map('x', 1), array(named_struct('p', 1, 'q', null))), "
        "(2, cast(array() as array<string>), map(), array(named_struct('p', null, 'q', 'z'))), (3, null, null, null) as t(i, a, m, s)"
    )
    assert sorted(map(tuple, spread(df, ["i"], "a", "v", position="n").collect())) == [(1, 0, "a"), (1, 1, None), (1, 2, "c")]
    assert [tuple(r) for r in spread(df, ["i"], "m", "k", "v").collect()] == [(1, "x", 1)]
    assert sorted(map(str, map(tuple, spread_structs(df, ["i"], "s").collect()))) == ["(1, 1, None)", "(2, None, 'z')"]
