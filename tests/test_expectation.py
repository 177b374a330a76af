"""GEN-1..13: the hourly traffic model as column expressions."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata.operators import expectation as ex


def _eval(spark, expr, ts, cond="sunny", temp=22.0, hol=False):
    df = spark.createDataFrame([(ts, cond, temp, hol)],
                               "ts timestamp_ntz, c string, t double, h boolean")
    return df.select(expr.alias("x")).first().x


def test_factor_helpers(spark):
    ts = dt.datetime(2026, 4, 20, 12)  # a Monday
    assert _eval(spark, ex.hourly_base("ts"), ts) == 1200
    assert _eval(spark, F.lit(100.0) * ex.weekday_factor("ts"), ts) == 70
    assert _eval(spark, F.lit(100.0) * ex.month_factor("ts"), dt.datetime(2026, 12, 1)) == 140
    assert _eval(spark, ex.weather_adjusted(F.lit(100.0), F.lit("heavy rain"), F.lit(20)), ts) == 70
    assert _eval(spark, ex.weather_adjusted(F.lit(100.0), F.lit("sunny"), F.lit(36)), ts) == 80
    assert _eval(spark, ex.weather_adjusted(F.lit(100.0), F.lit("sunny"), F.lit(35)), ts) == 100


def test_holiday_factor(spark):
    adj = ex.holiday_adjusted(F.lit(100.0), "h", "ts")
    assert _eval(spark, adj, dt.datetime(2026, 1, 1), hol=True) == 20
    assert _eval(spark, adj, dt.datetime(2026, 12, 25), hol=False) == 20
    assert _eval(spark, adj, dt.datetime(2026, 4, 22), hol=True) == 140
    assert _eval(spark, adj, dt.datetime(2026, 4, 22), hol=False) == 100


def test_whole_model_matches_plain_arithmetic(spark):
    e = ex.expected_visitors("ts", "c", "t", "h")
    assert _eval(spark, e, dt.datetime(2026, 4, 22, 12)) == int(1200 * 0.8 * 0.85)
    # every month and weekday against the plain formula
    hb = [50, 30, 20, 15, 15, 20, 50, 150, 400, 700, 900, 1100, 1200, 1100, 950, 850, 900, 1100,
          1200, 1000, 700, 400, 150, 80]
    wk = [0.7, 0.75, 0.8, 0.85, 1.1, 1.5, 1.3]
    mo = [0.6, 0.65, 0.8, 0.85, 0.9, 0.85, 0.7, 0.65, 0.85, 0.9, 1.1, 1.4]
    rows = []
    for m in range(1, 13):
        for d in (1, 11, 25):
            for h in (0, 9, 18):
                for cond, temp, hol in (("heavy rain", 10.0, True), ("sunny", 36.5, False)):
                    rows.append((dt.datetime(2025, m, d, h), cond, temp, hol))
    df = spark.createDataFrame(rows, "ts timestamp_ntz, c string, t double, h boolean")
    lo, hi = ex.noise_band("ts", "c", "t", "h")
    got = df.select("ts", "c", "t", "h", e.alias("e"), lo.alias("lo"), hi.alias("hi")).collect()
    for r in got:
        b = hb[r.ts.hour] * wk[r.ts.weekday()] * mo[r.ts.month - 1]
        b = b - b * 0.3 if r.c == "heavy rain" else (b - b * 0.2 if r.t > 35 else b)
        b = b * 0.2 if (r.ts.month, r.ts.day) in ((12, 25), (1, 1)) else (b * 1.4 if r.h else b)
        assert (r.e, r.lo, r.hi) == (int(b), int(b - b * 0.15), int(b + b * 0.15))


def test_day_label_and_defaults(spark):
    assert _eval(spark, ex.day_label("ts"), dt.datetime(2026, 4, 22, 10)) == "wednesday"
    df = spark.createDataFrame([(None, None, None)], "weather_condition string, temperature_c double, "
                                                     "is_holiday boolean")
    r = ex.with_defaults(df).first()
    assert (r.weather_condition, r.temperature_c, r.is_holiday) == ("sunny", 22.0, False)


def test_spine_sizes_hours_and_reversed_range(spark):
    ranges = spark.createDataFrame([("EUR_MAD_001", "2026-04-22", "2026-04-22"),
                                    ("EUR_MAD_002", "2026-04-22", "2026-04-23")],
                                   "center_id string, from_date string, to_date string")
    spine = ex.hourly_spine(ranges)
    counts = {r.center_id: r["count"] for r in spine.groupBy("center_id").count().collect()}
    assert counts == {"EUR_MAD_001": 24, "EUR_MAD_002": 48}
    hours = sorted(r.hour for r in spine.where("center_id = 'EUR_MAD_001'").collect())
    assert hours == list(range(24))
    bad = spark.createDataFrame([("X", "2026-04-23", "2026-04-22")],
                                "center_id string, from_date string, to_date string")
    with pytest.raises(PySparkException):
        ex.hourly_spine(bad).collect()
    with pytest.raises(ValueError):
        ex.check_range("2026-04-23", "2026-04-22")
    ex.check_range("2026-04-22", "2026-04-22")


def test_spine_is_zone_proof_on_dst_day(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        ranges = spark.createDataFrame([("M", "2026-03-29", "2026-03-29")],
                                       "center_id string, from_date string, to_date string")
        assert ex.hourly_spine(ranges).count() == 24
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_missing_hours(spark):
    ranges = spark.createDataFrame([("A", "2026-04-22", "2026-04-22")],
                                   "center_id string, from_date string, to_date string")
    seen = spark.createDataFrame([("A", dt.datetime(2026, 4, 22, 5)), ("A", dt.datetime(2026, 4, 22, 7)),
                                  ("A", dt.datetime(2026, 4, 22, 9, 30))],
                                 "center_id string, event_timestamp timestamp")
    gaps = ex.missing_hours(ranges, seen)
    hours = sorted(r.hour for r in gaps.collect())
    assert len(hours) == 22 and 5 not in hours and 9 in hours   # 09:30 is not the 09:00 hour
    attached = ex.attach_observed(ranges, seen.withColumn("v", F.hour("event_timestamp")), ("v",))
    got = {r.hour: r.v for r in attached.collect()}
    assert len(got) == 24 and got[5] == 5 and got[7] == 7 and got[9] is None
