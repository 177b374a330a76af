"""SCL-1..5 and decisions D1 / D3: lenient casts of JSON leaves."""

from pyspark.sql import functions as F

from strata.functions.casts import lenient_cast, parse_date, parse_timestamp, slot, trimmed_text


def _one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_integer_spellings(spark):
    rows = [("24.0",), ("24",), ("123.7",), ("3000000000",), (" 7 ",), ("1e2",), ("abc",), (None,),
            ("-5.9",), ("24.",)]
    df = spark.createDataFrame(rows, "s string").select(
        lenient_cast("s", "int").alias("i"), lenient_cast("s", "long").alias("l"))
    got = [(r.i, r.l) for r in df.collect()]
    assert got == [(24, 24), (24, 24), (123, 123), (None, 3000000000), (7, 7), (None, None),
                   (None, None), (None, None), (-5, -5), (24, 24)]


def test_double_and_boolean_spellings(spark):
    df = spark.createDataFrame([("3.5",), ("1e2",), ("true",), ("1",), ("no",), ("x",)], "s string")
    got = df.select(lenient_cast("s", "double").alias("d"),
                    lenient_cast("s", "boolean").alias("b")).collect()
    assert [r.d for r in got] == [3.5, 100.0, None, 1.0, None, None]
    assert [r.b for r in got] == [None, None, True, True, False, None]


def test_numeric_input_is_accepted(spark):
    assert _one(spark, lenient_cast("x", "int"), 24.0, "x double") == 24
    assert _one(spark, lenient_cast("x", "string"), 5, "x int") == "5"


def test_timestamp_and_date_text(spark):
    import datetime as dt
    assert _one(spark, parse_timestamp("s"), "2026-04-22T10:00:00") == dt.datetime(2026, 4, 22, 10)
    assert _one(spark, parse_timestamp("s"), "2026-04-22T10:00") == dt.datetime(2026, 4, 22, 10)
    assert _one(spark, parse_timestamp("s"), "not a time") is None
    assert _one(spark, parse_date("s"), "2026-04-22T23:30:00") == dt.date(2026, 4, 22)
    assert _one(spark, parse_date("s"), "2026-13-45") is None


def test_trim_blank_is_empty_not_null(spark):
    assert _one(spark, trimmed_text("s"), "    ") == ""
    assert _one(spark, trimmed_text("s"), "  IB123 ") == "IB123"
    assert _one(spark, trimmed_text("s"), None) is None


def test_slot_out_of_range_is_null(spark):
    df = spark.createDataFrame([(["a", "b"],)], "a array<string>")
    r = df.select(slot("a", 1).alias("x"), slot("a", 16).alias("y")).first()
    assert (r.x, r.y) == ("b", None)


def test_ansi_stays_on_and_nothing_throws(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("999999999999999999999",)], "s string")
    assert df.select(lenient_cast("s", "long").alias("x")).first().x is None
    assert df.select(F.lit(1)).count() == 1
