"""EXP-1..3, FLT-2: row generators over payload arrays."""

from strata.operators.explode import explode_array, explode_struct_array, explode_zipped_arrays
from strata.schemas import TRAFFIC_RAW, WEATHER_RAW
from strata.sources.raw import parse_documents
from tests.conftest import docs_frame


def test_explode_array_null_empty_missing_yield_nothing(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, None), (3, [])], "k int, a array<int>")
    out = explode_array(df, "a", "x", include_cols=("k",))
    assert out.columns == ["x", "k"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1), (2, 1)]


def test_explode_struct_array_fields_then_carried(spark):
    docs = docs_frame(spark, ['{"records":[{"center_id":"A","timestamp":"t"}],"total_records":1}',
                              '{"records":[]}', '{"records":null}', '{"other":1}'])
    raw = parse_documents(docs, TRAFFIC_RAW)
    out = explode_struct_array(raw, "records", include_cols=("total_records",))
    assert out.columns[:2] == ["center_id", "timestamp"] and out.columns[-1] == "total_records"
    assert out.count() == 1


def test_zip_pads_short_arrays_and_null_array_drops_document(spark):
    docs = docs_frame(spark, [
        '{"latitude":1,"hourly":{"time":["a","b","c"],"temperature_2m":[1,2],'
        '"precipitation":[0,0,0],"windspeed_10m":[5,5,5],"weathercode":[1,2,3]}}',
        '{"latitude":2,"hourly":{"time":["x"],"temperature_2m":null,'
        '"precipitation":[0],"windspeed_10m":[5],"weathercode":[1]}}',
    ])
    raw = parse_documents(docs, WEATHER_RAW)
    out = explode_zipped_arrays(raw, ("hourly.time", "hourly.temperature_2m"),
                                include_cols=("latitude",))
    assert out.columns == ["time", "temperature_2m", "latitude"]
    rows = sorted((r.time, r.temperature_2m) for r in out.collect())
    assert rows == [("a", "1"), ("b", "2"), ("c", None)]
