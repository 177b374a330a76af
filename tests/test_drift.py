"""SRC-5: drift of documents against the declared schemas."""

import json

import pytest

from strata import schemas
from strata.operators.drift import compared, declared_paths, observed_paths, schema_drift


def test_paths_of_both_sides():
    d = declared_paths(schemas.HOLIDAYS_RAW)
    assert d["holidays"] == "list" and d["holidays[]"] == "object" and d["holidays[].launchYear"] == "integer"
    assert d["holidays[].types[]"] == "scalar" and "_corrupt_record" not in d
    o = observed_paths("OBJECT<a: ARRAY<OBJECT<`x y`: DECIMAL(3,1), z: ARRAY<VOID>>>, b: OBJECT<>, c: STRING>")
    assert o == {"a": "list", "a[]": "object", "a[].x y": "DECIMAL(3,1)", "a[].z": "list", "a[].z[]": "VOID", "b": "object",
                 "c": "STRING"}


@pytest.mark.parametrize("observed,expected", [
    ({"r": "list", "r[]": "object", "r[].v": "BIGINT", "n": "BIGINT"}, []),
    ({"r": "list", "r[]": "VOID", "n": "VOID"}, []),
    ({"r": "list", "n": "DOUBLE"}, []),
    ({"n": "BIGINT"}, [("VANISHED", "r", "list", None)]),
    ({"r": "object", "r.x": "STRING", "n": "STRING"}, [("RETYPED", "r", "list", "object")]),
    ({"r": "list", "r[]": "object", "r[].v": "list", "r[].v[]": "BIGINT", "n": "STRING", "m": "object", "m.k": "STRING"},
     [("NEW", "m", None, "object"), ("RETYPED", "r[].v", "scalar", "list")]),
])
def test_comparison(observed, expected):
    declared = {"r": "list", "r[]": "object", "r[].v": "scalar", "n": "scalar"}
    assert sorted(compared(declared, observed)) == sorted(expected)


def test_drift_of_a_source_and_day(spark):
    good = {"records": [{k: "1" for k in schemas.TRAFFIC_RECORD.fieldNames()}], "total_records": 1}
    rows = [("traffic", "2026-04-01", json.dumps(good)),
            ("traffic", "2026-04-02", json.dumps({**good, "note": [1]})), ("traffic", "2026-04-02", json.dumps(good)),
            ("traffic", "2026-04-03", json.dumps({"records": [{**good["records"][0], "visitors_count": {"n": 1}}]})),
            ("traffic", "2026-04-03", "{broken"), ("tides", "2026-04-03", "{}"), ("traffic", "2026-04-04", None)]
    df = spark.createDataFrame(rows, "source string, ingest_date string, document string")
    got = sorted((r.day, r.drift, r.path, r.documents)
                 for r in schema_drift(df, {"traffic": schemas.TRAFFIC_RAW}).collect())
    assert got == [("2026-04-02", "NEW", "note", 2), ("2026-04-03", "RETYPED", "records[].visitors_count", 1),
                   ("2026-04-03", "VANISHED", "total_records", 1)]
    assert schema_drift(df.limit(0), {"traffic": schemas.TRAFFIC_RAW}).collect() == []
