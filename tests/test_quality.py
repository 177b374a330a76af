"""DQ-1..9: one verdict row per (document, rule)."""

import pytest

from strata.operators.quality import (
    Rule,
    ValidationFailed,
    assert_passed,
    standard_rules,
    summarize,
    verdicts,
)
from tests.conftest import docs_frame


def _verdict(spark, text, path, mode, expected):
    rows = verdicts(docs_frame(spark, [text]), [Rule(expected, path, mode)]).collect()
    assert len(rows) == 1
    return rows[0]


LIST = "[" + ",".join(str(i) for i in range(7)) + "]"


@pytest.mark.parametrize("text,path,mode,expected,actual", [
    ('{"n":-3}', "n", "value", -3, -3),
    ('{"n":9007199254740993}', "n", "value", 9007199254740993, 9007199254740993),
    ('{"a":{"b":{"c":%s}}}' % LIST, "a.b.c", "count", 7, 7),
    ('{"a":[]}', "a", "count", 0, 0),
    ('{"a":%s}' % LIST, "a", "gte", 7, 7),
    ('{"a":8}', "a", "gte", 7, 8),
    ('{"a":[{}, null]}', "a", "\tCount ", 2, 2),
    ('{"x y":{"":5}}', "x y.", "value", 5, 5),
])
def test_passing_cases(spark, text, path, mode, expected, actual):
    r = _verdict(spark, text, path, mode, expected)
    assert (r.status, r.error_class, r.actual) == ("PASS", None, actual)


@pytest.mark.parametrize("text,path,mode,expected,error", [
    ('{"a":%s}' % LIST, "a", "value", 7, "TYPE_MISMATCH"),
    ('{"a":[]}', "a", "value", 0, "TYPE_MISMATCH"),
    ('{"a":{}}', "a", "gte", 0, "TYPE_MISMATCH"),
    ('{"a":{"b":1}}', "a", "value", 1, "TYPE_MISMATCH"),
    ('{"a":"7"}', "a", "gte", 1, "TYPE_MISMATCH"),
    ('{"a":false}', "a", "value", 0, "TYPE_MISMATCH"),
    ('{"a":%s}' % LIST, "a", "gte", 8, "BELOW_MINIMUM"),
    ('{"a":%s}' % LIST, "a", "count", 8, "COUNT_MISMATCH"),
    ('{"a":%s}' % LIST, "a", "length", 7, "BAD_MODE"),
    ('{"total_records":24.0}', "total_records", "value", 24, "TYPE_MISMATCH"),
    ('{"total_records":1e2}', "total_records", "value", 100, "TYPE_MISMATCH"),
    ('{"total_records":123456789012345678901}', "total_records", "value", 1, "TYPE_MISMATCH"),
    ('{"total_records":null}', "total_records", "value", 1, "TYPE_MISMATCH"),
    ('{"h":{"t":null}}', "h.t", "count", 1, "TYPE_MISMATCH"),
    ('{"h":{"t":true}}', "h.t", "count", 1, "TYPE_MISMATCH"),
    ('{"h":3}', "h.t", "count", 1, "NOT_OBJECT"),
    ('{"h":[1]}', "h.t", "count", 1, "NOT_OBJECT"),
    ('{"h":null}', "h.t", "count", 1, "NOT_OBJECT"),
    ('[1]', "h.t", "count", 1, "NOT_OBJECT"),
    ('{}', "h.t", "count", 1, "MISSING_FIELD"),
    ('{"h":{}}', "h.t", "sum", 1, "MISSING_FIELD"),
    ('{"total_records": 2}', "", "value", 2, "EMPTY_PATH"),
    ('{', "total_records", "value", 1, "MALFORMED_JSON"),
    ('{"a":1,"a":2}', "a", "value", 1, "MALFORMED_JSON"),
    ('{"a":NaN}', "a", "value", 1, "MALFORMED_JSON"),
])
def test_failing_cases(spark, text, path, mode, expected, error):
    r = _verdict(spark, text, path, mode, expected)
    assert (r.status, r.error_class) == ("FAIL", error)


def test_rule_defaults_and_expected_must_be_int():
    r = Rule(" 24 ")
    assert (r.field_path, r.mode, r.expected) == ("total_records", "value", 24)
    with pytest.raises(ValueError):
        Rule("many")


def test_rules_apply_per_source_and_gate(spark):
    docs = docs_frame(spark, ['{"records":[1,2]}'], source="traffic").unionByName(
        docs_frame(spark, ['{"states":[]}'], source="flights"))
    v = verdicts(docs, standard_rules({"traffic": 2}))
    got = sorted((r.source, r.field_path, r.status) for r in v.collect())
    assert got == [("flights", "states", "FAIL"), ("traffic", "records", "PASS")]
    assert summarize(v).count() == 2
    with pytest.raises(ValidationFailed, match="BELOW_MINIMUM"):
        assert_passed(v)
    assert_passed(v.where("status = 'PASS'"))


def test_holidays_have_a_rule_only_where_one_is_given(spark):
    assert {r.source for r in standard_rules()} == {"traffic", "weather", "flights"}
    docs = docs_frame(spark, ['{"total_records":1,"holidays":[{}]}'], source="holidays")
    assert verdicts(docs, standard_rules()).count() == 0
    assert verdicts(docs, standard_rules({"holidays": 1})).first().status == "PASS"


def test_snapshot_day_check(spark):
    import datetime as dt
    from strata.operators.quality import snapshot_day_check
    df = spark.createDataFrame([(dt.date(2026, 4, 22), 1776859200), (dt.date(2026, 4, 22), 1776945600)],
                               "event_date date, snapshot_time long")
    r = snapshot_day_check(df).first()
    assert (r.states, r.off_day_states, r.status) == (2, 1, "FAIL")
