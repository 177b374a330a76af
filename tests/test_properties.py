"""Property tests: operators against brute-force Python models on random
small inputs (hypothesis)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.functions.casts import lenient_cast
from strata.operators.dedupe import dedupe_by

SETTINGS = dict(max_examples=25, deadline=None, derandomize=True,
                suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
ints = st.one_of(st.none(), st.integers(min_value=-3, max_value=3))
texts = st.one_of(st.none(), st.sampled_from(["", "x", "y", "heavy rain"]))
rows = st.lists(st.tuples(keys, ints, ints, texts), min_size=1, max_size=30)


def _null_first(v):
    return (0, 0) if v is None else (1, v)


def _null_last_desc(v):
    return (0, 0) if v is None else (1, v)


@settings(**SETTINGS)
@given(rows)
def test_dedupe_matches_smallest_payload_model(spark, data):
    df = spark.createDataFrame(data, "k string, t int, a int, b string")
    got = [tuple(r) for r in dedupe_by(df, ["k", "t"]).collect()]
    best = {}
    for k, t, a, b in data:
        cand = (a, b)
        cur = best.get((k, t))
        if cur is None or tuple(map(_null_first, cand)) < tuple(map(_null_first, cur)):
            best[(k, t)] = cand
    want = [(k, t, a, b) for (k, t), (a, b) in best.items()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@settings(**SETTINGS)
@given(rows)
def test_dedupe_newest_matches_model(spark, data):
    df = spark.createDataFrame(data, "k string, t int, a int, b string")
    got = {(r.k, r.t): (r.a, r.b) for r in dedupe_by(df, ["k"], newest=["a"]).collect()}
    best = {}
    for k, t, a, b in data:
        cand = (a, t, b)   # newest column first, then the payload in column order
        cur = best.get(k)
        if cur is None or tuple(map(_null_last_desc, cand)) > tuple(map(_null_last_desc, cur)):
            best[k] = cand
    assert {(k, t): (a, b) for k, (a, t, b) in best.items()} == got


number_text = st.one_of(
    st.integers(min_value=-5_000_000_000, max_value=5_000_000_000).map(str),
    st.decimals(min_value=-1000, max_value=1000, places=3, allow_nan=False).map(str),
    st.sampled_from(["24.", "1e2", "abc", " 7 ", "+3", "-0.5", ""]),
)


def _model_int(s, bits):
    """Documented semantics: integer text, or plain decimal text truncated
    toward zero; anything else, or out of range, is NULL."""
    t = s.strip()
    lo, hi = -(2 ** (bits - 1)), 2 ** (bits - 1) - 1
    try:
        v = int(t)
    except ValueError:
        body = t[1:] if t[:1] in "+-" else t
        if "." not in body or not body.replace(".", "", 1).isdigit() or body.startswith("."):
            return None
        v = math.trunc(float(t))
    return v if lo <= v <= hi else None


@settings(**SETTINGS)
@given(st.lists(number_text, min_size=1, max_size=40))
def test_lenient_integer_cast_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = df.select(lenient_cast("s", "int").alias("i"), lenient_cast("s", "long").alias("l")).collect()
    for v, r in zip(values, got):
        assert (r.i, r.l) == (_model_int(v, 32), _model_int(v, 64)), v


# -- payload validation against a plain-Python model ---------------------------

import json  # noqa: E402

from strata.operators.quality import Rule, verdicts  # noqa: E402

_keys = st.sampled_from(["a", "b", "t"])
_scalars = st.one_of(st.none(), st.booleans(), st.integers(min_value=-50, max_value=50),
                     st.floats(min_value=-10, max_value=10, allow_nan=False, allow_infinity=False),
                     st.text(alphabet="xy", max_size=2))
_json = st.recursive(_scalars, lambda inner: st.one_of(
    st.lists(inner, max_size=4), st.dictionaries(_keys, inner, max_size=3)), max_leaves=12)
_paths = st.one_of(st.just(""), st.lists(_keys, min_size=1, max_size=3).map(".".join))
_modes = st.sampled_from(["value", "count", "gte", " Count ", "sum"])


def _model_verdict(doc, path, mode, expected):
    """(error_class, actual) by the documented rules, in their order."""
    if not path:
        return "EMPTY_PATH", None
    cur = doc
    for seg in path.split("."):
        if not isinstance(cur, dict):
            return "NOT_OBJECT", None
        if seg not in cur:
            return "MISSING_FIELD", None
        cur = cur[seg]
    m = mode.strip().lower()
    if m not in ("value", "count", "gte"):
        return "BAD_MODE", None
    is_int = isinstance(cur, int) and not isinstance(cur, bool)
    if m == "value":
        actual = cur if is_int else None
    elif m == "count":
        actual = len(cur) if isinstance(cur, list) else None
    else:
        actual = len(cur) if isinstance(cur, list) else (cur if is_int else None)
    if actual is None:
        return "TYPE_MISMATCH", None
    if m == "gte":
        return ("BELOW_MINIMUM" if actual < expected else None), actual
    return ("COUNT_MISMATCH" if actual != expected else None), actual


@settings(**{**SETTINGS, "max_examples": 15})
@given(st.lists(st.tuples(_json, _paths, _modes, st.integers(min_value=0, max_value=3)),
                min_size=1, max_size=20))
def test_verdicts_match_model(spark, cases):
    # one document per case, each rule restricted to its own document's source
    rows = [(f"d{i}", f"d{i}", json.dumps(doc)) for i, (doc, _, _, _) in enumerate(cases)]
    docs = spark.createDataFrame(rows, "source string, object_key string, document string")
    rules = [Rule(expected, path, mode, f"d{i}") for i, (_, path, mode, expected) in enumerate(cases)]
    got = {r.document: r for r in verdicts(docs, rules).collect()}
    assert len(got) == len(cases)
    for i, (doc, path, mode, expected) in enumerate(cases):
        want_err, want_actual = _model_verdict(doc, path, mode, expected)
        r = got[f"d{i}"]
        assert (r.error_class, r.actual) == (want_err, want_actual), (doc, path, mode, expected)
        assert r.status == ("PASS" if want_err is None else "FAIL")
