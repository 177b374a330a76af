"""Payload validation on VARIANT (DQ-1..9).

One verdict row per (document, rule), instead of stopping at the first bad
document. A rule is (field path, mode, expected):

* ``value`` - the field must be an integer (not a boolean or a float); it
  must equal ``expected``.
* ``count`` - the field must be a list; its length must equal ``expected``.
* ``gte``   - a list's length, else an integer; must be >= ``expected``.

Every failure is a ``FAIL`` with an ``error_class``, checked in this order:
MALFORMED_JSON, EMPTY_PATH, then per path segment NOT_OBJECT / MISSING_FIELD,
BAD_MODE, TYPE_MISMATCH, COUNT_MISMATCH (value, count) or BELOW_MINIMUM (gte).
A JSON ``null`` leaf resolves (it is present) and then fails the type check.

The rule list is small and fixed per run, so each rule becomes one column
expression built on the driver; the document is parsed once and all rules are
evaluated in the same projection - no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.casts import array_length
from strata.operators.explode import explode_column

MALFORMED_JSON = "MALFORMED_JSON"
EMPTY_PATH = "EMPTY_PATH"
NOT_OBJECT = "NOT_OBJECT"
MISSING_FIELD = "MISSING_FIELD"
BAD_MODE = "BAD_MODE"
TYPE_MISMATCH = "TYPE_MISMATCH"
COUNT_MISMATCH = "COUNT_MISMATCH"
BELOW_MINIMUM = "BELOW_MINIMUM"

MODES = ("value", "count", "gte")
INTEGER_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT")
VERDICT_COLUMNS = ("source", "document", "field_path", "mode", "expected", "actual", "status",
                   "error_class")


@dataclass(frozen=True)
class Rule:
    """DQ-7: defaults are path ``total_records`` and mode ``value``; the
    expected value must parse as an integer. ``source`` limits the rule to
    documents of one source (None: every document)."""

    expected: int
    field_path: str = "total_records"
    mode: str = "value"
    source: str | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "expected", int(str(self.expected).strip()))


# Expected values of the standard rules when none are given: 24 hourly
# records per traffic or weather document, at least one flight state. How many
# holidays a day has depends on the country and the day, so there is no default.
STANDARD_EXPECTED = {"traffic": 24, "weather": 24, "flights": 1}


def standard_rules(expected: dict[str, int] | None = None) -> list[Rule]:
    """DQ-8: the standard rule of every registered source - traffic counts
    ``records``, weather counts ``hourly.time``, flights needs at least
    ``expected`` ``states``, holidays checks the ``total_records`` value and has
    a rule only where ``expected`` names it."""
    from strata.specs import SOURCES

    e = {**STANDARD_EXPECTED, **(expected or {})}
    return [Rule(e[name], spec.rule_path, spec.rule_mode, name) for name, spec in SOURCES.items() if name in e]


def _path(segments: Sequence[str]) -> str:
    quoted = "".join('["' + s.replace("\\", "\\\\").replace('"', '\\"') + '"]' for s in segments)
    return "$" + quoted


def _segments(rule: Rule) -> tuple[str, ...]:
    return tuple(rule.field_path.split(".")) if rule.field_path else ()


class _Facts:
    """Column names of the per-document facts the rules read.

    Every distinct path prefix is extracted once (``prefix``) and tested once
    for being an object (``object``); the list length and integer value of a
    leaf are derived once, for the leaves whose rules ask for them (``length``,
    ``integer``). The rules then only compare columns."""

    def __init__(self, rules: Sequence[Rule]):
        prefixes: set[tuple[str, ...]] = set()
        parents: set[tuple[str, ...]] = set()
        counted: set[tuple[str, ...]] = set()
        valued: set[tuple[str, ...]] = set()
        for r in rules:
            segs, mode = _segments(r), r.mode.strip().lower()
            parents.update(segs[:i] for i in range(len(segs)))
            for i in range(1, len(segs) + 1):
                prefixes.add(segs[:i])
            if segs and mode in ("count", "gte"):
                counted.add(segs)
            if segs and mode in ("value", "gte"):
                valued.add(segs)
        self.prefix = {p: f"__p{i}" for i, p in enumerate(sorted(prefixes))}
        self.prefix[()] = "__v"
        self.object = {p: f"__o{i}" for i, p in enumerate(sorted(parents))}
        self.length = {p: f"__n{i}" for i, p in enumerate(sorted(counted))}
        self.integer = {p: f"__i{i}" for i, p in enumerate(sorted(valued))}

    def extract(self, parsed: DataFrame) -> DataFrame:
        v = F.col("__v")
        values = [F.try_variant_get(v, _path(p), "variant").alias(name)
                  for p, name in self.prefix.items() if p]
        with_values = parsed.select("*", *values)
        objects = [_is_object(F.col(self.prefix[p])).alias(name) for p, name in self.object.items()]
        lengths = [array_length(F.try_variant_get(F.col(self.prefix[p]), "$", "array<variant>")).cast("long").alias(name)
                   for p, name in self.length.items()]
        ints = []
        for p, name in self.integer.items():
            leaf = F.col(self.prefix[p])
            # Only scalars are typed: objects and lists with elements are ruled out
            # first (And short-circuits), so schema_of_variant never walks a large value.
            scalar = ~_is_object(leaf) & F.try_variant_get(leaf, "$[0]", "variant").isNull()
            is_int = F.schema_of_variant(leaf).isin(*INTEGER_TYPES)
            ints.append(F.when(scalar & is_int, F.try_variant_get(leaf, "$", "bigint")).alias(name))
        return with_values.select("*", *objects, *lengths, *ints)


def _is_object(v: Column) -> Column:
    # Casting to an empty struct succeeds exactly for objects and reads no
    # field, unlike schema_of_variant which walks the whole value.
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def _check(rule: Rule, facts: _Facts) -> Column:
    """The verdict of one rule as a struct column over the extracted facts."""
    mode = rule.mode.strip().lower()
    segments = _segments(rule)
    err = F.when(F.col("__v").isNull(), F.lit(MALFORMED_JSON))
    actual = F.lit(None).cast("long")
    if not segments:
        err = err.when(F.lit(True), F.lit(EMPTY_PATH))
    else:
        for i in range(len(segments)):
            err = err.when(~F.col(facts.object[segments[:i]]), F.lit(NOT_OBJECT))
            err = err.when(F.col(facts.prefix[segments[: i + 1]]).isNull(), F.lit(MISSING_FIELD))
        if mode not in MODES:
            err = err.when(F.lit(True), F.lit(BAD_MODE))
        else:
            if mode == "value":
                actual = F.col(facts.integer[segments])
            elif mode == "count":
                actual = F.col(facts.length[segments])
            else:
                actual = F.coalesce(F.col(facts.length[segments]), F.col(facts.integer[segments]))
            expected = F.lit(rule.expected).cast("long")
            err = err.when(actual.isNull(), F.lit(TYPE_MISMATCH))
            if mode == "gte":
                err = err.when(actual < expected, F.lit(BELOW_MINIMUM))
            else:
                err = err.when(actual != expected, F.lit(COUNT_MISMATCH))
    # ``actual`` is NULL whenever the path did not resolve or the type was
    # wrong, so it is shown as is.
    return F.struct(
        F.lit(rule.field_path).alias("field_path"),
        F.lit(rule.mode).alias("mode"),
        F.lit(rule.expected).cast("long").alias("expected"),
        actual.cast("long").alias("actual"),
        F.when(err.isNull(), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        err.alias("error_class"),
    )


def verdicts(docs: DataFrame, rules: Iterable[Rule], text_col: str = "document",
             source_col: str = "source", id_col: str = "object_key") -> DataFrame:
    """DQ-1..6: one row per (document, applicable rule) with columns
    ``source, document, field_path, mode, expected, actual, status, error_class``.

    ``docs`` holds the document text (e.g. from ``read_documents_text`` or an
    envelope), its source and an identifier (path or object key). Narrow:
    parse, extract and judge run in the scan's tasks, no shuffle."""
    rules = list(rules)
    if not rules:
        raise ValueError("at least one rule is required")
    parsed = docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("document"),
                         F.try_parse_json(F.col(text_col)).alias("__v"))
    facts = _Facts(rules)
    extracted = facts.extract(parsed)
    # One array of checks per source, chosen by a plain CASE on the source
    # (no higher-order function, so it stays in generated code). Rules without
    # a source belong to every branch; a document no rule applies to gets NULL
    # and therefore no rows.
    everywhere = [r for r in rules if r.source is None]
    applicable = None
    for src in sorted({r.source for r in rules if r.source is not None}):
        checks = F.array(*[_check(r, facts) for r in rules if r.source in (None, src)])
        hit = F.col("source") == F.lit(src)
        applicable = F.when(hit, checks) if applicable is None else applicable.when(hit, checks)
    if everywhere:
        fallback = F.array(*[_check(r, facts) for r in everywhere])
        applicable = fallback if applicable is None else applicable.otherwise(fallback)
    out = explode_column(extracted, applicable, "__c", ("source", "document"))
    return out.select("source", "document", "__c.*")


class ValidationFailed(Exception):
    """Raised by ``assert_passed`` with a sample of failing verdicts."""


def summarize(verdict_rows: DataFrame) -> DataFrame:
    """Verdict counts per (source, field_path, mode, status, error_class)."""
    return verdict_rows.groupBy("source", "field_path", "mode", "status", "error_class").agg(
        F.count(F.lit(1)).alias("documents"))


def assert_passed(verdict_rows: DataFrame, sample: int = 5) -> None:
    """DQ-9: the batch gate. Fails when any verdict failed, naming up to
    ``sample`` failing (document, rule) pairs; the scan stops at the sample."""
    failing = verdict_rows.where(F.col("status") != "PASS").limit(sample).collect()
    if failing:
        lines = [f"{r['document']} {r['field_path']}/{r['mode']}: {r['error_class']} "
                 f"(actual={r['actual']}, expected={r['expected']})" for r in failing]
        raise ValidationFailed("payload validation failed:\n" + "\n".join(lines))


def snapshot_day_check(flights: DataFrame, date_col: str = "event_date",
                       snapshot_col: str = "snapshot_time") -> DataFrame:
    """D11: backfilled flight payloads carry the requested day as
    ``event_date`` while the snapshot is taken "now". Per event date: states,
    states whose snapshot falls on another UTC day, and a status."""
    snap_day = F.date_from_unix_date(F.floor(F.col(snapshot_col) / F.lit(86400)).cast("int"))
    off = (snap_day != F.col(date_col)).cast("int")
    out = flights.groupBy(date_col).agg(F.count(F.lit(1)).alias("states"),
                                        F.sum(off).cast("long").alias("off_day_states"))
    return out.withColumn("status", F.when(F.col("off_day_states") == 0, F.lit("PASS"))
                          .otherwise(F.lit("FAIL")))
