"""Payload validation job: every document under a path against one rule.

    python -m strata.validate --INPUT_PATH s3://raw/traffic/year=2026/month=04/day=22 \
        --EXPECTED_RECORDS 24 --VALIDATION_FIELD_PATH records --VALIDATION_MODE count

Settings come from ``--KEY value`` pairs or the environment (CLI first):
``INPUT_PATH`` (or ``BUCKET`` + ``OBJECT_KEY``), ``EXPECTED_RECORDS`` (must be
an integer), ``VALIDATION_FIELD_PATH`` (default ``total_records``),
``VALIDATION_MODE`` (default ``value``), ``RAW_FORMAT`` (default
``document``). Writes the verdict summary as JSON lines and exits 1 when any
document fails (DQ-9), 0 otherwise.
"""

from __future__ import annotations

import json
import os
import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import functions as F

from strata.jobs import parse_cli_pairs
from strata.operators.quality import Rule, ValidationFailed, assert_passed, summarize, verdicts
from strata.sources.paths import Location
from strata.sources.raw import read_documents_text


def settings(argv: Sequence[str], env: Mapping[str, str] | None = None) -> dict[str, str]:
    env = os.environ if env is None else env
    cli = parse_cli_pairs(argv)

    def pick(name: str, default: str = "") -> str:
        return cli.get(name) or env.get(name) or default

    path = pick("INPUT_PATH")
    if not path:
        bucket, key = pick("BUCKET"), pick("OBJECT_KEY")
        if not bucket or not key:
            raise ValueError("INPUT_PATH, or BUCKET and OBJECT_KEY, are required")
        path = Location(bucket) / key
    expected = pick("EXPECTED_RECORDS")
    if not expected:
        raise ValueError("EXPECTED_RECORDS is required")
    return {"path": path, "expected": expected,
            "field_path": pick("VALIDATION_FIELD_PATH", "total_records"),
            "mode": pick("VALIDATION_MODE", "value"),
            "raw_format": pick("RAW_FORMAT", "document")}


def main(argv: Sequence[str] | None = None, env: Mapping[str, str] | None = None) -> int:
    from strata.session import get_session

    s = settings(list(argv) if argv is not None else sys.argv, env)
    rule = Rule(s["expected"], s["field_path"], s["mode"])
    spark = get_session(app_name="validate-payloads")
    docs = read_documents_text(spark, s["path"], s["raw_format"]).withColumn("source", F.lit(None))
    result = verdicts(docs, [rule], id_col="path")
    counts = [r.asDict() for r in summarize(result).collect()]
    for row in counts:
        print(json.dumps(row))
    if any(row["status"] != "PASS" for row in counts):
        try:
            assert_passed(result)  # reads again, up to the first failures, to name them
        except ValidationFailed as failure:
            print(json.dumps({"status": "FAIL", "detail": str(failure)}))
        return 1
    print(json.dumps({"status": "PASS"}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
