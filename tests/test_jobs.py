"""API-2, API-3, SRC-2/3, SNK-2/4/5: parameters, registry, locations."""

from datetime import date

import pytest

from strata.jobs import KEYS, JobParams, parse_cli_pairs
from strata.sources.paths import Location, identifier
from strata.specs import SOURCES, get_spec

BASE = {"SOURCE_NAME": "weather", "RAW_BUCKET": "landing", "CURATED_BUCKET": "lake"}


def from_env(**changes):
    return JobParams.from_args(["job"], {k: v for k, v in {**BASE, **changes}.items() if v is not None},
                               today=date(2025, 3, 1))


def test_every_key_reaches_its_field_from_either_side():
    for field, (keys, _) in KEYS.items():
        if field != "source_name":
            assert getattr(from_env(**{keys[0]: "env-value"}), field) == "env-value"
            cli = JobParams.from_args(["job", f"--{keys[0]}", "cli-value"], {**BASE, keys[0]: "env-value"})
            assert getattr(cli, field) == "cli-value"


@pytest.mark.parametrize("key", ["SOURCE_NAME", "SOURCE", "INGEST_SOURCE"])
def test_source_aliases_and_spelling(key):
    assert from_env(**{"SOURCE_NAME": None, key: "  FliGHts "}).source_name == "flights"


def test_defaults():
    p = from_env()
    assert (p.ingest_date, p.end_date) == ("2025-02-28", "2025-02-28")
    assert (p.write_mode, p.database, p.job_name, p.raw_format, p.missing_days) == (
        "overwrite_partitions", "curated", "curate-weather", "document", "error")


def test_an_empty_value_counts_as_absent():
    p = JobParams.from_args(["job", "--RAW_BUCKET", "", "--WRITE_MODE", ""], {**BASE, "WRITE_MODE": "append"})
    assert (p.raw_root, p.write_mode) == ("landing", "append")


def test_one_error_names_all_that_is_lacking():
    with pytest.raises(ValueError) as e:
        JobParams.from_args(["job"], {})
    assert all(k in str(e.value) for k in ("SOURCE_NAME", "INPUT_PATH or RAW_BUCKET", "OUTPUT_PATH or CURATED_BUCKET"))
    with pytest.raises(ValueError, match="CURATED_BUCKET"):
        from_env(CURATED_BUCKET=None)


def test_job_locations():
    p = from_env(INGEST_DATE="2025-01-05")
    assert p.input_location() == "s3://landing/weather/year=2025/month=01/day=05"
    assert p.output_location() == "s3://lake/curated/weather"
    ranged = from_env(INGEST_DATE="2025-01-05", END_DATE="2025-01-09", CURATED_BUCKET="hdfs://nn/lake/")
    assert ranged.input_location() == "s3://landing/weather"
    assert ranged.output_location() == "hdfs://nn/lake/curated/weather"
    own = from_env(RAW_BUCKET=None, INPUT_PATH="/drop/x.json", OUTPUT_PATH="gs://out/w/")
    assert (own.input_location(), own.output_location()) == ("/drop/x.json", "gs://out/w")
    assert own.table == "`curated`.`weather`"


def test_locations_join_and_keep_their_scheme():
    assert Location("/a/b/") / "/c//d/" == "/a/b/c/d"
    assert Location("file:/a") / "" == "file:/a" and Location("/") / "x" == "/x"
    assert Location("plain-bucket") == "s3://plain-bucket" and Location(Location("plain-bucket")) == "s3://plain-bucket"
    assert Location("/z").on(date(987, 6, 5)) == "/z/year=0987/month=06/day=05"
    for bad in ("2025-02-30", "tomorrow"):
        with pytest.raises(ValueError):
            Location("/z").on(bad)
    with pytest.raises(ValueError):
        Location("  ")


def test_identifiers_are_quoted():
    assert identifier("my-db", "t`x", "a.b") == "`my-db`.`t``x`.`a.b`"


def test_cli_pairs_skip_stray_tokens():
    assert parse_cli_pairs(["p", "x", "--A", "1", "--B"]) == {"A": "1"}
    assert parse_cli_pairs(["p", "--A", "--B", "1"]) == {"A": "--B"}
    assert parse_cli_pairs(["p"]) == {}


def test_registry_lookup():
    assert {get_spec(f" {n.upper()}\t").name for n in SOURCES} == set(SOURCES) == {"traffic", "weather", "holidays", "flights"}
    with pytest.raises(ValueError, match="no source is called 'tides'.*flights.*holidays"):
        get_spec("tides")
