"""Source specifications and the registry (API-1, API-2).

A ``SourceSpec`` bundles what a curation job needs to know about one source:
its raw schema, its curator, its dedupe keys and its partition columns. It is
plain data; curators compose with ``DataFrame.transform``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from strata import schemas
from strata.operators import curators
from strata.operators.partitions import EVENT_DATE_COL, PARTITION_COLS


@dataclass(frozen=True)
class SourceSpec:
    name: str
    raw_schema: StructType
    curate: Callable[[DataFrame], DataFrame]
    project: Callable[..., DataFrame]
    keys: tuple[str, ...]
    newest: tuple[str, ...] = ()
    partition_cols: tuple[str, ...] = PARTITION_COLS
    event_date_col: str = EVENT_DATE_COL
    # Field path and mode of the standard payload rule (DQ-8).
    rule_path: str = "total_records"
    rule_mode: str = "value"


SOURCES: dict[str, SourceSpec] = {
    spec.name: spec
    for spec in (
        SourceSpec("traffic", schemas.TRAFFIC_RAW, curators.curate_traffic,
                   curators.project_traffic, curators.TRAFFIC_KEYS,
                   rule_path="records", rule_mode="count"),
        SourceSpec("weather", schemas.WEATHER_RAW, curators.curate_weather,
                   curators.project_weather, curators.WEATHER_KEYS,
                   rule_path="hourly.time", rule_mode="count"),
        SourceSpec("holidays", schemas.HOLIDAYS_RAW, curators.curate_holidays,
                   curators.project_holidays, curators.HOLIDAYS_KEYS,
                   newest=curators.HOLIDAYS_NEWEST),
        SourceSpec("flights", schemas.FLIGHTS_RAW, curators.curate_flights,
                   curators.project_flights, curators.FLIGHTS_KEYS,
                   newest=curators.FLIGHTS_NEWEST, rule_path="states", rule_mode="gte"),
    )
}


def get_spec(source_name: str) -> SourceSpec:
    """API-2: the spec of a source, whatever the case and the blanks around its
    name (SCL-10)."""
    spec = SOURCES.get(source_name.strip().lower())
    if spec is None:
        raise ValueError(f"no source is called {source_name!r}; there are {sorted(SOURCES)}")
    return spec
