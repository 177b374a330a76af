"""Column-level helpers (SCL-*) and the fixed value tables of the traffic model."""

from strata.functions.casts import (
    array_length,
    lenient_cast,
    parse_date,
    parse_timestamp,
    slot,
    trimmed_text,
)

__all__ = ["array_length", "lenient_cast", "parse_date", "parse_timestamp", "slot", "trimmed_text"]
