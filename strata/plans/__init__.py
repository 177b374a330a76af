"""Query plans over the driver's tables: payload builders, registered queries,
their DuckDB oracles, and plan inspection helpers."""
