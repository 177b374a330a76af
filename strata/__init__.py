"""strata: raw JSON payloads to typed, deduplicated, date-partitioned tables on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
built-ins; nothing in the data path runs Python per row.
"""

__version__ = "0.1.0"
