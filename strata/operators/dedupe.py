"""Deterministic key dedupe (DED-1, decision D5).

One row survives per key; NULL key parts form one group, as in
``dropDuplicates``. Unlike ``dropDuplicates`` the survivor is fixed: the
smallest payload in struct order, or - when ``newest`` columns are given - the
row with the greatest ``newest`` values (ties broken by the greatest payload).

Plan shape: partial aggregate on the map side, one hash exchange on the keys,
final aggregate. A key holding a third of all rows is reduced to one row per
map task before the exchange, so hot keys do not pile into one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PICK = "__survivor"


def dedupe_by(df: DataFrame, keys: Sequence[str], newest: Sequence[str] = (),
              gather: Sequence[str] = ()) -> DataFrame:
    """Keep one row per ``keys``; output keeps the input's column order.

    ``gather`` names columns of which the survivor keeps the distinct non-null
    values of all rows of its key, as an array (few by their meaning, e.g. the
    folders that a key came from). They don't take part in the choice."""
    keys = list(keys)
    missing = [k for k in [*keys, *newest, *gather] if k not in df.columns]
    if missing:
        raise ValueError(f"dedupe columns not in frame: {missing}")
    payload = [c for c in df.columns if c not in keys and c not in gather]
    if not payload and not gather:
        return df.select(*keys).distinct()
    if newest:
        ordered = list(newest) + [c for c in payload if c not in newest]
        pick = F.max(F.struct(*[F.col(c) for c in ordered]))
    else:
        pick = F.min(F.struct(*[F.col(c) for c in payload]))
    sets = [F.collect_set(c).alias(c) for c in gather]
    grouped = df.groupBy(*keys).agg(pick.alias(_PICK), *sets)
    return grouped.select(*[F.col(c) if c in keys or c in gather else F.col(f"{_PICK}.{c}").alias(c)
                            for c in df.columns])
