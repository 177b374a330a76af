"""Row generators over payload arrays (EXP-1..3, FLT-2).

All three have ``explode`` semantics: a document whose array is NULL or empty
contributes no rows (FLT-2), a NULL element inside an array is a row. They are
narrow: no shuffle, and column pruning reaches through them into the scan.

They are planned as ``posexplode_outer`` plus a filter on the position. With a
plain ``explode`` the optimizer infers ``size(array) > 0`` and pushes it below
the projection that parses the document, so a ``from_json`` parse runs twice
per document; the outer generator has no inferred filter, and the position
filter sits above the generator where it cannot be pushed down.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _carried(include_cols: Sequence[str]) -> list:
    return [F.col(name) for name in include_cols]


_POS = "__pos"


def explode_column(df: DataFrame, array: Column, alias: str,
                   include_cols: Sequence[str] = ()) -> DataFrame:
    """``explode`` of an array expression, planned so the expression is
    evaluated once per input row (see the module note)."""
    rows = df.select(F.posexplode_outer(array).alias(_POS, alias), *_carried(include_cols))
    return rows.where(F.col(_POS).isNotNull()).drop(_POS)


def explode_array(df: DataFrame, array_col: str, alias: str,
                  include_cols: Sequence[str] = ()) -> DataFrame:
    """EXP-1: one row per element of ``array_col``, element named ``alias``,
    followed by the carried columns."""
    return explode_column(df, F.col(array_col), alias, include_cols)


def explode_struct_array(df: DataFrame, array_col: str, alias: str = "record",
                         include_cols: Sequence[str] = ()) -> DataFrame:
    """EXP-2: EXP-1 over an array of structs, then the struct's fields as
    columns (star expansion, SCL-9); struct fields first, carried columns after."""
    rows = explode_array(df, array_col, alias, include_cols)
    carried = [name.rsplit(".", 1)[-1] for name in include_cols]
    return rows.select(f"{alias}.*", *carried)


def explode_zipped_arrays(df: DataFrame, array_cols: Sequence[str], alias: str = "record",
                          include_cols: Sequence[str] = ()) -> DataFrame:
    """EXP-3 (SCL-8): zip parallel arrays by position and emit one row per position.

    Each zipped field is named after the last path segment (``hourly.time`` ->
    ``time``). Shorter arrays are padded with NULL to the longest; if any of
    the arrays is NULL the document yields no rows.
    """
    named = [F.col(path).alias(path.rsplit(".", 1)[-1]) for path in array_cols]
    rows = explode_column(df, F.arrays_zip(*named), alias, include_cols)
    carried = [name.rsplit(".", 1)[-1] for name in include_cols]
    return rows.select(f"{alias}.*", *carried)
