"""Schema drift of landed documents against the declared raw schemas (SRC-5).

The readers declare every schema, so a field that a source adds, drops or sends in
another shape goes unseen. Here the documents' own schema is merged for each source
and day (``schema_of_variant_agg``, which Spark combines before the shuffle) and
compared, path by path, with the declared one.

Kinds of a path: ``object``, ``list`` or ``scalar``; a declared text leaf takes any
scalar, as its lenient casts do, and a strictly typed leaf its own type only. A
field that was null in every document has no kind and is neither missing nor
retyped; one with several kinds is retyped.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from strata.schemas import CORRUPT_COL
from strata.session import ship

NEW, RETYPED, VANISHED = "NEW", "RETYPED", "VANISHED"
TOKEN = re.compile(r"`(?:[^`]|``)*`|[^\s<>,:()]+(?:\([^)]*\))?|[<>,:]")
# Types that a variant schema names for a strictly declared leaf.
STRICT = {"boolean": ("BOOLEAN",), "integer": ("BIGINT",)}


def declared_paths(schema: StructType) -> dict[str, str]:
    """Dotted path -> kind, lists marked by ``[]``; a strict leaf is its type's name."""
    out: dict[str, str] = {}

    def walk(t: DataType, path: str) -> None:
        if isinstance(t, StructType):
            if path:
                out[path] = "object"
            for f in t.fields:
                if f.name != CORRUPT_COL:
                    walk(f.dataType, f"{path}.{f.name}" if path else f.name)
        elif isinstance(t, ArrayType):
            out[path] = "list"
            walk(t.elementType, path + "[]")
        else:
            out[path] = "scalar" if isinstance(t, StringType) else t.typeName()

    walk(schema, "")
    return out


def observed_paths(text: str) -> dict[str, str]:
    """The same of a variant schema such as ``OBJECT<a: ARRAY<BIGINT>>``; scalars
    keep their type's name. ``VOID`` is null alone, ``VARIANT`` several kinds."""
    tokens = TOKEN.findall(text)
    out: dict[str, str] = {}

    def walk(i: int, path: str) -> int:
        name = tokens[i].upper()
        if name == "OBJECT" or name == "ARRAY":
            if path:
                out[path] = "object" if name == "OBJECT" else "list"
            if i + 1 >= len(tokens) or tokens[i + 1] != "<":
                return i + 1
            i += 2
            while tokens[i] != ">":
                if name == "OBJECT":
                    field = tokens[i][1:-1].replace("``", "`") if tokens[i].startswith("`") else tokens[i]
                    i = walk(i + 2, f"{path}.{field}" if path else field)
                else:
                    i = walk(i, path + "[]")
                if tokens[i] == ",":
                    i += 1
            return i + 1
        if path:
            out[path] = name
        return i + 1

    walk(0, "")
    return out


def compared(declared: dict[str, str], observed: dict[str, str]) -> list[tuple[str, str, str | None, str | None]]:
    """(drift, path, declared, observed) of every path that differs. Below a path
    that is new, vanished, null or retyped nothing more is reported."""
    out, closed = [], []
    below = lambda p: any(p.startswith(c) and p[len(c):len(c) + 1] in (".", "[") for c in closed)
    for path in sorted({*declared, *observed}):
        if below(path):
            continue
        want, got = declared.get(path), observed.get(path)
        if want is None:
            if path.endswith("[]") and declared.get(path[:-2]) == "scalar":
                continue
            out.append((NEW, path, None, got))
            closed.append(path)
        elif got is None:
            if not path.endswith("[]"):  # an empty list has no elements to show
                out.append((VANISHED, path, want, None))
            closed.append(path)
        elif got == "VOID":
            closed.append(path)
        elif want in ("object", "list"):
            if got != want:
                out.append((RETYPED, path, want, got))
                closed.append(path)
        elif got in ("object", "list", "VARIANT") or want != "scalar" and not got.startswith(STRICT.get(want, (want.upper(),))):
            if not (want == "scalar" and got == "VARIANT"):
                out.append((RETYPED, path, want, got))
            closed.append(path)
    return out


def schema_drift(docs: DataFrame, schemas: dict[str, StructType], source_col: str = "source",
                 day_col: str = "ingest_date", text_col: str = "document") -> DataFrame:
    """(source, day, drift, path, declared, observed, documents): what the
    documents of a source and day have otherwise than declared. Documents that
    don't parse, and sources without a declared schema, are left to validation."""
    ship(docs.sparkSession)
    declared = {name: declared_paths(s) for name, s in schemas.items()}
    parsed = docs.select(F.col(source_col).alias("source"), F.col(day_col).cast("string").alias("day"),
                         F.try_parse_json(F.col(text_col)).alias("v")).where(F.col("v").isNotNull())
    found = parsed.where(F.col("source").isin(*declared)).groupBy("source", "day").agg(
        F.schema_of_variant_agg("v").alias("observed"), F.count(F.lit(1)).alias("documents"))

    def compare(frames):
        for frame in frames:
            rows = [(r.source, r.day, *d, r.documents) for r in frame.itertuples()
                    for d in compared(declared[r.source], observed_paths(r.observed))]
            yield pd.DataFrame(rows, columns=["source", "day", "drift", "path", "declared", "observed", "documents"])

    return found.mapInPandas(compare, "source string, day string, drift string, path string, declared string, "
                                      "observed string, documents long")
