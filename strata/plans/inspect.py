"""Physical-plan checks used by tests and by plan reviews."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as ``df.explain(mode)`` prints it."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def count_nodes(df: DataFrame, node: str) -> int:
    """Occurrences of a physical operator in the (initial) physical plan tree."""
    tree = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(rf"\b{re.escape(node)}\b", tree))


def exchanges(df: DataFrame) -> int:
    """Shuffle exchanges (broadcast exchanges are not counted)."""
    tree = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|"
                          r"SinglePartition|rebalance)", tree, flags=re.IGNORECASE))


def python_nodes(df: DataFrame) -> list[str]:
    """Python evaluation nodes present in the plan (should be empty)."""
    text = plan_text(df, "simple")
    return [n for n in PYTHON_NODES if n in text]
