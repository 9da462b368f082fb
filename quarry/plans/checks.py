"""Physical-plan checks used by tests and when tuning a query.

These read the executed plan's text (``explain`` output), the same view a
user gets from ``df.explain()``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

FORBIDDEN_JOINS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    """The physical plan as printed by ``df.explain(mode)``."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def operators(df: DataFrame) -> list[str]:
    """Physical operator names, top-down."""
    return re.findall(r"[+-]\s*(\*?\(?\d*\)?\s*[A-Za-z]+)", plan_text(df))


def pair_products(df: DataFrame) -> list[str]:
    """Joins that form every pair of their inputs (none should appear)."""
    txt = plan_text(df)
    return [j for j in FORBIDDEN_JOINS if j in txt]


def exchanges(df: DataFrame) -> int:
    """Number of shuffle exchanges (broadcasts not counted)."""
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)",
                          plan_text(df)))
