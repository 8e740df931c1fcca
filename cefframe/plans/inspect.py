"""Plan inspection helpers used by tests and the benchmark."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def optimized_plan(df: DataFrame) -> str:
    """Text of the optimized logical plan."""
    return df._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001


def physical_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


def count_calls(plan_text: str, function: str) -> int:
    return len(re.findall(re.escape(function) + r"\(", plan_text))
