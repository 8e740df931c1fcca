"""Columns that are computed once per row, however the user filters on them.

Catalyst pushes a filter on a computed column below the projection that computes it and copies the
expression into the filter, once per reference.  ``UNPIVOT`` with a single entry plans as an Expand
of one row per row: filters on its value columns stay above it, filters on all other columns pass
below it (down to the scan's partition filters), and unused value columns are pruned.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame


def computed_once(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """``df`` with the columns in ``names`` (old -> new) behind such an Expand."""
    if not names:
        return df
    quoted = lambda cols: ", ".join("`" + c.replace("`", "``") + "`" for c in cols)
    new, old = quoted(names.values()), quoted(names)
    if len(names) > 1:
        new, old = f"({new})", f"({old})"
    # {{df}}: filled in by spark.sql, which names the DataFrame for the time of the analysis.
    query = f"SELECT * FROM {{df}} UNPIVOT INCLUDE NULLS ({_literal(new)} FOR `__cef_entry` IN ({_literal(old)} AS `x`))"
    return df.sparkSession.sql(query, df=df).drop("__cef_entry")


def _literal(text: str) -> str:
    """Braces in column names are not fields of the query."""
    return text.replace("{", "{{").replace("}", "}}")
