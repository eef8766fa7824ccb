"""SQL-expression helpers for wide projections.

A 60-horizon projection built column by column costs thousands of
driver <-> JVM calls; the same projection as SQL expression strings is
one ``selectExpr`` call.  The resulting plans are identical."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def q(name: str) -> str:
    """Back-quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def select_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df.select(*names)`` in one call."""
    return df.selectExpr(*[q(n) for n in names])
