"""PD-implied rating grade as a plain CASE expression (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.schemas import RATING_DEFAULT, RATING_LEVELS, RATING_THRESHOLDS


def rating_grade(value: Column | str, round_dp: int | None = None) -> Column:
    """Grade 22..1 of a mean PD: the level of the first (largest) threshold
    the value reaches; a missing value counts as 0.0, a value below every
    threshold gets the default grade.

    The value is graded exactly, as the reference does; ``round_dp`` can
    round it first when two engines' means may differ in the last bit.
    """
    if isinstance(value, str):
        return F.expr(rating_grade_sql("`" + value + "`", round_dp, spark_sql=True))
    v = F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(0.0))
    if round_dp is not None:
        v = F.round(v, round_dp)
    expr = None
    for t, lvl in zip(RATING_THRESHOLDS, RATING_LEVELS):
        cond = v >= F.lit(float(t))
        expr = F.when(cond, F.lit(lvl)) if expr is None else expr.when(cond, F.lit(lvl))
    return expr.otherwise(F.lit(RATING_DEFAULT))


def rating_grade_sql(value_sql: str, round_dp: int | None = None, spark_sql: bool = False) -> str:
    """The same rule as SQL text (Spark SQL, or DuckDB for the oracle)."""
    nan_free = f"CASE WHEN isnan({value_sql}) THEN NULL ELSE {value_sql} END"
    v = f"coalesce({nan_free}, {'0.0D' if spark_sql else '0.0'})"
    if round_dp is not None:
        v = f"round({v}, {round_dp})"
    lit = (lambda t: f"{float(t)!r}D") if spark_sql else (lambda t: repr(t))
    whens = " ".join(f"WHEN {v} >= {lit(t)} THEN {lvl}" for t, lvl in zip(RATING_THRESHOLDS, RATING_LEVELS))
    return f"(CASE {whens} ELSE {RATING_DEFAULT} END)"
