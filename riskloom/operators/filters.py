"""Row filters and calendar generators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.schemas import FILL_LOOKBACK_DAYS


def _lit(v):
    return v if isinstance(v, Column) else F.lit(v)


def filter_any_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with any missing (NULL or NaN) value in ``subset``."""
    return df.na.drop("any", subset=list(subset))


def filter_missing_value(df: DataFrame, c: str) -> DataFrame:
    return df.where(F.col(c).isNotNull() & ~F.isnan(F.col(c)))


def filter_lookback(df: DataFrame, as_of, days: int = FILL_LOOKBACK_DAYS,
                    date_col: str = "data_date") -> DataFrame:
    """``date_col >= as_of - days``; on a date-partitioned table this prunes."""
    return df.where(F.col(date_col) >= F.date_sub(_lit(as_of), days))


def filter_either_date(df: DataFrame, since, start: str = "start_date", end: str = "end_date") -> DataFrame:
    s = _lit(since)
    return df.where((F.col(start) >= s) | (F.col(end) >= s))


def trading_calendar(spark: SparkSession, start, end, name: str = "data_date") -> DataFrame:
    """Weekdays (Mon-Fri) in ``[start, end]``, one row each."""
    return (spark.range(1)
            .select(F.explode(F.sequence(_lit(start).cast("date"), _lit(end).cast("date"))).alias(name))
            .where(F.weekday(name) < 5))


def filter_ids_semi(df: DataFrame, ids: DataFrame, key: str = "company_id") -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_semi")


def filter_day(df: DataFrame, day, date_col: str = "data_date") -> DataFrame:
    return df.where(F.col(date_col) == _lit(day))


def latest_n_dates(df: DataFrame, n: int = 2, date_col: str = "data_date") -> DataFrame:
    """Rows whose date is one of the ``n`` latest distinct dates.  The date
    list is a top-n of distinct dates (tiny), joined back with a semi join."""
    top = df.select(date_col).distinct().orderBy(F.col(date_col).desc()).limit(n)
    return df.join(top, date_col, "left_semi")

