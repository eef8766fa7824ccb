"""Window operators: latest version, forward fill, rolling mean, implied
rating, keep-last.  Each partitions by a company-level key whose group is
bounded by the calendar (one latest row per company and day), so no group
grows with the number of versions or companies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.clean import nan_to_null
from riskloom.functions.expr import q
from riskloom.functions.rating import rating_grade
from riskloom.schemas import ROLLING_ROWS


def latest_version(df: DataFrame, keys: Sequence[str] = ("data_date", "company_id"),
                   version: str = "operation_time", tiebreak: Sequence[str] | str = ("calibration_date",)) -> DataFrame:
    """One row per key: the highest ``version``.

    The versioned tables declare (key, version) unique, so the version alone
    orders them and only the key, version and downstream columns travel
    through the shuffle (column pruning stays intact).  For inputs that can
    tie, ``tiebreak`` lists extra order columns (descending, where present; by
    default the later calibration wins); ``"all"`` uses every remaining column.

    ``row_number() == 1`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so a key with very many versions is cut down map-side."""
    keys = list(keys)
    if tiebreak == "all":
        rest = [c for c in df.columns if c not in keys + [version]]
    else:
        rest = [c for c in tiebreak if c != version and c in df.columns]
    order = ", ".join(f"{q(c)} DESC NULLS LAST" for c in [version] + rest)
    rn = F.expr(f"row_number() OVER (PARTITION BY {', '.join(q(k) for k in keys)} ORDER BY {order})")
    return df.withColumn("_rn", rn).where("_rn = 1").drop("_rn")


def forward_fill_rating(df: DataFrame, rating: str = "PDIR", out: str = "pdir_filled",
                        partition: Sequence[str] = ("company_id",), order: str = "data_date") -> DataFrame:
    """``COALESCE(NULLIF(r,0), last non-zero r of the earlier rows, 0)`` per company."""
    r = F.when(F.col(rating) != 0, F.col(rating))
    w = (Window.partitionBy(*partition).orderBy(order)
         .rowsBetween(Window.unboundedPreceding, -1))
    prev = F.last(r, ignorenulls=True).over(w)
    return df.withColumn(out, F.coalesce(r, prev, F.lit(0.0)))


def rolling_mean(df: DataFrame, value: str = "PD_12", out: str = "pd12_mean10",
                 rows: int = ROLLING_ROWS, partition: Sequence[str] = ("company_id",),
                 order: str = "data_date") -> DataFrame:
    """Mean over the current and ``rows-1`` previous rows (rows, not days);
    missing values (NULL or NaN) are skipped; at least one row."""
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(-(rows - 1), 0)
    return df.withColumn(out, F.avg(nan_to_null(value)).over(w))


def implied_rating(df: DataFrame, value: str = "PD_12", out: str = "pdir_implied",
                   partition: Sequence[str] = ("company_id",), order: str = "data_date") -> DataFrame:
    """Rolling 10-row mean of PD_12 graded with the 22 thresholds."""
    tmp = "_mean_for_grade"
    res = rolling_mean(df, value, tmp, partition=partition, order=order)
    return res.withColumn(out, rating_grade(tmp)).drop(tmp)


def keep_last(df: DataFrame, keys: Sequence[str] = ("company_id", "data_date"),
              order: str = "current_trading_date",
              tiebreak: Sequence[str] | str = ("operation_time",)) -> DataFrame:
    """Of each key keep the row that sorts last by ``order``; ties (two
    deliveries of one trading day) are broken by ``tiebreak`` so reruns give
    the same row."""
    return latest_version(df, keys, order, tiebreak)


def asof_forward(left: DataFrame, right: DataFrame, values: Sequence[str], left_date: str = "data_date", right_date: str = "data_start_date",
                 keys: Sequence[str] = ()) -> DataFrame:
    """Sorted forward as-of lookup: each row of ``left`` with the ``values`` of the
    first row of ``right`` (of its ``keys``) dated on or after it, NULL if there
    is none.  Union and one window, no pair explosion.  Of right rows on one
    date the smallest values count.  Without ``keys`` both sides must be
    calendar-sized (distinct dates), as one task orders them."""
    keys, values, cols = list(keys), list(values), left.columns
    first = right.where(F.col(right_date).isNotNull()).groupBy(*keys, F.col(right_date).alias("_date")).agg(F.min(F.struct(*values)).alias("_value"))
    events = first.select(*keys, "_date", F.lit(1).alias("_tag"), "_value", F.lit(None).cast(left.schema).alias("_row"))
    asked = left.select(*keys, F.col(left_date).alias("_date"), F.lit(0).alias("_tag"), F.lit(None).cast(first.schema["_value"].dataType).alias("_value"),
                        F.struct(*[F.col(q(c)) for c in cols]).alias("_row"))
    ahead = Window.partitionBy(*keys).orderBy(F.col("_date").asc_nulls_last(), "_tag").rowsBetween(0, Window.unboundedFollowing)
    found = asked.unionByName(events).withColumn("_next", F.first("_value", ignorenulls=True).over(ahead))
    next_value = F.when(F.col("_date").isNotNull(), F.col("_next"))
    return (found.where("_tag = 0").withColumn("_next", next_value)
            .select(*[F.col(f"_row.{q(c)}").alias(c) for c in cols], *[F.col(f"_next.{q(v)}").alias(v) for v in values]))
