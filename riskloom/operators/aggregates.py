"""Aggregations and data-quality checks.  All are single-pass aggregates
with partial (map-side) combining; none gathers rows on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.expr import q
from riskloom.schemas import ACTION_REVISION


def revision_span(df: DataFrame,
                  keys: Sequence[str] = ("econ_id", "company_id", "calibration_date", "operation_time"),
                  action: str = ACTION_REVISION) -> DataFrame:
    """Per load key: first and last data_date touched, tagged with an action."""
    return (df.groupBy(*keys)
            .agg(F.min("data_date").alias("data_start_date"), F.max("data_date").alias("data_end_date"))
            .select("data_start_date", "data_end_date", *keys, F.lit(action).alias("operation_action")))


def dates_per_company(df: DataFrame, key: str = "company_id", date_col: str = "data_date") -> DataFrame:
    """company -> sorted distinct dates, in one shuffle: the partial
    ``collect_set`` de-duplicates map-side, and a group holds at most one
    entry per calendar day whatever the number of versions."""
    g = df.groupBy(key).agg(F.sort_array(F.collect_set(date_col)).alias("dates"))
    return g.withColumn("n_dates", F.size("dates").cast("bigint"))


def reconcile(left: DataFrame, right: DataFrame, merged: DataFrame) -> DataFrame:
    """One-row report: rows of left, right, merged and merged - right.  The
    three inputs are tagged and unioned, then counted in one aggregate."""
    tagged = (left.select(F.lit(1).alias("_s"))
              .unionByName(right.select(F.lit(2).alias("_s")))
              .unionByName(merged.select(F.lit(3).alias("_s"))))
    return tagged.agg(
        F.count(F.when(F.col("_s") == 1, 1)).alias("n_left"),
        F.count(F.when(F.col("_s") == 2, 1)).alias("n_right"),
        F.count(F.when(F.col("_s") == 3, 1)).alias("n_merged"),
    ).withColumn("n_diff", F.col("n_merged") - F.col("n_right"))


def exists_flag(df: DataFrame, name: str = "flag") -> DataFrame:
    """1 if ``df`` has any row, else 0 (one row)."""
    return df.agg((F.count(F.lit(1)) > 0).cast("int").alias(name))


def missing_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column, the number of missing cells (NULL, or NaN for floats);
    one pass, then reshaped to (column_name, n_missing)."""
    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    for c in cols:
        miss = f"{q(c)} IS NULL"
        if isinstance(types[c], (T.DoubleType, T.FloatType)):
            miss += f" OR isnan({q(c)})"
        aggs.append(f"count(CASE WHEN {miss} THEN 1 END) AS {q(c)}")
    wide = df.selectExpr(*aggs)
    return wide.unpivot([], cols, "column_name", "n_missing")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "input") -> DataFrame:
    """Pass ``df`` through, failing the query if a key occurs twice.  The
    count is a window over the same keys the following join shuffles on, so
    it adds a sort but no extra exchange."""
    from pyspark.sql import Window
    cols = df.columns
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    bad = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"duplicate key in {what}: {', '.join(keys)}")))
    return df.withColumn("_n", n).where(bad.isNull()).select(*cols)


# --------------------------------------------------------------------------
# reconciliation by digests
# --------------------------------------------------------------------------
#: Parts into which a differing bucket is cut for the second level.
FINE_PARTS = 256


def key_digests(df: DataFrame, keys: Sequence[str], bucket: Sequence[str]) -> DataFrame:
    """Per bucket: rows and two order-independent checksums of the keys (sum and
    exclusive or of a 64-bit hash).  Only one row a bucket leaves a task."""
    h = F.xxhash64(*keys)
    return df.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("total"), F.bit_xor(h).alias("parity"))


def differing_buckets(a: DataFrame, b: DataFrame, keys: Sequence[str], bucket: Sequence[str]) -> DataFrame:
    """Buckets whose digests differ: one aggregation of both sides' digests, no join.
    Equal digests mean equal keys (up to collisions of 128 bits and a count)."""
    both = key_digests(a, keys, bucket).withColumn("side", F.lit(0)).unionByName(key_digests(b, keys, bucket).withColumn("side", F.lit(1)))
    found = both.groupBy(*bucket).agg(F.count(F.lit(1)).alias("sides"), *[F.min(c).alias(f"{c}_lo") for c in ("n", "total", "parity")],
                                      *[F.max(c).alias(f"{c}_hi") for c in ("n", "total", "parity")])
    same = F.col("sides") == 2
    for c in ("n", "total", "parity"):
        same = same & (F.col(f"{c}_lo") == F.col(f"{c}_hi"))
    return found.where(~same).select(*bucket)


def _in_buckets(df: DataFrame, buckets: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows of ``df`` in one of the buckets (NULLs are buckets, too)."""
    few = buckets.select(*[F.col(c).alias(f"_b_{c}") for c in cols])
    hit = F.lit(True)
    for c in cols:
        hit = hit & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    return df.join(few, hit, "left_semi")


def diff_keys_by_digest(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("company_id", "data_date"),
                        bucket: Sequence[str] = ("econ_id", "data_month"), fine: int = FINE_PARTS) -> DataFrame:
    """``diff_keys_both`` of two tables that mostly agree: digests by bucket,
    those of differing buckets again by ``fine`` parts of the key hash, and an
    exact comparison of the parts that differ.  Rows of equal buckets never
    reach a shuffle.  ``bucket`` columns must depend on the key alone.  Keys with
    a NULL equal nothing (as in SQL), so they are always compared exactly."""
    from riskloom.operators.joins import diff_keys_both
    from riskloom.operators.mutate import staged
    cols = list(dict.fromkeys([*keys, *bucket]))
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    unknown = [x.where(~known).select(*keys) for x in (a, b)]
    a, b = a.where(known).select(*cols), b.where(known).select(*cols)
    coarse = staged(differing_buckets(a, b, keys, bucket), "differing-buckets")
    part = F.pmod(F.xxhash64(*keys, F.lit(1)), F.lit(fine)).cast("int")
    a, b = (_in_buckets(x, coarse, bucket).withColumn("_part", part) for x in (a, b))
    parts = staged(differing_buckets(a, b, keys, [*bucket, "_part"]), "differing-parts")
    a, b = (_in_buckets(x, parts, [*bucket, "_part"]).select(*keys).unionByName(y) for x, y in zip((a, b), unknown))
    return diff_keys_both(a, b, keys)
