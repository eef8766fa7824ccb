"""Table mutation on plain Parquet (no MERGE / UPDATE / DELETE there).

Every operation is a pure function ``(current, incoming, keys) -> new
state`` (or the rows it affects), so it can be checked as a query; the
writer ``commit_partitions`` then replaces only the touched partitions.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.expr import select_names
from riskloom.operators.filters import filter_lookback
from riskloom.operators.joins import update_from_join
from riskloom.operators.windows import forward_fill_rating, latest_version
from riskloom.schemas import (ACTION_DAILY, ACTION_REVISION, ALL_SENTINEL, FILL_LOOKBACK_DAYS,
                              REVISION_GUARD_DAYS)
from riskloom.operators.aggregates import exists_flag, revision_span
from riskloom.session import checkpoint_root, scratch_path


def _lit(v):
    return v if isinstance(v, Column) else F.lit(v)


def dedupe_incoming(incoming: DataFrame, keys: Sequence[str], version: str | None = "operation_time") -> DataFrame:
    """One incoming row per key (highest version; equal versions broken by a
    hash of the whole row, so a batch with repeated keys dedupes
    deterministically by two sort columns, however wide it is)."""
    version = version if version and version in incoming.columns else incoming.columns[-1]
    rest = [F.col(f"`{c}`") for c in incoming.columns if c not in keys]
    hashed = incoming.withColumn("_row_hash", F.xxhash64(*rest))
    return latest_version(hashed, keys, version, tiebreak=("_row_hash",)).drop("_row_hash")


def replace_all(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Delete everything, insert the batch."""
    return select_names(incoming, current.columns)


def delete_insert(current: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  null_safe: bool = False, min_date: dt.date | None = None,
                  date_col: str | None = None) -> DataFrame:
    """Delete current rows whose key is in the batch, then insert the batch.
    SQL equality by default (a NULL key never matches); ``min_date`` keeps
    the reference's guard that only deletes rows dated on/after it.  One
    pass over the current table: a left join against the batch's distinct
    keys flags the rows to delete."""
    keys = list(keys)
    k = incoming.select(*[F.col(c).alias(f"_k_{c}") for c in keys]).distinct().withColumn("_hit", F.lit(True))
    cond = None
    for c in keys:
        e = current[c].eqNullSafe(k[f"_k_{c}"]) if null_safe else current[c] == k[f"_k_{c}"]
        cond = e if cond is None else cond & e
    flagged = current.join(k, cond, "left")
    delete = F.col("_hit").isNotNull()
    if min_date is not None:
        delete = delete & (F.col(date_col) >= F.lit(min_date))
    keep = flagged.where(~F.coalesce(delete, F.lit(False))).select(*[current[c] for c in current.columns])
    return keep.unionByName(select_names(incoming, current.columns))


def insert_ignore(current: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  version: str | None = "operation_time") -> DataFrame:
    """Rows whose key exists are skipped; the batch is de-duplicated first."""
    keys = list(keys)
    new = dedupe_incoming(select_names(incoming, current.columns), keys, version)
    return current.unionByName(new.join(current.select(*keys), keys, "left_anti"))


def inserted_rows(current: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  version: str | None = "operation_time") -> DataFrame:
    """Only the rows insert-ignore would add (what an append writes)."""
    keys = list(keys)
    new = dedupe_incoming(select_names(incoming, current.columns), keys, version)
    return new.join(current.select(*keys), keys, "left_anti")


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str],
           version: str | None = "operation_time") -> DataFrame:
    """``INSERT ... ON DUPLICATE KEY UPDATE``: batch rows replace current rows
    with the same key, new keys are added."""
    keys = list(keys)
    new = dedupe_incoming(select_names(incoming, current.columns), keys, version)
    return current.join(incoming.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def history_capture(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current rows about to be replaced (appended to the history table)."""
    keys = list(keys)
    return current.join(incoming.select(*keys).distinct(), keys, "left_semi")


def forward_fill_update(main: DataFrame, as_of, days: int = FILL_LOOKBACK_DAYS,
                        rating: str = "PDIR") -> DataFrame:
    """Forward-fill job on the versioned table: latest versions in the
    look-back are filled per company, then every version with a missing or
    zero rating in the look-back takes the filled value."""
    since = F.date_sub(_lit(as_of), days)
    recent = filter_lookback(main, as_of, days)
    latest = latest_version(recent.select("data_date", "company_id", "operation_time", rating),
                            ("data_date", "company_id"), "operation_time")
    filled = forward_fill_rating(latest, rating=rating)
    return update_from_join(main, filled, target=rating, since=since)


def operation_log_columns(data_date, calibration_date, operation_time, action: str = ACTION_DAILY) -> list:
    """Columns of a daily log row (econ and company are 'all')."""
    return [_lit(data_date).cast("date").alias("data_start_date"),
            _lit(data_date).cast("date").alias("data_end_date"),
            F.lit(ALL_SENTINEL).alias("econ_id"), F.lit(ALL_SENTINEL).cast("bigint").alias("company_id"),
            _lit(calibration_date).cast("date").alias("calibration_date"),
            _lit(operation_time).cast("timestamp_ntz").alias("operation_time"),
            F.lit(action).alias("operation_action")]


def operation_log_daily(spark: SparkSession, data_date, calibration_date, operation_time,
                        action: str = ACTION_DAILY) -> DataFrame:
    """The one log row of a daily load."""
    return spark.range(1).select(*operation_log_columns(data_date, calibration_date, operation_time, action))


def operation_log_revision(batch: DataFrame) -> DataFrame:
    """One log row per (econ, company, calibration, operation) of a revision."""
    return revision_span(batch, action=ACTION_REVISION).select(
        "data_start_date", "data_end_date", F.col("econ_id").cast("int").alias("econ_id"),
        F.col("company_id").cast("bigint").alias("company_id"), "calibration_date",
        "operation_time", "operation_action")


def guard_daily(log: DataFrame, day) -> DataFrame:
    """1 if a daily load for ``day`` is logged already."""
    return exists_flag(log.where((F.col("operation_action") == ACTION_DAILY)
                                 & (F.col("data_end_date") == _lit(day))), "already_loaded")


def guard_revision(log: DataFrame, day, days: int = REVISION_GUARD_DAYS) -> DataFrame:
    """1 if a revision ending within ``[day - days, day]`` is logged."""
    d = _lit(day)
    return exists_flag(log.where((F.col("operation_action") == ACTION_REVISION)
                                 & F.col("data_end_date").between(F.date_sub(d, days), d)),
                       "already_loaded")


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Reorder / widen / drop extras to the declared schema and fail on a
    NULL in a NOT NULL column."""
    relaxed = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])
    res = df.to(relaxed)
    for f in schema.fields:
        if not f.nullable:
            res = res.withColumn(f.name, F.when(F.col(f.name).isNull(), F.raise_error(
                F.lit(f"NULL in NOT NULL column {f.name}"))).otherwise(F.col(f.name)).cast(f.dataType))
    return res


def with_month(df: DataFrame, date_col: str = "data_date", name: str = "data_month") -> DataFrame:
    return df.withColumn(name, F.date_format(F.col(date_col), "yyyy-MM"))


def read_touched(spark: SparkSession, path: str, batch: DataFrame, part_col: str = "data_month",
                 date_col: str = "data_date") -> DataFrame:
    """The part of a table a batch can touch: when the table is partitioned
    by month, only the batch's months are read (partition pruning; the month
    list is bounded by the calendar), otherwise the whole table."""
    table = spark.read.parquet(path)
    if part_col not in table.columns or date_col not in batch.columns:
        return table
    months = [r[0] for r in batch.select(F.date_format(date_col, "yyyy-MM")).distinct().collect()]
    return table.where(F.col(part_col).isin(months))


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to scratch and read back: evaluated once, and safe from a lost executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_by_month(df: DataFrame, name: str, part_col: str = "data_month") -> tuple[DataFrame, list[str]]:
    """``df`` (with its month column) written once to scratch by month and read
    back, and the months in it, taken from the folder names (bounded by the calendar)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(part_col).parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    months = {m[1] for f in staged.inputFiles() if (m := re.search(rf"/{part_col}=([^/]+)/", f))}
    return staged, sorted(months)


def absent_rows(current: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a written table whose key ``current`` lacks.  Keys are compared
    on their own; the whole rows meet a key only where some are there."""
    keys = list(keys)
    there = staged(rows.select(*keys).join(current.select(*keys), keys, "left_semi").distinct(), "keys-there")
    return rows if there.isEmpty() else rows.join(there, keys, "left_anti").select(*rows.columns)


def one_per_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dropDuplicates(keys)`` of a written table: repeated keys are found on
    their own, and only their rows are brought together (NULLs are keys, too)."""
    keys = list(keys)
    again = staged(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
                   .select(*[F.col(k).alias(f"_k_{k}") for k in keys]), "keys-repeated")
    if again.isEmpty():
        return rows
    hit = F.lit(True)
    for k in keys:
        hit = hit & rows[k].eqNullSafe(again[f"_k_{k}"])
    return rows.join(again, hit, "left_anti").unionByName(rows.join(again, hit, "left_semi").dropDuplicates(keys))


def commit_partitions(df: DataFrame, path: str, partition_cols: Sequence[str] = ("data_month",),
                      cut_lineage: bool = True) -> None:
    """Replace only the partitions present in ``df`` (dynamic overwrite).

    The new state usually reads the table it replaces; a reliable
    ``checkpoint()`` (in ``spark.checkpoint.dir``) materialises it first, so
    overwriting never deletes files a running plan still needs and a lost
    executor recomputes from the checkpoint, not from deleted input."""
    if cut_lineage:
        checkpoint_root(df.sparkSession)
        df = df.checkpoint(eager=True)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def commit_months(df: DataFrame, path: str, months: Sequence[str], part_col: str = "data_month") -> None:
    """Replace exactly the given month partitions by the rows of ``df`` (which
    are of these months): a month without rows any more is emptied, too."""
    spark = df.sparkSession
    fresh, present = staged_by_month(df, "months", part_col)      # the new state may read what it replaces
    (fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(path))
    schema = T.StructType([f for f in df.schema.fields if f.name != part_col])
    for month in sorted(set(months) - set(present)):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{part_col}={month}")


def truncate_table(spark: SparkSession, path: str) -> None:
    """Empty a Parquet table but keep its schema."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
