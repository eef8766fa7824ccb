"""Sinks: size-bounded Parquet, reject (quarantine) CSV, append, and the
clustered panel layout.  Writers always go through ``DataFrameWriter`` so
parallelism is the partition count and a failed task is simply retried."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGET_FILE_MB = 500

# Rough in-memory widths per type, used to turn a byte target into rows.
_TYPE_BYTES = {T.DoubleType: 8, T.LongType: 8, T.IntegerType: 4, T.ShortType: 2, T.ByteType: 1,
               T.FloatType: 4, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
               T.BooleanType: 1}
STRING_BYTES = 32


def row_bytes(schema: T.StructType) -> int:
    total = 0
    for f in schema.fields:
        w = next((b for t, b in _TYPE_BYTES.items() if isinstance(f.dataType, t)), None)
        if w is None:
            w = STRING_BYTES * (8 if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else 1)
        total += w
    return max(total, 1)


def rows_per_file(schema: T.StructType, target_mb: float = TARGET_FILE_MB) -> int:
    return max(1, math.floor(target_mb * 1024 * 1024 / row_bytes(schema)))


def write_parquet_chunked(df: DataFrame, path: str, target_mb: float = TARGET_FILE_MB,
                          mode: str = "overwrite", partition_cols: Sequence[str] = ()) -> None:
    """Snappy Parquet where no file exceeds ~``target_mb`` of row data: the
    byte target becomes ``maxRecordsPerFile`` from the schema's row width."""
    w = (df.write.mode(mode).option("compression", "snappy").option("partitionOverwriteMode", "static")
         .option("maxRecordsPerFile", rows_per_file(df.schema, target_mb)))
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def split_valid(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows + ``reject_reason``).  ``checks`` maps a
    reason to a predicate that must hold; the first failing reason is kept."""
    reason = None
    for name, ok in checks.items():
        fail = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name))
        reason = fail if reason is None else F.coalesce(reason, fail)
    tagged = df.withColumn("reject_reason", reason)
    return (tagged.where(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.where(F.col("reject_reason").isNotNull()))


def write_rejects(rejected: DataFrame, path: str) -> None:
    """Rejected rows as CSV (header, every column rendered as text)."""
    out = rejected.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in rejected.columns])
    out.write.mode("append").option("header", True).csv(path)


def append(df: DataFrame, path: str, fmt: str = "parquet", partition_cols: Sequence[str] = ()) -> None:
    """Bulk append; parallelism is the partition count."""
    w = df.write.mode("append").format(fmt)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.save(path)


def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str] = ("data_date", "company_id"),
                    partition_col: str = "data_month", date_col: str = "data_date",
                    num_partitions: int | None = None) -> None:
    """Month partitions, range-partitioned and sorted on the cluster key, so
    min/max statistics of each file skip most row groups for date / company
    predicates.  Month (not day) partitions keep the folder count low."""
    res = df.withColumn(partition_col, F.date_format(F.col(date_col), "yyyy-MM"))
    n = num_partitions or int(res.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    res = res.repartitionByRange(n, *cluster_by).sortWithinPartitions(*cluster_by)
    # a rebuild replaces the whole table, months that are gone included
    res.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition_col).parquet(path)
