"""Readers for delimited, registry, JSON, staged Parquet and SQL sources.
Schemas are always given (no inference), so scans prune and push down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.clean import clean_all
from riskloom.schemas import LAYOUTS


def read_csv_shards(spark: SparkSession, root: str, schema: T.StructType, glob: str | None = None,
                    header: bool = True) -> DataFrame:
    """All CSV shards under ``root`` as one scan.  An empty file (zero bytes
    or header only) contributes no rows; a missing column is NULL."""
    r = (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
         .option("recursiveFileLookup", "true"))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.csv(root)


def read_registry(spark: SparkSession, path: str, fmt: str = "csv",
                  names: Sequence[str] = tuple(LAYOUTS["exclusion_registry"]),
                  drop: Sequence[str] = ("No.",), clean: bool = True) -> DataFrame:
    """A registry sheet (exported as CSV or Parquet) with positional names;
    the running-number column is dropped and cells cleaned."""
    if fmt == "csv":
        df = spark.read.option("header", True).csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    if len(df.columns) != len(names):
        raise ValueError(f"registry has {len(df.columns)} columns, expected {len(names)}")
    df = df.toDF(*names)
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in set(drop)])
    return clean_all(df) if clean else df


def read_json_records(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Flat JSON objects (one per line, or one array with ``multi_line``);
    keys absent from a record read as NULL."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_staged(spark: SparkSession, stage: str, schema: T.StructType) -> DataFrame:
    """Parquet files put on a stage, read with the target table's schema."""
    return spark.read.schema(schema).parquet(stage)


def sql_query(spark: SparkSession, text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """A SELECT with bound parameters (``:name``) over DataFrames passed as
    ``{name}`` references; values are never formatted into the text."""
    return spark.sql(text, args=args or {}, **frames)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet table is at ``path``: only a missing path or a folder
    without data files says no, any other read error is raised."""
    from pyspark.errors import AnalysisException
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True
