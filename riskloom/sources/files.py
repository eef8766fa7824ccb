"""File listings as DataFrames: listing, prefix / pattern filters, ids from
file names, the expected-file manifest, completeness and the calibration
catalogue lookup.  A listing never reads file contents."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LISTING_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
])


def list_files(spark: SparkSession, root: str, glob: str | None = None,
               recursive: bool = True) -> DataFrame:
    """(path, file_name, length, modificationTime) of files under ``root``.
    The ``binaryFile`` source prunes ``content`` when it is not selected.
    An unreadable or missing folder gives an empty listing."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    try:
        df = r.load(root).select("path", "length", "modificationTime")
    except Exception as e:  # noqa: BLE001 - a missing folder is an empty listing
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        df = spark.createDataFrame([], LISTING_SCHEMA).select("path", "length", "modificationTime")
    return df.withColumn("file_name", file_name_of("path"))


def file_name_of(path: str | Column = "path") -> Column:
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(p, r"([^/]+)$", 1)


def filter_prefix(listing: DataFrame, prefix: str, name: str = "file_name") -> DataFrame:
    return listing.where(F.col(name).startswith(prefix))


def filter_pattern(listing: DataFrame, pattern: str, name: str = "file_name") -> DataFrame:
    return listing.where(F.col(name).rlike(pattern))


def id_from_name(name: str | Column = "file_name") -> Column:
    """The id after the last ``_`` and before the first ``.`` of a file name
    (``pd60h_12.mat`` -> 12, ``pd60h_12.p3.npy`` -> 12)."""
    n = F.col(name) if isinstance(name, str) else name
    last = F.element_at(F.split(n, "_"), -1)
    return F.split(last, r"\.").getItem(0).try_cast("bigint")


def expected_manifest(folders: DataFrame, products: Sequence[tuple[str, str]], econs: Sequence[int],
                      folder_col: str = "folder") -> DataFrame:
    """Expected files of each delivery folder: one row per (folder, product,
    economy).  The fixed product x economy list is one literal array, so
    each folder fans out to a bounded, known number of rows."""
    combos = [F.struct(F.lit(p).alias("product"), F.lit(sub).alias("subfolder"), F.lit(int(e)).alias("econ_id"))
              for p, sub in products for e in econs]
    x = folders.select(F.col(folder_col).alias("folder"), F.explode(F.array(*combos)).alias("f"))
    return x.select("folder", "f.product", "f.econ_id",
                    F.concat_ws("", F.col("folder"), F.lit("/Products/"), F.col("f.subfolder"), F.lit("/"),
                                F.col("f.product"), F.lit("_"), F.col("f.econ_id").cast("string"),
                                F.lit(".mat")).alias("path"))


def missing_files(expected: DataFrame, present: DataFrame, keys: Sequence[str] | str = "econ_id") -> DataFrame:
    """Expected entries with no present counterpart."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return expected.join(present.select(*keys).distinct(), keys, "left_anti")


def calibration_lookup(folders: DataFrame, day: dt.date, name: str = "name") -> DataFrame:
    """The single daily folder ``yyyymmdd_cali_yyyymmdd`` whose prefix is
    ``day``; its calibration date is the last 8 characters.  No match or
    more than one match fails the query."""
    d = f"{day:%Y%m%d}"
    hits = folders.where((F.substring(F.col(name), 1, 8) == d) & (F.substring(F.col(name), 1, 1) <= "9"))
    one = hits.agg(F.count(F.lit(1)).alias("n"), F.max(name).alias("name"))
    checked = F.when(F.col("n") == 1, F.col("name")).otherwise(
        F.raise_error(F.concat(F.lit(f"expected one calibration folder for {d}, found "),
                               F.col("n").cast("string"))))
    return one.select(checked.alias("folder")).select(
        "folder", F.to_date(F.substring("folder", -8, 8), "yyyyMMdd").alias("calibration_date"))
