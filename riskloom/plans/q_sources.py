"""Catalogue entries for sources and sinks (SURVEY A).  Each query lands
files derived from the driver's tables in a fresh folder under the shared
checkpoint root, then scans them back with the library's readers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import fixtures as fx
from riskloom.fixtures import sql
from riskloom.operators import mutate as mu
from riskloom.operators import reshape as rs
from riskloom.operators import windows as win
from riskloom.plans.catalog import LATEST_SQL, register
from riskloom.plans.q_reshape import as_csv_rows
from riskloom.schemas import AS_CSV_COLS, DAILY_ECONOMIES, PD_COLS, PD_TABLE
from riskloom.session import _fs_path, checkpoint_root, landed_fixture, scratch_path
from riskloom.sources import files as fl
from riskloom.sources import readers as rd
from riskloom.sources import sinks as sk
from riskloom.sources.matrix import scan_matrix, write_matrix_shards


def land_pd_shards(spark, d, with_pdir=False):
    """The daily PD matrix as per-economy .npy shards plus a corrupt shard
    and an unrelated file (and, with ``with_pdir``, the rating shards).
    Landed once per source-table state (immutable input) and reused."""
    name = "pd-pdir-shards" if with_pdir else "pd-shards"
    return landed_fixture(spark, name, d, lambda out: _write_pd_shards(spark, d, out, with_pdir))


def _write_pd_shards(spark, d, out, with_pdir):
    write_matrix_shards(fx.pd_matrix_rows(spark, d), out, "pd60h_")
    fs, base = _fs_path(out)
    with fs.open_output_stream(f"{base}/pd60h_999.corrupt.npy") as fh:
        fh.write(b"not a matrix")
    with fs.open_output_stream(f"{base}/readme.txt") as fh:
        fh.write(b"delivery notes")
    if with_pdir:
        land_pdir_shards(spark, d, out)


def land_pdir_shards(spark, d, out):
    from riskloom.plans.q_reshape import pdir_daily_named
    rows = pdir_daily_named(spark, d)
    rows = rows.select("econ_id", F.array("company_id", "yyyy", "mm", "dd", "pdir").alias("values"))
    write_matrix_shards(rows, out, "pdirNum_")
    return out


# ---------------------------------------------------------------- A1 / A2 matrix scan
@register("src_matrix_scan", sql(
    "SELECT * REPLACE (CASE WHEN isnan(PD_60) THEN NULL ELSE PD_60 END AS PD_60) FROM pd_matrix_named",
    "pd_matrix_named"))
def q_src_matrix_scan(spark, d):
    root = land_pd_shards(spark, d)
    rows = scan_matrix(spark, root, "pd60h_*.npy")
    rows = rows.withColumn("econ_id", fl.id_from_name("file_name").cast("int"))
    return rs.name_positional(rows, "pd_daily", keep=["econ_id"])


@register("src_matrix_errors", sql(
    "SELECT econ_id, count(*) AS n_rows, false AS failed FROM pd_matrix_named GROUP BY econ_id "
    "UNION ALL SELECT 999, 0, true", "pd_matrix_named"))
def q_src_matrix_errors(spark, d):
    """Rows of each economy's shards and whether one failed to decode (the corrupt one does)."""
    root = land_pd_shards(spark, d)
    rows = scan_matrix(spark, root, "pd60h_*.npy", keep_errors=True)
    econ = fl.id_from_name("file_name").cast("int").alias("econ_id")
    return rows.groupBy(econ).agg(F.count("row").alias("n_rows"), F.max(F.col("error").isNotNull()).alias("failed"))


@register("src_matrix_variables", sql(
    "SELECT company_id, data_date, PD_1, PD_12 FROM pd_raw", "pd_raw"))
def q_src_matrix_variables(spark, d):
    """A2: archives of two named variables, of which the scan takes one."""
    root = scratch_path(spark, "named-variables")
    rows = fx.pd_raw(spark, d).select(fx.econ_of().alias("econ_id"), F.array(
        F.col("company_id").cast("double"), F.year("data_date").cast("double"), F.month("data_date").cast("double"),
        F.dayofmonth("data_date").cast("double"), "PD_1", "PD_12").alias("values"))
    write_matrix_shards(rows, root, "archive_", variables=("pd", "unused"))
    v = scan_matrix(spark, root, "archive_*", variables=["pd"]).select("values")
    day = F.make_date(F.col("values")[1].cast("int"), F.col("values")[2].cast("int"), F.col("values")[3].cast("int"))
    return v.select(F.col("values")[0].cast("bigint").alias("company_id"), day.alias("data_date"),
                    F.col("values")[4].alias("PD_1"), F.col("values")[5].alias("PD_12"))


# ---------------------------------------------------------------- A3 CSV
AS_CSV_SCHEMA = T.StructType([T.StructField("Date", T.StringType()), T.StructField("U3_ID", T.LongType())]
                             + [T.StructField(c, T.DoubleType()) for c in AS_CSV_COLS])
AS_CSV_SQL = ("SELECT CAST(data_date AS VARCHAR) AS Date, company_id AS U3_ID, "
              + ", ".join(f"PD_{12 * i} AS Y{i}" for i in range(1, 5))
              + ", CASE WHEN PDIR IS NULL THEN NULL ELSE PD_60 END AS Y5 FROM pd_raw")


@register("src_csv_scan", sql(AS_CSV_SQL, "pd_raw"))
def q_src_csv_scan(spark, d):
    root = scratch_path(spark, "as-csv")
    rows = as_csv_rows(spark, d).withColumn("econ", fx.econ_of("U3_ID"))
    rows.write.mode("overwrite").option("header", True).partitionBy("econ").csv(root)
    fs, base = _fs_path(root)                       # plus an empty shard of another economy
    fs.create_dir(f"{base}/econ=0", recursive=True)
    with fs.open_output_stream(f"{base}/econ=0/AS_empty.csv"):
        pass
    return rd.read_csv_shards(spark, root, AS_CSV_SCHEMA, glob="*.csv")


# ---------------------------------------------------------------- A4 registry
REGISTRY_SQL = (
    "SELECT r_name AS Region, CAST(e.company_id AS VARCHAR) AS CompanyNumber, n_name AS Country, e.ticker AS Ticker, "
    "e.ticker AS CompanyName, CASE WHEN e.end_date IS NULL THEN 'open' END AS Reason, "
    "CAST(NULL AS VARCHAR) AS Remark, CAST(e.start_date AS VARCHAR) AS StartDate, "
    "CAST(e.end_date AS VARCHAR) AS EndDate, CAST(NULL AS VARCHAR) AS ErrorFoundDate, "
    "CAST(NULL AS VARCHAR) AS SQLQuery, CAST(NULL AS VARCHAR) AS StopReason, "
    "CAST(NULL AS VARCHAR) AS InternalRemarks FROM excluded_companies e "
    "JOIN customer c ON c.c_custkey = e.company_id JOIN nation ON c_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey")


def registry_sheet(spark, d):
    from riskloom.plans.q_reshape import exclusion_sheet
    sh = exclusion_sheet(spark, d)
    return sh.select(
        F.col("Region"), F.col("Company Number").cast("string").alias("c1"), F.col("country"), F.col("Ticker"),
        F.col("Company Name"),
        F.when(F.col("Stopped Excluding On (PD date)").isNull(), F.lit("open")).otherwise(F.lit(" nan ")).alias("r"),
        F.lit("").alias("rm"), F.col("Excluded Since (PD date)").cast("string").alias("s"),
        F.col("Stopped Excluding On (PD date)").cast("string").alias("e"), F.lit("NaT").alias("f"),
        F.lit(None).cast("string").alias("q"), F.lit(None).cast("string").alias("sr"),
        F.lit(" ").alias("ir"), F.col("`No.`").cast("string").alias("n"))


@register("src_registry_scan", sql(REGISTRY_SQL, "excluded_companies"))
def q_src_registry_scan(spark, d):
    path = scratch_path(spark, "registry")
    registry_sheet(spark, d).write.mode("overwrite").option("header", True).csv(path)
    return rd.read_registry(spark, path)


# ---------------------------------------------------------------- A5 JSON
USER_JSON_SCHEMA = T.StructType([
    T.StructField("UserKey", T.LongType()), T.StructField("Email", T.StringType()),
    T.StructField("Industry", T.StringType()), T.StructField("BudaAccess", T.StringType()),
    T.StructField("Type", T.StringType()),
])


def land_users_json(spark, d):
    path = scratch_path(spark, "users-json")
    u = fx.users_flat(spark, d)
    u.select(F.col("user_key").alias("UserKey"), F.col("email").alias("Email"), F.col("industry").alias("Industry"),
             F.col("buda_access").alias("BudaAccess")).write.mode("overwrite").json(path)
    return path


@register("src_json_scan", sql(
    "SELECT user_key AS UserKey, email AS Email, industry AS Industry, buda_access AS BudaAccess, "
    "CAST(NULL AS VARCHAR) AS Type FROM users_flat", "users_flat"))
def q_src_json_scan(spark, d):
    return rd.read_json_records(spark, land_users_json(spark, d), USER_JSON_SCHEMA)


# ---------------------------------------------------------------- A6 / A7 / A9 / A13 sinks
@register("sink_parquet_chunked", sql(LATEST_SQL, "pd_raw"))
def q_sink_parquet_chunked(spark, d):
    path = scratch_path(spark, "chunked")
    sk.write_parquet_chunked(win.latest_version(fx.pd_raw(spark, d)), path, target_mb=0.25)
    return spark.read.parquet(path)


QUARANTINE_SCHEMA = T.StructType([T.StructField(c, T.DoubleType()) for c in ["company_id", "yyyy", "mm", "dd"]]
                                 + [T.StructField("reject_reason", T.StringType())])


@register("sink_quarantine", sql(
    "SELECT company_id, yyyy, mm, dd, 'missing_pd' AS reject_reason FROM pd_matrix_named WHERE "
    + " OR ".join(f"isnan(PD_{i})" for i in range(1, 61)), "pd_matrix_named"))
def q_sink_quarantine(spark, d):
    path = scratch_path(spark, "rejects")
    named = fx.pd_matrix_named(spark, d).select("company_id", "yyyy", "mm", "dd", *PD_COLS)
    checks = {"missing_pd": F.lit(True)}
    for c in PD_COLS:
        checks["missing_pd"] = checks["missing_pd"] & F.col(c).isNotNull() & ~F.isnan(c)
    _valid, rejected = sk.split_valid(named, checks)
    sk.write_rejects(rejected.select("company_id", "yyyy", "mm", "dd", "reject_reason"), path)
    return spark.read.schema(QUARANTINE_SCHEMA).option("header", True).csv(path)


@register("sink_append", sql(
    "SELECT * FROM pd_current UNION ALL SELECT l.* FROM (" + LATEST_SQL + ") l WHERE NOT EXISTS "
    "(SELECT 1 FROM pd_current c WHERE c.company_id = l.company_id AND c.data_date = l.data_date)",
    "pd_raw", "pd_current"))
def q_sink_append(spark, d):
    path = scratch_path(spark, "append")
    cur = fx.pd_current(spark, d)
    cur.write.mode("overwrite").parquet(path)
    table = spark.read.parquet(path)
    new_rows = mu.inserted_rows(table, fx.pd_raw(spark, d), ["company_id", "data_date"])
    # the batch reads the table it appends to: materialise it first
    checkpoint_root(spark)
    sk.append(new_rows.checkpoint(eager=True), path)
    return spark.read.parquet(path)


@register("load_staged", sql(
    f"SELECT data_date, company_id, calibration_date, operation_time, PDIR, {', '.join(PD_COLS)} FROM ({LATEST_SQL}) l",
    "pd_raw"))
def q_load_staged(spark, d):
    stage = scratch_path(spark, "stage")
    table = scratch_path(spark, "raw-table")
    win.latest_version(fx.pd_raw(spark, d)).write.mode("overwrite").parquet(stage)
    sk.append(rd.read_staged(spark, stage, PD_TABLE), table)
    return spark.read.parquet(table)


# ---------------------------------------------------------------- A8 parameterised SQL
@register("src_sql_params", sql(
    "SELECT company_id, data_date, PDIR FROM pd_raw WHERE data_date = DATE '2024-01-15' AND PDIR >= 10", "pd_raw"))
def q_src_sql_params(spark, d):
    return rd.sql_query(spark, "SELECT company_id, data_date, PDIR FROM {pd} WHERE data_date = :day AND PDIR >= :lvl",
                        args={"day": dt.date(2024, 1, 15), "lvl": 10}, pd=fx.pd_raw(spark, d))


# ---------------------------------------------------------------- A10-A12, A14 listings
@register("manifest_expected", sql(
    "SELECT name AS folder, p AS product, e AS econ_id, concat(name, '/Products/', s, '/', p, '_', CAST(e AS VARCHAR), "
    "'.mat') AS path FROM daily_folders, (VALUES ('pd60h', 'P2_Pd'), ('pdirNum', 'P3_Pdir')) AS t(p, s), "
    "unnest([" + ", ".join(str(e) for e in DAILY_ECONOMIES) + "]) AS u(e)", "daily_folders"))
def q_manifest_expected(spark, d):
    folders = fx.daily_folders(spark, d).select(F.col("name").alias("folder"))
    return fl.expected_manifest(folders, [("pd60h", "P2_Pd"), ("pdirNum", "P3_Pdir")], DAILY_ECONOMIES)


def _listing(spark, d):
    return fl.list_files(spark, land_pd_shards(spark, d, with_pdir=True))


ECON_SQL = "SELECT DISTINCT CAST(company_id % 25 + 1 AS BIGINT) AS econ_id FROM pd_raw"


@register("files_listing", sql(
    f"SELECT 'pd60h_' AS prefix, econ_id FROM ({ECON_SQL}) a UNION ALL SELECT 'pdirNum_', econ_id FROM ({ECON_SQL}) b "
    "UNION ALL SELECT 'pd60h_', 999 UNION ALL SELECT 'readme.txt', NULL", "pd_raw"))
def q_files_listing(spark, d):
    ls = _listing(spark, d).where(F.col("length") > 0)
    return ls.select(F.regexp_extract("file_name", r"^([A-Za-z0-9]+_|readme\.txt)", 1).alias("prefix"),
                     fl.id_from_name("file_name").alias("econ_id")).distinct()


@register("files_filter", sql(ECON_SQL, "pd_raw"))
def q_files_filter(spark, d):
    ls = fl.filter_pattern(fl.filter_prefix(_listing(spark, d), "pdirNum_"), r"^pdirNum_\d+\.p\d+-\d+\.npy$")
    return ls.select(fl.id_from_name("file_name").alias("econ_id")).distinct()


@register("files_extract_id", sql(
    f"SELECT econ_id FROM ({ECON_SQL}) a UNION ALL SELECT 999", "pd_raw"))
def q_files_extract_id(spark, d):
    root = land_pd_shards(spark, d)
    return fl.filter_prefix(fl.list_files(spark, root, "*.npy"), "pd60h_").select(
        fl.id_from_name("file_name").alias("econ_id")).distinct()


@register("catalog_calibration", sql(
    "SELECT name AS folder, CAST(strptime(right(name, 8), '%Y%m%d') AS DATE) AS calibration_date FROM daily_folders "
    "WHERE substr(name, 1, 8) = '20240115'", "daily_folders"))
def q_catalog_calibration(spark, d):
    return fl.calibration_lookup(fx.daily_folders(spark, d), dt.date(2024, 1, 15))

