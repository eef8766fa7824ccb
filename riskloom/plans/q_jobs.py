"""Catalogue entries for the jobs (SURVEY J) and the streaming ingest (K1).

Each query lands a delivery derived from the driver's tables (matrix
shards per economy and day, CSV / JSON / registry files) in a fresh folder
under the checkpoint root, runs the job end to end, and returns the
resulting table read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from riskloom import fixtures as fx
from riskloom.fixtures import sql
from riskloom.operators import mutate as mu
from riskloom.operators import reshape as rs
from riskloom.operators import windows as win
from riskloom.plans import jobs
from riskloom.plans.catalog import LATEST_SQL, OPERATION_TIME, register
from riskloom.plans.q_reshape import rating_grid
from riskloom.schemas import AS_COLS, AS_TABLE, PD_COLS, PDIR_TABLE, SIMPLE_HORIZONS, WEBSITE_HORIZONS
from riskloom.session import landed_fixture, scratch_path
from riskloom.sources.matrix import write_matrix_shards

OP_SQL = "TIMESTAMP '2024-02-02 06:00:00'"
OLD_OP = dt.datetime(2024, 2, 1, 0, 0, 0)
OLD_OP_SQL = "TIMESTAMP '2024-02-01 00:00:00'"
REV_OP = dt.datetime(2024, 2, 3, 0, 0, 0)
REV_OP_SQL = "TIMESTAMP '2024-02-03 00:00:00'"
DAY = dt.date(2024, 1, 15)
RANGE = (dt.date(2024, 1, 15), dt.date(2024, 1, 19))
NEW_DAY = dt.date(2024, 1, 22)
CUTOFF = dt.date(2024, 1, 21)
#: What a delivered row of horizons follows from.
VALUE_COLS = ["company_id", "data_date", "PDIR", "value"]


def _nan():
    return F.lit(float("nan"))


def _latest(spark, d):
    return fx.pd_latest(spark, d)


def _horizons(*cols):
    return [F.expr(fx.PD_EXPRS[c]) for c in cols]


def _last_horizon():
    """The last of a row's values, missing where the rating is."""
    return F.when(F.col("PDIR").isNull(), _nan()).otherwise(F.expr(fx.PD_EXPRS["PD_60"]))


def _pdir_schema(df):
    return mu.enforce_schema(df, PDIR_TABLE)


def _as_schema(df):
    return mu.enforce_schema(df, AS_TABLE)


def _folder(date_col, sub):
    return F.concat(F.date_format(date_col, "yyyyMMdd"), F.lit(f"_cali_20240201/Products/{sub}"))


def _ymd(date_col="data_date"):
    return [F.year(date_col).cast("double"), F.month(date_col).cast("double"), F.dayofmonth(date_col).cast("double")]


# ---------------------------------------------------------------- delivery landing
def land_delivery(spark, d, products=("pd", "pdir", "as")):
    """Daily delivery folders for every day of the data: PD (latest version
    of each company/day, NaN horizon where the rating is missing), PDIR
    (daily ratings) and AS shards, cut by economy.  Landed once per source
    tables (immutable input) and reused."""
    return landed_fixture(spark, "delivery-" + "-".join(products), d,
                          lambda root: _write_delivery(spark, d, root, products))


def _write_delivery(spark, d, root, products):
    lat, key = fx.latest_values(spark, d), F.col("company_id").cast("double")
    if "pd" in products:
        rows = lat.select(fx.econ_of().alias("econ_id"), _folder(F.col("data_date"), "P2_Pd").alias("folder"), *VALUE_COLS)
        write_matrix_shards(rows, root, "pd60h_", folder="folder",
                            values=F.array(key, *_ymd(), *_horizons(*PD_COLS[:-1]), _last_horizon()))
    if "pdir" in products:
        rk = fx.rating_key(spark, d) if "pd" in products else fx.rating_all(spark, d)
        rows = rk.select(fx.econ_of().alias("econ_id"), _folder(F.col("data_date"), "P3_Pdir").alias("folder"),
                         F.array(F.col("company_id").cast("double"), *_ymd(), F.col("pdir")).alias("values"))
        write_matrix_shards(rows, root, "pdirNum_", folder="folder")
    if "as" in products:
        rows = lat.select(fx.econ_of().alias("econ_id"), _folder(F.col("data_date"), "P7_As").alias("folder"), *VALUE_COLS)
        write_matrix_shards(rows, root, "as_", folder="folder",
                            values=F.array(key, *_ymd(), *_horizons(*[f"PD_{12 * i}" for i in range(1, 5)]), _last_horizon()))


# ---------------------------------------------------------------- J1
@register("job_simple_load", sql(
    "SELECT company_id AS comp_id, data_date AS date, "
    + ", ".join(f"PD_{h} AS pd_{h}" for h in SIMPLE_HORIZONS) + " FROM pd_raw", "pd_raw"))
def q_job_simple_load(spark, d):
    root = scratch_path(spark, "simple-matrix")
    raw = fx.pd_raw(spark, d)
    rows = raw.select(fx.econ_of().alias("econ_id"),
                      F.array(F.col("company_id").cast("double"), *_ymd(),
                              *[F.col(f"PD_{h}") for h in SIMPLE_HORIZONS]).alias("values"))
    write_matrix_shards(rows, root, "pd_")
    return jobs.simple_load(spark, root, scratch_path(spark, "pd-daily-test"), "pd_*.npy")


# ---------------------------------------------------------------- J2 / J5 / reconcile
PD_DAY_SQL = (
    f"SELECT l.data_date, l.company_id, DATE '2024-02-01' AS calibration_date, {OP_SQL} AS operation_time, "
    f"r.pdir AS PDIR, {', '.join('l.' + c for c in PD_COLS)}, CAST(strftime(l.data_date, '%Y%m%d') AS INT) "
    "AS current_trading_date, CAST(l.company_id % 25 + 1 AS INT) AS econ_id "
    f"FROM ({LATEST_SQL}) l LEFT JOIN rating_key r ON l.company_id = r.company_id AND l.data_date = r.data_date "
    "WHERE l.PDIR IS NOT NULL")


@register("job_pd_day", sql(PD_DAY_SQL + " AND l.data_date = DATE '2024-01-15'", "pd_raw", "rating_key"))
def q_job_pd_day(spark, d):
    return jobs.pd_day(spark, land_delivery(spark, d, ("pd", "pdir")), DAY, OPERATION_TIME)


@register("job_pdir_day", sql(
    "SELECT r.data_date, r.company_id, r.pdir AS pdir_extracted FROM rating_key r WHERE r.data_date = "
    f"DATE '2024-01-15' AND EXISTS (SELECT 1 FROM ({LATEST_SQL}) l WHERE l.company_id = r.company_id AND "
    "l.data_date = r.data_date AND l.PDIR IS NOT NULL)", "pd_raw", "rating_key"))
def q_job_pdir_day(spark, d):
    root = land_delivery(spark, d, ("pd", "pdir"))
    folders = jobs.folders_in_range(spark, root, DAY, DAY)
    keys = jobs.pd_days(spark, root, folders, OPERATION_TIME).select("data_date", "company_id")
    return jobs.pdir_days(spark, root, folders, OPERATION_TIME, keys)


@register("job_pd_day_reconcile", sql(
    f"WITH p AS ({PD_DAY_SQL} AND l.data_date = DATE '2024-01-15'), "
    "r AS (SELECT * FROM rating_key WHERE data_date = DATE '2024-01-15') "
    "SELECT (SELECT count(*) FROM p) AS n_left, (SELECT count(*) FROM r) AS n_right, "
    "(SELECT count(*) FROM p) AS n_merged, (SELECT count(*) FROM p) - (SELECT count(*) FROM r) AS n_diff",
    "pd_raw", "rating_key"))
def q_job_pd_day_reconcile(spark, d):
    return jobs.pd_day_reconcile(spark, land_delivery(spark, d, ("pd", "pdir")), DAY, OPERATION_TIME)


# ---------------------------------------------------------------- J3 / J14
PD_RANGE_SQL = (
    "WITH cur AS (SELECT company_id, data_date, operation_time, PDIR, PD_12 FROM pd_current), "
    f"new AS (SELECT l.company_id, l.data_date, {OP_SQL} AS operation_time, COALESCE(r.pdir, 0) AS PDIR, l.PD_12 "
    f"FROM ({LATEST_SQL}) l LEFT JOIN rating_key r ON l.company_id = r.company_id AND l.data_date = r.data_date "
    "WHERE l.PDIR IS NOT NULL AND l.data_date BETWEEN DATE '2024-01-15' AND DATE '2024-01-19'), "
    "tbl AS (SELECT * FROM cur UNION ALL SELECT * FROM new), "
    "rk AS (SELECT * FROM tbl WHERE data_date >= DATE '2024-01-05' QUALIFY row_number() OVER "
    "(PARTITION BY company_id, data_date ORDER BY operation_time DESC) = 1), "
    "f AS (SELECT company_id, data_date, COALESCE(NULLIF(PDIR, 0), last_value(NULLIF(PDIR, 0) IGNORE NULLS) OVER "
    "(PARTITION BY company_id ORDER BY data_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pdir_filled "
    "FROM rk) SELECT t.company_id, t.data_date, t.operation_time, CASE WHEN f.pdir_filled IS NOT NULL AND "
    "(t.PDIR IS NULL OR t.PDIR = 0) AND t.data_date >= DATE '2024-01-05' THEN f.pdir_filled ELSE t.PDIR END AS PDIR, "
    "t.PD_12 FROM tbl t LEFT JOIN f ON t.company_id = f.company_id AND t.data_date = f.data_date")


def _pd_table(spark, d):
    table = scratch_path(spark, "pd-table")
    mu.with_month(fx.pd_current(spark, d)).write.mode("overwrite").partitionBy("data_month").parquet(table)
    return table


@register("job_pd_range", sql(PD_RANGE_SQL, "pd_raw", "pd_current", "rating_key"))
def q_job_pd_range(spark, d):
    root = land_delivery(spark, d, ("pd", "pdir"))
    res = jobs.pd_range(spark, root, RANGE[0], RANGE[1], OPERATION_TIME, _pd_table(spark, d),
                        snapshot=scratch_path(spark, "pd-snapshot"))
    return res.select("company_id", "data_date", "operation_time", "PDIR", "PD_12")


# ---------------------------------------------------------------- J4 / J6 backfills
@register("job_pd_backfill", sql(
    f"SELECT l.data_date, CAST(l.company_id % 25 + 1 AS INT) AS econ_id, l.company_id, DATE '2024-02-01' AS "
    f"calibration_date, {OP_SQL} AS operation_time, r.pdir AS PDIR, {', '.join('l.' + c for c in PD_COLS)} "
    f"FROM ({LATEST_SQL}) l LEFT JOIN rating_all r ON l.company_id = r.company_id AND l.data_date = r.data_date "
    "WHERE l.PDIR IS NOT NULL", "pd_raw", "rating_all"))
def q_job_pd_backfill(spark, d):
    root = scratch_path(spark, "pd-history")
    rows = fx.latest_values(spark, d).select(fx.econ_of().alias("econ_id"), *VALUE_COLS)
    write_matrix_shards(rows, root, "pd60h_", values=F.array(F.col("company_id").cast("double"), *_ymd(), *_horizons(*PD_COLS[:-1]),
                                                             _last_horizon()))
    ratings = jobs.pdir_backfill(rating_grid(spark, d))
    return jobs.pd_backfill(spark, root, ratings, "20240201", OPERATION_TIME, scratch_path(spark, "pd-backfill"))


@register("job_pdir_backfill", sql(
    "SELECT CAST(data_date AS DATE) AS data_date, CAST(company_id % 25 + 1 AS INT) AS econ_id, company_id, pdir "
    "FROM rating_all", "rating_all"))
def q_job_pdir_backfill(spark, d):
    grids = scratch_path(spark, "rating-grids")
    rating_grid(spark, d).write.mode("overwrite").parquet(grids)
    return jobs.pdir_backfill(spark.read.parquet(grids), scratch_path(spark, "pdir-backfill"))


# ---------------------------------------------------------------- J7 PDIR2
PDIR_CUR_SQL = ("SELECT data_date, CAST(company_id % 25 + 1 AS INT) AS econ_id, company_id, DATE '2024-02-01' AS "
                f"calibration_date, {OLD_OP_SQL} AS operation_time, pdir FROM rating_all "
                "WHERE data_date < DATE '2024-01-21'")


def _pdir_current(spark, d):
    rk = fx.rating_all(spark, d).where(F.col("data_date") < F.lit(CUTOFF))
    return rk.select("data_date", fx.econ_of().alias("econ_id"), "company_id",
                     F.lit(fx.CALIBRATION).alias("calibration_date"),
                     F.lit(OLD_OP).cast("timestamp_ntz").alias("operation_time"), "pdir").transform(_pdir_schema)


@register("job_pdir2_day", sql(
    f"{PDIR_CUR_SQL} UNION ALL SELECT data_date, CAST(company_id % 25 + 1 AS INT), company_id, DATE '2024-02-01', "
    f"{OP_SQL}, pdir FROM rating_all WHERE data_date = DATE '2024-01-22'", "rating_all"))
def q_job_pdir2_day(spark, d):
    root = land_delivery(spark, d, ("pdir",))
    latest = scratch_path(spark, "pdir2-latest")
    mu.with_month(_pdir_current(spark, d)).write.partitionBy("data_month").parquet(latest)
    folders = jobs.folders_in_range(spark, root, NEW_DAY, NEW_DAY)
    rows = jobs.scan_product(spark, root, folders, jobs.PDIR_SUB, "pdirNum_*", "pdir_daily")
    cal = F.to_date(F.substring("folder", -8, 8), "yyyyMMdd")
    batch = rs.prep_pdir_daily(rows, cal, OPERATION_TIME, econ_id=F.col("econ_id")).transform(_pdir_schema)
    return jobs.load_day_state(spark, batch, latest, scratch_path(spark, "pdir2-1d"),
                               scratch_path(spark, "pdir2-log"), NEW_DAY, fx.CALIBRATION, OPERATION_TIME).drop("data_month")


REV_FROM = dt.date(2024, 1, 15)
PDIR_REV_SQL = ("SELECT data_date, CAST(company_id % 25 + 1 AS INT) AS econ_id, company_id, DATE '2024-02-01' AS "
                f"calibration_date, {REV_OP_SQL} AS operation_time, least(pdir + 1, 22) AS pdir FROM rating_all "
                "WHERE data_date >= DATE '2024-01-15'")


@register("job_pdir2_revision", sql(
    f"WITH cur AS ({PDIR_CUR_SQL}), rev AS ({PDIR_REV_SQL}) SELECT * FROM cur WHERE NOT EXISTS (SELECT 1 FROM rev "
    "WHERE rev.data_date = cur.data_date AND rev.company_id = cur.company_id) UNION ALL SELECT * FROM rev",
    "rating_all"))
def q_job_pdir2_revision(spark, d):
    latest = scratch_path(spark, "pdir2-latest")
    mu.with_month(_pdir_current(spark, d)).write.partitionBy("data_month").parquet(latest)
    grid = rating_grid(spark, d)
    revised = grid.withColumn("values", F.transform("values", lambda v: F.least(v + 1, F.lit(22.0))))
    cells = rs.melt_grid(revised, ["econ_id", F.col("date_key").alias("data_date")], "firms", "values",
                         "company_id", "pdir")
    cells = cells.withColumn("company_id", F.col("company_id") / 1000)
    batch = rs.prep_pdir_revision(cells, fx.CALIBRATION, REV_OP, econ_id=F.col("econ_id"))
    batch = batch.where(F.col("data_date") >= F.lit(REV_FROM)).transform(_pdir_schema)
    return jobs.revise_state(spark, batch, latest, scratch_path(spark, "pdir2-incremental"),
                             scratch_path(spark, "pdir2-log"), daily_path=scratch_path(spark, "pdir2-1d"), day=REV_FROM).drop("data_month")


# ---------------------------------------------------------------- J8 / J9 / J10 AS
AS_CUR_SQL = (f"SELECT data_date, CAST(company_id % 25 + 1 AS INT) AS econ_id, company_id, DATE '2024-02-01' AS "
              f"calibration_date, {OLD_OP_SQL} AS operation_time, "
              + ", ".join(f"PD_{12 * i} AS cdsvalue{i}" for i in range(1, 6))
              + f" FROM ({LATEST_SQL}) l WHERE PDIR IS NOT NULL AND data_date < DATE '2024-01-21'")


def _as_current(spark, d):
    lat = _latest(spark, d).where(F.col("PDIR").isNotNull() & (F.col("data_date") < F.lit(CUTOFF)))
    return lat.select("data_date", fx.econ_of().alias("econ_id"), "company_id",
                      F.lit(fx.CALIBRATION).alias("calibration_date"),
                      F.lit(OLD_OP).cast("timestamp_ntz").alias("operation_time"),
                      *[F.col(f"PD_{12 * i}").alias(c) for i, c in enumerate(AS_COLS, 1)]).transform(_as_schema)


@register("job_as_day", sql(
    f"{AS_CUR_SQL} UNION ALL SELECT data_date, CAST(company_id % 25 + 1 AS INT), company_id, DATE '2024-02-01', "
    f"{OP_SQL}, " + ", ".join(f"PD_{12 * i}" for i in range(1, 6))
    + f" FROM ({LATEST_SQL}) l WHERE PDIR IS NOT NULL AND data_date = DATE '2024-01-22'", "pd_raw"))
def q_job_as_day(spark, d):
    root = land_delivery(spark, d, ("as",))
    latest = scratch_path(spark, "as-latest")
    mu.with_month(_as_current(spark, d)).write.partitionBy("data_month").parquet(latest)
    folders = jobs.folders_in_range(spark, root, NEW_DAY, NEW_DAY)
    batch = jobs.as_day_batch(spark, root, folders, OPERATION_TIME).transform(_as_schema)
    return jobs.load_day_state(spark, batch, latest, scratch_path(spark, "as-1d"), scratch_path(spark, "as-log"),
                               NEW_DAY, fx.CALIBRATION, OPERATION_TIME).drop("data_month")


def land_as_csv(spark, d, factor=2.0, since=REV_FROM):
    """Revision CSV shards ``<root>/econ=<id>/*.csv`` (Date, U3_ID, Y1..Y5)."""
    root = scratch_path(spark, "as-revision-csv")
    lat = _latest(spark, d).where(F.col("data_date") >= F.lit(since))
    rows = lat.select(F.col("data_date").cast("string").alias("Date"), F.col("company_id").alias("U3_ID"),
                      *[(F.col(f"PD_{12 * i}") * factor).alias(f"Y{i}") for i in range(1, 5)],
                      F.when(F.col("PDIR").isNull(), F.lit(None).cast("double"))
                      .otherwise(F.col("PD_60") * factor).alias("Y5"),
                      fx.econ_of().alias("econ"))
    rows.write.mode("overwrite").option("header", True).partitionBy("econ").csv(root)
    return root


AS_REV_SQL = (f"SELECT data_date, CAST(company_id % 25 + 1 AS INT) AS econ_id, company_id, DATE '2024-02-01' AS "
              f"calibration_date, {REV_OP_SQL} AS operation_time, "
              + ", ".join(f"PD_{12 * i} * 2.0 AS cdsvalue{i}" for i in range(1, 5))
              + ", CASE WHEN PDIR IS NULL THEN NULL ELSE PD_60 * 2.0 END AS cdsvalue5 "
              f"FROM ({LATEST_SQL}) l WHERE data_date >= DATE '2024-01-15'")


@register("job_as_revision", sql(
    f"WITH cur AS ({AS_CUR_SQL}), rev AS ({AS_REV_SQL}) SELECT * FROM cur WHERE NOT EXISTS (SELECT 1 FROM rev "
    "WHERE rev.data_date = cur.data_date AND rev.company_id = cur.company_id) UNION ALL SELECT * FROM rev",
    "pd_raw", "operation_log"))
def q_job_as_revision(spark, d):
    latest = scratch_path(spark, "as-latest")
    mu.with_month(_as_current(spark, d)).write.partitionBy("data_month").parquet(latest)
    return jobs.as_revision(spark, land_as_csv(spark, d), fx.operation_log(spark, d), latest, scratch_path(spark, "as-incremental"),
                            scratch_path(spark, "as-log"), REV_FROM, REV_OP, daily_path=scratch_path(spark, "as-1d")).drop("data_month")


@register("job_as_backfill", sql(
    f"SELECT data_date, CAST(company_id % 25 + 1 AS INT) AS econ_id, company_id, DATE '2024-02-01' AS calibration_date, "
    f"{OP_SQL} AS operation_time, " + ", ".join(f"PD_{12 * i} AS cdsvalue{i}" for i in range(1, 5))
    + ", CASE WHEN PDIR IS NULL THEN NULL ELSE PD_60 END AS cdsvalue5 FROM pd_raw", "pd_raw"))
def q_job_as_backfill(spark, d):
    root = scratch_path(spark, "as-history-csv")
    raw = fx.pd_raw(spark, d)
    raw.select(F.col("data_date").cast("string").alias("Date"), F.col("company_id").alias("U3_ID"),
               *[F.col(f"PD_{12 * i}").alias(f"Y{i}") for i in range(1, 5)],
               F.when(F.col("PDIR").isNull(), F.lit(None).cast("double")).otherwise(F.col("PD_60")).alias("Y5"),
               fx.econ_of().alias("econ")).write.mode("overwrite").option("header", True).partitionBy("econ").csv(root)
    return jobs.as_backfill(spark, root, scratch_path(spark, "as-backfill"), scratch_path(spark, "as-rejects"),
                            fx.CALIBRATION, OPERATION_TIME)


# ---------------------------------------------------------------- J11 / J12 credit events
EVENTS_SQL = ("SELECT default_date, company_id, default_type, event_id, CAST(NULL AS VARCHAR) AS additional_comments "
              "FROM credit_events_raw")


def _event_values(ev, daily=False):
    ds = F.date_format("default_date", "yyyyMMdd").cast("double")
    vals = [F.col("company_id").cast("double"), ds, F.col("event_id").cast("double")]
    if daily:
        vals.append(F.lit(0.0))
    vals += [F.col("default_type").cast("double"), ds, F.col("event_id").cast("double")]
    return F.array(*vals)


@register("job_events_full", sql(EVENTS_SQL, "credit_events_raw"))
def q_job_events_full(spark, d):
    root = scratch_path(spark, "events-history")
    ev = fx.credit_events_raw(spark, d)
    rows = ev.select((F.col("company_id") % 4 + 1).alias("region"), _event_values(ev).alias("values"))
    write_matrix_shards(rows, root, "CreditEvent_", key="region")
    return jobs.events_full(spark, root, scratch_path(spark, "events-table"))


EV_FROM, EV_TO = dt.date(1995, 7, 1), dt.date(1998, 12, 31)
EVENTS_DAILY_SQL = (
    "WITH cur AS (SELECT default_date, company_id, default_type, event_id, CAST(NULL AS VARCHAR) AS "
    "additional_comments FROM credit_events_raw WHERE default_date < DATE '1996-01-01'), "
    "bat AS (SELECT DISTINCT default_date, company_id, default_type, event_id, CAST(NULL AS VARCHAR) AS "
    "additional_comments FROM credit_events_raw WHERE CAST(date_trunc('month', default_date) AS DATE) BETWEEN "
    "DATE '1995-07-01' AND DATE '1998-12-31') "
    "SELECT * FROM cur WHERE NOT EXISTS (SELECT 1 FROM bat WHERE bat.company_id = cur.company_id AND "
    "bat.default_date = cur.default_date AND bat.default_type = cur.default_type AND bat.event_id = cur.event_id) "
    "UNION ALL SELECT * FROM bat")


@register("job_events_daily", sql(EVENTS_DAILY_SQL, "credit_events_raw"))
def q_job_events_daily(spark, d):
    root, table = land_events_daily(spark, d)
    return jobs.events_daily(spark, root, EV_FROM, EV_TO, table).drop(jobs.EVENT_MONTH)


def land_events_daily(spark, d, day=None):
    """Event deliveries (4 region shards each), in a folder a month or on the given day
    (a column), and the event table, by month, as loaded before 1996."""
    root = scratch_path(spark, "events-delivery")
    ev = mu.staged(fx.credit_events_raw(spark, d), "events-raw")      # range bounds, shards and table read it
    day = F.trunc("default_date", "month") if day is None else day
    folder = F.concat(F.date_format(day, "yyyyMMdd"), F.lit("_cali_20240201/Products/CompanyFlow"))
    rows = ev.select((F.col("company_id") % 4 + 1).alias("region"), folder.alias("folder"), "*")
    write_matrix_shards(rows, root, "NewCreditEvent_Region_", key="region", folder="folder", values=_event_values(ev, daily=True))
    table = scratch_path(spark, "events-table")
    old = ev.where(F.col("default_date") < F.lit(dt.date(1996, 1, 1))).select(
        "default_date", "company_id", "default_type", "event_id", F.lit(None).cast("string").alias("additional_comments"))
    mu.with_month(old, "default_date", jobs.EVENT_MONTH).write.partitionBy(jobs.EVENT_MONTH).parquet(table)
    return root, table


# ---------------------------------------------------------------- J13 exclusions
EXCL_SINCE = dt.date(2024, 1, 10)


@register("job_exclusions", sql(
    "WITH cur AS (SELECT CAST(NULL AS VARCHAR) AS region, company_id, CAST(NULL AS BIGINT) AS country_id, ticker, "
    "CAST(NULL AS VARCHAR) AS company_name, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS remark, "
    "start_date, end_date, CAST(NULL AS DATE) AS error_found_date, CAST(NULL AS VARCHAR) AS sql_query, "
    "CAST(NULL AS VARCHAR) AS stop_reason, CAST(NULL AS VARCHAR) AS internal_remarks FROM excluded_companies), "
    "reg AS (SELECT r_name AS region, e.company_id, CAST(NULL AS BIGINT) AS country_id, e.ticker, "
    "e.ticker AS company_name, CASE WHEN e.end_date IS NULL THEN 'open' END AS reason, 'updated' AS remark, "
    "e.start_date, e.end_date, CAST(NULL AS DATE) AS error_found_date, CAST(NULL AS VARCHAR) AS sql_query, "
    "CAST(NULL AS VARCHAR) AS stop_reason, CAST(NULL AS VARCHAR) AS internal_remarks FROM excluded_companies e "
    "JOIN customer c ON c.c_custkey = e.company_id JOIN nation ON c_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey WHERE e.start_date >= DATE '2024-01-10' "
    "OR e.end_date >= DATE '2024-01-10') "
    "SELECT * FROM cur WHERE NOT EXISTS (SELECT 1 FROM reg WHERE reg.ticker = cur.ticker AND "
    "reg.start_date = cur.start_date) UNION ALL SELECT * FROM reg", "excluded_companies"))
def q_job_exclusions(spark, d):
    reg_path, table = land_exclusions(spark, d)
    return jobs.exclusions_load(spark, reg_path, EXCL_SINCE, table, scratch_path(spark, "exclusions-v2"))


def land_exclusions(spark, d):
    """The exclusion registry sheet (remarks updated) and the exclusion table."""
    from riskloom.plans.q_sources import registry_sheet
    from riskloom.schemas import EXCLUDED_COMPANIES
    reg_path = scratch_path(spark, "registry")
    registry_sheet(spark, d).withColumn("rm", F.lit("updated")).write.mode("overwrite").option("header", True) \
        .csv(reg_path)
    table = scratch_path(spark, "exclusions")
    ex = fx.excluded_companies(spark, d)
    cur = ex.select(F.lit(None).cast("string").alias("region"), "company_id",
                    F.lit(None).cast("bigint").alias("country_id"), "ticker",
                    *[F.lit(None).cast("string").alias(c) for c in ("company_name", "reason", "remark")],
                    "start_date", "end_date", F.lit(None).cast("date").alias("error_found_date"),
                    *[F.lit(None).cast("string").alias(c) for c in ("sql_query", "stop_reason", "internal_remarks")])
    cur.to(EXCLUDED_COMPANIES).write.mode("overwrite").parquet(table)
    return reg_path, table


# ---------------------------------------------------------------- J14 daily run
#: Economies that the daily run requires: three files a day, cut by company.
RUN_ECONOMIES = (1, 2, 3)


def land_daily_run(spark, d):
    """A delivery of PD and rating shards for every day, cut into three economies."""
    def build(root):
        lat, econ = fx.latest_values(spark, d), (F.col("company_id") % 3 + 1).cast("int").alias("econ_id")
        key = F.col("company_id").cast("double")
        write_matrix_shards(lat.select(econ, _folder(F.col("data_date"), "P2_Pd").alias("folder"), *VALUE_COLS), root, "pd60h_",
                            folder="folder", values=F.array(key, *_ymd(), *_horizons(*PD_COLS[:-1]), _last_horizon()))
        write_matrix_shards(fx.rating_key(spark, d).select(econ, _folder(F.col("data_date"), "P3_Pdir").alias("folder"), F.array(
            key, *_ymd(), F.col("pdir")).alias("values")), root, "pdirNum_", folder="folder")
    return landed_fixture(spark, "delivery-daily-run", d, build)


def daily_run_tables(spark, d):
    """A run over the range with registry, credit events and refresh; an economy too many is a gap, which stops it
    before anything is loaded.  Returns (website, exclusions, events, whether the gap was reported)."""
    root, table = land_daily_run(spark, d), _pd_table(spark, d)
    registry, excluded = land_exclusions(spark, d)
    ev_root, ev_table = land_events_daily(spark, d, F.date_add(F.lit(RANGE[0]), F.col("event_id").cast("int") % 5))
    out, new_excluded, log = (scratch_path(spark, f"daily-run-{n}") for n in ("derived", "excluded", "log"))
    companies = fx.companies_mapping_info(spark, d)

    def run(econs):
        jobs.daily_run(spark, root, RANGE[0], RANGE[1], OPERATION_TIME, table, econs, log, registry=registry,
                       exclusions=(excluded, new_excluded), events=(ev_root, ev_table),
                       refresh=(companies, fx.excluded_companies(spark, d), out))

    try:
        run([*RUN_ECONOMIES, 4])
        gap = False
    except RuntimeError as e:
        gap = "pd60h_4" in str(e)
    run(RUN_ECONOMIES)
    return spark.read.parquet(f"{out}/website"), spark.read.parquet(new_excluded), spark.read.parquet(ev_table), gap


DAILY_RUN_SQL = (
    f"WITH tbl AS (SELECT * FROM pd_current UNION ALL SELECT l.company_id, l.data_date, DATE '2024-02-01', {OP_SQL}, "
    f"0.0, {', '.join('l.' + c for c in PD_COLS)} FROM ({LATEST_SQL}) l WHERE l.PDIR IS NOT NULL AND l.data_date "
    "BETWEEN DATE '2024-01-15' AND DATE '2024-01-19'), "
    "newest AS (SELECT company_id, data_date, max(operation_time) AS operation_time FROM tbl GROUP BY ALL), "
    "served AS (SELECT t.*, c.region_id FROM tbl t JOIN newest USING (company_id, data_date, operation_time) "
    "JOIN companies_mapping_info c USING (company_id)), "
    "shut AS (SELECT company_id, start_date, coalesce(end_date, DATE '9999-12-31') AS end_date FROM excluded_companies) "
    "SELECT company_id AS CompanyID, data_date AS DTDate, data_date AS FSDate, "
    + ", ".join(f"PD_{h} AS DFT{i}" for i, h in enumerate(WEBSITE_HORIZONS, 1))
    + ", region_id AS RegionFlag, 0 AS Draft, (SELECT count(*) FROM excluded_companies) AS n_exclusions, "
    "(SELECT count(*) FROM credit_events_raw) AS n_events, true AS gap_found FROM served s "
    "WHERE (SELECT count(*) FROM shut x WHERE x.company_id = s.company_id AND s.data_date BETWEEN x.start_date AND x.end_date) = 0")


@register("job_daily_run", sql(DAILY_RUN_SQL, "pd_raw", "pd_current", "companies_mapping_info", "excluded_companies", "credit_events_raw"))
def q_job_daily_run(spark, d):
    web, excluded, events, gap = daily_run_tables(spark, d)
    counts = excluded.agg(F.count(F.lit(1)).alias("n_exclusions")).crossJoin(events.agg(F.count(F.lit(1)).alias("n_events")))   # one row
    return web.drop("Updated").crossJoin(counts).withColumn("gap_found", F.lit(gap))


# ---------------------------------------------------------------- J15 users
def _user_sql():
    from riskloom.schemas import USER_BOOL_FIELDS, USER_DEFAULTS, USER_JSON_FIELDS
    given = {"Email": "email", "Industry": "industry"}
    cols = []
    for src, dst in USER_JSON_FIELDS.items():
        if src == "BudaAccess":
            cols.append(f"COALESCE(upper(buda_access) = 'Y', false) AS {dst}")
        elif src in USER_BOOL_FIELDS:
            cols.append(f"false AS {dst}")
        elif src in given:
            cols.append(f"{given[src]} AS {dst}")
        elif dst in USER_DEFAULTS:
            cols.append(f"'{USER_DEFAULTS[dst]}' AS {dst}")
        else:
            cols.append(f"CAST(NULL AS VARCHAR) AS {dst}")
    cols += ["true AS dashboard_access", "CAST(NULL AS TIMESTAMP) AS last_login"]
    return "SELECT " + ", ".join(cols) + " FROM users_flat"


@register("job_user_load", sql(_user_sql(), "users_flat"))
def q_job_user_load(spark, d):
    from riskloom.plans.q_sources import USER_JSON_SCHEMA, land_users_json
    from riskloom.sources.readers import read_json_records
    users = read_json_records(spark, land_users_json(spark, d), USER_JSON_SCHEMA)
    table = scratch_path(spark, "users")
    jobs.user_load(spark, users.where(F.col("BudaAccess") == "Y"), table)   # users migrated earlier
    res = jobs.user_load(spark, users, table)
    return res.drop("id")


# ---------------------------------------------------------------- K1 streaming ingest
@register("stream_ingest_latest", sql(LATEST_SQL, "pd_raw"))
def q_stream_ingest_latest(spark, d):
    from riskloom.streaming.ingest import ingest_available, latest_view
    src = scratch_path(spark, "landing")
    raw = fx.pd_raw(spark, d)
    # three deliveries (by data day) land in one write; the middle one is re-sent later
    delivery = (F.when(F.col("data_date") < F.lit(dt.date(2024, 1, 11)), F.lit(0))
                .when(F.col("data_date") < F.lit(dt.date(2024, 1, 21)), F.lit(1)).otherwise(F.lit(2)))
    raw.withColumn("delivery", delivery).write.partitionBy("delivery").parquet(src)
    table = scratch_path(spark, "stream-table")
    ckpt = scratch_path(spark, "stream-ckpt")
    ingest_available(spark, f"{src}/delivery=*", raw.schema, table, ckpt, max_files_per_trigger=64)
    (spark.read.parquet(f"{src}/delivery=1").write.parquet(f"{src}/delivery=9"))   # the re-sent delivery
    ingest_available(spark, f"{src}/delivery=*", raw.schema, table, ckpt)
    return latest_view(spark, table)



# ---------------------------------------------------------------- C9 + K1 completeness gate
#: Economies that a complete delivery holds (the fixture's files are cut by them).
GATE_ECONOMIES = range(1, 26)
GAP_ECONOMY, LATE_ECONOMY = 7, 3


def _gate_fixture(spark, d):
    """PD rows with the folder they are delivered in: economy 7 never delivers on every sixth day of a month."""
    raw = fx.pd_raw(spark, d).withColumn("econ_id", fx.econ_of())
    raw = raw.where(~((F.dayofmonth("data_date") % 6 == 0) & (F.col("econ_id") == GAP_ECONOMY)))
    return raw.withColumn("folder", F.concat(F.date_format("data_date", "yyyyMMdd"), F.lit("_cali_20240201")))


def _land(rows, landing):
    rows.repartition("folder", "econ_id").write.mode("append").partitionBy("folder", "econ_id").parquet(landing)


def gated_ingest(spark, d):
    """Three landings, the stream started anew from its checkpoint after each:
    all but economy 3 of every fifth day; the late files; files of released days sent again with other values."""
    from riskloom.streaming.gate import ingest_complete
    landing, table, log, ckpt = (scratch_path(spark, f"gate-{n}") for n in ("landing", "table", "log", "ckpt"))
    rows = _gate_fixture(spark, d)
    late = (F.dayofmonth("data_date") % 5 == 0) & (F.col("econ_id") == LATE_ECONOMY)
    schema = fx.pd_raw(spark, d).schema
    for part in (rows.where(~late), rows.where(late),
                 rows.where((F.dayofmonth("data_date") == 1) & (F.col("econ_id") == 1)).withColumn("PDIR", F.lit(-1.0))):
        _land(part, landing)
        ingest_complete(spark, landing, schema, table, log, ckpt, GATE_ECONOMIES)
    return table, log


_GATE_SQL = ("gated AS (SELECT *, CAST(company_id % 25 + 1 AS INT) AS econ_id FROM pd_raw "
             "WHERE NOT (day(data_date) % 6 = 0 AND company_id % 25 + 1 = 7)), "
             "complete AS (SELECT data_date FROM gated GROUP BY data_date HAVING count(DISTINCT econ_id) = 25)")


@register("stream_gate_released", sql(
    f"WITH {_GATE_SQL} SELECT strftime(data_date, '%Y%m%d') || '_cali_20240201' AS folder, CAST(25 AS INT) AS n_economies FROM complete",
    "pd_raw"))
def q_stream_gate_released(spark, d):
    from riskloom.streaming.gate import released_days
    return released_days(spark, gated_ingest(spark, d)[1])


@register("stream_gate_panel", sql(
    f"WITH {_GATE_SQL} SELECT * EXCLUDE (econ_id) FROM gated WHERE data_date IN (SELECT data_date FROM complete) "
    "QUALIFY row_number() OVER (PARTITION BY data_date, company_id ORDER BY operation_time DESC) = 1", "pd_raw"))
def q_stream_gate_panel(spark, d):
    """The latest view of what the gate let in: rows of complete days only, each day as it was when released."""
    from riskloom.streaming.ingest import latest_view
    return latest_view(spark, gated_ingest(spark, d)[0])


# ---------------------------------------------------------------- runs that are repeated
@register("job_pd_range_rerun", sql(PD_RANGE_SQL, "pd_raw", "pd_current", "rating_key"))
def q_job_pd_range_rerun(spark, d):
    """The range loaded twice: the second run adds nothing."""
    root, table = land_delivery(spark, d, ("pd", "pdir")), _pd_table(spark, d)
    jobs.pd_range(spark, root, RANGE[0], RANGE[1], OPERATION_TIME, table)
    res = jobs.pd_range(spark, root, RANGE[0], RANGE[1], OPERATION_TIME, table)
    return res.select("company_id", "data_date", "operation_time", "PDIR", "PD_12")
