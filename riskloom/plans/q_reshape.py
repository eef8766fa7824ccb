"""Catalogue entries for projection, cleaning, dates, grids, rating and the
per-product prepare layouts (SURVEY B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import fixtures as fx
from riskloom.fixtures import sql
from riskloom.functions import clean as cl
from riskloom.functions import dates as dts
from riskloom.functions.rating import rating_grade, rating_grade_sql
from riskloom.operators import reshape as rs
from riskloom.operators import windows as win
from riskloom.plans.catalog import CALIBRATION, LATEST_SQL, OPERATION_TIME, register
from riskloom.session import scratch_path
from riskloom.schemas import AS_COLS, COMPANY_DEFAULTS, OPEN_END_TEXT, PD_COLS, SIMPLE_HORIZONS

OP_SQL = "TIMESTAMP '2024-02-02 06:00:00'"


def _latest(spark, d):
    return win.latest_version(fx.pd_raw(spark, d))


# ---------------------------------------------------------------- inputs shaped like source files
def as_daily_named(spark, d):
    """Daily AS matrix rows: company, y/m/d, cdsvalue1..5 (= PD at 12..60 months;
    NaN where the PD row lacks a rating)."""
    m = fx.pd_matrix_named(spark, d)
    return m.select("econ_id", "company_id", "yyyy", "mm", "dd",
                    *[F.col(f"PD_{12 * i}").alias(c) for i, c in enumerate(AS_COLS, 1)])


AS_DAILY_SQL = ("SELECT econ_id, company_id, yyyy, mm, dd, "
                + ", ".join(f"PD_{12 * i} AS cdsvalue{i}" for i in range(1, 6)) + " FROM pd_matrix_named")


def as_csv_rows(spark, d):
    """AS CSV rows: Date text, U3_ID, Y1..Y5 (Y5 empty where the rating is missing)."""
    raw = fx.pd_raw(spark, d)
    return raw.select(F.col("data_date").cast("string").alias("Date"), F.col("company_id").alias("U3_ID"),
                      *[F.col(f"PD_{12 * i}").alias(f"Y{i}") for i in range(1, 5)],
                      F.when(F.col("PDIR").isNull(), F.lit(None).cast("double")).otherwise(F.col("PD_60")).alias("Y5"))


def pdir_daily_named(spark, d):
    raw = fx.pd_raw(spark, d)
    return raw.select(fx.econ_of().alias("econ_id"), F.col("company_id").cast("double").alias("company_id"),
                      F.year("data_date").cast("double").alias("yyyy"), F.month("data_date").cast("double").alias("mm"),
                      F.dayofmonth("data_date").cast("double").alias("dd"),
                      F.coalesce(F.col("PDIR"), F.lit(float("nan"))).alias("pdir"))


def rating_grid(spark, d):
    """Rating grid rows as delivered per economy: one row per date (yyyymmdd)
    with the firm ids (company_id x 1000) and their ratings, firm-sorted."""
    rk = fx.rating_all(spark, d)
    cells = rk.select(fx.econ_of().alias("econ_id"),
                      F.date_format("data_date", "yyyyMMdd").cast("double").alias("date_key"),
                      (F.col("company_id") * 1000).cast("double").alias("firm"), "pdir")
    return rs.transpose_grid(cells, ["econ_id"], "firm", "date_key", "pdir", "firms", "values")


RATING_CELLS_SQL = ("SELECT CAST(company_id % 25 + 1 AS INT) AS econ_id, CAST(strftime(data_date, '%Y%m%d') "
                    "AS DOUBLE) AS data_date, CAST(company_id * 1000 AS DOUBLE) AS company_id, pdir FROM rating_all")


# ---------------------------------------------------------------- B1-B3
register("proj_positional", sql("SELECT * FROM pd_matrix_named", "pd_matrix_named"))(
    lambda spark, d: rs.name_positional(fx.pd_matrix_rows(spark, d), "pd_daily", keep=["econ_id"]))

register("proj_horizons", sql(
    "SELECT company_id, data_date, " + ", ".join(f"PD_{h}" for h in SIMPLE_HORIZONS) + f" FROM ({LATEST_SQL}) l",
    "pd_raw"))(
    lambda spark, d: _latest(spark, d).select("company_id", "data_date",
                                              *rs.horizon_columns("PD_", SIMPLE_HORIZONS)))

register("proj_reorder", sql(
    "SELECT data_date, company_id, operation_time, PDIR AS pdir, PD_1, PD_12 FROM pd_raw", "pd_raw"))(
    lambda spark, d: rs.reorder(fx.pd_raw(spark, d), ["data_date", "company_id", "operation_time", "pdir", "PD_1",
                                                      "PD_12"], rename={"PDIR": "pdir"}, drop=["calibration_date"]))


# ---------------------------------------------------------------- B4-B10 dates, ids, casts, stamps
@register("date_assemble", sql(
    "SELECT company_id, CAST(operation_time AS DATE) AS data_date, count(*) AS n_rows FROM pd_raw GROUP BY ALL", "pd_raw"))
def q_date_assemble(spark, d):
    """The parts of every row's real date, put together again."""
    p = fx.pd_raw(spark, d).select("company_id", F.year("operation_time").cast("double").alias("yyyy"),
                                   F.month("operation_time").cast("double").alias("mm"),
                                   F.dayofmonth("operation_time").cast("double").alias("dd"))
    return (p.select("company_id", dts.date_from_parts("yyyy", "mm", "dd").alias("data_date"))
            .groupBy("company_id", "data_date").agg(F.count(F.lit(1)).alias("n_rows")))


@register("date_assemble_coerce", sql(
    "SELECT event_id, CASE WHEN dd <= day(last_day(make_date(yyyy, mm, 1))) THEN make_date(yyyy, mm, dd) END "
    "AS data_date FROM ymd_parts", "ymd_parts"))
def q_date_assemble_coerce(spark, d):
    return fx.ymd_parts(spark, d).select(
        "event_id", dts.date_from_parts_coerce("yyyy", "mm", "dd").alias("data_date"))


@register("date_from_int", sql(
    "SELECT company_id, event_id, default_type, CAST(strptime(CAST(CAST(CAST(strftime(default_date, '%Y%m%d') "
    "AS DOUBLE) AS BIGINT) AS VARCHAR), '%Y%m%d') AS DATE) AS default_date FROM credit_events_raw",
    "credit_events_raw"))
def q_date_from_int(spark, d):
    ev = fx.credit_events_raw(spark, d).select(
        "company_id", "event_id", "default_type",
        F.date_format("default_date", "yyyyMMdd").cast("double").alias("DateStr"))
    return ev.select("company_id", "event_id", "default_type", dts.date_from_yyyymmdd("DateStr").alias("default_date"))


@register("date_format", sql(
    "SELECT DISTINCT data_date, strftime(data_date, '%Y-%m-%d') AS iso_date, strftime(data_date, '%Y%m%d') "
    "AS compact_date FROM pd_raw", "pd_raw"))
def q_date_format(spark, d):
    return (fx.pd_raw(spark, d).select("data_date").distinct()
            .select("data_date", dts.format_date("data_date", "iso").alias("iso_date"),
                    dts.format_date("data_date", "compact").alias("compact_date")))


register("id_rescale", sql(
    "SELECT event_id, CAST(raw_company_id // 1000 AS VARCHAR) AS company_id FROM ymd_parts", "ymd_parts"))(
    lambda spark, d: fx.ymd_parts(spark, d).select(
        "event_id", cl.rescale_id("raw_company_id", 1000).alias("company_id")))


@register("cast_columns", sql(
    "SELECT CAST(event_id AS VARCHAR) AS event_key, CAST(trunc(value) AS BIGINT) AS value_int, "
    "TRY_CAST(substr(props, 7, 2) AS INTEGER) AS k, TRY_CAST(props AS INTEGER) AS props_int FROM events"))
def q_cast_columns(spark, d):
    ev = fx.table(spark, d, "events")
    return ev.select(F.col("event_id").cast("string").alias("event_key"),
                     F.col("value").cast("bigint").alias("value_int"),
                     F.expr("try_cast(substr(props, 7, 2) as int)").alias("k"),
                     F.expr("try_cast(props as int)").alias("props_int"))


@register("stamp_load", sql(
    f"SELECT data_date, -99 AS econ_id, company_id, DATE '2024-02-01' AS calibration_date, {OP_SQL} AS "
    f"operation_time FROM ({LATEST_SQL}) l", "pd_raw"))
def q_stamp_load(spark, d):
    keys = _latest(spark, d).select("data_date", "company_id")
    return rs.stamp(keys, CALIBRATION, OPERATION_TIME).select(
        "data_date", "econ_id", "company_id", "calibration_date", "operation_time")


# ---------------------------------------------------------------- B11-B14 cleaning
register("clean_cells", sql(
    "SELECT event_id, CASE WHEN lower(trim(cell)) IN ('nan', 'nat', '') THEN NULL ELSE trim(cell) END AS cell "
    "FROM dirty_text", "dirty_text"))(
    lambda spark, d: cl.clean_all(fx.dirty_text(spark, d)))


@register("normalize_record", sql(
    "SELECT CAST(company_id AS BIGINT) AS company_id, strftime(make_date(CAST(yyyy AS INT), CAST(mm AS INT), "
    "CAST(dd AS INT)), '%Y-%m-%d') AS data_date, CASE WHEN isnan(PD_60) THEN NULL ELSE PD_60 END AS PD_60 "
    "FROM pd_matrix_named", "pd_matrix_named"))
def q_normalize_record(spark, d):
    m = fx.pd_matrix_named(spark, d)
    rec = m.select(F.col("company_id").cast("bigint").alias("company_id"),
                   dts.date_from_parts("yyyy", "mm", "dd").alias("data_date"), "PD_60")
    return cl.normalize_record(rec)


@register("fill_sentinels", sql(
    f"SELECT l.company_id, l.data_date, COALESCE(r.pdir, 0) AS pdir, -99 AS econ_id FROM ({LATEST_SQL}) l "
    "LEFT JOIN rating_key r ON l.company_id = r.company_id AND l.data_date = r.data_date", "pd_raw", "rating_key"))
def q_fill_sentinels(spark, d):
    j = _latest(spark, d).select("company_id", "data_date").join(fx.rating_key(spark, d), ["company_id", "data_date"],
                                                                  "left")
    return cl.fill_by_type(j.withColumn("econ_id", F.lit(None).cast("int")), {"pdir": 0.0, "econ_id": -99})


@register("fill_open_end", sql(
    f"SELECT company_id, ticker, CAST(start_date AS VARCHAR) AS start_date, COALESCE(CAST(end_date AS VARCHAR), "
    f"'{OPEN_END_TEXT}') AS end_date FROM excluded_companies", "excluded_companies"))
def q_fill_open_end(spark, d):
    ex = fx.excluded_companies(spark, d)
    return cl.fill_by_type(ex.select("company_id", "ticker", F.col("start_date").cast("string").alias("start_date"),
                                     "end_date"), {"end_date": OPEN_END_TEXT})


@register("apply_defaults", sql(
    "SELECT p.company_id, COALESCE(m.domicile_id, 99999) AS domicile_id, "
    "COALESCE(m.country_domicile, 'Unknown Domicile') AS country_domicile, COALESCE(m.region_id, 99999) AS region_id, "
    "COALESCE(m.region, 'Unknown Region') AS region, COALESCE(m.industry_sector, 'Unclassifiable') AS industry_sector "
    "FROM (SELECT DISTINCT company_id FROM pd_raw) p LEFT JOIN companies_mapping_info m ON p.company_id = m.company_id",
    "pd_raw", "companies_mapping_info"))
def q_apply_defaults(spark, d):
    co = fx.pd_raw(spark, d).select("company_id").distinct().join(
        fx.companies_mapping_info(spark, d).drop("company_name"), "company_id", "left")
    keys = ["domicile_id", "country_domicile", "region_id", "region", "industry_sector"]
    res = cl.with_defaults(co, {k: COMPANY_DEFAULTS[k] for k in keys})
    return res.select("company_id", *[F.col(k).cast("bigint").alias(k) if k.endswith("_id") else F.col(k)
                                      for k in keys])


# ---------------------------------------------------------------- B15/B16 grids
@register("melt_matrix", sql(RATING_CELLS_SQL, "rating_all"))
def q_melt_matrix(spark, d):
    return rs.melt_grid(rating_grid(spark, d), ["econ_id", F.col("date_key").alias("data_date")], "firms", "values",
                        "company_id", "pdir").select("econ_id", "data_date", "company_id", "pdir")


@register("melt_wide", sql(
    f"UNPIVOT (SELECT company_id, data_date, {', '.join(PD_COLS)} FROM ({LATEST_SQL}) l) ON "
    f"{', '.join(PD_COLS)} INTO NAME horizon VALUE pd", "pd_raw"))
def q_melt_wide(spark, d):
    return rs.melt_wide(_latest(spark, d).select("company_id", "data_date", *PD_COLS), ["company_id", "data_date"],
                        PD_COLS, "horizon", "pd")


@register("transpose_matrix", sql(
    "SELECT econ_id, company_id, count(*) AS n_dates, string_agg(CAST(CAST(data_date AS BIGINT) AS VARCHAR), ',' "
    "ORDER BY data_date) AS dates, string_agg(CAST(CAST(pdir AS BIGINT) AS VARCHAR), ',' ORDER BY data_date) AS ratings "
    f"FROM ({RATING_CELLS_SQL}) c GROUP BY econ_id, company_id", "rating_all"))
def q_transpose(spark, d):
    cells = rs.melt_grid(rating_grid(spark, d), ["econ_id", "date_key"], "firms", "values", "company_id", "pdir")
    t = rs.transpose_grid(cells, ["econ_id"], "date_key", "company_id", "pdir", "dates", "ratings")
    return t.select("econ_id", "company_id", F.size("dates").cast("bigint").alias("n_dates"),
                    F.array_join(F.transform("dates", lambda x: x.cast("bigint").cast("string")), ",").alias("dates"),
                    F.array_join(F.transform("ratings", lambda x: x.cast("bigint").cast("string")), ",").alias("ratings"))


# ---------------------------------------------------------------- B17, B18-B25
@register("rating_grade", sql(
    "SELECT company_id, operation_time, PD_12, " + rating_grade_sql("PD_12") + " AS grade FROM pd_raw", "pd_raw"))
def q_rating_grade(spark, d):
    return fx.pd_raw(spark, d).select("company_id", "operation_time", "PD_12", rating_grade("PD_12").alias("grade"))


@register("parse_bool", sql(
    "SELECT user_key, COALESCE(upper(buda_access) = 'Y', false) AS buda_access, "
    "COALESCE(user_key % 2 = 1, false) AS odd_flag FROM users_flat", "users_flat"))
def q_parse_bool(spark, d):
    from pyspark.sql import types as T
    u = fx.users_flat(spark, d)
    return u.select("user_key", cl.parse_bool("buda_access").alias("buda_access"),
                    cl.parse_bool(F.col("user_key") % 2, T.LongType()).alias("odd_flag"))


@register("surrogate_id", sql(
    "SELECT count(*) AS n_rows, count(*) AS n_ids, count(*) AS n_uuid, count(DISTINCT user_key) AS n_users FROM users_flat",
    "users_flat"))
def q_surrogate_id(spark, d):
    """Ids are random, so what is compared is that they are UUIDs and distinct;
    they are written once, then read."""
    path = scratch_path(spark, "surrogate")
    fx.users_flat(spark, d).select(F.expr("uuid()").alias("id"), "user_key", "email").write.parquet(path)
    uuid = F.col("id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids"),
                                        F.count(F.when(uuid, 1)).alias("n_uuid"), F.countDistinct("user_key").alias("n_users"))


EXCL_SHEET_SQL = (
    "SELECT r_name AS \"Region\", CAST(e.company_id AS VARCHAR) AS \"Company Number\", n_name AS country, "
    "e.ticker AS \"Ticker\", e.ticker AS \"Company Name\", CAST(e.start_date AS VARCHAR) AS \"Excluded Since (PD date)\", "
    f"COALESCE(CAST(e.end_date AS VARCHAR), '{OPEN_END_TEXT}') AS \"Stopped Excluding On (PD date)\", "
    f"'{OPEN_END_TEXT}' AS \"Date the error was found\", CAST(e.company_id AS VARCHAR) AS \"No.\" "
    "FROM excluded_companies e JOIN customer c ON c.c_custkey = e.company_id JOIN nation ON c_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey")


def exclusion_sheet(spark, d):
    """The exclusion spreadsheet as delivered (typed cells, blanks as NULL)."""
    ex = fx.excluded_companies(spark, d)
    c = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("company_id"), F.col("c_nationkey").alias("nat"))
    n = fx.table(spark, d, "nation").select(F.col("n_nationkey").alias("nat"), "n_name", F.col("n_regionkey").alias("reg"))
    r = fx.table(spark, d, "region").select(F.col("r_regionkey").alias("reg"), "r_name")
    j = ex.join(c, "company_id").join(n, "nat").join(r, "reg")
    return j.select(F.col("r_name").alias("Region"), F.col("company_id").alias("Company Number"),
                    F.col("n_name").alias("country"), F.col("ticker").alias("Ticker"),
                    F.col("ticker").alias("Company Name"), F.col("start_date").alias("Excluded Since (PD date)"),
                    F.col("end_date").alias("Stopped Excluding On (PD date)"),
                    F.lit(None).cast("date").alias("Date the error was found"),
                    F.col("company_id").alias("No."))


register("prep_exclusions", sql(EXCL_SHEET_SQL, "excluded_companies"))(
    lambda spark, d: rs.prep_exclusions(exclusion_sheet(spark, d)))


@register("last_trading_day", sql(
    "SELECT DISTINCT data_date, CAST(data_date - CAST(greatest(0, isodow(data_date) - 5) AS INT) AS DATE) "
    "AS trading_day FROM pd_raw", "pd_raw"))
def q_last_trading_day(spark, d):
    return (fx.pd_raw(spark, d).select("data_date").distinct()
            .select("data_date", dts.last_trading_day("data_date").alias("trading_day")))


@register("relative_date", sql(
    "SELECT DISTINCT data_date, CAST(data_date - 2 AS DATE) AS daily_target, CAST(data_date - 6 AS DATE) "
    "AS revision_target, CAST(data_date - 1 AS DATE) AS upload_target FROM pd_raw", "pd_raw"))
def q_relative_date(spark, d):
    from riskloom.schemas import OFFSET_DAILY, OFFSET_REVISION, OFFSET_UPLOAD
    return (fx.pd_raw(spark, d).select("data_date").distinct()
            .select("data_date", dts.relative_date("data_date", OFFSET_DAILY).alias("daily_target"),
                    dts.relative_date("data_date", OFFSET_REVISION).alias("revision_target"),
                    dts.relative_date("data_date", OFFSET_UPLOAD).alias("upload_target")))


# ---------------------------------------------------------------- B26 prepare layouts
def _no_nan(cols):
    return " AND ".join(f"NOT isnan({c})" for c in cols)


PREP_PD_DAILY_SQL = (
    "SELECT make_date(CAST(yyyy AS INT), CAST(mm AS INT), CAST(dd AS INT)) AS data_date, econ_id, "
    f"CAST(company_id AS BIGINT) AS company_id, DATE '2024-02-01' AS calibration_date, {OP_SQL} AS operation_time, "
    f"{', '.join(PD_COLS)} FROM pd_matrix_named WHERE {_no_nan(PD_COLS)}")


@register("prep_pd_daily", sql(PREP_PD_DAILY_SQL, "pd_matrix_named"))
def q_prep_pd_daily(spark, d):
    return rs.prep_pd_daily(fx.pd_matrix_named(spark, d), CALIBRATION, OPERATION_TIME, econ_id=F.col("econ_id"))


@register("prep_pd_revision", sql(
    "SELECT CAST(strptime(CAST(CAST(yyyy * 10000 + mm * 100 + dd AS BIGINT) AS VARCHAR), '%Y%m%d') AS DATE) "
    f"AS data_date, -99 AS econ_id, CAST(trunc(company_id * 1000 / 1000) AS BIGINT) AS company_id, "
    f"DATE '2024-02-01' AS calibration_date, {OP_SQL} AS operation_time, {', '.join(PD_COLS)} FROM pd_matrix_named "
    f"WHERE {_no_nan(PD_COLS)}", "pd_matrix_named"))
def q_prep_pd_revision(spark, d):
    m = fx.pd_matrix_named(spark, d)
    rows = m.select((F.col("company_id") * 1000).alias("company_id"),
                    (F.col("yyyy") * 10000 + F.col("mm") * 100 + F.col("dd")).alias("data_date"), *PD_COLS)
    return rs.prep_pd_revision(rows, CALIBRATION, OPERATION_TIME)


@register("prep_as_daily", sql(
    "SELECT make_date(CAST(yyyy AS INT), CAST(mm AS INT), CAST(dd AS INT)) AS data_date, econ_id, "
    f"CAST(company_id AS BIGINT) AS company_id, DATE '2024-02-01' AS calibration_date, {OP_SQL} AS operation_time, "
    f"{', '.join(AS_COLS)} FROM ({AS_DAILY_SQL}) a WHERE {_no_nan(AS_COLS)}", "pd_matrix_named"))
def q_prep_as_daily(spark, d):
    return rs.prep_as_daily(as_daily_named(spark, d), CALIBRATION, OPERATION_TIME, econ_id=F.col("econ_id"))


@register("prep_as_file", sql(
    f"SELECT data_date, -99 AS econ_id, company_id, DATE '2024-02-01' AS calibration_date, {OP_SQL} AS operation_time, "
    + ", ".join(f"PD_{12 * i} AS cdsvalue{i}" for i in range(1, 5))
    + ", CASE WHEN PDIR IS NULL THEN NULL ELSE PD_60 END AS cdsvalue5 FROM pd_raw", "pd_raw"))
def q_prep_as_file(spark, d):
    return rs.prep_as_file(as_csv_rows(spark, d), CALIBRATION, OPERATION_TIME)


@register("prep_pdir_daily", sql(
    "SELECT CAST(ts AS DATE) AS data_date, CAST(user_id % 25 + 1 AS INT) AS econ_id, user_id AS company_id, "
    f"DATE '2024-02-01' AS calibration_date, {OP_SQL} AS operation_time, "
    "CASE WHEN event_type = 'view' THEN 0e0 ELSE CAST(1 + event_id % 21 AS DOUBLE) END AS pdir "
    "FROM events WHERE event_type <> 'error'"))
def q_prep_pdir_daily(spark, d):
    return rs.prep_pdir_daily(pdir_daily_named(spark, d), CALIBRATION, OPERATION_TIME, econ_id=F.col("econ_id"))


@register("prep_pdir_revision", sql(
    "SELECT CAST(strptime(CAST(CAST(data_date AS BIGINT) AS VARCHAR), '%Y%m%d') AS DATE) AS data_date, econ_id, "
    f"CAST(company_id AS BIGINT) AS company_id, DATE '2024-02-01' AS calibration_date, {OP_SQL} AS operation_time, "
    f"pdir FROM ({RATING_CELLS_SQL}) c", "rating_all"))
def q_prep_pdir_revision(spark, d):
    cells = rs.melt_grid(rating_grid(spark, d), ["econ_id", F.col("date_key").alias("data_date")], "firms", "values",
                         "company_id", "pdir")
    return rs.prep_pdir_revision(cells, CALIBRATION, OPERATION_TIME, econ_id=F.col("econ_id"))


@register("prep_pdir_historical", sql(
    "SELECT CAST(strptime(CAST(CAST(data_date AS BIGINT) AS VARCHAR), '%Y%m%d') AS DATE) AS data_date, econ_id, "
    f"CAST(trunc(company_id / 1000) AS BIGINT) AS company_id, pdir FROM ({RATING_CELLS_SQL}) c", "rating_all"))
def q_prep_pdir_historical(spark, d):
    cells = rs.melt_grid(rating_grid(spark, d), ["econ_id", F.col("date_key").alias("date")], "firms", "values",
                         "company_id", "pdir")
    return rs.prep_pdir_historical(cells)

