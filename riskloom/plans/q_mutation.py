"""Catalogue entries for table mutation, the operation log and guards, and
table-level writes read back (SURVEY I)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from riskloom import fixtures as fx
from riskloom.fixtures import sql
from riskloom.operators import mutate as mu
from riskloom.operators import windows as win
from riskloom.plans import derived
from riskloom.plans.catalog import AS_OF, LATEST_SQL, LOOKBACK_AS_OF, OPERATION_TIME, UPDATED_AT, register
from riskloom.plans.q_relational import PANEL_SQL, WEBSITE_SQL, _revision_batch
from riskloom.schemas import PD_COLS, PD_TABLE
from riskloom.session import scratch_path
from riskloom.sources.sinks import write_clustered

KEYS = ["company_id", "data_date"]
BATCH_FROM = dt.date(2024, 1, 15)
COLS = ", ".join(["company_id", "data_date", "calibration_date", "operation_time", "PDIR"] + PD_COLS)

INC_SQL = "SELECT * FROM pd_raw WHERE data_date >= DATE '2024-01-15'"
INC_LATEST_SQL = (f"SELECT * FROM ({INC_SQL}) i QUALIFY row_number() OVER (PARTITION BY company_id, data_date "
                  "ORDER BY operation_time DESC) = 1")


def _incoming(spark, d):
    return fx.pd_raw(spark, d).where(F.col("data_date") >= F.lit(BATCH_FROM))


@register("mut_replace", sql(LATEST_SQL, "pd_raw", "pd_current"))
def q_replace(spark, d):
    """A written table whose rows are all replaced by the batch."""
    path = scratch_path(spark, "replace")
    fx.pd_current(spark, d).write.parquet(path)
    current = spark.read.parquet(path)
    mu.replace_all(current, win.latest_version(fx.pd_raw(spark, d))).write.mode("overwrite").parquet(path)
    return spark.read.schema(current.schema).parquet(path)


@register("mut_delete_insert", sql(
    f"SELECT {COLS} FROM pd_current c WHERE NOT EXISTS (SELECT 1 FROM ({INC_SQL}) i WHERE i.company_id = c.company_id "
    f"AND i.data_date = c.data_date) UNION ALL SELECT {COLS} FROM ({INC_SQL}) i", "pd_raw", "pd_current"))
def q_delete_insert(spark, d):
    return mu.delete_insert(fx.pd_current(spark, d), _incoming(spark, d), KEYS)


@register("mut_insert_ignore", sql(
    f"SELECT {COLS} FROM pd_current UNION ALL SELECT {COLS} FROM ({LATEST_SQL}) l WHERE NOT EXISTS "
    "(SELECT 1 FROM pd_current c WHERE c.company_id = l.company_id AND c.data_date = l.data_date)",
    "pd_raw", "pd_current"))
def q_insert_ignore(spark, d):
    return mu.insert_ignore(fx.pd_current(spark, d), fx.pd_raw(spark, d), KEYS)


@register("mut_upsert", sql(
    f"SELECT {COLS} FROM pd_current c WHERE NOT EXISTS (SELECT 1 FROM ({INC_SQL}) i WHERE i.company_id = c.company_id "
    f"AND i.data_date = c.data_date) UNION ALL SELECT {COLS} FROM ({INC_LATEST_SQL}) l", "pd_raw", "pd_current"))
def q_upsert(spark, d):
    return mu.upsert(fx.pd_current(spark, d), _incoming(spark, d), KEYS)


@register("mut_history_capture", sql(
    f"SELECT {COLS} FROM pd_current c WHERE EXISTS (SELECT 1 FROM ({INC_SQL}) i WHERE i.company_id = c.company_id "
    "AND i.data_date = c.data_date)", "pd_raw", "pd_current"))
def q_history_capture(spark, d):
    return mu.history_capture(fx.pd_current(spark, d), _incoming(spark, d), KEYS)


@register("mut_forward_fill", sql(
    "WITH r AS (SELECT * FROM pd_raw WHERE data_date >= DATE '2024-01-10' QUALIFY row_number() OVER "
    "(PARTITION BY company_id, data_date ORDER BY operation_time DESC) = 1), "
    "f AS (SELECT company_id, data_date, COALESCE(NULLIF(PDIR, 0), last_value(NULLIF(PDIR, 0) IGNORE NULLS) OVER "
    "(PARTITION BY company_id ORDER BY data_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pdir_filled "
    "FROM r) SELECT p.company_id, p.data_date, p.operation_time, CASE WHEN f.pdir_filled IS NOT NULL AND "
    "(p.PDIR IS NULL OR p.PDIR = 0) AND p.data_date >= DATE '2024-01-10' THEN f.pdir_filled ELSE p.PDIR END AS PDIR "
    "FROM pd_raw p LEFT JOIN f ON p.company_id = f.company_id AND p.data_date = f.data_date", "pd_raw"))
def q_forward_fill_update(spark, d):
    main = fx.pd_raw(spark, d).select("company_id", "data_date", "operation_time", "PDIR")
    return mu.forward_fill_update(main, LOOKBACK_AS_OF)


REV_LOG_SQL = (
    "SELECT min(data_date) AS data_start_date, max(data_date) AS data_end_date, econ_id, company_id, "
    "calibration_date, operation_time, 'revision' AS operation_action FROM (SELECT CAST(company_id % 25 + 1 AS INT) "
    "AS econ_id, company_id, data_date, calibration_date, TIMESTAMP '2024-02-03 00:00:00' AS operation_time "
    f"FROM ({LATEST_SQL}) l) t GROUP BY econ_id, company_id, calibration_date, operation_time")


@register("log_operations", sql(
    "SELECT DATE '2024-01-15' AS data_start_date, DATE '2024-01-15' AS data_end_date, -99 AS econ_id, "
    "CAST(-99 AS BIGINT) AS company_id, DATE '2024-02-01' AS calibration_date, "
    "TIMESTAMP '2024-02-02 06:00:00' AS operation_time, 'daily_insertion' AS operation_action "
    f"FROM (SELECT count(*) AS n FROM pd_raw WHERE data_date = DATE '2024-01-15') s WHERE n > 0 "
    f"UNION ALL {REV_LOG_SQL}", "pd_raw"))
def q_log_operations(spark, d):
    day = BATCH_FROM
    loaded = fx.pd_raw(spark, d).where(F.col("data_date") == F.lit(day)).agg(F.count(F.lit(1)).alias("n"))
    daily = _daily_log_if_loaded(spark, loaded, day)
    return daily.unionByName(mu.operation_log_revision(_revision_batch(spark, d)))


def _daily_log_if_loaded(spark, loaded, day):
    """The daily log row, emitted only when the day actually loaded rows:
    a projection of the one-row count, so no join is needed."""
    return loaded.where(F.col("n") > 0).select(*mu.operation_log_columns(day, fx.CALIBRATION, OPERATION_TIME))


register("guard_daily", sql(
    "SELECT CAST(count(*) > 0 AS INT) AS already_loaded FROM operation_log WHERE operation_action = 'daily_insertion' "
    "AND data_end_date = DATE '2024-01-15'", "operation_log"))(
    lambda spark, d: mu.guard_daily(fx.operation_log(spark, d), BATCH_FROM))

GUARD_DAY = dt.date(2024, 1, 20)


@register("guard_revision", sql(
    f"SELECT CAST(count(*) > 0 AS INT) AS already_loaded FROM ({REV_LOG_SQL}) r WHERE operation_action = 'revision' "
    "AND data_end_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'", "pd_raw"))
def q_guard_revision(spark, d):
    log = fx.operation_log(spark, d).select(
        "data_start_date", "data_end_date", "econ_id", F.col("company_id").cast("bigint").alias("company_id"),
        "calibration_date", "operation_time", "operation_action"
    ).unionByName(mu.operation_log_revision(_revision_batch(spark, d)))
    return mu.guard_revision(log, GUARD_DAY)


@register("mut_truncate", sql(
    "SELECT count(*) AS n_before, CAST(0 AS BIGINT) AS n_after, CAST(65 AS BIGINT) AS n_columns FROM pd_current",
    "pd_raw", "pd_current"))
def q_truncate(spark, d):
    """Rows before and after, and the columns that stay."""
    path = scratch_path(spark, "truncate")
    fx.pd_current(spark, d).write.parquet(path)
    before = spark.read.parquet(path).count()
    mu.truncate_table(spark, path)
    after = spark.read.parquet(path)
    return after.agg(F.lit(before).cast("bigint").alias("n_before"), F.count(F.lit(1)).alias("n_after"),
                     F.lit(len(after.columns)).cast("bigint").alias("n_columns"))


register("enforce_schema", sql(
    f"SELECT data_date, company_id, calibration_date, operation_time, PDIR, {', '.join(PD_COLS)} FROM pd_raw",
    "pd_raw"))(
    lambda spark, d: mu.enforce_schema(fx.pd_raw(spark, d), PD_TABLE))


@register("refresh_derived", sql(WEBSITE_SQL, "pd_raw", "companies_mapping_info", "excluded_companies"))
def q_refresh_derived(spark, d):
    out = scratch_path(spark, "derived")
    paths = derived.refresh_derived(spark, fx.pd_raw(spark, d), fx.companies_mapping_info(spark, d),
                                    fx.excluded_companies(spark, d), out, AS_OF, UPDATED_AT)
    return spark.read.parquet(paths["website"])


@register("layout_clustered", sql(
    f"SELECT *, strftime(data_date, '%Y-%m') AS data_month FROM ({PANEL_SQL}) p", "pd_raw", "companies_mapping_info"))
def q_layout_clustered(spark, d):
    path = scratch_path(spark, "panel-clustered")
    write_clustered(derived.panel_latest(fx.pd_raw(spark, d), fx.companies_mapping_info(spark, d)), path)
    back = spark.read.option("basePath", path).parquet(path)
    return back.withColumn("data_month", F.col("data_month").cast("string"))


@register("mut_commit_partitions", sql(
    f"SELECT {COLS}, strftime(data_date, '%Y-%m') AS data_month FROM pd_current c WHERE NOT EXISTS (SELECT 1 FROM "
    f"({INC_SQL}) i WHERE i.company_id = c.company_id AND i.data_date = c.data_date) UNION ALL SELECT {COLS}, "
    f"strftime(data_date, '%Y-%m') AS data_month FROM ({INC_LATEST_SQL}) l", "pd_raw", "pd_current"))
def q_commit_partitions(spark, d):
    """Upsert written as a table: state in month partitions, the new state
    of the touched months computed from the table itself and committed with
    dynamic partition overwrite, then read back."""
    path = scratch_path(spark, "pd-state")
    cur = mu.with_month(fx.pd_current(spark, d))
    cur.write.mode("overwrite").partitionBy("data_month").parquet(path)
    inc = mu.with_month(_incoming(spark, d))
    # months by their names, not by a join: a month is one key, and all its rows would go to one task
    cur_touched = mu.read_touched(spark, path, inc)
    new_state = mu.upsert(cur_touched, inc.select(*cur_touched.columns), KEYS)
    mu.commit_partitions(new_state, path)
    return spark.read.parquet(path).select(*[c for c in cur.columns])
