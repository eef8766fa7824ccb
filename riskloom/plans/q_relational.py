"""Catalogue entries for filters, joins, aggregates, windows, sort, set
operations and the derived serving tables (SURVEY C, D, E, F, G, H, J16)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from riskloom import fixtures as fx
from riskloom.fixtures import sql
from riskloom.functions.rating import rating_grade_sql
from riskloom.operators import aggregates as agg
from riskloom.operators import filters as flt
from riskloom.operators import joins as jn
from riskloom.operators import mutate as mu
from riskloom.operators import windows as win
from riskloom.plans import derived
from riskloom.plans.catalog import AS_OF, LATEST_SQL, LOOKBACK_AS_OF, UPDATED_AT, pd_list, register
from riskloom.schemas import DAILY_ECONOMIES, PD_COLS, WEBSITE_HORIZONS
from riskloom.session import scratch_path


def _latest(spark, d):
    return win.latest_version(fx.pd_raw(spark, d))


# ---------------------------------------------------------------- F windows
register("latest_version", sql(LATEST_SQL, "pd_raw"))(
    lambda spark, d: _latest(spark, d))


@register("forward_fill_rating", sql(
    "SELECT company_id, data_date, PD_12, COALESCE(NULLIF(PDIR, 0), last_value(NULLIF(PDIR, 0) IGNORE NULLS) "
    "OVER (PARTITION BY company_id ORDER BY data_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
    f"AS pdir_filled FROM ({LATEST_SQL}) l", "pd_raw"))
def q_forward_fill(spark, d):
    return win.forward_fill_rating(_latest(spark, d)).select("company_id", "data_date", "PD_12", "pdir_filled")


@register("rolling_mean_10", sql(
    "SELECT company_id, data_date, round(avg(PD_12) OVER (PARTITION BY company_id ORDER BY data_date "
    f"ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 12) AS pd12_mean10 FROM ({LATEST_SQL}) l", "pd_raw"))
def q_rolling_mean(spark, d):
    return (win.rolling_mean(_latest(spark, d))
            .select("company_id", "data_date", F.round("pd12_mean10", 12).alias("pd12_mean10")))


@register("implied_rating", sql(
    "SELECT company_id, data_date, " + rating_grade_sql("m") + " AS pdir_implied FROM ("
    "SELECT company_id, data_date, avg(PD_12) OVER (PARTITION BY company_id ORDER BY data_date "
    f"ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS m FROM ({LATEST_SQL}) l) t", "pd_raw"))
def q_implied_rating(spark, d):
    return win.implied_rating(_latest(spark, d)).select("company_id", "data_date", "pdir_implied")


def _with_trading_date(spark, d):
    return fx.pd_raw(spark, d).withColumn(
        "current_trading_date", F.date_format("operation_time", "yyyyMMdd").cast("int"))


@register("keep_last", sql(
    "SELECT company_id, data_date, current_trading_date, operation_time, PDIR, PD_1, PD_60 FROM ("
    "SELECT *, CAST(strftime(operation_time, '%Y%m%d') AS INT) AS current_trading_date FROM pd_raw) t "
    "QUALIFY row_number() OVER (PARTITION BY company_id, data_date ORDER BY current_trading_date DESC, "
    "operation_time DESC) = 1", "pd_raw"))
def q_keep_last(spark, d):
    return (win.keep_last(_with_trading_date(spark, d))
            .select("company_id", "data_date", "current_trading_date", "operation_time", "PDIR", "PD_1", "PD_60"))


# ---------------------------------------------------------------- G sort
@register("sort_by_date", sql(
    "SELECT * FROM credit_events_raw ORDER BY default_date, company_id, default_type, event_id",
    "credit_events_raw"))
def q_sort(spark, d):
    return fx.credit_events_raw(spark, d).orderBy("default_date", "company_id", "default_type", "event_id")


FIRST_ON_OR_AFTER = dt.date(2024, 1, 10)


@register("first_on_or_after", sql(
    "SELECT calibration_date FROM operation_log WHERE operation_action = 'daily_insertion' "
    "AND data_start_date >= DATE '2024-01-10' ORDER BY data_start_date LIMIT 1", "operation_log"))
def q_first_on_or_after(spark, d):
    log = fx.operation_log(spark, d)
    return (log.where((F.col("operation_action") == "daily_insertion")
                      & (F.col("data_start_date") >= F.lit(FIRST_ON_OR_AFTER)))
            .agg(F.min_by("calibration_date", "data_start_date").alias("calibration_date")))


# ---------------------------------------------------------------- H union
@register("union_shards", sql(
    "SELECT company_id, data_date, pdir, CAST(NULL AS DOUBLE) AS PD_12 FROM rating_all UNION ALL "
    f"SELECT company_id, data_date, CAST(NULL AS DOUBLE) AS pdir, PD_12 FROM ({LATEST_SQL}) l",
    "rating_all", "pd_raw"))
def q_union(spark, d):
    from riskloom.operators.setops import union_shards
    a = fx.rating_all(spark, d)
    b = _latest(spark, d).select("company_id", "data_date", "PD_12")
    return union_shards([a, b]).select("company_id", "data_date", "pdir", "PD_12")


# ---------------------------------------------------------------- C filters
@register("filter_any_missing", sql(
    "SELECT econ_id, company_id, yyyy, mm, dd, PD_1, PD_60 FROM pd_matrix_named WHERE NOT ("
    + " OR ".join(f"PD_{i} IS NULL OR isnan(PD_{i})" for i in range(1, 61)) + ")", "pd_matrix_named"))
def q_filter_any_missing(spark, d):
    return (flt.filter_any_missing(fx.pd_matrix_named(spark, d), PD_COLS)
            .select("econ_id", "company_id", "yyyy", "mm", "dd", "PD_1", "PD_60"))


@register("filter_missing_value", sql(
    "SELECT company_id, data_date, operation_time, PDIR FROM pd_raw WHERE PDIR IS NOT NULL AND NOT isnan(PDIR)",
    "pd_raw"))
def q_filter_missing_value(spark, d):
    return flt.filter_missing_value(fx.pd_raw(spark, d), "PDIR").select(
        "company_id", "data_date", "operation_time", "PDIR")


@register("filter_lookback", sql(
    "SELECT company_id, data_date, operation_time, PDIR FROM pd_raw "
    "WHERE data_date >= DATE '2024-01-20' - INTERVAL 10 DAY", "pd_raw"))
def q_filter_lookback(spark, d):
    return flt.filter_lookback(fx.pd_raw(spark, d), LOOKBACK_AS_OF).select(
        "company_id", "data_date", "operation_time", "PDIR")


EITHER_SINCE = dt.date(2024, 1, 15)


@register("filter_either_date", sql(
    "SELECT * FROM excluded_companies WHERE start_date >= DATE '2024-01-15' OR end_date >= DATE '2024-01-15'",
    "excluded_companies"))
def q_filter_either(spark, d):
    return flt.filter_either_date(fx.excluded_companies(spark, d), EITHER_SINCE)


@register("trading_calendar", sql(
    "SELECT CAST(g AS DATE) AS data_date FROM (SELECT min(data_date) AS lo, max(data_date) AS hi FROM pd_raw) s, "
    "unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS u(g) "
    "WHERE isodow(CAST(g AS DATE)) <= 5", "pd_raw"))
def q_trading_calendar(spark, d):
    span = fx.pd_raw(spark, d).agg(F.min("data_date").alias("lo"), F.max("data_date").alias("hi"))
    return (span.select(F.explode(F.sequence("lo", "hi")).alias("data_date"))
            .where(F.weekday("data_date") < 5))


@register("filter_ids_semi", sql(
    "SELECT company_id, data_date, operation_time FROM pd_raw "
    "WHERE company_id IN (SELECT company_id FROM rating_key)", "pd_raw", "rating_key"))
def q_filter_ids_semi(spark, d):
    return flt.filter_ids_semi(fx.pd_raw(spark, d), fx.rating_key(spark, d)).select(
        "company_id", "data_date", "operation_time")


FILTER_DAY = dt.date(2024, 1, 15)


@register("filter_day", sql(
    "SELECT company_id, data_date, operation_time, PDIR FROM pd_raw WHERE data_date = DATE '2024-01-15'",
    "pd_raw"))
def q_filter_day(spark, d):
    return flt.filter_day(fx.pd_raw(spark, d), FILTER_DAY).select(
        "company_id", "data_date", "operation_time", "PDIR")


@register("latest_n_dates", sql(
    "SELECT company_id, data_date, operation_time FROM pd_raw WHERE data_date IN "
    "(SELECT DISTINCT data_date FROM pd_raw ORDER BY data_date DESC LIMIT 2)", "pd_raw"))
def q_latest_n_dates(spark, d):
    return flt.latest_n_dates(fx.pd_raw(spark, d), 2).select("company_id", "data_date", "operation_time")


# ---------------------------------------------------------------- D joins
@register("join_company_dim", sql(
    "SELECT p.company_id, p.data_date, p.operation_time, c.company_name, c.region_id "
    "FROM pd_raw p JOIN companies_mapping_info c ON p.company_id = c.company_id",
    "pd_raw", "companies_mapping_info"))
def q_join_company_dim(spark, d):
    return jn.join_company_dim(fx.pd_raw(spark, d), fx.companies_mapping_info(spark, d),
                               ("company_name", "region_id")).select(
        "company_id", "data_date", "operation_time", "company_name", "region_id")


@register("join_rating_left", sql(
    f"SELECT l.company_id, l.data_date, l.PD_12, r.pdir FROM ({LATEST_SQL}) l "
    "LEFT JOIN rating_key r ON l.data_date = r.data_date AND l.company_id = r.company_id",
    "pd_raw", "rating_key"))
def q_join_rating_left(spark, d):
    return jn.join_rating(_latest(spark, d).select("company_id", "data_date", "PD_12"),
                          fx.rating_key(spark, d), "left").select("company_id", "data_date", "PD_12", "pdir")


@register("join_rating_inner", sql(
    f"SELECT l.company_id, l.data_date, l.PD_12, r.pdir FROM ({LATEST_SQL}) l "
    "JOIN rating_key r ON l.data_date = r.data_date AND l.company_id = r.company_id",
    "pd_raw", "rating_key"))
def q_join_rating_inner(spark, d):
    return jn.join_rating(_latest(spark, d).select("company_id", "data_date", "PD_12"),
                          fx.rating_key(spark, d), "inner").select("company_id", "data_date", "PD_12", "pdir")


@register("anti_exclusion_interval", sql(
    "SELECT company_id, data_date, operation_time FROM pd_raw p WHERE NOT EXISTS (SELECT 1 FROM "
    "excluded_companies ex WHERE p.company_id = ex.company_id AND p.data_date >= ex.start_date "
    "AND p.data_date <= COALESCE(ex.end_date, DATE '2024-01-30'))", "pd_raw", "excluded_companies"))
def q_anti_exclusion(spark, d):
    return jn.anti_exclusion_interval(fx.pd_raw(spark, d), fx.excluded_companies(spark, d), AS_OF).select(
        "company_id", "data_date", "operation_time")


@register("diff_keys_both", sql(
    f"SELECT DISTINCT company_id, data_date, 'left_only' AS side FROM ({LATEST_SQL}) l "
    "WHERE NOT EXISTS (SELECT 1 FROM rating_key r WHERE r.company_id = l.company_id AND r.data_date = l.data_date) "
    "UNION ALL SELECT DISTINCT company_id, data_date, 'right_only' AS side FROM rating_key r WHERE NOT EXISTS "
    f"(SELECT 1 FROM ({LATEST_SQL}) l WHERE r.company_id = l.company_id AND r.data_date = l.data_date)",
    "pd_raw", "rating_key"))
def q_diff_keys(spark, d):
    return jn.diff_keys_both(_latest(spark, d), fx.rating_key(spark, d))


def _bucketed(df):
    return df.select("company_id", "data_date", fx.econ_of().alias("econ_id"))


@register("diff_keys_by_digest", sql(
    "SELECT DISTINCT company_id, data_date, 'left_only' AS side FROM pd_raw p WHERE (company_id, data_date) NOT IN "
    "(SELECT (company_id, data_date) FROM pd_current) OR (company_id % 50 = 0 AND data_date < DATE '2024-01-21') "
    "UNION ALL SELECT company_id + 1000000, data_date, 'right_only' FROM pd_current WHERE company_id % 70 = 0",
    "pd_raw", "pd_current"))
def q_diff_keys_by_digest(spark, d):
    """All keys against those before the cut-off, without some and with some more: most buckets agree."""
    current = _bucketed(fx.pd_current(spark, d))
    other = current.where(F.col("company_id") % 50 != 0).unionByName(
        current.where(F.col("company_id") % 70 == 0).withColumn("company_id", F.col("company_id") + 1000000))
    return agg.diff_keys_by_digest(_bucketed(_latest(spark, d)), other, bucket=["econ_id", "data_date"])


@register("asof_calibration", sql(
    "SELECT d.data_date, (SELECT arg_min(calibration_date, data_start_date) FROM operation_log o "
    "WHERE o.data_start_date >= d.data_date AND operation_action = 'daily_insertion') AS calibration_date "
    "FROM (SELECT DISTINCT data_date FROM pd_raw) d", "pd_raw", "operation_log"))
def q_asof_calibration(spark, d):
    from riskloom.plans import jobs
    return jobs.calibration_of_dates(fx.operation_log(spark, d), fx.pd_raw(spark, d))


@register("asof_next_rating", sql(
    "SELECT p.company_id, p.data_date, p.operation_time, r.pdir FROM pd_raw p ASOF LEFT JOIN rating_key r "
    "ON p.company_id = r.company_id AND p.data_date <= r.data_date", "pd_raw", "rating_key"))
def q_asof_next_rating(spark, d):
    """Every version with the first rating of its company on or after its day."""
    rows = fx.pd_raw(spark, d).select("company_id", "data_date", "operation_time")
    return win.asof_forward(rows, fx.rating_key(spark, d), ["pdir"], "data_date", "data_date", keys=["company_id"])


NOT_LOADED_SQL = (
    "SELECT company_id, data_date, PD_12 FROM (" + LATEST_SQL + ") l WHERE NOT EXISTS (SELECT 1 FROM pd_current c "
    "WHERE c.company_id = l.company_id AND c.data_date = l.data_date AND c.company_id % 4 <> 0)")


@register("anti_not_loaded_indexed", sql(NOT_LOADED_SQL, "pd_raw", "pd_current"))
def q_anti_not_loaded_indexed(spark, d):
    """Rows not loaded yet, by the bitmap index; part of the table is indexed by a merge after an append."""
    from riskloom.operators import key_index as ki
    loaded = fx.pd_current(spark, d).where(F.col("company_id") % 4 != 0)
    index = ki.build_key_index(loaded.where(F.col("company_id") % 3 != 0))
    index = mu.staged(ki.merge_key_index(index, loaded.where(F.col("company_id") % 3 == 0)), "key-index")
    return ki.anti_loaded_indexed(_latest(spark, d), loaded, index).select("company_id", "data_date", "PD_12")


@register("anti_not_loaded", sql(
    f"SELECT company_id, data_date, operation_time, PDIR FROM ({LATEST_SQL}) l WHERE NOT EXISTS "
    "(SELECT 1 FROM pd_current c WHERE c.company_id = l.company_id AND c.data_date = l.data_date)",
    "pd_raw", "pd_current"))
def q_anti_not_loaded(spark, d):
    return jn.anti_not_loaded(_latest(spark, d), fx.pd_current(spark, d)).select(
        "company_id", "data_date", "operation_time", "PDIR")


@register("anti_new_users", sql(
    "SELECT user_key, email, industry, buda_access FROM users_flat u WHERE NOT EXISTS "
    "(SELECT 1 FROM users_flat e WHERE e.buda_access = 'Y' AND e.email = u.email)", "users_flat"))
def q_anti_new_users(spark, d):
    users = fx.users_flat(spark, d)
    existing = users.where(F.col("buda_access") == "Y")
    return jn.anti_new_users(users, existing).select("user_key", "email", "industry", "buda_access")


@register("diff_shards", sql(
    "WITH a AS (SELECT DISTINCT CAST(company_id % 25 + 1 AS INT) AS econ_id FROM pd_raw), "
    "b AS (SELECT DISTINCT CAST(c_nationkey AS INT) AS econ_id FROM rating_key r "
    "JOIN customer c ON c.c_custkey = r.company_id) "
    "SELECT econ_id, 'left_only' AS side FROM (SELECT econ_id FROM a EXCEPT SELECT econ_id FROM b) "
    "UNION ALL SELECT econ_id, 'right_only' AS side FROM (SELECT econ_id FROM b EXCEPT SELECT econ_id FROM a)",
    "pd_raw", "rating_key"))
def q_diff_shards(spark, d):
    pd_shards = fx.pd_raw(spark, d).select(fx.econ_of().alias("econ_id"))
    cust = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("company_id"), "c_nationkey")
    pdir_shards = (fx.rating_key(spark, d).join(cust, "company_id")
                   .select(F.col("c_nationkey").cast("int").alias("econ_id")))
    return jn.diff_shards(pd_shards, pdir_shards)


@register("update_from_join", sql(
    "WITH f AS (SELECT company_id, data_date, COALESCE(NULLIF(PDIR, 0), last_value(NULLIF(PDIR, 0) IGNORE NULLS) "
    "OVER (PARTITION BY company_id ORDER BY data_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
    f"AS pdir_filled FROM ({LATEST_SQL}) l) "
    "SELECT p.company_id, p.data_date, p.operation_time, CASE WHEN f.pdir_filled IS NOT NULL AND "
    "(p.PDIR IS NULL OR p.PDIR = 0) THEN f.pdir_filled ELSE p.PDIR END AS PDIR FROM pd_raw p "
    "LEFT JOIN f ON p.company_id = f.company_id AND p.data_date = f.data_date", "pd_raw"))
def q_update_from_join(spark, d):
    filled = win.forward_fill_rating(_latest(spark, d).select("company_id", "data_date", "operation_time", "PDIR"))
    main = fx.pd_raw(spark, d).select("company_id", "data_date", "operation_time", "PDIR")
    return jn.update_from_join(main, filled)


@register("join_event_enriched", sql(
    "SELECT e.company_id, e.default_date, e.default_type, e.event_id, k.action_name, c.company_name, "
    "c.region_id, c.region FROM credit_events_raw e LEFT JOIN event_code_mapping k ON e.default_type = k.id "
    "LEFT JOIN companies_mapping_info c ON e.company_id = c.company_id",
    "credit_events_raw", "event_code_mapping", "companies_mapping_info"))
def q_join_event_enriched(spark, d):
    return jn.join_event_enriched(fx.credit_events_raw(spark, d), fx.event_code_mapping(spark, d),
                                  fx.companies_mapping_info(spark, d)).select(
        "company_id", "default_date", "default_type", "event_id", "action_name", "company_name",
        "region_id", "region")


@register("join_region_default", sql(
    "WITH co AS (SELECT DISTINCT p.company_id, m.domicile_id FROM pd_raw p LEFT JOIN companies_mapping_info m "
    "ON p.company_id = m.company_id), "
    "rg AS (SELECT CAST(n_nationkey AS BIGINT) AS domicile_id, CAST(r_regionkey AS BIGINT) AS region_id, "
    "r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey) "
    "SELECT co.company_id, co.domicile_id, COALESCE(rg.region_id, 99999) AS region_id, "
    "COALESCE(rg.region, 'Unknown Region') AS region FROM co LEFT JOIN rg ON co.domicile_id = rg.domicile_id",
    "pd_raw", "companies_mapping_info"))
def q_join_region_default(spark, d):
    companies = (fx.pd_raw(spark, d).select("company_id").distinct()
                 .join(fx.companies_mapping_info(spark, d).select("company_id", "domicile_id"), "company_id", "left"))
    n = fx.table(spark, d, "nation")
    r = fx.table(spark, d, "region")
    regions = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("domicile_id"),
        F.col("r_regionkey").cast("bigint").alias("region_id"), F.col("r_name").alias("region"))
    return jn.join_region_default(companies, regions).select("company_id", "domicile_id", "region_id", "region")


# ---------------------------------------------------------------- E aggregates
REVISION_OP = dt.datetime(2024, 2, 3, 0, 0, 0)


def _revision_batch(spark, d):
    return (_latest(spark, d).select(fx.econ_of().alias("econ_id"), "company_id", "data_date", "calibration_date")
            .withColumn("operation_time", F.lit(REVISION_OP).cast("timestamp_ntz")))


@register("agg_revision_span", sql(
    "SELECT min(data_date) AS data_start_date, max(data_date) AS data_end_date, econ_id, company_id, "
    "calibration_date, operation_time, 'revision' AS operation_action FROM (SELECT CAST(company_id % 25 + 1 AS INT) "
    "AS econ_id, company_id, data_date, calibration_date, TIMESTAMP '2024-02-03 00:00:00' AS operation_time "
    f"FROM ({LATEST_SQL}) l) t GROUP BY econ_id, company_id, calibration_date, operation_time", "pd_raw"))
def q_agg_revision_span(spark, d):
    return agg.revision_span(_revision_batch(spark, d))


@register("agg_dates_per_company", sql(
    "SELECT company_id, array_to_string(list_sort(list(DISTINCT CAST(data_date AS VARCHAR))), ',') AS dates, "
    "count(DISTINCT data_date) AS n_dates FROM pd_raw GROUP BY company_id", "pd_raw"))
def q_agg_dates(spark, d):
    res = agg.dates_per_company(fx.pd_raw(spark, d))
    return res.select("company_id", F.array_join(F.transform("dates", lambda x: x.cast("string")), ",").alias("dates"),
                      "n_dates")


@register("agg_distinct", sql("SELECT DISTINCT data_date FROM pd_raw", "pd_raw"))
def q_agg_distinct(spark, d):
    return fx.pd_raw(spark, d).select("data_date").distinct()


@register("agg_reconcile", sql(
    f"WITH l AS ({LATEST_SQL}), m AS (SELECT l.company_id FROM l LEFT JOIN rating_key r "
    "ON l.company_id = r.company_id AND l.data_date = r.data_date) "
    "SELECT (SELECT count(*) FROM l) AS n_left, (SELECT count(*) FROM rating_key) AS n_right, "
    "(SELECT count(*) FROM m) AS n_merged, (SELECT count(*) FROM m) - (SELECT count(*) FROM rating_key) AS n_diff",
    "pd_raw", "rating_key"))
def q_agg_reconcile(spark, d):
    left = _latest(spark, d).select("company_id", "data_date")
    right = fx.rating_key(spark, d)
    merged = jn.join_rating(left, right, "left")
    return agg.reconcile(left, right, merged)


@register("exists_flag", sql(
    "SELECT CAST(count(*) > 0 AS INT) AS flag FROM operation_log "
    "WHERE operation_action = 'daily_insertion' AND data_end_date = DATE '2024-01-15'", "operation_log"))
def q_exists_flag(spark, d):
    log = fx.operation_log(spark, d)
    return agg.exists_flag(log.where((F.col("operation_action") == "daily_insertion")
                                     & (F.col("data_end_date") == F.lit(FILTER_DAY))))


def _missing_sql():
    cols = ["econ_id", "company_id", "yyyy", "mm", "dd"] + PD_COLS
    parts = []
    for c in cols:
        cond = f"{c} IS NULL" if c == "econ_id" else f"{c} IS NULL OR isnan({c})"
        parts.append(f"SELECT '{c}' AS column_name, count(CASE WHEN {cond} THEN 1 END) AS n_missing FROM pd_matrix_named")
    return " UNION ALL ".join(parts)


register("dq_missing_counts", sql(_missing_sql(), "pd_matrix_named"))(
    lambda spark, d: agg.missing_counts(fx.pd_matrix_named(spark, d)))


@register("dq_duplicate_keys", sql(
    "SELECT company_id, data_date, count(*) AS n_rows FROM pd_raw GROUP BY company_id, data_date "
    "HAVING count(*) > 1", "pd_raw"))
def q_dup_keys(spark, d):
    return agg.duplicate_keys(fx.pd_raw(spark, d), ["company_id", "data_date"])


# ---------------------------------------------------------------- J16 derived tables
PANEL_SQL = (f"SELECT p.data_date, p.company_id, c.company_name, c.ticker, c.domicile_id, c.region_id, "
             f"c.industry_sector_id, c.industry_sector, c.industry_group_id, c.industry_subgroup_id, p.operation_time, p.PDIR, {pd_list('p.')} FROM ({LATEST_SQL}) p "
             "JOIN companies_mapping_info c ON p.company_id = c.company_id")


def _panel(spark, d):
    return derived.panel_latest(fx.pd_raw(spark, d), fx.companies_mapping_info(spark, d))


register("table_panel_latest", sql(PANEL_SQL, "pd_raw", "companies_mapping_info"))(_panel)

register("table_panel_2d", sql(
    f"WITH panel AS ({PANEL_SQL}) SELECT * FROM panel WHERE data_date IN "
    "(SELECT DISTINCT data_date FROM panel ORDER BY data_date DESC LIMIT 2)", "pd_raw", "companies_mapping_info"))(
    lambda spark, d: derived.panel_2d(_panel(spark, d)))

WEBSITE_SQL = (
    f"WITH panel AS ({PANEL_SQL}) SELECT company_id AS CompanyID, data_date AS DTDate, data_date AS FSDate, "
    + ", ".join(f"PD_{h} AS DFT{i}" for i, h in enumerate(WEBSITE_HORIZONS, 1))
    + ", region_id AS RegionFlag, 0 AS Draft, TIMESTAMP '2024-02-01 00:00:00' AS Updated FROM panel pd "
    "WHERE NOT EXISTS (SELECT 1 FROM excluded_companies ex WHERE pd.company_id = ex.company_id "
    "AND pd.data_date >= ex.start_date AND pd.data_date <= COALESCE(ex.end_date, DATE '2024-01-30'))")


def table_website(spark, d):
    return derived.website(_panel(spark, d), fx.excluded_companies(spark, d), AS_OF, UPDATED_AT)


register("table_website", sql(WEBSITE_SQL, "pd_raw", "companies_mapping_info", "excluded_companies"))(table_website)


#: The state before the changes that the incremental refresh has to find.
_OLD_DAY = dt.date(2024, 1, 21)


def incremental_tables(spark, d):
    """Tables built without the versions from 21 January on, without the companies whose key
    ends in 3, with another sector for those that end in 4, and with exclusions two days
    later and up to an earlier day; then refreshed once with all that is given."""
    out, table = scratch_path(spark, "derived-incremental"), scratch_path(spark, "pd-raw")
    raw, companies, exclusions = mu.with_month(fx.pd_raw(spark, d)), fx.companies_mapping_info(spark, d), fx.excluded_companies(spark, d)
    late = F.col("data_date") >= F.lit(_OLD_DAY)
    raw.where(~late).write.partitionBy("data_month").parquet(table)
    before = companies.where(F.col("company_id") % 10 != 3).withColumn(
        "industry_sector", F.when(F.col("company_id") % 10 == 4, F.lit("OLD")).otherwise(F.col("industry_sector")))
    derived.start_incremental(spark, table, before, exclusions.withColumn("start_date", F.date_add("start_date", 2)), out,
                              AS_OF - dt.timedelta(days=4), UPDATED_AT)
    raw.where(late).write.mode("append").partitionBy("data_month").parquet(table)
    derived.refresh_incremental(spark, table, companies, exclusions, out, AS_OF, raw.where(late), UPDATED_AT)
    return out


register("refresh_incremental_website", sql(WEBSITE_SQL, "pd_raw", "companies_mapping_info", "excluded_companies"))(
    lambda spark, d: spark.read.parquet(f"{incremental_tables(spark, d)}/website").drop("data_month"))
register("refresh_incremental_panel", sql(PANEL_SQL, "pd_raw", "companies_mapping_info"))(
    lambda spark, d: spark.read.parquet(f"{incremental_tables(spark, d)}/panel").drop("data_month"))


@register("proj_website", sql(
    "SELECT company_id AS CompanyID, data_date AS DTDate, data_date AS FSDate, "
    + ", ".join(f"PD_{h} AS DFT{i}" for i, h in enumerate(WEBSITE_HORIZONS, 1))
    + ", region_id AS RegionFlag, 0 AS Draft, TIMESTAMP '2024-02-01 00:00:00' AS Updated "
    "FROM pd_raw p JOIN companies_mapping_info c USING (company_id)", "pd_raw", "companies_mapping_info"))
def q_proj_website(spark, d):
    from riskloom.operators.reshape import website_projection
    p = fx.pd_raw(spark, d).join(fx.companies_mapping_info(spark, d).select("company_id", "region_id"), "company_id")
    return website_projection(p, UPDATED_AT)


@register("manifest_missing", sql(
    "WITH expected AS (SELECT name AS folder, e AS econ_id, concat(name, '/Products/P2_Pd/pd60h_', "
    "CAST(e AS VARCHAR), '.mat') AS path FROM daily_folders, unnest([" + ", ".join(str(e) for e in DAILY_ECONOMIES)
    + "]) AS u(e) WHERE substr(name, 1, 8) = '20240115'), "
    "present AS (SELECT DISTINCT CAST(company_id % 25 + 1 AS INT) AS econ_id FROM pd_raw "
    "WHERE data_date = DATE '2024-01-15') "
    "SELECT folder, path FROM expected WHERE econ_id NOT IN (SELECT econ_id FROM present)", "pd_raw", "daily_folders"))
def q_manifest_missing(spark, d):
    from riskloom.sources.files import expected_manifest, missing_files
    folders = fx.daily_folders(spark, d).where(F.substring("name", 1, 8) == f"{FILTER_DAY:%Y%m%d}")
    exp = expected_manifest(folders.select(F.col("name").alias("folder")), [("pd60h", "P2_Pd")], DAILY_ECONOMIES)
    present = (flt.filter_day(fx.pd_raw(spark, d), FILTER_DAY).select(fx.econ_of().alias("econ_id")).distinct())
    return missing_files(exp, present).select("folder", "path")

