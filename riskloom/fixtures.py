"""Panel-shaped views derived from the driver's test tables.

Each view exists twice: as a DataFrame built from the base parquet tables
(used by the queries) and as SQL text (inlined as CTEs by the DuckDB
oracle).  The two are written independently so the oracle is a real check.
Every view covers its whole base table; the few key-derived rules below
(every 7th company unmapped, every 5th excluded, a third without ratings)
decide *which* rows play which role, they never cut the input.
"""

from __future__ import annotations

import datetime as dt
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.schemas import PD_COLS

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations"]

CALIBRATION = dt.date(2024, 2, 1)
CURRENT_CUTOFF = dt.date(2024, 1, 21)
AS_OF = dt.date(2024, 1, 30)
PD_SCALE = 3e4


_READERS: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver test table.  The tables are read-only, so the reader
    DataFrame (file listing + footer schema) is kept per session and path."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    per_session = _READERS.setdefault(spark, {})
    df = per_session.get(path)
    if df is None:
        df = per_session[path] = spark.read.parquet(path)
    return df


# --------------------------------------------------------------------------
# DataFrame views
# --------------------------------------------------------------------------
def pdir_expr(event_type="event_type", event_id="event_id"):
    return (F.when(F.col(event_type) == "error", F.lit(None).cast("double"))
            .when(F.col(event_type) == "view", F.lit(0.0))
            .otherwise((F.lit(1) + F.col(event_id) % 21).cast("double")))


VERSION_EXPRS = ["user_id AS company_id", "CAST(ts AS DATE) AS data_date", "DATE'2024-02-01' AS calibration_date",
                 "ts AS operation_time",
                 "CASE WHEN event_type = 'error' THEN CAST(NULL AS DOUBLE) WHEN event_type = 'view' THEN 0.0D "
                 "ELSE CAST(1 + event_id % 21 AS DOUBLE) END AS PDIR"]
#: The horizons of a version, from its ``value``.
PD_EXPRS = {c: f"value * {i} / 3e4" for i, c in enumerate(PD_COLS, 1)}
PD_RAW_EXPRS = VERSION_EXPRS + [f"{e} AS {c}" for c, e in PD_EXPRS.items()]


def pd_raw(spark, sf_dir) -> DataFrame:
    """One version row per event: the company's 60-horizon PD panel."""
    return table(spark, sf_dir, "events").selectExpr(*PD_RAW_EXPRS)


def latest_values(spark, sf_dir, before: dt.date | None = None) -> DataFrame:
    """Latest version of each (company, date), its horizons still one ``value``:
    60 columns that follow from a row need not be sorted and shuffled with it."""
    from riskloom.operators.windows import latest_version
    versions = table(spark, sf_dir, "events").selectExpr(*VERSION_EXPRS, "value")
    if before is not None:
        versions = versions.where(F.col("data_date") < F.lit(before))
    return latest_version(versions)


def with_horizons(versions: DataFrame) -> DataFrame:
    """The panel of ``latest_values``."""
    return versions.selectExpr(*[c for c in versions.columns if c != "value"], *[f"{e} AS {c}" for c, e in PD_EXPRS.items()])


def pd_latest(spark, sf_dir) -> DataFrame:
    """Latest version of each (company, date)."""
    return with_horizons(latest_values(spark, sf_dir))


def pd_current(spark, sf_dir) -> DataFrame:
    """Latest version of each (company, date) before the cut-off date."""
    return with_horizons(latest_values(spark, sf_dir, CURRENT_CUTOFF))


def companies_mapping_info(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (c.where(F.col("c_custkey") % 7 != 0)
            .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("c_custkey").alias("company_id"),
                    F.col("c_name").alias("company_name"),
                    F.col("n_nationkey").cast("bigint").alias("domicile_id"),
                    F.col("n_name").alias("country_domicile"),
                    F.col("r_regionkey").cast("bigint").alias("region_id"),
                    F.col("r_name").alias("region"),
                    F.col("c_mktsegment").alias("industry_sector"),
                    F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ticker"),
                    F.length("c_mktsegment").cast("bigint").alias("industry_sector_id"),
                    (F.col("c_custkey") % 11).cast("bigint").alias("industry_group_id"),
                    (F.col("c_custkey") % 37).cast("bigint").alias("industry_subgroup_id")))


def excluded_companies(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    start = F.lit(dt.date(2024, 1, 1))
    return (c.where(F.col("c_custkey") % 5 == 0)
            .select(F.col("c_custkey").alias("company_id"),
                    F.col("c_name").alias("ticker"),
                    F.date_add(start, (F.col("c_custkey") % 20).cast("int")).alias("start_date"),
                    F.when(F.col("c_custkey") % 10 == 0, F.lit(None).cast("date"))
                    .otherwise(F.date_add(start, (F.col("c_custkey") % 20 + 5).cast("int")))
                    .alias("end_date")))


def credit_events_raw(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.select(F.col("l_suppkey").alias("company_id"),
                    F.col("l_shipdate").cast("date").alias("default_date"),
                    F.col("l_linenumber").cast("bigint").alias("default_type"),
                    F.col("l_orderkey").alias("event_id"))
            .distinct())


def event_code_mapping(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.where(F.col("l_linenumber") < 6)
            .select(F.col("l_linenumber").cast("bigint").alias("id"),
                    F.concat(F.lit("ACTION_"), F.col("l_linenumber").cast("string")).alias("action_name"))
            .distinct())


def rating_all(spark, sf_dir) -> DataFrame:
    """A rating for every company and day of the data."""
    ev = table(spark, sf_dir, "events")
    return (ev.groupBy(F.col("user_id").alias("company_id"), F.col("ts").cast("date").alias("data_date"))
            .agg(F.max((F.lit(1) + F.col("event_id") % 21).cast("double")).alias("pdir")))


def rating_key(spark, sf_dir) -> DataFrame:
    """Ratings of the companies that have one (joins and reconciliation need some without)."""
    return rating_all(spark, sf_dir).where(F.col("company_id") % 3 != 0)


def users_flat(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("user_key"),
        F.concat(F.lower("c_name"), F.lit("@x.org")).alias("email"),
        F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("industry"),
        F.when(k % 3 == 0, F.lit("Y")).when(k % 3 == 1, F.lit("n")).alias("buda_access"),
    )


def dirty_text(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    m = F.col("event_id") % 5
    return ev.select(
        "event_id",
        F.when(m == 0, F.lit(" NaN ")).when(m == 1, F.lit("")).when(m == 2, F.lit("NaT"))
        .otherwise(F.concat(F.lit("  "), F.col("event_type"), F.lit(" "))).alias("cell"),
    )


def ymd_parts(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.lit(2024).alias("yyyy"),
        (F.col("event_id") % 12 + 1).cast("int").alias("mm"),
        (F.col("event_id") % 31 + 1).cast("int").alias("dd"),
        (F.col("user_id") * 1000 + 7).cast("bigint").alias("raw_company_id"),
    )


def daily_folders(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return (ev.select(F.concat(F.date_format(F.col("ts").cast("date"), "yyyyMMdd"),
                               F.lit("_cali_20240201")).alias("name"))
            .distinct())


def operation_log(spark, sf_dir) -> DataFrame:
    raw = pd_raw(spark, sf_dir).where(F.col("data_date") < F.lit(CURRENT_CUTOFF))
    return (raw.groupBy("data_date", "calibration_date")
            .agg(F.max("operation_time").alias("operation_time"))
            .select(F.col("data_date").alias("data_start_date"),
                    F.col("data_date").alias("data_end_date"),
                    F.lit(-99).alias("econ_id"), F.lit(-99).alias("company_id"),
                    "calibration_date", "operation_time",
                    F.lit("daily_insertion").alias("operation_action")))


def econ_of(company_id="company_id"):
    """Economy shard a company is delivered in (the files are cut by economy)."""
    return (F.col(company_id) % 25 + 1).cast("int")


def pd_matrix_named(spark, sf_dir) -> DataFrame:
    """The daily pd60h matrix rows as the source delivers them: doubles only,
    date split into yyyy/mm/dd, NaN for a missing PD (PD_60 of rows whose
    rating is missing)."""
    return pd_raw(spark, sf_dir).selectExpr(
        "CAST(company_id % 25 + 1 AS INT) AS econ_id", "CAST(company_id AS DOUBLE) AS company_id",
        "CAST(year(data_date) AS DOUBLE) AS yyyy", "CAST(month(data_date) AS DOUBLE) AS mm",
        "CAST(day(data_date) AS DOUBLE) AS dd", *PD_COLS[:-1],
        f"CASE WHEN PDIR IS NULL THEN CAST('NaN' AS DOUBLE) ELSE {PD_COLS[-1]} END AS {PD_COLS[-1]}")


def pd_matrix_rows(spark, sf_dir) -> DataFrame:
    """Unnamed form of ``pd_matrix_named``: (econ_id, values array<double>)."""
    named = pd_matrix_named(spark, sf_dir)
    cols = [c for c in named.columns if c != "econ_id"]
    return named.selectExpr("econ_id", f"array({', '.join(cols)}) AS values")


VIEWS = {
    "pd_raw": pd_raw,
    "pd_current": pd_current,
    "companies_mapping_info": companies_mapping_info,
    "excluded_companies": excluded_companies,
    "credit_events_raw": credit_events_raw,
    "event_code_mapping": event_code_mapping,
    "rating_all": rating_all,
    "rating_key": rating_key,
    "users_flat": users_flat,
    "dirty_text": dirty_text,
    "ymd_parts": ymd_parts,
    "daily_folders": daily_folders,
    "operation_log": operation_log,
    "pd_matrix_named": pd_matrix_named,
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return VIEWS[name](spark, sf_dir)


# --------------------------------------------------------------------------
# SQL text of the same views, for the DuckDB oracle
# --------------------------------------------------------------------------
_PD_SQL_COLS = ", ".join(f"value * {i} / 3e4 AS PD_{i}" for i in range(1, len(PD_COLS) + 1))

VIEW_SQL = {
    "pd_raw": (
        "SELECT user_id AS company_id, CAST(ts AS DATE) AS data_date, "
        "CAST('2024-02-01' AS DATE) AS calibration_date, ts AS operation_time, "
        "CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN 0e0 "
        "ELSE CAST(1 + event_id % 21 AS DOUBLE) END AS PDIR, " + _PD_SQL_COLS + " FROM events"
    ),
    "pd_current": (
        "SELECT * FROM pd_raw p WHERE data_date < CAST('2024-01-21' AS DATE) AND operation_time = "
        "(SELECT max(operation_time) FROM pd_raw q WHERE q.company_id = p.company_id "
        "AND q.data_date = p.data_date)"
    ),
    "companies_mapping_info": (
        "SELECT c_custkey AS company_id, c_name AS company_name, CAST(n_nationkey AS BIGINT) AS domicile_id, "
        "n_name AS country_domicile, CAST(r_regionkey AS BIGINT) AS region_id, r_name AS region, "
        "c_mktsegment AS industry_sector, 'T' || c_custkey AS ticker, length(c_mktsegment) AS industry_sector_id, "
        "c_custkey % 11 AS industry_group_id, c_custkey % 37 AS industry_subgroup_id "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey "
        "JOIN region ON n_regionkey = r_regionkey WHERE c_custkey % 7 <> 0"
    ),
    "excluded_companies": (
        "SELECT c_custkey AS company_id, c_name AS ticker, "
        "CAST('2024-01-01' AS DATE) + CAST(c_custkey % 20 AS INT) AS start_date, "
        "CASE WHEN c_custkey % 10 = 0 THEN NULL "
        "ELSE CAST('2024-01-01' AS DATE) + CAST(c_custkey % 20 + 5 AS INT) END AS end_date "
        "FROM customer WHERE c_custkey % 5 = 0"
    ),
    "credit_events_raw": (
        "SELECT DISTINCT l_suppkey AS company_id, CAST(l_shipdate AS DATE) AS default_date, "
        "CAST(l_linenumber AS BIGINT) AS default_type, l_orderkey AS event_id "
        "FROM lineitem"
    ),
    "event_code_mapping": (
        "SELECT DISTINCT CAST(l_linenumber AS BIGINT) AS id, "
        "concat('ACTION_', CAST(l_linenumber AS VARCHAR)) AS action_name FROM lineitem WHERE l_linenumber < 6"
    ),
    "rating_all": (
        "SELECT user_id AS company_id, CAST(ts AS DATE) AS data_date, "
        "max(CAST(1 + event_id % 21 AS DOUBLE)) AS pdir FROM events "
        "GROUP BY user_id, CAST(ts AS DATE)"
    ),
    "rating_key": (
        "SELECT user_id AS company_id, CAST(ts AS DATE) AS data_date, "
        "max(CAST(1 + event_id % 21 AS DOUBLE)) AS pdir FROM events WHERE user_id % 3 <> 0 "
        "GROUP BY user_id, CAST(ts AS DATE)"
    ),
    "users_flat": (
        "SELECT c_custkey AS user_key, concat(lower(c_name), '@x.org') AS email, "
        "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS industry, "
        "CASE WHEN c_custkey % 3 = 0 THEN 'Y' WHEN c_custkey % 3 = 1 THEN 'n' END AS buda_access "
        "FROM customer"
    ),
    "dirty_text": (
        "SELECT event_id, CASE event_id % 5 WHEN 0 THEN ' NaN ' WHEN 1 THEN '' WHEN 2 THEN 'NaT' "
        "ELSE concat('  ', event_type, ' ') END AS cell FROM events"
    ),
    "ymd_parts": (
        "SELECT event_id, 2024 AS yyyy, CAST(event_id % 12 + 1 AS INT) AS mm, "
        "CAST(event_id % 31 + 1 AS INT) AS dd, CAST(user_id * 1000 + 7 AS BIGINT) AS raw_company_id "
        "FROM events"
    ),
    "daily_folders": (
        "SELECT DISTINCT concat(replace(CAST(CAST(ts AS DATE) AS VARCHAR), '-', ''), '_cali_20240201') "
        "AS name FROM events"
    ),
    "operation_log": (
        "SELECT data_date AS data_start_date, data_date AS data_end_date, -99 AS econ_id, "
        "-99 AS company_id, calibration_date, max(operation_time) AS operation_time, "
        "'daily_insertion' AS operation_action FROM pd_raw "
        "WHERE data_date < CAST('2024-01-21' AS DATE) GROUP BY data_date, calibration_date"
    ),
    "pd_matrix_named": (
        "SELECT CAST(company_id % 25 + 1 AS INT) AS econ_id, CAST(company_id AS DOUBLE) AS company_id, "
        "CAST(year(data_date) AS DOUBLE) AS yyyy, CAST(month(data_date) AS DOUBLE) AS mm, "
        "CAST(day(data_date) AS DOUBLE) AS dd, "
        + ", ".join(f"PD_{i}" for i in range(1, 60))
        + ", CASE WHEN PDIR IS NULL THEN CAST('NaN' AS DOUBLE) ELSE PD_60 END AS PD_60 FROM pd_raw"
    ),
}

VIEW_DEPS = {"pd_current": ["pd_raw"], "operation_log": ["pd_raw"], "pd_matrix_named": ["pd_raw"]}


def with_views(*names: str) -> str:
    """``WITH`` clause defining the named views (and what they depend on)."""
    order: list[str] = []

    def add(n):
        for d in VIEW_DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in order) + "\n"


def sql(body: str, *views: str) -> str:
    """Oracle text: the views as CTEs, merged with a leading ``WITH`` of the body."""
    if not views:
        return body
    head = with_views(*views)
    b = body.lstrip()
    if b[:5].upper() == "WITH ":
        return head.rstrip("\n") + ",\n" + b[5:]
    return head + body
