"""Jobs: the reference's load routines as Spark plans.

The per-day and per-economy loops of the source become one multi-file scan
in which the delivery folder (day, calibration) and the economy (file name)
are columns.  The driver only handles file-path manifests (one entry per
delivery folder in range) and scalar parameters; rows never pass through it.

Delivery layout (as in the source system)::

    <root>/<yyyymmdd>_cali_<yyyymmdd>/Products/<P2_Pd|P3_Pdir|P7_As>/<prefix><econ>[.<part>].<ext>
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.clean import clean_all, parse_bool
from riskloom.functions.dates import date_from_parts, date_from_yyyymmdd
from riskloom.operators import aggregates as agg
from riskloom.operators import filters as flt
from riskloom.operators import joins as jn
from riskloom.operators import mutate as mu
from riskloom.operators import reshape as rs
from riskloom.operators import windows as win
from riskloom.schemas import (ACTION_DAILY, AS_TABLE, CREDIT_EVENT_KEYS, FILL_LOOKBACK_DAYS, PD_COLS, PD_KEYS,
                              SIMPLE_HORIZONS, USER_BOOL_FIELDS, USER_DEFAULTS, USER_JSON_FIELDS,
                              USER_TIME_FIELDS)
from riskloom.sources import files as fl
from riskloom.sources import readers as rd
from riskloom.sources import sinks as sk
from riskloom.sources.matrix import FOLDER_RE, scan_matrix
from riskloom.sources.readers import table_exists

#: Partition column of the event table.
EVENT_MONTH = "default_month"
PD_SUB, PDIR_SUB, AS_SUB = "P2_Pd", "P3_Pdir", "P7_As"


def _lit(v):
    return v if isinstance(v, Column) else F.lit(v)


# --------------------------------------------------------------------------
# delivery catalogue
# --------------------------------------------------------------------------
def list_delivery_names(root: str) -> list[str]:
    """Names of the delivery folders directly under ``root``: one directory
    listing (metadata only, one entry per delivery day), no file scan."""
    import re

    from pyarrow import fs as pafs

    from riskloom.session import _fs_path
    fs, base = _fs_path(root)
    try:
        infos = fs.get_file_info(pafs.FileSelector(base, recursive=False))
    except FileNotFoundError:                          # any other trouble with the listing is raised
        return []
    pat = re.compile(r"^\d{8}_cali_\d{8}$")
    return sorted(i.base_name for i in infos if i.type == pafs.FileType.Directory and pat.match(i.base_name))


def delivery_folders(spark: SparkSession, root: str) -> DataFrame:
    """(folder, folder_date, calibration_date) of every daily delivery folder."""
    names = list_delivery_names(root)
    f = spark.createDataFrame([(n,) for n in names], "folder string")
    return f.select(
        "folder", F.to_date(F.substring("folder", 1, 8), "yyyyMMdd").alias("folder_date"),
        F.to_date(F.substring("folder", -8, 8), "yyyyMMdd").alias("calibration_date"))


def _as_date(v) -> dt.date:
    return v if isinstance(v, dt.date) and not isinstance(v, dt.datetime) else \
        (v.date() if isinstance(v, dt.datetime) else dt.date.fromisoformat(str(v)))


def folders_in_range(spark: SparkSession, root: str, start, end) -> DataFrame:
    """The delivery folder of each trading day (Mon-Fri) in ``[start, end]``;
    a day with two folders or none fails the job.  Selected from the
    directory listing (metadata, one name per day)."""
    lo, hi = _as_date(start), _as_date(end)
    by_day: dict[dt.date, list[str]] = {}
    for n in list_delivery_names(root):
        day = dt.datetime.strptime(n[:8], "%Y%m%d").date()
        if lo <= day <= hi and day.weekday() < 5:
            by_day.setdefault(day, []).append(n)
    dup = {d: v for d, v in by_day.items() if len(v) > 1}
    if dup:
        raise ValueError(f"more than one calibration folder for {sorted(dup)[0]}: {dup[sorted(dup)[0]]}")
    days = [lo + dt.timedelta(days=k) for k in range((hi - lo).days + 1)]
    absent = [str(d) for d in days if d.weekday() < 5 and d not in by_day]
    if absent:
        raise FileNotFoundError(f"no delivery folder for {absent} under {root}")
    rows = [(v[0], d, dt.datetime.strptime(v[0][-8:], "%Y%m%d").date()) for d, v in sorted(by_day.items())]
    return spark.createDataFrame(rows, "folder string, folder_date date, calibration_date date")


def _paths(root: str, folders: DataFrame, sub: str) -> list[str]:
    """Folder paths of one product for the folders in range (a path
    manifest bounded by the number of days, not by data)."""
    return [f"{root.rstrip('/')}/{r.folder}/Products/{sub}" for r in folders.select("folder").collect()]


def read_shards(spark: SparkSession, root, glob: str) -> DataFrame:
    """``scan_matrix`` for the jobs: an unreadable shard fails the job with its
    path and error instead of leaving its rows out."""
    rows = scan_matrix(spark, root, glob, keep_errors=True)
    stop = F.raise_error(F.concat_ws(" ", F.lit("unreadable shard"), "path", "error")).cast("array<double>")
    return rows.withColumn("values", F.when(F.col("error").isNull(), F.col("values")).otherwise(stop)).drop("error")


def scan_product(spark: SparkSession, root: str, folders: DataFrame, sub: str, glob: str,
                 layout: str | Sequence[str]) -> DataFrame:
    """Named matrix rows of one product over the given delivery folders,
    with ``folder`` and ``econ_id`` (from the file name) as columns."""
    paths = _paths(root, folders, sub)
    if not paths:
        names = rs.LAYOUTS[layout] if isinstance(layout, str) else list(layout)
        return spark.createDataFrame([], ", ".join(["folder string", "econ_id int"] + [f"`{n}` double" for n in names]))
    rows = read_shards(spark, paths, glob)
    return rs.name_positional(rows, layout, keep=["folder", "econ_id"])


# --------------------------------------------------------------------------
# J1 simple load
# --------------------------------------------------------------------------
def simple_load(spark: SparkSession, matrix_root: str, table: str, glob: str = "*.npy") -> DataFrame:
    """Matrix -> (comp_id, date, 8 horizons) appended to the test table."""
    rows = rs.name_positional(read_shards(spark, matrix_root, glob), "simple_pd")
    out = rows.select(F.col("comp_id").cast("bigint").alias("comp_id"),
                      date_from_parts("yyyy", "mm", "dd").alias("date"),
                      *[F.col(f"pd_{h}") for h in SIMPLE_HORIZONS])
    sk.append(out, table)
    return spark.read.parquet(table)


# --------------------------------------------------------------------------
# PDIR day, PD day, PD range
# --------------------------------------------------------------------------
def pdir_days(spark: SparkSession, root: str, folders: DataFrame, operation_time,
              pd_keys: DataFrame | None = None, check_unique: bool = True) -> DataFrame:
    """Daily ratings of the folders: (data_date, company_id, pdir_extracted),
    the rating's own date kept; restricted to the PD keys when given (D3).
    A repeated (date, company) rating fails the job instead of multiplying
    PD rows in the join."""
    rows = scan_product(spark, root, folders, PDIR_SUB, "pdirNum_*", "pdir_daily")
    cal = F.to_date(F.substring("folder", -8, 8), "yyyyMMdd")
    prepared = rs.prep_pdir_daily(rows, cal, operation_time, econ_id=F.col("econ_id"))
    out = prepared.select("data_date", "company_id", F.col("pdir").alias("pdir_extracted"))
    if check_unique:
        out = agg.require_unique(out, ["data_date", "company_id"], "daily ratings")
    if pd_keys is not None:
        out = out.join(pd_keys.select("data_date", "company_id").distinct(), ["data_date", "company_id"], "inner")
    return out


def unrated_days(spark: SparkSession, root: str, folders: DataFrame, operation_time) -> DataFrame:
    """PD rows of the folders: data_date is the requested (folder) day,
    ``current_trading_date`` the folder's yyyymmdd; rows missing any horizon
    are dropped."""
    rows = scan_product(spark, root, folders, PD_SUB, "pd60h_*", "pd_daily")
    cal = F.to_date(F.substring("folder", -8, 8), "yyyyMMdd")
    prepared = rs.prep_pd_daily(rows, cal, operation_time, econ_id=F.col("econ_id"), keep=["folder"])
    return (prepared.withColumn("data_date", F.to_date(F.substring("folder", 1, 8), "yyyyMMdd"))
            .withColumn("current_trading_date", F.substring("folder", 1, 8).cast("int")).drop("folder"))


def pd_days(spark: SparkSession, root: str, folders: DataFrame, operation_time, check_unique: bool = True) -> DataFrame:
    """PD rows of the folders, PDIR from the day's rating matrix (left join):
    one scan for each product."""
    ratings = pdir_days(spark, root, folders, operation_time, check_unique=check_unique)
    rows = unrated_days(spark, root, folders, operation_time)
    joined = jn.join_rating(rows, ratings, "left").withColumnRenamed("pdir_extracted", "PDIR")
    return joined.select("data_date", "company_id", "calibration_date", "operation_time", "PDIR", *PD_COLS,
                         "current_trading_date", "econ_id")


def pd_day(spark: SparkSession, root: str, day, operation_time) -> DataFrame:
    return pd_days(spark, root, folders_in_range(spark, root, day, day), operation_time)


def pd_day_reconcile(spark: SparkSession, root: str, day, operation_time) -> DataFrame:
    """E4 report of one PD day: PD rows before the join, rating rows, merged
    rows, difference.  A repeated rating key shows as more merged rows."""
    folders = folders_in_range(spark, root, day, day)
    rows = unrated_days(spark, root, folders, operation_time)
    ratings = pdir_days(spark, root, folders, operation_time, check_unique=False)
    merged = jn.join_rating(rows, ratings, "left")
    return agg.reconcile(rows, ratings, merged)


def pd_range(spark: SparkSession, root: str, start, end, operation_time, table: str,
             snapshot: str | None = None, fill_first: bool = False,
             refresh: tuple[DataFrame, DataFrame, str] | None = None) -> DataFrame:
    """All trading days in range in one scan -> keep the last delivery of
    each (company, day) -> snapshot Parquet -> PDIR missing = 0 -> insert the
    versions that the versioned table lacks -> forward fill over the look-back -> derived
    tables refreshed from the table when ``refresh = (companies, exclusions,
    out_dir)`` is given (I10).  ``fill_first`` keeps the reference's order
    (fill before insert)."""
    folders = folders_in_range(spark, root, start, end)
    merged = win.keep_last(pd_days(spark, root, folders, operation_time))
    rows = merged.select("data_date", "company_id", "calibration_date", "operation_time", "PDIR", *PD_COLS)
    if snapshot:
        sk.write_parquet_chunked(rows, snapshot)
        rows = spark.read.parquet(snapshot)
    rows = rows.withColumn("PDIR", F.coalesce(F.col("PDIR"), F.lit(0.0)))
    if fill_first:
        forward_fill_table(spark, table, start)
    # the shards are decoded once; the batch's months are the folders it was staged in
    rows, months = mu.staged_by_month(mu.with_month(rows), "pd-range")
    current = spark.read.parquet(table).where(F.col("data_month").isin(months))
    # insert-ignore on the version key: a run that is repeated adds nothing; each key is in the batch once
    sk.append(mu.absent_rows(current, rows.select(*current.columns), PD_KEYS), table, partition_cols=["data_month"])
    if not fill_first:
        forward_fill_table(spark, table, start)
    if refresh is not None:
        from riskloom.plans.derived import refresh_derived
        companies, exclusions, out_dir = refresh
        refresh_derived(spark, spark.read.parquet(table).drop("data_month"), companies, exclusions, out_dir)
    return spark.read.parquet(table)


def forward_fill_table(spark: SparkSession, table: str, as_of, days: int = FILL_LOOKBACK_DAYS) -> None:
    """I6 on the month-partitioned table: only the months the look-back
    reaches are recomputed and replaced."""
    first = _as_date(as_of) - dt.timedelta(days=days)
    touched = spark.read.parquet(table).where(F.col("data_month") >= f"{first:%Y-%m}")    # prunes partitions when planned
    new = mu.forward_fill_update(touched.drop("data_month"), as_of, days)
    mu.commit_partitions(mu.with_month(new), table)


# --------------------------------------------------------------------------
# backfills
# --------------------------------------------------------------------------
def pdir_backfill(grid: DataFrame, out: str | None = None) -> DataFrame:
    """Rating grids (econ, date_key, firms[], values[]) -> melted, prepared
    (data_date, econ_id, company_id, pdir) -> size-bounded Parquet."""
    cells = rs.melt_grid(grid, ["econ_id", F.col("date_key").alias("date")], "firms", "values", "company_id", "pdir")
    res = rs.prep_pdir_historical(cells)
    if out:
        sk.write_parquet_chunked(res, out)
        return grid.sparkSession.read.parquet(out)
    return res


def pd_backfill(spark: SparkSession, matrix_root: str, ratings: DataFrame, calibration_date, operation_time,
                out: str, econs: DataFrame | Sequence[int] | None = None) -> DataFrame:
    """Historical PD shards (daily 64-column layout) of every economy in one
    scan, optionally restricted to a batch of economies (the files of others
    are not opened), rated from the historical PDIR table and written as size-bounded Parquet."""
    rows = read_shards(spark, matrix_root, "pd60h_*")
    if econs is not None:                              # one id an economy
        ids = [r[0] for r in econs.select("econ_id").distinct().collect()] if isinstance(econs, DataFrame) else list(econs)
        rows = rows.where(F.col("econ_id").isin(ids))
    named = rs.name_positional(rows, "pd_daily", keep=["econ_id"])
    prepared = rs.prep_pd_daily(named, calibration_date, operation_time, econ_id=F.col("econ_id"))
    r = ratings.select("data_date", "company_id", F.col("pdir").alias("PDIR"))
    rated = jn.join_rating(prepared, r, "left")
    res = rated.select("data_date", "econ_id", "company_id", "calibration_date", "operation_time", "PDIR", *PD_COLS)
    sk.write_parquet_chunked(res, out)
    return spark.read.parquet(out)


# --------------------------------------------------------------------------
# Current-state tables with history and log
# --------------------------------------------------------------------------
def load_day_state(spark: SparkSession, batch: DataFrame, latest_path: str, daily_path: str, log_path: str,
                   day, calibration_date, operation_time, keys: Sequence[str] = ("data_date", "company_id"),
                   check_duplicate: bool = True) -> DataFrame:
    """Daily load of a current-state product (PDIR2, AS): guard on the log,
    replace the 1-day table, insert-ignore into the latest table, log the
    run.  Returns the latest table."""
    if check_duplicate and _exists(spark, log_path):
        flag = mu.guard_daily(spark.read.parquet(log_path), day)
        if flag.first()[0] == 1:
            return spark.read.parquet(latest_path)
    batch.write.mode("overwrite").parquet(daily_path)                       # I1
    day_rows = spark.read.parquet(daily_path)
    current = mu.read_touched(spark, latest_path, day_rows)                  # pruned to the day's month
    parts = ["data_month"] if "data_month" in current.columns else []
    if parts:
        day_rows = mu.with_month(day_rows)
    new_rows = mu.inserted_rows(current, day_rows, keys)                     # I3
    # appending while reading the table is safe: the scan's file list is fixed
    # when the job is planned and new files commit at job end
    sk.append(new_rows, latest_path, partition_cols=parts)
    log = mu.operation_log_daily(spark, day, calibration_date, operation_time, ACTION_DAILY)
    sk.append(log, log_path)                                                  # I7 last: a crash re-runs
    return spark.read.parquet(latest_path)


def revise_state(spark: SparkSession, batch: DataFrame, latest_path: str, history_path: str, log_path: str,
                 keys: Sequence[str] = ("data_date", "company_id"),
                 daily_path: str | None = None, day=None, check_duplicate: bool = True) -> DataFrame:
    """Revision of a current-state product kept by month: rows about to change
    go to the history table (I5), the batch is upserted (I4) into the months
    of the latest table that it touches - no other month is read or written -,
    the day slice is upserted into the 1-day table (C7 + I4), one log row per
    load key (E1) is appended.  A revision logged within the guard's days (I8)
    is not loaded again; one that broke off before its log row is, and adds
    nothing to the history twice."""
    from riskloom.session import checkpoint_root
    checkpoint_root(spark)
    if check_duplicate and day is not None and _exists(spark, log_path):
        if mu.guard_revision(spark.read.parquet(log_path), day).first()[0] == 1:
            return spark.read.parquet(latest_path)
    table = spark.read.parquet(latest_path)
    plain = [c for c in table.columns if c != "data_month"]
    batch, months = mu.staged_by_month(mu.with_month(batch.select(*plain)), "revision")
    batch = batch.select(*plain)
    current = table.where(F.col("data_month").isin(months)).select(*plain)
    # a run that broke off after the commit finds its own rows: they were not replaced
    replaced = mu.history_capture(current, batch, keys).join(batch.select(*keys, "operation_time").distinct(), [*keys, "operation_time"], "left_anti")
    if _exists(spark, history_path):
        version = [*keys, "operation_time"]
        replaced = replaced.join(spark.read.parquet(history_path).select(*version), version, "left_anti")
    sk.append(replaced, history_path)
    mu.commit_months(mu.with_month(mu.upsert(current, batch, keys)), latest_path, months)
    if daily_path and day is not None:
        if _exists(spark, daily_path):
            d1 = spark.read.parquet(daily_path)
            staged = mu.upsert(d1, flt.filter_day(batch, day), keys).checkpoint(eager=True)
        else:
            staged = flt.filter_day(batch, day)
        staged.write.mode("overwrite").parquet(daily_path)
    sk.append(mu.operation_log_revision(batch), log_path)
    return spark.read.parquet(latest_path)


def as_revision(spark: SparkSession, csv_root: str, log: DataFrame, latest_path: str, history_path: str, log_path: str,
                day, operation_time, daily_path: str | None = None) -> DataFrame:
    """Revision of the AS state from CSV shards: not loaded if ``log`` has a
    revision within the guard's days (I8); its calibration is that of the first daily load on/after ``day`` (G3)."""
    if mu.guard_revision(log, day).first()[0] == 1:
        return spark.read.parquet(latest_path)
    rows = as_file_batch(spark, csv_root, F.lit(None).cast("date"), operation_time).drop("calibration_date")
    found = calibration_of_dates(log, spark.range(1).select(_lit(day).cast("date").alias("day")), "day")
    batch = mu.enforce_schema(rows.join(F.broadcast(found.drop("day"))), AS_TABLE)            # one row: the revision's day
    return revise_state(spark, batch, latest_path, history_path, log_path, daily_path=daily_path, day=day)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at ``path``; any other trouble with reading it is raised."""
    return table_exists(spark, path)


def as_day_batch(spark: SparkSession, root: str, folders: DataFrame, operation_time) -> DataFrame:
    rows = scan_product(spark, root, folders, AS_SUB, "as_*", "as_daily")
    cal = F.to_date(F.substring("folder", -8, 8), "yyyyMMdd")
    return rs.prep_as_daily(rows, cal, operation_time, econ_id=F.col("econ_id"))


def as_file_batch(spark: SparkSession, csv_root: str, calibration_date, operation_time,
                  schema=None, econ_col: str = "econ") -> DataFrame:
    """AS CSV shards laid out as ``<root>/<econ_col>=<id>/*.csv`` (the
    economy folder becomes a partition column) -> prepared rows."""
    from pyspark.sql import types as T
    schema = schema or T.StructType([T.StructField("Date", T.StringType()), T.StructField("U3_ID", T.LongType())]
                                    + [T.StructField(f"Y{i}", T.DoubleType()) for i in range(1, 6)])
    csv = spark.read.schema(schema).option("header", True).csv(csv_root)
    econ = F.col(econ_col).cast("int") if econ_col in csv.columns else F.lit(-99)
    return rs.prep_as_file(csv, calibration_date, operation_time, econ_id=econ)


def calibration_of_dates(log: DataFrame, dates: DataFrame, date_col: str = "data_date") -> DataFrame:
    """G3 for many revisions: (date, calibration_date) of the first daily load
    on/after each date; both sides are calendar-sized."""
    loads = log.where(F.col("operation_action") == ACTION_DAILY)
    return win.asof_forward(dates.select(date_col).distinct(), loads, ["calibration_date"], date_col)


def revision_calibration(log: DataFrame, day) -> DataFrame:
    """Calibration of the first daily load on/after ``day`` (one row)."""
    return (log.where((F.col("operation_action") == ACTION_DAILY) & (F.col("data_start_date") >= _lit(day)))
            .agg(F.min_by("calibration_date", "data_start_date").alias("calibration_date")))


# --------------------------------------------------------------------------
# AS backfill, credit events, exclusions
# --------------------------------------------------------------------------
def as_backfill(spark: SparkSession, csv_root: str, out: str, reject_out: str,
                calibration_date, operation_time) -> DataFrame:
    """All AS CSV shards -> prepared, staged once -> valid rows to Parquet,
    rows without a company or date to the reject CSV."""
    from riskloom.session import scratch_path
    staged = scratch_path(spark, "as-backfill-rows")
    as_file_batch(spark, csv_root, calibration_date, operation_time).write.parquet(staged)
    batch = spark.read.parquet(staged)
    valid, rejected = sk.split_valid(batch, {"no_company": F.col("company_id").isNotNull(),
                                             "no_date": F.col("data_date").isNotNull()})
    sk.write_parquet_chunked(valid, out)
    sk.write_rejects(rejected, reject_out)
    return spark.read.parquet(out)


def credit_event_rows(rows: DataFrame, layout: str) -> DataFrame:
    """Named event matrix rows -> (default_date, company_id, default_type,
    event_id, additional_comments), cells cleaned."""
    named = rs.name_positional(rows, layout)
    typed = named.select(date_from_yyyymmdd("DateStr").alias("default_date"),
                         F.col("CompanyID").cast("bigint").alias("company_id"),
                         F.col("DefaultType").cast("bigint").alias("default_type"),
                         F.col("EventID").cast("bigint").alias("event_id"),
                         F.lit(None).cast("string").alias("additional_comments"))
    return clean_all(typed)


def events_full(spark: SparkSession, root: str, table: str, glob: str = "CreditEvent_*",
                pattern: str = r"^CreditEvent_\d+(\.p\d+(-\d+)?)?\.npy$") -> DataFrame:
    """Every historical event shard -> one table (replace all), sorted; an
    existing table is left as it is when there is no event."""
    rows = fl.filter_pattern(read_shards(spark, root, glob), pattern)
    events = mu.staged(credit_event_rows(rows, "credit_events_hist"), "events-full")
    if not (events.isEmpty() and _exists(spark, table)):
        events.orderBy("default_date", "company_id", "default_type", "event_id").write.mode("overwrite").parquet(table)
    return spark.read.parquet(table)


def events_daily(spark: SparkSession, root: str, start, end, table: str, min_date: dt.date | None = None) -> DataFrame:
    """Region event shards of the delivery folders in ``[start, end]``, every
    calendar day of it (events arrive on weekends, too) -> delete the batch's
    keys from the table, insert the batch (I2).  The table is kept by month
    of the default date; only the months of the batch are read and rewritten."""
    folders = delivery_folders(spark, root).where(F.col("folder_date").between(_lit(start), _lit(end)))
    paths = _paths(root, folders, "CompanyFlow")
    if paths:
        rows = read_shards(spark, paths, "NewCreditEvent_Region_*")
        batch = mu.with_month(credit_event_rows(rows, "credit_events_daily").distinct(), "default_date", EVENT_MONTH)
        batch, months = mu.staged_by_month(batch, "events", EVENT_MONTH)
        state = spark.read.parquet(table)
        current = state.where(F.col(EVENT_MONTH).isin(months))
        new_state = mu.delete_insert(current, batch.select(*current.columns), CREDIT_EVENT_KEYS, min_date=min_date, date_col="default_date")
        mu.commit_months(new_state, table, months, EVENT_MONTH)
    return spark.read.parquet(table)


def exclusions_load(spark: SparkSession, registry: str, since, table: str, out: str,
                    null_safe: bool = False) -> DataFrame:
    """Registry -> cleaned -> rows starting or ending on/after ``since`` ->
    replace their (ticker, start_date) keys in the exclusion table."""
    reg = rd.read_registry(spark, registry)
    typed = reg.select(
        F.col("Region").alias("region"), F.col("CompanyNumber").cast("bigint").alias("company_id"),
        F.col("Country").try_cast("bigint").alias("country_id"), F.col("Ticker").alias("ticker"),
        F.col("CompanyName").alias("company_name"), F.col("Reason").alias("reason"),
        F.col("Remark").alias("remark"), F.col("StartDate").cast("date").alias("start_date"),
        F.col("EndDate").cast("date").alias("end_date"), F.col("ErrorFoundDate").cast("date").alias("error_found_date"),
        F.col("SQLQuery").alias("sql_query"), F.col("StopReason").alias("stop_reason"),
        F.col("InternalRemarks").alias("internal_remarks"))
    batch = flt.filter_either_date(typed, since)
    current = spark.read.parquet(table)
    new_state = mu.delete_insert(current, batch.select(*current.columns), ["ticker", "start_date"], null_safe)
    new_state.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


# --------------------------------------------------------------------------
# J14 daily run, J15 user load
# --------------------------------------------------------------------------
def last_trading_day(d: dt.date) -> dt.date:
    """Saturday/Sunday -> the Friday before (driver-side scalar, as B24)."""
    return d - dt.timedelta(days=max(0, d.weekday() - 4))


def daily_run(spark: SparkSession, root: str, start, end, operation_time, table: str, econs: Sequence[int],
              log_path: str, registry: str | None = None, exclusions: tuple[str, str] | None = None,
              events: tuple[str, str] | None = None,
              refresh: tuple[DataFrame, DataFrame, str] | None = None) -> DataFrame:
    """The daily run: completeness of every delivery in range (C9, raises on
    a gap) -> exclusions (J13) and credit events (J12) when given -> PD range
    (J3), derived tables refreshed with the exclusions just loaded -> one history row (date_int, source folder, operation_date).
    ``start``/``end`` default to the last trading day before today."""
    if end is None:
        end = last_trading_day(dt.date.today() - dt.timedelta(days=1))
    if start is None:
        start = end
    folders = folders_in_range(spark, root, start, end)
    expected = fl.expected_manifest(folders, [("pd60h", PD_SUB)], econs)
    names = sorted(r.folder for r in folders.select("folder").collect())       # one a day
    present = fl.list_files(spark, f"{root.rstrip('/')}/{{{','.join(names)}}}/Products/{PD_SUB}", "pd60h_*").select(
        F.regexp_extract("path", f"/{FOLDER_RE}/", 1).alias("folder"),
        fl.id_from_name("file_name").cast("int").alias("econ_id"))
    missing = fl.missing_files(expected, present, ["folder", "econ_id"])
    gap = missing.select("path").orderBy("path").collect()   # a manifest: days in range x economies at most
    if gap:
        raise RuntimeError(f"missing delivery files: {[r.path for r in gap]}")
    if registry and exclusions:
        current = exclusions_load(spark, registry, start, exclusions[0], exclusions[1])
        if refresh is not None:                        # the derived tables see the exclusions just loaded
            refresh = (refresh[0], current, refresh[2])
    if events:
        events_daily(spark, events[0], start, end, events[1])
    res = pd_range(spark, root, start, end, operation_time, table, refresh=refresh)
    history = folders.where(F.col("folder_date") == _lit(_as_date(end)).cast("date")).select(
        F.substring("folder", 1, 8).cast("int").alias("date_int"), F.col("folder").alias("source"),
        _lit(operation_time).cast("timestamp_ntz").alias("operation_date"))
    sk.append(history, log_path)                       # written last: a crashed run is simply re-run
    return res


def user_rows(users_json: DataFrame, null_literal: str | None = None) -> DataFrame:
    """JSON user records -> table rows: booleans parsed, text kept (NULL
    stays NULL, or becomes ``null_literal`` when a target needs a text
    marker), TYPE / STATUS defaults when absent, dashboard access on."""
    cols = []
    for src, dst in USER_JSON_FIELDS.items():
        if src not in users_json.columns:
            c = F.lit(None).cast("string")
        else:
            c = F.col(src)
        if src in USER_BOOL_FIELDS:
            dtype = users_json.schema[src].dataType if src in users_json.columns else None
            c = parse_bool(c, dtype)
        elif dst in USER_DEFAULTS:
            c = F.coalesce(c.cast("string"), F.lit(USER_DEFAULTS[dst]))
        elif null_literal is not None and src not in USER_TIME_FIELDS:
            c = F.coalesce(c.cast("string"), F.lit(null_literal))
        cols.append(c.alias(dst))
    return users_json.select(*cols, F.lit(True).alias("dashboard_access"),
                             F.lit(None).cast("timestamp_ntz").alias("last_login"))


def user_load(spark: SparkSession, users_json: DataFrame, table: str) -> DataFrame:
    """New users only (e-mail not in the table), with a surrogate id fixed
    once at write time, appended."""
    rows = user_rows(users_json)
    if _exists(spark, table):
        rows = jn.anti_new_users(rows, spark.read.parquet(table), "email")
    sk.append(rows.select(F.expr("uuid()").alias("id"), *rows.columns), table)
    return spark.read.parquet(table)

