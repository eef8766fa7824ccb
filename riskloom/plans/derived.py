"""Derived serving tables and their refresh order.

panel (latest version per company/day, mapped companies only)
  -> panel_2d (the two latest dates)
  -> website (outside exclusion intervals, served horizons)

``refresh_derived`` rebuilds all of them.  ``refresh_incremental`` keeps what
cannot have changed: new versions, changed mappings and changed exclusions are
turned into affected (company, day) keys, and only the months that hold one are
recomputed, from those months of the raw table and of the panel.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import mutate as mu
from riskloom.functions.expr import select_names
from riskloom.operators.filters import latest_n_dates
from riskloom.operators.joins import anti_exclusion_interval, join_company_dim
from riskloom.operators.reshape import website_projection
from riskloom.operators.windows import latest_version
from riskloom.schemas import PD_COLS
from riskloom.sources.sinks import write_clustered

PANEL_DIM_COLS = ("company_name", "ticker", "domicile_id", "region_id", "industry_sector_id", "industry_sector",
                  "industry_group_id", "industry_subgroup_id")


def panel_latest(pd_raw: DataFrame, companies: DataFrame) -> DataFrame:
    """Latest version per (data_date, company_id), joined to the mapping."""
    latest = latest_version(pd_raw, ("data_date", "company_id"), "operation_time")
    joined = join_company_dim(latest, companies, PANEL_DIM_COLS)
    return select_names(joined, ["data_date", "company_id", *PANEL_DIM_COLS, "operation_time", "PDIR", *PD_COLS])


def panel_2d(panel: DataFrame, n: int = 2) -> DataFrame:
    return latest_n_dates(panel, n, "data_date")


def website(panel: DataFrame, exclusions: DataFrame, as_of: dt.date | Column | None = None,
            updated_at: dt.datetime | Column | None = None) -> DataFrame:
    kept = anti_exclusion_interval(panel, exclusions, as_of)
    return website_projection(kept, updated_at)


def read_by_month(like: DataFrame, path: str) -> DataFrame:
    """The table at ``path`` (by month) with the columns of ``like``; it may be empty, without a single month."""
    columns = [f for f in like.schema.fields if f.name != "data_month"]
    schema = T.StructType([*columns, T.StructField("data_month", T.StringType())])
    return like.sparkSession.read.schema(schema).parquet(path)


def refresh_derived(spark: SparkSession, pd_raw: DataFrame, companies: DataFrame,
                    exclusions: DataFrame, out_dir: str, as_of=None, updated_at=None) -> dict[str, str]:
    """Rebuild panel -> 2-day -> website in dependency order.  The panel is
    written once and its downstream tables read the written copy, so the
    window + join run once and lineage is cut at the table boundary."""
    paths = {k: f"{out_dir}/{k}" for k in ("panel", "panel_2d", "website")}
    built = panel_latest(pd_raw, companies)
    write_clustered(built, paths["panel"])
    panel = read_by_month(built, paths["panel"]).drop("data_month")
    panel_2d(panel).write.mode("overwrite").parquet(paths["panel_2d"])
    website(panel, exclusions, as_of, updated_at).write.mode("overwrite").parquet(paths["website"])
    return paths


# --------------------------------------------------------------------------
# I10 incremental refresh
# --------------------------------------------------------------------------
#: Columns of the mapping and of the exclusions that the derived tables depend on.
MAPPING_COLS = ("company_id", *PANEL_DIM_COLS)
#: Snapshots of the inputs, beside the tables they led to.
MAPPING, INTERVALS = "_mapping", "_intervals"


def _intervals(exclusions: DataFrame, as_of) -> DataFrame:
    """Closed exclusion intervals: an open one ends at ``as_of``, so a later ``as_of`` is a change of it."""
    end = F.coalesce(F.col("end_date"), as_of if isinstance(as_of, Column) else F.lit(as_of))
    return exclusions.select("company_id", "start_date", end.alias("end_date")).distinct()


def changed_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows in one of two tables only (NULLs compare equal): one aggregation, no join."""
    cols = new.columns
    both = old.select(*cols, F.lit(1).alias("_old")).unionByName(new.select(*cols, F.lit(0).alias("_old")))
    sides = both.groupBy(*cols).agg(F.max("_old").alias("_in_old"), F.min("_old").alias("_in_new"))
    return sides.where(~((F.col("_in_old") == 1) & (F.col("_in_new") == 0))).select(*cols)


def affected_months(keys: DataFrame, date_col: str = "data_date") -> list[str]:
    """Months of the affected keys: a list bounded by the calendar."""
    return sorted(r[0] for r in keys.select(F.date_format(date_col, "yyyy-MM")).distinct().collect())


def affected_by_mapping(pd_raw: DataFrame, changed: DataFrame) -> DataFrame:
    """(company_id, data_date) of the companies whose mapping appeared, changed or went."""
    return pd_raw.select("company_id", "data_date").join(changed.select("company_id").distinct(), "company_id", "left_semi")


def affected_by_exclusions(panel: DataFrame, changed: DataFrame) -> DataFrame:
    """(company_id, data_date) of the panel inside an exclusion interval that appeared or went."""
    days = panel.select("company_id", "data_date")
    hit = ((days["company_id"] == changed["company_id"]) & (days["data_date"] >= changed["start_date"])
           & (days["data_date"] <= changed["end_date"]))
    return days.join(changed, hit, "left_semi")


def _latest_dates(panel: DataFrame, n: int = 2) -> DataFrame:
    """``panel_2d`` from the last months that can hold the ``n`` latest dates: a
    month with rows holds one date at least, so ``n`` months are enough."""
    months = sorted((r[0] for r in panel.select("data_month").distinct().collect()), reverse=True)[:n]
    return panel_2d(panel.where(F.col("data_month").isin(months)).drop("data_month"), n)


def start_incremental(spark: SparkSession, pd_table: str, companies: DataFrame, exclusions: DataFrame, out_dir: str, as_of,
                      updated_at=None) -> dict[str, str]:
    """The first, full build of the tables that ``refresh_incremental`` keeps: as
    ``refresh_derived``, with the website by month and snapshots of the inputs."""
    paths = {k: f"{out_dir}/{k}" for k in ("panel", "panel_2d", "website")}
    raw = spark.read.parquet(pd_table).drop("data_month")
    built = panel_latest(raw, companies)
    write_clustered(built, paths["panel"])
    panel = read_by_month(built, paths["panel"])
    served = mu.with_month(website(panel.drop("data_month"), exclusions, as_of, updated_at), "DTDate")
    served.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("data_month").parquet(paths["website"])
    _latest_dates(panel).write.mode("overwrite").parquet(paths["panel_2d"])
    companies.select(*MAPPING_COLS).distinct().write.mode("overwrite").parquet(f"{out_dir}/{MAPPING}")
    _intervals(exclusions, as_of).write.mode("overwrite").parquet(f"{out_dir}/{INTERVALS}")
    return paths


def refresh_incremental(spark: SparkSession, pd_table: str, companies: DataFrame, exclusions: DataFrame, out_dir: str, as_of,
                        new_versions: DataFrame | None = None, updated_at=None) -> dict[str, list[str]]:
    """Bring the derived tables of ``out_dir`` up to date and return the months
    recomputed for each.  ``new_versions`` holds the (company_id, data_date)
    keys that loads have touched since the last refresh; changes of the mapping
    and of the exclusions are found against the snapshots, which are replaced
    last: a refresh that breaks off is found again and repeated."""
    raw, panel_path, web_path = spark.read.parquet(pd_table), f"{out_dir}/panel", f"{out_dir}/website"
    mapping_now = companies.select(*MAPPING_COLS).distinct()
    intervals_now = _intervals(exclusions, as_of)
    mapping_diff = mu.staged(changed_rows(spark.read.parquet(f"{out_dir}/{MAPPING}"), mapping_now), "mapping-diff")
    interval_diff = mu.staged(changed_rows(spark.read.parquet(f"{out_dir}/{INTERVALS}"), intervals_now), "interval-diff")

    keys = affected_by_mapping(raw, mapping_diff) if not mapping_diff.isEmpty() else None
    if new_versions is not None:
        loaded = new_versions.select("company_id", "data_date")
        keys = loaded if keys is None else keys.unionByName(loaded)
    panel_months = affected_months(keys) if keys is not None else []
    rebuilt = panel_latest(raw.where(F.col("data_month").isin(panel_months)).drop("data_month"), companies)
    if panel_months:
        mu.commit_months(mu.with_month(rebuilt), panel_path, panel_months)
        _latest_dates(read_by_month(rebuilt, panel_path)).write.mode("overwrite").parquet(f"{out_dir}/panel_2d")

    panel = read_by_month(rebuilt, panel_path)
    hidden = affected_months(affected_by_exclusions(panel, interval_diff)) if not interval_diff.isEmpty() else []
    web_months = sorted(set(panel_months) | set(hidden))
    if web_months:
        touched = panel.where(F.col("data_month").isin(web_months)).drop("data_month")
        mu.commit_months(mu.with_month(website(touched, exclusions, as_of, updated_at), "DTDate"), web_path, web_months)
    for now, name in ((mapping_now, MAPPING), (intervals_now, INTERVALS)):
        now.write.mode("overwrite").parquet(f"{out_dir}/{name}")
    return {"panel": panel_months, "website": web_months}
