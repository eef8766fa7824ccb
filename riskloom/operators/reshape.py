"""Projection and reshaping: positional naming of matrix rows, horizon
selection, melt / transpose of rating grids, the website projection, and
the per-product ``prepare`` layouts.  All are narrow (no shuffle) except
``transpose_grid``, which regroups by the other axis."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.clean import nan_to_null, rescale_id
from riskloom.functions.expr import q
from riskloom.functions.dates import date_from_parts_coerce, date_from_yyyymmdd
from riskloom.operators.filters import filter_any_missing, filter_missing_value
from riskloom.schemas import (ALL_SENTINEL, AS_COLS, AS_CSV_COLS, EXCLUSION_FILL, LAYOUTS, OPEN_END_TEXT,
                              PD_COLS, WEBSITE_HORIZONS)


def _lit(v, dtype=None):
    c = v if isinstance(v, Column) else F.lit(v)
    return c.cast(dtype) if dtype else c


# --------------------------------------------------------------------------
# B1-B3
# --------------------------------------------------------------------------
def name_positional(df: DataFrame, names: Sequence[str] | str, values: str = "values",
                    keep: Sequence[str] = (), check_length: bool = True) -> DataFrame:
    """Give the elements of an unnamed ``values`` array column names by
    position.  With ``check_length`` a row of a different width fails the
    query instead of silently shifting columns."""
    names = LAYOUTS[names] if isinstance(names, str) else list(names)
    n = len(names)
    arr = F.col(values)
    if check_length:
        # one predicate per row (raise_error yields NULL when it does not fire),
        # so the element accesses below stay plain and codegen stays small
        bad = F.when(F.size(arr) != n, F.raise_error(
            F.concat(F.lit(f"matrix row width != {n}: "), F.size(arr).cast("string"))))
        df = df.where(bad.isNull())
    if all(isinstance(k, str) for k in keep):
        return df.selectExpr(*[q(k) for k in keep], *[f"{q(values)}[{i}] AS {q(c)}" for i, c in enumerate(names)])
    return df.select(*keep, *[F.col(values)[i].alias(c) for i, c in enumerate(names)])


def horizon_columns(prefix: str = "PD_", horizons: Sequence[int] | int = 60) -> list[str]:
    hs = range(1, horizons + 1) if isinstance(horizons, int) else horizons
    return [f"{prefix}{h}" for h in hs]


def reorder(df: DataFrame, columns: Sequence[str], rename: dict | None = None,
            drop: Sequence[str] = ()) -> DataFrame:
    """Fixed output order after optional renames and drops."""
    if rename:
        df = df.withColumnsRenamed(rename)
    if drop:
        df = df.drop(*drop)
    return df.select(*columns)


# --------------------------------------------------------------------------
# grids
# --------------------------------------------------------------------------
def melt_grid(grid: DataFrame, keep: Sequence, index: str, values: str,
              index_name: str, value_name: str) -> DataFrame:
    """Grid rows carrying an index vector (``index``) parallel to ``values``
    -> one row per cell: (*keep, index_name, value_name).  Empty rows give
    nothing; NULL cells are kept (filter them with C2)."""
    first = grid.select(*keep, F.col(index).alias("_idx"), F.posexplode(values).alias("_pos", value_name))
    kept = [c for c in first.columns if c not in ("_idx", "_pos", value_name)]
    return first.select(*kept, F.col("_idx")[F.col("_pos")].alias(index_name), value_name)


def melt_wide(df: DataFrame, ids: Sequence[str], value_cols: Sequence[str],
              var_name: str = "variable", value_name: str = "value") -> DataFrame:
    """Wide -> long keeping NULL cells (``DataFrame.unpivot``)."""
    return df.unpivot(list(ids), list(value_cols), var_name, value_name)


def transpose_grid(cells: DataFrame, keep: Sequence[str], row_key: str, col_key: str,
                   value: str, index_out: str = "index", values_out: str = "values") -> DataFrame:
    """Long cells (row_key, col_key, value) -> one row per ``col_key`` with the
    ``row_key`` index vector and the values in row_key order.  A group holds
    one entry per row_key (a grid axis, bounded by the calendar or by the
    firms of one economy), never all rows."""
    g = cells.groupBy(*keep, col_key).agg(
        F.array_sort(F.collect_list(F.struct(F.col(row_key).alias("k"), F.col(value).alias("v")))).alias("_kv"))
    return g.select(*keep, col_key,
                    F.transform("_kv", lambda x: x["k"]).alias(index_out),
                    F.transform("_kv", lambda x: x["v"]).alias(values_out))


# --------------------------------------------------------------------------
# B18 website projection
# --------------------------------------------------------------------------
def website_projection(panel: DataFrame, updated_at: dt.datetime | Column | None = None) -> DataFrame:
    upd = F.current_timestamp() if updated_at is None else _lit(updated_at)
    return panel.selectExpr(
        "company_id AS CompanyID", "data_date AS DTDate", "data_date AS FSDate",
        *[f"PD_{h} AS DFT{i}" for i, h in enumerate(WEBSITE_HORIZONS, 1)],
        "region_id AS RegionFlag", "0 AS Draft",
    ).withColumn("Updated", upd)


# --------------------------------------------------------------------------
# B23 exclusion sheet preparation
# --------------------------------------------------------------------------
EXCLUSION_SHEET_COLS = ["Region", "Company Number", "country", "Ticker", "Company Name",
                        "Excluded Since (PD date)", "Stopped Excluding On (PD date)",
                        "Date the error was found", "No."]
EXCLUSION_OPEN_COLS = ["Stopped Excluding On (PD date)", "Date the error was found"]


def prep_exclusions(sheet: DataFrame) -> DataFrame:
    """Every column as text; missing -> ``-1``; missing end / found dates ->
    the open-ended ``9999-12-31 00:00:00``; the 9 sheet columns in order."""
    out = []
    for c in EXCLUSION_SHEET_COLS:
        txt = F.col(f"`{c}`").cast("string")
        fill = OPEN_END_TEXT if c in EXCLUSION_OPEN_COLS else EXCLUSION_FILL
        out.append(F.coalesce(txt, F.lit(fill)).alias(c))
    return sheet.select(*out)


# --------------------------------------------------------------------------
# B26 per-product preparation of named matrix rows
# --------------------------------------------------------------------------
def stamp(df: DataFrame, calibration_date, operation_time, econ_id=ALL_SENTINEL) -> DataFrame:
    """Load stamps: the calibration date (``yyyymmdd`` text or date), one
    operation time for the whole run, and the economy (``-99`` = all)."""
    cal, op = _stamp(calibration_date, operation_time)
    return df.withColumns({"econ_id": _lit(econ_id, "int"), "calibration_date": cal, "operation_time": op})


def _stamp(calibration_date, operation_time):
    cal = calibration_date
    if isinstance(cal, str) and len(cal) == 8 and cal.isdigit():
        cal = dt.datetime.strptime(cal, "%Y%m%d").date()
    return _lit(cal, "date"), _lit(operation_time, "timestamp_ntz")


def _prepared(r: DataFrame, specials: dict, metrics: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Computed key/stamp columns first, then the metrics and kept columns,
    projected by name in one call."""
    tmp = {f"__{k}": v for k, v in specials.items()}
    r = r.withColumns(tmp)
    return r.selectExpr(*[f"{q('__' + k)} AS {q(k)}" for k in specials], *[q(m) for m in metrics],
                        *[q(k) for k in keep])


def prep_pd_daily(rows: DataFrame, calibration_date, operation_time, econ_id=ALL_SENTINEL, keep=()) -> DataFrame:
    """pd60h rows -> (data_date, econ_id, company_id, calibration_date,
    operation_time, PD_1..PD_60); rows with any missing PD are dropped."""
    cal, op = _stamp(calibration_date, operation_time)
    r = filter_any_missing(rows, PD_COLS)
    return _prepared(r, {"data_date": date_from_parts_coerce("yyyy", "mm", "dd"),
                         "econ_id": _lit(econ_id, "int"),
                         "company_id": F.col("company_id").cast("bigint"),
                         "calibration_date": cal, "operation_time": op}, PD_COLS, keep)


def prep_pd_revision(rows: DataFrame, calibration_date, operation_time, econ_id=ALL_SENTINEL, keep=()) -> DataFrame:
    """Transposed revision rows (company_id x1000, yyyymmdd, PD_1..PD_60)."""
    cal, op = _stamp(calibration_date, operation_time)
    r = filter_any_missing(rows, PD_COLS)
    return _prepared(r, {"data_date": date_from_yyyymmdd("data_date"),
                         "econ_id": _lit(econ_id, "int"),
                         "company_id": rescale_id("company_id", 1000, as_text=False),
                         "calibration_date": cal, "operation_time": op}, PD_COLS, keep)


def prep_as_daily(rows: DataFrame, calibration_date, operation_time, econ_id=ALL_SENTINEL, keep=()) -> DataFrame:
    cal, op = _stamp(calibration_date, operation_time)
    r = filter_any_missing(rows, AS_COLS)
    return _prepared(r, {"data_date": date_from_parts_coerce("yyyy", "mm", "dd"),
                         "econ_id": _lit(econ_id, "int"),
                         "company_id": F.col("company_id").cast("bigint"),
                         "calibration_date": cal, "operation_time": op}, AS_COLS, keep)


def prep_as_file(csv_rows: DataFrame, calibration_date, operation_time, econ_id=ALL_SENTINEL, keep=()) -> DataFrame:
    """AS CSV rows (Date, U3_ID, Y1..Y5): no row is dropped; metrics keep
    NULL; ``Y1..Y5`` are the canonical ``cdsvalue1..5``."""
    cal, op = _stamp(calibration_date, operation_time)
    specials = {"data_date": F.col("Date").cast("date"), "econ_id": _lit(econ_id, "int"),
                "company_id": F.col("U3_ID").cast("bigint"), "calibration_date": cal, "operation_time": op}
    specials.update({c: nan_to_null(F.col(y).cast("double")) for y, c in zip(AS_CSV_COLS, AS_COLS)})
    return _prepared(csv_rows, specials, [], keep)


def prep_pdir_daily(rows: DataFrame, calibration_date, operation_time, econ_id=ALL_SENTINEL, keep=()) -> DataFrame:
    cal, op = _stamp(calibration_date, operation_time)
    r = filter_missing_value(rows, "pdir")
    return _prepared(r, {"data_date": date_from_parts_coerce("yyyy", "mm", "dd"),
                         "econ_id": _lit(econ_id, "int"),
                         "company_id": F.col("company_id").cast("bigint"),
                         "calibration_date": cal, "operation_time": op,
                         "pdir": F.col("pdir").cast("double")}, [], keep)


def prep_pdir_revision(cells: DataFrame, calibration_date, operation_time, econ_id=ALL_SENTINEL, keep=()) -> DataFrame:
    """Melted revision grid (data_date yyyymmdd, company_id, pdir)."""
    cal, op = _stamp(calibration_date, operation_time)
    r = filter_missing_value(cells, "pdir")
    return _prepared(r, {"data_date": date_from_yyyymmdd("data_date"),
                         "econ_id": _lit(econ_id, "int"),
                         "company_id": F.col("company_id").cast("bigint"),
                         "calibration_date": cal, "operation_time": op,
                         "pdir": F.col("pdir").cast("double")}, [], keep)


def prep_pdir_historical(cells: DataFrame, keep=()) -> DataFrame:
    """Melted historical grid (date yyyymmdd, company_id x1000, pdir, econ_id)."""
    r = filter_missing_value(cells, "pdir")
    return r.select(
        date_from_yyyymmdd("date").alias("data_date"),
        F.col("econ_id").cast("int").alias("econ_id"),
        rescale_id("company_id", 1000, as_text=False).alias("company_id"),
        F.col("pdir").cast("double").alias("pdir"), *keep)
