"""Hand-written golden frames for the edge cases of each operator."""

import datetime as dt
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.clean import clean_text, parse_bool
from riskloom.functions.dates import date_from_parts_coerce, last_trading_day
from riskloom.functions.rating import rating_grade
from riskloom.operators import filters as flt
from riskloom.operators import joins as jn
from riskloom.operators import reshape as rs
from riskloom.operators import windows as win
from riskloom.schemas import RATING_LEVELS, RATING_THRESHOLDS

D = dt.date


def grade_reference(v):
    """Plain-Python statement of the rule: first threshold reached, else 1."""
    v = 0.0 if v is None or (isinstance(v, float) and math.isnan(v)) else v
    for t, lvl in zip(RATING_THRESHOLDS, RATING_LEVELS):
        if v >= t:
            return lvl
    return 1


def test_rating_grade_boundaries(spark):
    vals = []
    for t in RATING_THRESHOLDS:
        vals += [t, t * (1 - 1e-9) if t else -1e-12, t * (1 + 1e-9) if t else 1e-12]
    vals += [None, float("nan"), -5.0, 2.0, 1.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = {r.i: r.g for r in df.select("i", rating_grade("v").alias("g")).collect()}
    for i, v in enumerate(vals):
        assert got[i] == grade_reference(v), (v, got[i])


def test_rolling_mean_skips_missing_and_grades_empty_as_one(spark):
    rows = [(1, D(2024, 1, d), None if d <= 10 else (float("nan") if d == 11 else 0.5)) for d in range(1, 14)]
    df = spark.createDataFrame(rows, "company_id long, data_date date, PD_12 double")
    res = {r.data_date.day: r for r in win.implied_rating(win.rolling_mean(df)).collect()}
    assert res[1].pd12_mean10 is None and res[1].pdir_implied == 1       # all missing -> grade 1
    assert res[11].pd12_mean10 is None                                   # NaN skipped like NULL
    assert res[12].pd12_mean10 == pytest.approx(0.5)                     # min 1 row
    assert res[12].pdir_implied == 21                                    # 0.2364 <= 0.5 < 1.0


def test_forward_fill_zero_first_middle_last(spark):
    rows = [(1, D(2024, 1, 1), 0.0), (1, D(2024, 1, 2), 5.0), (1, D(2024, 1, 3), 0.0),
            (1, D(2024, 1, 4), None), (1, D(2024, 1, 5), 7.0), (1, D(2024, 1, 6), 0.0)]
    df = spark.createDataFrame(rows, "company_id long, data_date date, PDIR double")
    got = [r.pdir_filled for r in win.forward_fill_rating(df).orderBy("data_date").collect()]
    assert got == [0.0, 5.0, 5.0, 5.0, 7.0, 7.0]


def test_latest_version_tie_is_deterministic(spark):
    t = dt.datetime(2024, 1, 1, 12)
    rows = [(1, D(2024, 1, 1), t, 3.0), (1, D(2024, 1, 1), t, 9.0), (1, D(2024, 1, 1), t - dt.timedelta(1), 99.0)]
    df = spark.createDataFrame(rows, "company_id long, data_date date, operation_time timestamp_ntz, PDIR double")
    for _ in range(3):
        got = win.latest_version(df.repartition(3), tiebreak="all").collect()
        assert len(got) == 1 and got[0].PDIR == 9.0


def test_exclusion_open_end_and_as_of(spark):
    panel = spark.createDataFrame([(1, D(2024, 1, d)) for d in (4, 5, 10, 20, 25)], "company_id long, data_date date")
    ex = spark.createDataFrame([(1, D(2024, 1, 5), None)], "company_id long, start_date date, end_date date")
    for as_of, kept in [(D(2024, 1, 3), [4, 5, 10, 20, 25]), (D(2024, 1, 10), [4, 20, 25]),
                        (D(2024, 1, 30), [4])]:
        got = sorted(r.data_date.day for r in jn.anti_exclusion_interval(panel, ex, as_of).collect())
        assert got == kept, as_of


def test_clean_text_and_bool(spark):
    df = spark.createDataFrame([(" NaN ",), ("",), ("NaT",), ("  x ",), (None,), ("nAn",)], "c string")
    assert [r.c for r in df.select(clean_text("c").alias("c")).collect()] == [None, None, None, "x", None, None]
    b = spark.createDataFrame([("Y",), ("y",), ("n",), (None,), ("yes",)], "c string")
    assert [r.b for r in b.select(parse_bool("c").alias("b")).collect()] == [True, True, False, False, False]
    i = spark.createDataFrame([(1,), (0,), (None,), (2,)], "c long")
    assert [r.b for r in i.select(parse_bool("c", T.LongType()).alias("b")).collect()] == [True, False, False, False]


def test_weekend_to_friday_and_impossible_dates(spark):
    df = spark.createDataFrame([(D(2024, 1, d),) for d in (5, 6, 7, 8)], "d date")
    got = [r.t for r in df.select(last_trading_day("d").alias("t")).collect()]
    assert got == [D(2024, 1, 5)] * 3 + [D(2024, 1, 8)]
    p = spark.createDataFrame([(2024, 2, 30), (2024, 2, 29), (2023, 2, 29)], "y int, m int, d int")
    got = [r.x for r in p.select(date_from_parts_coerce("y", "m", "d").alias("x")).collect()]
    assert got == [None, D(2024, 2, 29), None]


def test_empty_grid_row_and_nulls_kept(spark):
    grid = spark.createDataFrame([(1, 20240101.0, [1000.0, 2000.0], [3.0, None]), (1, 20240102.0, [], [])],
                                 "econ_id int, date_key double, firms array<double>, values array<double>")
    cells = rs.melt_grid(grid, ["econ_id", "date_key"], "firms", "values", "company_id", "pdir").collect()
    assert len(cells) == 2 and sorted((c.company_id, c.pdir) for c in cells if c.pdir) == [(1000.0, 3.0)]
    assert flt.filter_missing_value(spark.createDataFrame(cells), "pdir").count() == 1


def test_any_missing_drops_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 1.0), (None, 1.0)], "a double, b double")
    assert flt.filter_any_missing(df, ["a", "b"]).count() == 1


def test_matrix_scan_reports_corrupt_file_and_reads_npz(spark, tmp_path):
    from riskloom.sources.matrix import scan_matrix
    np.save(tmp_path / "pd60h_1.npy", np.array([[1.0, 2.0], [3.0, float("nan")]]))
    np.savez(tmp_path / "grid_2.npz", other=np.zeros((2, 2, 2)), pdirNum=np.array([[5.0, 6.0]]))
    (tmp_path / "pd60h_3.npy").write_bytes(b"broken")
    np.save(tmp_path / "pd60h_4.npy", np.zeros((2, 2, 2)))
    rows = scan_matrix(spark, str(tmp_path), "*", variables=["pdirnum", "pdirNum"], keep_errors=True).collect()
    by = {(r.file_name, r.row): r for r in rows}
    assert by[("pd60h_1.npy", 1)]["values"] == [3.0, None]        # NaN -> NULL at ingest
    assert by[("grid_2.npz", 0)]["values"] == [5.0, 6.0]           # named variable, fallback spelling
    for name in ("pd60h_3.npy", "pd60h_4.npy"):
        bad = [r for r in rows if r.file_name == name]
        assert len(bad) == 1 and bad[0].error and bad[0]["values"] is None


def test_csv_scan_tolerates_empty_file(spark, tmp_path):
    from riskloom.sources.readers import read_csv_shards
    (tmp_path / "AS_1.csv").write_text("Date,U3_ID,Y1\n2024-01-02,7,0.5\n")
    (tmp_path / "AS_2.csv").write_text("")
    (tmp_path / "AS_3.csv").write_text("Date,U3_ID,Y1\n")
    schema = "Date string, U3_ID long, Y1 double, Y2 double"
    rows = read_csv_shards(spark, str(tmp_path), T._parse_datatype_string(schema)).collect()
    assert len(rows) == 1 and rows[0].Y2 is None


def test_calibration_lookup_requires_exactly_one(spark):
    from riskloom.sources.files import calibration_lookup
    f = spark.createDataFrame([("20240115_cali_20240201",), ("20240116_cali_20240201",), ("20240116_cali_20240301",)],
                              "name string")
    assert calibration_lookup(f, D(2024, 1, 15)).first().calibration_date == D(2024, 2, 1)
    with pytest.raises(Exception):
        calibration_lookup(f, D(2024, 1, 16)).collect()
    with pytest.raises(Exception):
        calibration_lookup(f, D(2024, 1, 17)).collect()


def test_positional_width_is_checked(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "values array<double>")
    with pytest.raises(Exception):
        rs.name_positional(df, ["a", "b"]).collect()


def test_file_id_extraction(spark):
    from riskloom.sources.files import id_from_name
    df = spark.createDataFrame([("pd60h_12.mat",), ("pdirNum_7.p00003.npy",), ("readme.txt",)], "file_name string")
    assert [r.i for r in df.select(id_from_name("file_name").alias("i")).collect()] == [12, 7, None]


def test_scratch_is_under_checkpoint_dir(spark):
    from riskloom.session import checkpoint_root, scratch_path
    root = checkpoint_root(spark)
    assert scratch_path(spark, "x").startswith(root) and root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert not os.path.exists(scratch_path(spark, "x"))


def test_repeated_rating_key_fails_instead_of_multiplying(spark):
    from riskloom.operators.aggregates import require_unique
    ok = spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 1, 1))], "company_id long, data_date date")
    assert require_unique(ok, ["data_date", "company_id"]).count() == 2
    dup = ok.unionByName(ok.limit(1))
    with pytest.raises(Exception):
        require_unique(dup, ["data_date", "company_id"]).collect()


def test_user_rows_defaults_and_null_literal(spark):
    from riskloom.plans.jobs import user_rows
    u = spark.createDataFrame([("a@x.org", None, "Y", None)], "Email string, Phone string, BudaAccess string, Type string")
    r = user_rows(u).first()
    assert r.phone is None and r.type == "REGULAR" and r.status == "UNACTIVATED" and r.buda_access is True
    r2 = user_rows(u, null_literal="NULL").first()
    assert r2.phone == "NULL" and r2.type == "REGULAR" and r2.created is None


def test_yyyymmdd_numbers(spark):
    from riskloom.functions.dates import date_from_yyyymmdd
    df = spark.createDataFrame([(20240131.0,), (19991231.0,), (None,)], "x double")
    got = [r.d for r in df.select(date_from_yyyymmdd("x").alias("d")).collect()]
    assert got == [D(2024, 1, 31), D(1999, 12, 31), None]
    bad = spark.createDataFrame([(20240230.0,)], "x double")
    assert bad.select(date_from_yyyymmdd("x", strict=False).alias("d")).first().d is None
    with pytest.raises(Exception):
        bad.select(date_from_yyyymmdd("x").alias("d")).collect()
