"""Behaviour that matters at scale: skewed groups are split, re-runs are no-ops."""

import datetime as dt

from pyspark.sql import functions as F

from riskloom.operators import mutate as mu
from riskloom.plans import jobs
from riskloom.schemas import PDIR_TABLE
from riskloom.session import scratch_path
from riskloom.sources.matrix import scan_matrix, write_matrix_shards


def test_hot_economy_is_split_across_tasks(spark):
    # economy 1 holds half of all rows
    rows = spark.range(40000).select(
        F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise((F.col("id") % 7 + 2)).alias("econ_id"),
        F.array(F.col("id").cast("double"), (F.col("id") * 2).cast("double")).alias("values"))
    out = scratch_path(spark, "skew-shards")
    manifest = write_matrix_shards(rows, out, "pd60h_", num_partitions=8)
    hot = manifest.where("econ_id = 1")
    assert hot.count() >= 3                                   # spread over several tasks / files
    assert hot.agg(F.max("n_rows")).first()[0] < 20000        # no single file holds the hot group
    back = scan_matrix(spark, out, "pd60h_*.npy")
    assert back.count() == 40000


def test_daily_state_load_twice_is_a_no_op(spark):
    day = dt.date(2024, 1, 22)
    op = dt.datetime(2024, 2, 2, 6)
    cur = spark.createDataFrame([(dt.date(2024, 1, 19), 1, 7, dt.date(2024, 2, 1), op, 3.0)],
                                "data_date date, econ_id int, company_id bigint, calibration_date date, "
                                "operation_time timestamp_ntz, pdir double")
    batch = spark.createDataFrame([(day, 1, 7, dt.date(2024, 2, 1), op, 4.0), (day, 1, 8, dt.date(2024, 2, 1), op, 5.0)],
                                  cur.schema)
    latest, daily, log = (scratch_path(spark, n) for n in ("latest", "d1", "log"))
    mu.enforce_schema(cur, PDIR_TABLE).write.parquet(latest)
    first = jobs.load_day_state(spark, batch, latest, daily, log, day, dt.date(2024, 2, 1), op)
    assert first.count() == 3
    second = jobs.load_day_state(spark, batch, latest, daily, log, day, dt.date(2024, 2, 1), op)
    assert second.count() == 3 and spark.read.parquet(log).count() == 1


def test_forward_fill_table_rewrites_only_lookback_months(spark):
    table = scratch_path(spark, "ff-table")
    rows = [(1, dt.date(2023, 11, 10), dt.datetime(2023, 11, 10), 0.0),      # old month, zero rating stays
            (1, dt.date(2024, 1, 10), dt.datetime(2024, 1, 10), 5.0),
            (1, dt.date(2024, 1, 12), dt.datetime(2024, 1, 12), 0.0)]
    df = spark.createDataFrame(rows, "company_id long, data_date date, operation_time timestamp_ntz, PDIR double")
    mu.with_month(df).write.partitionBy("data_month").parquet(table)
    jobs.forward_fill_table(spark, table, dt.date(2024, 1, 15))
    got = {(r.data_month, r.data_date.day): r.PDIR for r in spark.read.parquet(table).collect()}
    assert got == {("2023-11", 10): 0.0, ("2024-01", 10): 5.0, ("2024-01", 12): 5.0}


def test_daily_run_full_composition(spark):
    from pyspark.sql import functions as F
    from riskloom import fixtures as fx
    from riskloom.plans import q_jobs
    from tests.conftest import SF_SMALL
    d = SF_SMALL
    root = q_jobs.land_delivery(spark, d, ("pd", "pdir"))
    econs = [r.e for r in fx.pd_raw(spark, d).where(F.col("data_date") == F.lit(dt.date(2024, 1, 16)))
             .select(fx.econ_of().alias("e")).distinct().collect()]
    reg, excl = q_jobs.land_exclusions(spark, d)
    ev_root, ev_table = q_jobs.land_events_daily(spark, d)
    log = scratch_path(spark, "history")
    excl_out, ev_before = scratch_path(spark, "excl-v2"), spark.read.parquet(ev_table).count()
    derived_out = scratch_path(spark, "derived")
    res = jobs.daily_run(spark, root, dt.date(2024, 1, 16), dt.date(2024, 1, 16), dt.datetime(2024, 2, 2, 6),
                         q_jobs._pd_table(spark, d), sorted(econs), log, registry=reg, exclusions=(excl, excl_out),
                         events=(ev_root, ev_table),
                         refresh=(fx.companies_mapping_info(spark, d), fx.excluded_companies(spark, d), derived_out))
    assert spark.read.parquet(derived_out + "/website").count() > 0
    assert res.where(F.col("operation_time") == F.lit(dt.datetime(2024, 2, 2, 6))).count() > 0
    assert spark.read.parquet(excl_out).where("remark = 'updated'").count() > 0
    assert spark.read.parquet(ev_table).count() >= ev_before
    h = spark.read.parquet(log).collect()
    assert len(h) == 1 and h[0].date_int == 20240116 and h[0].source == "20240116_cali_20240201"


def test_daily_run_of_a_day_does_not_stop_a_wider_range(spark):
    from pyspark.sql import functions as F
    from riskloom import fixtures as fx
    from riskloom.plans import q_jobs
    from tests.conftest import SF_SMALL
    d, op = SF_SMALL, dt.datetime(2024, 2, 2, 6)
    root, log = q_jobs.land_delivery(spark, d, ("pd", "pdir")), scratch_path(spark, "history")
    monday, friday = dt.date(2024, 1, 15), dt.date(2024, 1, 19)
    ratings = fx.pd_raw(spark, d).where(F.col("data_date").between(F.lit(monday), F.lit(friday)) & (F.weekday("data_date") < 5))
    per = ratings.groupBy(fx.econ_of().alias("e")).agg(F.countDistinct("data_date").alias("n")).where("n = 5")
    table, econs = q_jobs._pd_table(spark, d), sorted(r.e for r in per.collect())
    loaded = lambda: {r.data_date: r["count"] for r in spark.read.parquet(table).where(
        F.col("operation_time") == F.lit(op)).groupBy("data_date").count().collect()}
    jobs.daily_run(spark, root, friday, friday, op, table, econs, log)
    alone = loaded()
    assert set(alone) == {friday}
    jobs.daily_run(spark, root, monday, friday, op, table, econs, log)
    whole = loaded()
    assert set(whole) == {monday + dt.timedelta(days=k) for k in range(5)} and whole[friday] == alone[friday]
    jobs.daily_run(spark, root, monday, friday, op, table, econs, log)
    assert loaded() == whole and {r.date_int for r in spark.read.parquet(log).collect()} == {20240119}


def test_cli_pd_range_and_refresh(spark):
    from riskloom import cli
    from riskloom import fixtures as fx
    from riskloom.plans import q_jobs
    from tests.conftest import SF_SMALL
    root = q_jobs.land_delivery(spark, SF_SMALL, ("pd", "pdir"))
    table = q_jobs._pd_table(spark, SF_SMALL)
    before = spark.read.parquet(table).count()
    cli.main(["pd-range", "--root", root, "--table", table, "--start", "2024-01-15", "--end", "2024-01-19"])
    assert spark.read.parquet(table).count() > before
    comp, excl, out = (scratch_path(spark, n) for n in ("companies", "exclusions", "derived"))
    fx.companies_mapping_info(spark, SF_SMALL).write.parquet(comp)
    fx.excluded_companies(spark, SF_SMALL).write.parquet(excl)
    cli.main(["refresh", "--table", table, "--companies", comp, "--exclusions", excl, "--out", out,
              "--as-of", "2024-01-30"])
    assert spark.read.parquet(out + "/website").count() > 0


def test_missing_delivery_folder_fails(spark, tmp_path):
    import datetime as dt

    import pytest
    from riskloom.plans import jobs
    for name in ("20240115_cali_20240201", "20240117_cali_20240201"):
        (tmp_path / name).mkdir()
    assert jobs.folders_in_range(spark, str(tmp_path), dt.date(2024, 1, 15), dt.date(2024, 1, 15)).count() == 1
    with pytest.raises(FileNotFoundError, match="2024-01-16"):
        jobs.folders_in_range(spark, str(tmp_path), dt.date(2024, 1, 15), dt.date(2024, 1, 17))


def test_unreadable_shard_fails_the_job(spark, tmp_path):
    import numpy as np
    import pytest
    from riskloom.plans import jobs
    np.save(tmp_path / "pd_1.npy", np.ones((2, 4)))
    assert jobs.read_shards(spark, str(tmp_path), "pd_*.npy").count() == 2
    (tmp_path / "pd_2.npy").write_bytes(b"not a matrix")
    with pytest.raises(Exception, match="unreadable shard"):
        jobs.read_shards(spark, str(tmp_path), "pd_*.npy").collect()


def test_rebuilt_clustered_table_has_no_old_months(spark, tmp_path):
    from riskloom.sources.sinks import write_clustered
    path = str(tmp_path / "panel")
    for dates in (("2024-01-05", "2024-02-05"), ("2024-02-06",)):
        rows = spark.createDataFrame([(d, 1) for d in dates], "d string, company_id int").selectExpr("CAST(d AS DATE) data_date", "company_id")
        write_clustered(rows, path)
    assert [str(r.data_date) for r in spark.read.parquet(path).collect()] == ["2024-02-06"]


def test_unreadable_table_is_not_taken_for_a_missing_one(spark, tmp_path):
    import pytest
    from riskloom.sources.readers import table_exists
    assert not table_exists(spark, str(tmp_path / "none"))
    (tmp_path / "empty").mkdir()
    assert not table_exists(spark, str(tmp_path / "empty"))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"junk junk junk junk")
    with pytest.raises(Exception):
        table_exists(spark, str(tmp_path / "bad"))


def test_revision_run_twice_equals_once(spark, tmp_path):
    import datetime as dt
    from riskloom.plans import jobs
    schema = "data_date date, econ_id int, company_id long, calibration_date date, operation_time timestamp_ntz, pdir double"
    old, new = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 3)
    day, cal = dt.date(2024, 1, 15), dt.date(2024, 2, 1)
    latest, history, log = (str(tmp_path / n) for n in ("latest", "history", "log"))
    rows = [(d, 1, c, cal, old, 1.0) for c in range(5) for d in (day, dt.date(2023, 11, 3))]
    mu.with_month(spark.createDataFrame(rows, schema)).write.partitionBy("data_month").parquet(latest)
    untouched = sorted((tmp_path / "latest" / "data_month=2023-11").iterdir())
    batch = spark.createDataFrame([(day, 1, c, cal, new, 2.0) for c in range(3, 8)], schema)
    for check in (True, True, False):                 # a repeat that the guard stops, and one after a lost log row
        res = jobs.revise_state(spark, batch, latest, history, log, day=day, check_duplicate=check)
        assert {r.company_id: r.pdir for r in res.where("data_month = '2024-01'").collect()} == {c: 1.0 if c < 3 else 2.0 for c in range(8)}
        assert spark.read.parquet(history).count() == 2
        # the other month was neither rewritten nor read into the history
        assert sorted((tmp_path / "latest" / "data_month=2023-11").iterdir()) == untouched and res.count() == 13
