"""Plan checks: the physical plans are the ones we want at scale."""

from riskloom import fixtures as fx
from riskloom.operators import windows as win
from tests.conftest import SF_CHECK


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_version_uses_partial_window_group_limit(spark):
    p = plan(win.latest_version(fx.pd_raw(spark, SF_CHECK)))
    assert "WindowGroupLimit" in p


def test_exclusion_anti_join_is_not_nested_loop(spark):
    import __spark_entry__ as E
    df = E.queries()["anti_exclusion_interval"](spark, SF_CHECK)
    p = plan(df)
    assert "LeftAnti" in p and "NestedLoop" not in p


def test_scans_prune_columns_and_push_filters(spark):
    import __spark_entry__ as E
    df = E.queries()["filter_day"](spark, SF_CHECK)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in p or "DataFilters" in p
    # the events scan reads only the columns the query needs
    assert "props" not in p.split("ReadSchema")[1].split("\n")[0]


def test_no_python_outside_matrix_decoding(spark):
    import __spark_entry__ as E
    qs = E.queries()
    for name in ["table_website", "forward_fill_rating", "implied_rating", "mut_upsert", "prep_pd_daily",
                 "melt_matrix", "rating_grade", "clean_cells"]:
        p = plan(qs[name](spark, SF_CHECK))
        assert "Python" not in p and "ArrowEval" not in p, name


def test_flagship_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns[:3] == ["CompanyID", "DTDate", "FSDate"]


def test_bench_headline_queries_are_registered():
    import os
    import bench
    import __spark_entry__ as E
    qs = E.queries()
    assert set(bench.HEADLINE) <= set(qs)
    assert os.path.isdir(E.SMOKE_DIR)


def events(spark, path, rows):
    """A folder with an events table of (event_id, ts, user_id, event_type, value)."""
    made = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double")
    made.selectExpr("event_id", "cast(ts AS timestamp_ntz) AS ts", "user_id", "event_type", "value", "'{}' AS props").write.parquet(f"{path}/events.parquet")
    return str(path)


EVENTS = [(1, "2024-01-10 08:00:00", 7, "click", 2.0), (2, "2024-01-10 09:00:00", 7, "view", 3.0), (3, "2024-01-16 09:00:00", 7, "error", 4.0),
          (4, "2024-01-16 10:00:00", 8, "click", 5.0), (5, "2024-01-25 10:00:00", None, "click", None)]


def test_touched_months_are_not_one_shuffle_key(spark, tmp_path, monkeypatch):
    from riskloom.operators import mutate as mu
    from riskloom.plans import q_mutation as qm
    d, seen, commit = events(spark, tmp_path, EVENTS), [], mu.commit_partitions
    monkeypatch.setattr(mu, "commit_partitions", lambda df, path: (seen.append(plan(df)), commit(df, path)))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = qm.q_commit_partitions(spark, d).select("company_id", "PDIR", "data_month").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "hashpartitioning(data_month" not in seen[0]
    assert sorted(map(tuple, rows), key=str) == sorted([(7, 0.0, "2024-01"), (7, None, "2024-01"), (8, 5.0, "2024-01"), (None, 6.0, "2024-01")], key=str)


def test_horizons_follow_the_choice_of_versions(spark, tmp_path):
    d = events(spark, tmp_path, EVENTS)
    latest = fx.pd_latest(spark, d)
    assert "PD_60" not in plan(latest).split("Window", 1)[1]           # neither sorted nor shuffled
    want = win.latest_version(fx.pd_raw(spark, d))
    assert latest.columns == want.columns and sorted(latest.collect(), key=str) == sorted(want.collect(), key=str)
    before = win.latest_version(fx.pd_raw(spark, d).where("data_date < date'2024-01-21'"))
    assert sorted(fx.pd_current(spark, d).collect(), key=str) == sorted(before.collect(), key=str)
