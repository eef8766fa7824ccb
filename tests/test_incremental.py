"""Incremental refresh against a full rebuild, and the completeness gate's state step."""

from __future__ import annotations

import datetime as dt
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import mutate as mu
from riskloom.plans import derived
from riskloom.schemas import PD_COLS
from riskloom.streaming import gate

AS_OF = dt.date(2024, 6, 30)


def _raw(spark, rows):
    """(company, day, version, pd) -> panel versions with all horizons."""
    df = spark.createDataFrame(rows, "company_id long, data_date date, version int, pd double")
    return df.select("data_date", "company_id", F.lit(dt.date(2024, 1, 1)).alias("calibration_date"),
                     F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, version)").alias("operation_time"), F.lit(3.0).alias("PDIR"),
                     *[(F.col("pd") * k).alias(c) for k, c in enumerate(PD_COLS, 1)])


def _companies(spark, ids, sector="s"):
    return spark.createDataFrame([(i, f"n{i}", f"T{i}", i % 3, i % 2, 5, sector, 6, 7) for i in ids],
                                 "company_id long, " + ", ".join(f"{c} {'string' if c in ('company_name', 'ticker', 'industry_sector') else 'long'}"
                                                                 for c in derived.PANEL_DIM_COLS))


def _exclusions(spark, rows):
    return spark.createDataFrame(rows, "company_id long, start_date date, end_date date")


DAYS = [dt.date(2024, m, d) for m in range(1, 7) for d in (3, 14, 27)]
ROWS = [(c, day, 1, 0.01 * c) for c in range(1, 7) for day in DAYS]
BASE_EXCL = [(1, dt.date(2024, 2, 1), dt.date(2024, 3, 5)), (2, dt.date(2024, 5, 10), None)]


def _content(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def state(spark, tmp_path):
    table, out = f"{tmp_path}/raw", f"{tmp_path}/derived"
    mu.with_month(_raw(spark, ROWS)).write.partitionBy("data_month").parquet(table)
    derived.start_incremental(spark, table, _companies(spark, range(1, 6)), _exclusions(spark, BASE_EXCL), out, AS_OF, dt.datetime(2024, 7, 1))
    return table, out


CHANGES = {
    "nothing": ({}, [], []),
    "new versions": ({"rows": [(3, dt.date(2024, 3, 14), 2, 0.9), (3, dt.date(2024, 6, 29), 1, 0.8)]}, ["2024-03", "2024-06"], ["2024-03", "2024-06"]),
    "new mapping": ({"ids": range(1, 7)}, None, None),
    "mapping gone": ({"ids": [1, 2]}, None, None),
    "all gone": ({"ids": []}, None, None),
    "mapping changed": ({"sector": "t"}, None, None),
    "exclusion ended": ({"excl": [(1, dt.date(2024, 2, 1), dt.date(2024, 2, 20)), BASE_EXCL[1]]}, [], ["2024-02", "2024-03"]),
    "exclusion added": ({"excl": BASE_EXCL + [(4, dt.date(2024, 4, 14), dt.date(2024, 4, 14))]}, [], ["2024-04"]),
    "later day": ({"as_of": dt.date(2024, 7, 31), "rows": [(2, dt.date(2024, 7, 3), 1, 0.5)]}, ["2024-07"], None),
}


@pytest.mark.parametrize("kind", CHANGES)
def test_refresh_equals_full_rebuild(spark, tmp_path, state, kind):
    """After each kind of change the tables equal a full rebuild, and only the months that it touches were recomputed."""
    change, panel_months, web_months = CHANGES[kind]
    table, out = state
    companies = _companies(spark, change.get("ids", range(1, 6)), change.get("sector", "s"))
    exclusions, as_of = _exclusions(spark, change.get("excl", BASE_EXCL)), change.get("as_of", AS_OF)
    new = _raw(spark, change["rows"]) if "rows" in change else None
    if new is not None:
        mu.with_month(new).write.mode("append").partitionBy("data_month").parquet(table)
    updated = dt.datetime(2024, 7, 1)
    done = derived.refresh_incremental(spark, table, companies, exclusions, out, as_of, new, updated)
    full = derived.refresh_derived(spark, spark.read.parquet(table).drop("data_month"), companies, exclusions, f"{tmp_path}/full", as_of, updated)
    for name, path in full.items():
        mine = spark.read.parquet(f"{out}/{name}").drop("data_month")
        assert _content(mine) == _content(derived.read_by_month(mine, path).drop("data_month")), name
    if panel_months is not None:
        assert done["panel"] == panel_months
    if web_months is not None:
        assert done["website"] == web_months
    again = derived.refresh_incremental(spark, table, companies, exclusions, out, as_of, None, updated)
    assert again == {"panel": [], "website": []}


def test_only_touched_months_are_read(spark, state):
    """The recomputation of the panel prunes the raw table to the touched months."""
    table, _ = state
    touched = spark.read.parquet(table).where(F.col("data_month").isin(["2024-03"])).drop("data_month")
    plan = derived.panel_latest(touched, _companies(spark, range(1, 6)))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*data_month[^\]]*2024-03", plan), plan


class _State:
    """What a group state offers, for one key."""

    def __init__(self):
        self.value, self.timeout, self.hasTimedOut, self.watermark = None, None, False, 0

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutTimestamp(self, ms):
        self.timeout = ms

    def getCurrentWatermarkMs(self):
        return self.watermark


def test_gate_state():
    run = gate._gate(frozenset({1, 2, 3}), dt.timedelta(days=2), dt.timedelta(days=30))
    state, day = _State(), 24 * 3600 * 1000

    def arrive(*economies, at=1):
        frame = pd.DataFrame({"folder": "f", "econ_id": list(economies), "arrived": pd.Timestamp(at * day, unit="ms")})
        return [r.iloc[0].to_dict() for r in run(("f",), iter([frame]), state)]

    assert arrive(1, 9) == [] and state.timeout == 3 * day            # an economy that isn't expected doesn't count
    state.hasTimedOut = True
    late = [r.iloc[0].to_dict() for r in run(("f",), iter([]), state)]
    assert [(r["status"], r["n_economies"], list(r["missing"])) for r in late] == [("incomplete", 1, [2, 3])]
    state.hasTimedOut = False
    assert arrive(1, 2, at=2) == []
    done = arrive(3, at=5)
    assert [(r["status"], r["n_economies"], list(r["missing"])) for r in done] == [("released", 3, [])] and state.timeout == 35 * day
    assert arrive(1, 2, 3, at=6) == []                                  # sent again: released once
    state.hasTimedOut = True
    assert list(run(("f",), iter([]), state)) == [] and not state.exists


def test_arrivals_are_files(spark, tmp_path):
    """One row for each economy of a folder, however many files it has; other files don't count."""
    for name in ("folder=a/econ_id=1/x", "folder=a/econ_id=1/y", "folder=a/econ_id=2/x", "folder=b/econ_id=1/x", "folder=b/other/x"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"1")
    seen = gate.arrivals(spark, str(tmp_path), "1 day")
    query = seen.writeStream.format("memory").queryName("gate_arrivals").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.folder, r.econ_id) for r in spark.table("gate_arrivals").collect()) == [("a", 1), ("a", 2), ("b", 1)]


def test_keys_are_compared_on_their_own(spark, tmp_path):
    keys = ["company_id", "operation_time"]
    spark.createDataFrame([(1, 1, 1.0), (1, 1, 2.0), (2, 1, 3.0), (None, 1, 4.0), (None, 1, 5.0)], "company_id int, operation_time int, x double").write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    one = mu.one_per_key(rows, keys)
    assert sorted((r.company_id or 0) for r in one.collect()) == [0, 1, 2]
    single = mu.one_per_key(rows.where("company_id = 2"), keys)
    assert "Exchange" not in single._jdf.queryExecution().executedPlan().toString()
    left = mu.absent_rows(rows.where("company_id = 1 OR company_id IS NULL"), rows, keys)
    assert sorted(r.x for r in left.collect()) == [3.0, 4.0, 5.0]


def test_written_batch_is_loaded_without_moving_whole_rows(spark, tmp_path, monkeypatch):
    from riskloom.streaming.ingest import upsert_versions
    schema = "company_id int, data_date date, operation_time timestamp_ntz, x double"
    rows = spark.createDataFrame([(k, dt.date(2024, 1, 1 + k % 3), dt.datetime(2024, 1, 5), float(k)) for k in range(20)], schema)
    rows.write.parquet(f"{tmp_path}/batch")
    table, batch = f"{tmp_path}/table", spark.read.parquet(f"{tmp_path}/batch")
    mu.with_month(rows.limit(0)).write.parquet(table)
    plans, one = [], mu.one_per_key
    monkeypatch.setattr(mu, "one_per_key", lambda r, k: (plans.append((out := one(r, k))._jdf.queryExecution().executedPlan().toString()), out)[1])
    load = upsert_versions(table, ["company_id", "data_date", "operation_time"], written=True)
    load(batch, 0)
    load(batch, 1)                                                     # a replay adds nothing
    assert spark.read.parquet(table).count() == 20 and "Exchange" not in plans[0]
