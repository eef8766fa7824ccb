"""Bitmap key index, reconciliation by digests and the forward as-of lookup against plain computations."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import aggregates as agg
from riskloom.operators import joins as jn
from riskloom.operators import key_index as ki
from riskloom.operators import windows as win

KEYS = "company_id long, data_date date"


def _keys(spark, seed, n, companies=400):
    rng = random.Random(seed)
    rows = [(rng.randrange(companies), dt.date(2024, rng.randrange(1, 5), rng.randrange(1, 29))) for _ in range(n)]
    return spark.createDataFrame(rows + [(None, dt.date(2024, 1, 1)), (7, None), (7, None)], KEYS)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_index_equals_anti_join(spark):
    loaded, incoming = _keys(spark, 1, 4000), _keys(spark, 2, 3000).withColumn("v", F.col("company_id") * 2)
    index = ki.build_key_index(loaded)
    assert _rows(ki.anti_loaded_indexed(incoming, loaded, index)) == _rows(jn.anti_not_loaded(incoming, loaded))
    flagged = ki.flag_maybe_loaded(incoming, index)
    known = {(r.company_id, r.data_date) for r in loaded.collect() if r.company_id is not None and r.data_date}
    for r in flagged.collect():                          # no loaded key is ever missed, few new ones are looked up in vain
        assert r.maybe_loaded or (r.company_id, r.data_date) not in known
    vain = flagged.where("maybe_loaded").join(loaded, ["company_id", "data_date"], "left_anti").count()
    assert vain < incoming.count() / 6


def test_index_is_merged_after_an_append(spark):
    loaded, more = _keys(spark, 1, 500), _keys(spark, 3, 500)
    later = spark.createDataFrame([(k, dt.date(2024, 9, 3)) for k in range(50)], KEYS)
    index = ki.merge_key_index(ki.merge_key_index(ki.build_key_index(loaded), more), later)
    assert index.groupBy("data_month", "page").count().where("count > 1").isEmpty()
    every = loaded.unionByName(more).unionByName(later)
    assert _rows(ki.anti_loaded_indexed(every.unionByName(_keys(spark, 4, 300)), every, index)) == _rows(
        jn.anti_not_loaded(every.unionByName(_keys(spark, 4, 300)), every))
    empty = ki.build_key_index(loaded.limit(0))
    assert empty.count() == 0 and ki.anti_loaded_indexed(more, loaded.limit(0), empty).count() == more.count()


def test_sure_new_rows_do_not_read_the_table(spark, tmp_path):
    """Rows of a month that the index does not know, or whose bit is not set, pass without a join; otherwise months are pruned."""
    table = str(tmp_path / "t")
    loaded = _keys(spark, 1, 2000).where("data_date IS NOT NULL").withColumn("data_month", F.date_format("data_date", "yyyy-MM"))
    loaded.write.partitionBy("data_month").parquet(table)
    index = ki.build_key_index(spark.read.parquet(table)).cache()
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    new = spark.createDataFrame([(k, dt.date(2024, 7, 1)) for k in range(100)], KEYS)
    out = ki.anti_loaded_indexed(new, spark.read.parquet(table), index)
    assert out.count() == 100 and "LeftAnti" not in plan(out)
    known = loaded.where("data_month = '2024-02'").select("company_id", "data_date").limit(5)
    out = ki.anti_loaded_indexed(new.unionByName(known), spark.read.parquet(table), index)
    assert out.count() == 100 and "LeftAnti" in plan(out) and "2024-02" in plan(out) and "2024-03" not in plan(out)


@pytest.mark.parametrize("change", ["none", "some", "repeats", "nulls", "one empty"])
def test_digest_diff_equals_full_diff(spark, change):
    a = _keys(spark, 5, 3000).withColumn("econ_id", F.col("company_id") % 25).withColumn("data_month", F.date_format("data_date", "yyyy-MM"))
    b = {"none": a, "some": a.where("NOT (company_id = 30 AND data_month = '2024-02')").unionByName(
            a.where("company_id = 31").limit(1).withColumn("data_date", F.lit(dt.date(2024, 1, 29)))),
         "repeats": a.unionByName(a.where("company_id < 40")), "nulls": a.where("company_id IS NOT NULL AND data_date IS NOT NULL"),
         "one empty": a.limit(0)}[change]
    assert _rows(agg.diff_keys_by_digest(a, b)) == _rows(jn.diff_keys_both(a, b))
    differing = agg.differing_buckets(a, b, ["company_id", "data_date"], ["econ_id", "data_month"]).count()
    assert differing <= {"none": 0, "some": 2}.get(change, differing)


def test_asof_forward(spark):
    rng = random.Random(8)
    day = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)
    left = [(rng.randrange(5), day(rng.randrange(60)), k) for k in range(300)] + [(1, None, 900), (None, day(3), 901), (99, day(3), 902)]
    right = [(rng.randrange(5), day(rng.randrange(50)), rng.choice([None, 1.0, 2.0, 3.0])) for _ in range(60)] + [(None, day(5), 8.0), (2, None, 9.0)]
    out = win.asof_forward(spark.createDataFrame(left, "c long, d date, _date long"), spark.createDataFrame(right, "c long, s date, v double"),
                           ["v"], "d", "s", ["c"]).collect()
    def want(c, d):
        later = sorted({r[1] for r in right if r[0] == c and r[1] is not None and d is not None and r[1] >= d})
        if not later:
            return None
        values = [r[2] for r in right if r[0] == c and r[1] == later[0]]
        return None if None in values else min(values)                    # NULL sorts first among a date's values
    assert sorted((r._date, r.v) for r in out) == sorted((k, want(c, d)) for c, d, k in left)
