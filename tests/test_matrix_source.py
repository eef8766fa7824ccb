"""The matrix data source: row ranges, files chosen from the listing, bad files, commit and abort."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.sources import matrix as mx


def _values(df):
    return sorted(map(tuple, (r["values"] for r in df.select("values").collect())))


def test_large_file_is_read_by_several_tasks(spark, tmp_path):
    m = np.arange(30_000, dtype="float64").reshape(10_000, 3)
    np.save(tmp_path / "pd60h_1.npy", m)
    for split in (1_000, 7_777, 100_000, 1 << 30):       # cuts inside rows and inside the header as well
        rows = mx.scan_matrix(spark, str(tmp_path), split_bytes=split)
        assert rows.rdd.getNumPartitions() == max(1, -(-(m.nbytes + 128) // split))
        assert sorted((r.row, *r["values"]) for r in rows.collect()) == [(k, *m[k]) for k in range(len(m))]


def test_small_files_are_packed():
    plan = mx.plan_pieces([(f"f{k}", 10) for k in range(100)] + [("big", 25)], split=20 << 20)
    assert [len(p) for p in plan] == [20, 20, 20, 20, 20, 1]
    assert [p.start for p in sum(mx.plan_pieces([("big", 25)], 10), [])] == [0, 10, 20]
    assert [(p.start, p.stop) for p in sum(mx.plan_pieces([("empty", 0)], 10), [])] == [(0, 0)]


def test_other_layouts(spark, tmp_path):
    """Column-major, one-dimensional, integer, transposed, empty and second-version headers give the same cells."""
    m = np.arange(12).reshape(4, 3)
    np.save(tmp_path / "a_1.npy", np.asfortranarray(m.astype("float64")))
    np.save(tmp_path / "b_1.npy", m.astype("int32"))
    np.save(tmp_path / "c_1.npy", m.T.astype(">f8"))
    np.save(tmp_path / "d_1.npy", np.array([1.0, 2.0]))
    np.save(tmp_path / "e_1.npy", np.zeros((0, 3)))
    with open(tmp_path / "f_1.npy", "wb") as fh:
        np.lib.format.write_array(fh, m.astype("float64"), version=(2, 0))
    read = lambda glob, **more: _values(mx.scan_matrix(spark, str(tmp_path), glob, split_bytes=50, **more))
    want = sorted(map(tuple, m.astype("float64")))
    assert read("a_*") == read("b_*") == read("f_*") == read("c_*", transpose=True) == want
    assert read("d_*") == [(1.0, 2.0)] and read("e_*") == []


def test_a_bad_file_gives_one_error_row(spark, tmp_path):
    np.save(tmp_path / "pd60h_1.npy", np.ones((1000, 2)))
    whole = (tmp_path / "pd60h_1.npy").read_bytes()
    (tmp_path / "pd60h_2.npy").write_bytes(whole[:-8])   # cut off: none of its ranges is read
    (tmp_path / "pd60h_3.npy").write_bytes(b"")
    rows = mx.scan_matrix(spark, str(tmp_path), split_bytes=500, keep_errors=True)
    assert {r.econ_id: (r["n"], r["bad"]) for r in rows.groupBy("econ_id").agg(
        F.count("row").alias("n"), F.count("error").alias("bad")).collect()} == {1: (1000, 0), 2: (0, 1), 3: (0, 1)}


def test_excluded_files_are_never_opened(spark, tmp_path):
    """A filter on folder and economy chooses files: unreadable others are not even reported."""
    for day in ("20240101", "20240102"):
        sub = tmp_path / f"{day}_cali_20240201" / "Products"
        sub.mkdir(parents=True)
        np.save(sub / "pd60h_1.npy", np.full((2, 2), 1.0))
        (sub / "pd60h_2.npy").write_bytes(b"broken")
    rows = mx.scan_matrix(spark, str(tmp_path), keep_errors=True)
    assert rows.where("error is not null").count() == 2
    one = rows.where("econ_id = 1")
    assert one.count() == 4 and one.where("error is not null").count() == 0
    day = rows.where(F.col("folder").isin("20240101_cali_20240201") & F.col("econ_id").isin(1, 9))
    assert day.count() == 2 and rows.where("econ_id = 77").count() == 0
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "econ_id = 1" not in plan.replace("#", " ").replace("  ", " ").split("BatchScan")[0]     # answered by the source


def test_decoder_for_other_formats(spark, tmp_path):
    (tmp_path / "x_5.txt").write_bytes(b"1 2\n3 nan\n")
    rows = mx.scan_matrix(spark, str(tmp_path), decoder=lambda content, _: np.loadtxt(content.decode().split("\n")))
    assert _values(rows.where("row = 0")) == [(1.0, 2.0)] and rows.where("values[1] is null").count() == 1


def test_files_are_bounded_and_complete(spark, tmp_path):
    rows = spark.range(5000).select((F.col("id") % 3).cast("int").alias("econ_id"), F.array(F.col("id").cast("double"), F.lit(0.5)).alias("values"))
    files = mx.write_matrix_shards(rows, str(tmp_path / "out"), "pd60h_", num_partitions=3, file_bytes=4096).collect()
    assert sum(r.n_rows for r in files) == 5000 and len(files) > 15
    assert all(p.name.startswith("pd60h_") for p in (tmp_path / "out").iterdir())      # nothing staged is left
    assert max(p.stat().st_size for p in (tmp_path / "out").iterdir()) < 4096 + 8192 * 16
    assert len(_values(mx.scan_matrix(spark, str(tmp_path / "out")))) == 5000


def test_failed_write_leaves_nothing(spark, tmp_path):
    rows = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("stop")).cast("int")).otherwise(1).alias("econ_id"),
                                   F.array(F.col("id").cast("double")).alias("values"))
    with pytest.raises(Exception, match="stop"):
        mx.write_matrix_shards(rows, str(tmp_path / "out"), "x_")
    assert not (tmp_path / "out").exists() or list((tmp_path / "out").iterdir()) == []


def test_only_accepted_attempts_are_published(tmp_path):
    """Two attempts of one task: the files of the one whose message is committed appear, the other's go."""
    writer = mx.MatrixWriter({"out": str(tmp_path), "prefix": "x_", "key": "econ_id", "variables": json.dumps([])})
    kept, lost = tmp_path / writer.staging / "1", tmp_path / writer.staging / "2"
    for folder, value in ((kept, 1.0), (lost, 2.0)):
        folder.mkdir(parents=True)
        np.save(folder / "x_1.p00000-0.npy", np.full((1, 1), value))
    writer.commit([mx.Written([(f"{writer.staging}/1/x_1.p00000-0.npy", "x_1.p00000-0.npy")]), None])
    assert [p.name for p in tmp_path.iterdir()] == ["x_1.p00000-0.npy"] and np.load(tmp_path / "x_1.p00000-0.npy")[0, 0] == 1.0


def test_values_are_made_where_they_are_written(spark, tmp_path):
    rows = spark.range(500).selectExpr("cast(id % 3 AS int) AS econ_id", "cast(id AS double) AS x")
    made = F.array("x", F.col("x") * 2)
    mx.write_matrix_shards(rows, f"{tmp_path}/late", "pd_", num_partitions=4, values=made)
    mx.write_matrix_shards(rows.select("econ_id", made.alias("values")), f"{tmp_path}/early", "pd_", num_partitions=4)
    late, early = (sorted(map(tuple, mx.scan_matrix(spark, f"{tmp_path}/{n}", "pd_*").select("econ_id", "values").collect())) for n in ("late", "early"))
    assert late == early and len(late) == 500
