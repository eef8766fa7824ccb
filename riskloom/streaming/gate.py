"""C9 + K1: a delivery day enters the panel when its last economy has landed.

The stream reads file *arrivals* (one row a file: path and time, never the
content).  A watermark bounds how late an arrival may be; a file that is sent
again within it is dropped by ``dropDuplicatesWithinWatermark``.  The keyed
state of a delivery folder is the set of its economies that have landed, at
most as many as are expected, and whether it was released.

* A folder is released once, when no expected economy is missing.  Files that
  come after that change nothing: the state says so while it is kept, and the
  release log after it.
* A folder that is still incomplete ``patience`` after its last arrival is
  reported with the economies it lacks, and released when they come.
* The sink loads the rows of the released folders only (partition pruning on
  the folder) by insert-ignore on the version key and logs the release last: a
  micro-batch that is replayed, or a restart from the checkpoint, repeats
  nothing and leaves nothing out.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from riskloom.operators import mutate as mu
from riskloom.schemas import PD_KEYS
from riskloom.session import ship_package
from riskloom.sources import sinks as sk
from riskloom.sources.readers import table_exists
from riskloom.streaming.ingest import upsert_versions

ARRIVAL_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
GATE_SCHEMA = "folder string, status string, n_economies int, missing array<int>, at timestamp"
STATE_SCHEMA = "economies array<int>, released boolean, last long"
RELEASED, INCOMPLETE = "released", "incomplete"


def arrivals(spark: SparkSession, landing: str, delay: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of (folder, econ_id, arrived) from a landing laid out as
    ``folder=<name>/econ_id=<id>/<file>``; each economy of a folder once within the watermark."""
    reader = spark.readStream.format("binaryFile").schema(ARRIVAL_SCHEMA).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.load(landing)
    seen = files.select(F.regexp_extract("path", r"/folder=([^/]+)/", 1).alias("folder"),
                        F.regexp_extract("path", r"/econ_id=(\d+)/", 1).try_cast("int").alias("econ_id"),
                        F.col("modificationTime").alias("arrived"))
    seen = seen.where((F.col("folder") != "") & F.col("econ_id").isNotNull())
    return seen.withWatermark("arrived", delay).dropDuplicatesWithinWatermark(["folder", "econ_id"])


def _gate(expected: frozenset[int], patience: dt.timedelta, keep: dt.timedelta):
    """State function of one folder."""
    wait, hold = (int(x.total_seconds() * 1000) for x in (patience, keep))

    def run(key: tuple, batches: Iterator, state: GroupState) -> Iterator:
        import pandas as pd
        economies, released, last = state.get if state.exists else ([], False, 0)
        landed = set(economies)

        def row(status: str):
            return pd.DataFrame({"folder": [key[0]], "status": [status], "n_economies": [len(landed)], "missing": [sorted(expected - landed)],
                                 "at": [pd.Timestamp(last, unit="ms", tz="UTC")]})

        if state.hasTimedOut:
            if released:
                state.remove()
            else:                                        # no further report until the next arrival
                state.update((sorted(landed), released, last))
                yield row(INCOMPLETE)
            return
        for batch in batches:
            landed |= expected & set(batch["econ_id"].tolist())
            last = max(last, int(batch["arrived"].max().timestamp() * 1000))
        done = not released and landed >= expected
        state.update((sorted(landed), released or done, last))
        state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + (hold if released or done else wait))
        if done:
            yield row(RELEASED)

    return run


def gate(seen: DataFrame, expected: Sequence[int], patience: dt.timedelta = dt.timedelta(days=2),
         keep: dt.timedelta = dt.timedelta(days=30)) -> DataFrame:
    """Stream of folders that are released, or incomplete after ``patience``."""
    ship_package(seen.sparkSession)
    return seen.groupBy("folder").applyInPandasWithState(
        _gate(frozenset(int(e) for e in expected), patience, keep), GATE_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)


def load_released(landing: str, schema: T.StructType, table: str, release_log: str, keys: Sequence[str] = tuple(PD_KEYS)):
    """foreachBatch function: the rows of the released folders into the versioned table, then the log."""
    load = upsert_versions(table, keys, written=True)

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        found = batch.checkpoint(eager=True)             # the state step runs once a micro-batch
        if table_exists(spark, release_log):
            found = found.join(spark.read.parquet(release_log).where(F.col("status") == RELEASED).select("folder"), "folder", "left_anti")
        folders = [r.folder for r in found.where(F.col("status") == RELEASED).select("folder").distinct().collect()]   # days completed now
        if folders:
            rows = spark.read.schema(T.StructType(list(schema.fields)).add("folder", "string").add("econ_id", "integer")).parquet(landing)
            load(rows.where(F.col("folder").isin(folders)).select(*schema.names), epoch_id)
        sk.append(found, release_log)

    return run


def ingest_complete(spark: SparkSession, landing: str, schema: T.StructType, table: str, release_log: str, checkpoint: str,
                    expected: Sequence[int], delay: str = "2 days", patience: dt.timedelta = dt.timedelta(days=2),
                    max_files_per_trigger: int | None = None) -> None:
    """Process the files landed so far (``availableNow``): days that are complete enter ``table``."""
    mu.checkpoint_root(spark)
    if not table_exists(spark, table):                   # a table without a complete day is empty, not absent
        spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("data_month", T.StringType())])).write.mode("append").parquet(table)
    decisions = gate(arrivals(spark, landing, delay, max_files_per_trigger), expected, patience)
    q = (decisions.writeStream.foreachBatch(load_released(landing, schema, table, release_log))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def released_days(spark: SparkSession, release_log: str) -> DataFrame:
    """(folder, n_economies) of the folders released so far."""
    return spark.read.parquet(release_log).where(F.col("status") == RELEASED).select("folder", "n_economies")
