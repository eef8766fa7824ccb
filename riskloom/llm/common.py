"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskloom.session import scratch_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back:
    later steps reuse it, and a lost executor does not lose it."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a small table that one task takes at least.
TASK_ROWS = 8192


def narrowed(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of ``rows`` rows or not many more, in no more tasks than these need; a large
    table keeps its own.  Rows stay with the rows of their shuffle partition."""
    return df.coalesce(df.sparkSession.sparkContext.defaultParallelism + rows // TASK_ROWS)


#: Bytes of an Arrow batch at most: texts can be long, and a batch is held several times on its way.
BATCH_BYTES = 4 << 20


def on_workers(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, and keep the
    session's Arrow batches to BATCH_BYTES."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def crc_mod(id_col: str, m: int) -> Column:
    """crc32 of the id's decimal text, modulo ``m`` (a null id counts as '')."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(m))


#: What operators keep in a Python worker from task to task, by their names.
KEPT: dict[str, dict] = {}


def release_memory(keep: str | None = None) -> None:
    """Drop what operators other than ``keep`` have kept in a reused Python worker, and give back what is free."""
    import ctypes
    import gc

    import pyarrow as pa
    for name, kept in KEPT.items():
        if name != keep:
            kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):                    # another C library: nothing to trim
        pass


#: Rows handed to a worker function at once.
ROWS = 512


def with_computed(df: DataFrame, fields: list[tuple[str, str]], compute, keep: str | None = None) -> DataFrame:
    """``df`` with columns computed in the workers, replacing columns of the
    same names.  ``compute()`` is called once per task and returns a
    function from an Arrow record batch of ``df`` to the list of new arrays;
    what it keeps as KEPT[keep] stays in the worker for its next task."""
    on_workers(df.sparkSession)
    new = [name for name, _ in fields]
    keep = [c for c in df.columns if c not in new]
    schema = T.StructType([df.schema[c] for c in keep])
    for name, kind in fields:
        schema = schema.add(name, kind)
    at = [df.columns.index(c) for c in keep]

    def run(batches):
        import pyarrow as pa
        release_memory(keep)
        step = compute()
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                yield pa.RecordBatch.from_arrays([part.column(i) for i in at] + step(part), names=keep + new)

    return df.mapInArrow(run, schema)
