"""Session construction and shared scratch space.

Scratch space always lives under the session's ``spark.checkpoint.dir``
(a shared folder on a cluster).  Only when that setting is absent, as in
local tests, a folder under the system temp dir is configured once.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # 65-column panels exceed the default of 100 fields only in wide joins;
    # keep whole-stage codegen for them.
    "spark.sql.codegen.maxFields": "400",
    # 60-horizon rows with per-column NULL/NaN predicates make constraint
    # propagation grow combinatorially in the optimizer; filters are explicit.
    "spark.sql.constraintPropagation.enabled": "false",
    # A whole-stage method above 8000 bytes of bytecode is never JIT-compiled
    # by HotSpot; for wide (65-column) stages let Spark split instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # reliable checkpoints are removed by Spark once their DataFrame is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "riskloom") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Pin the settings results depend on (time zone) on an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
    spark.conf.set("spark.sql.codegen.maxFields", "400")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session; set one only if unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        root = tempfile.mkdtemp(prefix="riskloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/riskloom/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for code that must touch the local filesystem."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return path


def is_local_fs(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``riskloom`` importable in Python workers (``mapInPandas``
    functions are pickled by reference): zip the package once per
    SparkContext into the shared checkpoint folder and ``addPyFile`` it."""
    import io
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    target = scratch_path(spark, "pyfiles") + "/riskloom.zip"
    fs, p = _fs_path(target)
    fs.create_dir(os.path.dirname(p), recursive=True)
    with fs.open_output_stream(p) as fh:
        fh.write(buf.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


FIXTURE_VERSION = "2"


def _fs_path(path: str):
    """pyarrow filesystem and path for a local, HDFS or object-store location."""
    from pyarrow import fs as pafs
    if "://" in path and not path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), os.path.abspath(local_path(path))


def landed_fixture(spark: SparkSession, name: str, sf_dir: str, build) -> str:
    """Folder of an immutable test input derived from the tables in
    ``sf_dir``, landed once under the shared checkpoint root by
    ``build(path)`` and reused while the source tables are unchanged
    (the key covers their paths, sizes and modification times)."""
    import hashlib
    from pyarrow import fs as pafs

    src = local_path(sf_dir)
    stats = []
    if os.path.isdir(src):
        for f in sorted(os.listdir(src)):
            st = os.stat(os.path.join(src, f))
            stats.append(f"{f}:{st.st_size}:{int(st.st_mtime)}")
    key = hashlib.sha1("|".join([name, os.path.abspath(src), FIXTURE_VERSION, *stats]).encode()).hexdigest()[:16]
    path = f"{checkpoint_root(spark)}/riskloom/fixtures/{name}-{key}"
    fs, p = _fs_path(path)
    if fs.get_file_info(p + "/_LANDED").type == pafs.FileType.File:
        return path
    tmp = f"{path}.tmp-{uuid.uuid4().hex[:8]}"
    build(tmp)                                   # a failed build leaves only the temp folder
    _, tp = _fs_path(tmp)
    with fs.open_output_stream(tp + "/_LANDED") as fh:
        fh.write(b"")
    try:
        fs.move(tp, p)                           # publish; a concurrent winner is fine
    except OSError:
        if fs.get_file_info(p + "/_LANDED").type != pafs.FileType.File:
            raise
    return path
