"""Matrix shard files as a Spark data source (``format("matrix")``).

Reading.  The folder listing is planned into partitions: small files are packed
up to ``split_bytes`` and large ones cut into byte ranges, so one large matrix
is read by several tasks, each of which seeks to its own rows and holds a
block of them at a time.  Equality filters on ``folder``, ``econ_id`` and
``file_name`` are answered from the listing: files that they exclude are
never opened.

Writing.  Rows come sorted by (folder, key); a task writes each group's rows as
files of at most ``FILE_BYTES`` under a staging folder of the job.  Only Spark's
commit moves the files of the task attempts that it accepted into place, so a
failed or repeated attempt leaves nothing; an abort removes the staging folder.

The format is NumPy's ``.npy`` (split by rows) and ``.npz`` (named variables, as
in a MATLAB file, read whole).  MATLAB / HDF5 codecs are not installed here; a
``decoder(bytes, variables) -> ndarray`` can be given for such files.  A file
that cannot be decoded gives one row with ``error`` and no values, whatever
ranges it was cut into, so a bad shard is reported and never half read.  NaN
cells become NULL: NaN means "missing" and must not reach aggregates.
"""

from __future__ import annotations

import fnmatch
import io
import json
import os
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition,
                                    WriterCommitMessage)

MATRIX_SCHEMA = ("path string, folder string, file_name string, econ_id int, row bigint, values array<double>, error string")
#: Delivery folder in a path.
FOLDER_RE = r"(\d{8}_cali_\d{8})"
#: Bytes of files that one task reads, what opening a file counts for, rows of a batch, bytes of a written file.
SPLIT_BYTES, OPEN_BYTES, OUT_BATCH_ROWS, FILE_BYTES = 64 << 20, 1 << 20, 8192, 64 << 20

Decoder = Callable[[bytes, Sequence[str] | None], np.ndarray]


def decode_archive(content: bytes, variables: Sequence[str] | None = None) -> np.ndarray:
    """From an archive of named arrays the first of ``variables`` present, else
    the first array of at most two dimensions."""
    with np.load(io.BytesIO(content), allow_pickle=False) as archive:
        names = [v for v in variables if v in archive.files] if variables else [n for n in archive.files if archive[n].ndim <= 2]
        if not names:
            raise ValueError(f"none of {list(variables)} in file" if variables else "no matrix-like variable in file")
        return archive[names[0]]


def id_of(file_name: str) -> int | None:
    """The id after the last ``_`` and before the first ``.`` of a file name."""
    text = file_name.rsplit("_", 1)[-1].split(".")[0]
    return int(text) if re.fullmatch(r"[+-]?\d{1,9}", text) else None


# --------------------------------------------------------------------------
# reading
# --------------------------------------------------------------------------
@dataclass(frozen=True)
class Piece:
    """Bytes start..stop of a file of ``size`` bytes; its rows are those that begin there."""
    path: str
    size: int
    start: int
    stop: int


class Pieces(InputPartition):
    def __init__(self, pieces: list[Piece]):
        super().__init__(None)
        self.pieces = pieces


def plan_pieces(files: Sequence[tuple[str, int]], split: int = SPLIT_BYTES) -> list[list[Piece]]:
    """Files (path, size) cut at ``split`` bytes and packed, in order, up to about as many."""
    plan: list[list[Piece]] = []
    room = 0
    for path, size in files:
        for start in range(0, max(size, 1), split):
            piece = Piece(path, size, start, min(start + split, size))
            cost = piece.stop - piece.start + OPEN_BYTES
            if not plan or cost > room:
                plan.append([])
                room = split + OPEN_BYTES
            plan[-1].append(piece)
            room -= cost
    return plan


def _batch(path: str, m: np.ndarray, first: int):
    """Arrow batch from a block of rows; NaN cells become NULL through the validity mask."""
    import pyarrow as pa
    n, w = m.shape
    flat = np.ascontiguousarray(m, dtype="float64").reshape(-1)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * w, w, dtype="int32") if w else np.zeros(n + 1, "int32")),
                                     pa.array(flat, type=pa.float64(), mask=np.isnan(flat)))
    return _row_batch(path, n, pa.array(np.arange(first, first + n)), lists, pa.nulls(n, pa.string()))


def _row_batch(path: str, n: int, rows, values, errors):
    import pyarrow as pa
    name = path.rsplit("/", 1)[-1]
    folder = re.search(f"/{FOLDER_RE}/", path)
    columns = [pa.array([path] * n, pa.string()), pa.array([folder[1] if folder else ""] * n, pa.string()), pa.array([name] * n, pa.string()),
               pa.array([id_of(name)] * n, pa.int32()), rows, values, errors]
    return pa.RecordBatch.from_arrays(columns, names=["path", "folder", "file_name", "econ_id", "row", "values", "error"])


def _error(path: str, e: Exception):
    import pyarrow as pa
    return _row_batch(path, 1, pa.array([None], pa.int64()), pa.array([None], pa.list_(pa.float64())), pa.array([f"{type(e).__name__}: {e}"]))


def _header(fh, size: int) -> tuple[tuple[int, ...], bool, np.dtype, int]:
    """(shape, column by column, type, offset of the data) of an ``.npy`` file, whose size must agree."""
    major, _ = np.lib.format.read_magic(fh)
    read = np.lib.format.read_array_header_1_0 if major == 1 else np.lib.format.read_array_header_2_0
    shape, by_column, dtype = read(fh)
    if dtype.hasobject or len(shape) > 2:
        raise ValueError(f"expected a matrix, got {dtype} of shape {shape}")
    if fh.tell() + int(np.prod(shape)) * dtype.itemsize != size:
        raise ValueError(f"{size} bytes do not hold shape {shape}")
    return shape, by_column, dtype, fh.tell()


def _matrix(a: np.ndarray, transpose: bool) -> np.ndarray:
    a = np.asarray(a, dtype="float64")
    if a.ndim > 2:
        raise ValueError(f"expected a matrix, got shape {a.shape}")
    if a.ndim < 2:
        a = a.reshape(1, -1) if a.size else a.reshape(0, 0)
    return a.T if transpose else a


class MatrixReader(DataSourceReader):
    def __init__(self, options: dict, decoder: Decoder | None):
        self.roots = json.loads(options["roots"])
        self.glob, self.split = options.get("glob", "*"), int(options.get("split_bytes", SPLIT_BYTES))
        self.variables = json.loads(options.get("variables", "null"))
        self.transpose = options.get("transpose", "false") == "true"
        self.decoder = decoder
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if name not in ("folder", "econ_id", "file_name") or not isinstance(f, (EqualTo, In)):
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.wanted[name] = self.wanted.get(name, values) & values

    def _listed(self) -> Iterator[tuple[str, int]]:
        from pyarrow import fs as pafs

        from riskloom.session import _fs_path
        for root in self.roots:
            fs, base = _fs_path(root)
            shown = root.rstrip("/")
            for info in fs.get_file_info(pafs.FileSelector(base, recursive=True)):
                below = info.path[len(base.rstrip("/")) + 1:]
                if info.type != pafs.FileType.File or any(part[:1] in "_." for part in below.split("/")):
                    continue
                name = info.base_name
                folder = re.search(f"/{FOLDER_RE}/", f"{shown}/{below}")
                found = {"folder": folder[1] if folder else "", "econ_id": id_of(name), "file_name": name}
                if fnmatch.fnmatchcase(name, self.glob) and all(found[k] in v for k, v in self.wanted.items()):
                    yield f"{shown}/{below}", info.size

    def partitions(self) -> list[Pieces]:
        plan = [Pieces(p) for p in plan_pieces(sorted(self._listed()), self.split)]
        return plan or [Pieces([])]

    def read(self, partition: Pieces):
        for piece in partition.pieces:
            try:
                yield from self._read(piece)
            except Exception as e:  # noqa: BLE001 - a bad file is reported, once
                if piece.start == 0:
                    yield _error(piece.path, e)

    def _read(self, piece: Piece):
        from riskloom.session import _fs_path
        fs, path = _fs_path(piece.path)
        with fs.open_input_file(path) as fh:
            if self.decoder is None and fh.read(6) == b"\x93NUMPY":
                fh.seek(0)
                shape, by_column, dtype, offset = _header(fh, piece.size)
                if len(shape) == 2 and shape[1] and not by_column and not self.transpose:
                    width = shape[1] * dtype.itemsize
                    first, last = (max(0, -(-(at - offset) // width)) if at < piece.size else shape[0] for at in (piece.start, piece.stop))
                    fh.seek(offset + first * width)
                    for row in range(first, last, OUT_BATCH_ROWS):
                        n = min(OUT_BATCH_ROWS, last - row)
                        yield _batch(piece.path, np.frombuffer(fh.read(n * width), dtype).reshape(n, -1), row)
                    return
                fh.seek(0)
                decode = lambda content, _: np.load(io.BytesIO(content), allow_pickle=False)
            else:
                fh.seek(0)
                decode = self.decoder or decode_archive
            if piece.start:                              # what cannot be cut is read whole by its first piece
                return
            m = _matrix(decode(fh.read(), self.variables), self.transpose)
        for row in range(0, m.shape[0], OUT_BATCH_ROWS):
            yield _batch(piece.path, m[row:row + OUT_BATCH_ROWS], row)


# --------------------------------------------------------------------------
# writing
# --------------------------------------------------------------------------
@dataclass
class Written(WriterCommitMessage):
    """Files of an accepted task attempt: (staged, final), relative to the output folder."""
    files: list[tuple[str, str]]


class MatrixWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.out, self.prefix, self.key = options["out"], options["prefix"], options["key"]
        self.folder, self.variables = options.get("folder"), json.loads(options.get("variables", "[]"))
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))
        self.staging = f"_staging-{uuid.uuid4().hex[:12]}"

    def _bytes(self, m: np.ndarray) -> bytes:
        buf = io.BytesIO()
        if self.variables:                               # the rows under the first name, their numbers under the others
            np.savez(buf, **{v: m if v == self.variables[0] else np.arange(len(m), dtype="float64") for v in self.variables})
        else:
            np.save(buf, m, allow_pickle=False)
        return buf.getvalue()

    def write(self, iterator):
        from pyspark import TaskContext

        from riskloom.session import _fs_path
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        fs, base = _fs_path(self.out)
        done: list[tuple[str, str]] = []
        group, blocks, held, number = None, [], 0, 0

        def flush():
            nonlocal blocks, held, number
            if blocks:
                sub = f"{group[0]}/" if self.folder else ""
                name = f"{self.prefix}{int(group[-1])}.p{part:05d}-{number}.{'npz' if self.variables else 'npy'}"
                staged = f"{self.staging}/{attempt}/{sub}{name}"
                fs.create_dir(f"{base}/{os.path.dirname(staged)}", recursive=True)
                with fs.open_output_stream(f"{base}/{staged}") as fh:
                    fh.write(self._bytes(np.vstack(blocks)))
                done.append((staged, sub + name))
                blocks, held, number = [], 0, number + 1

        for rb in iterator:
            if not rb.num_rows:
                continue
            keys = [rb.column(c) for c in ([self.folder] if self.folder else []) + [self.key]]
            lists = rb.column("values")
            m = lists.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(rb.num_rows, -1)
            codes = np.stack([k.dictionary_encode().indices.fill_null(-1).to_numpy() for k in keys])
            ends = [*(np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(0)) + 1).tolist(), rb.num_rows]
            at = 0
            for row in ends:                             # runs of rows of one group
                now = tuple(k[at].as_py() for k in keys)
                if now != group:
                    flush()
                    group, number = now, 0
                step = max(1, self.file_bytes // max(1, m[0].nbytes))
                for lo in range(at, row, step):
                    blocks.append(m[lo:min(lo + step, row)])
                    held += blocks[-1].nbytes
                    if held >= self.file_bytes:
                        flush()
                at = row
        flush()
        return Written(done)

    def commit(self, messages):
        from riskloom.session import _fs_path
        fs, base = _fs_path(self.out)
        for staged, final in (f for m in messages if m is not None for f in m.files):
            fs.create_dir(f"{base}/{os.path.dirname(final)}".rstrip("/"), recursive=True)
            fs.move(f"{base}/{staged}", f"{base}/{final}")
        self._clear()

    def abort(self, messages):
        self._clear()

    def _clear(self):
        from pyarrow import fs as pafs

        from riskloom.session import _fs_path
        fs, base = _fs_path(self.out)
        staging = f"{base}/{self.staging}"
        if fs.get_file_info(staging).type == pafs.FileType.Directory:
            fs.delete_dir(staging)


class MatrixSource(DataSource):
    """``roots`` (JSON list), ``glob``, ``variables``, ``transpose``, ``split_bytes`` to read; ``out``, ``prefix``, ``key``,
    ``folder``, ``variables``, ``file_bytes`` to write rows (key, values[, folder])."""

    decoder: Decoder | None = None

    @classmethod
    def name(cls) -> str:
        return "matrix"

    def schema(self) -> str:
        return MATRIX_SCHEMA

    def reader(self, schema: T.StructType) -> MatrixReader:
        return MatrixReader(dict(self.options), type(self).decoder)

    def writer(self, schema: T.StructType, overwrite: bool) -> MatrixWriter:
        return MatrixWriter(dict(self.options))


_registered: set[tuple[str, str]] = set()


def register_source(spark: SparkSession, decoder: Decoder | None = None) -> str:
    """Make the source known to the session (once) and return its format name."""
    from riskloom.session import ship_package
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    name = "matrix" if decoder is None else f"matrix_{getattr(decoder, '__name__', 'x')}_{id(decoder):x}"
    mark = (str(spark._jsparkSession.sessionUUID()), name)
    if mark not in _registered:
        spark.dataSource.register(MatrixSource if decoder is None else type("MatrixSource", (MatrixSource,), {
            "decoder": staticmethod(decoder), "name": classmethod(lambda cls: name)}))
        _registered.add(mark)
    return name


def scan_matrix(spark: SparkSession, root: str | Sequence[str], glob: str = "*", decoder: Decoder | None = None,
                variables: Sequence[str] | None = None, transpose: bool = False, keep_errors: bool = False,
                split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Rows of every matrix file under ``root`` matching ``glob``: (path, folder,
    file_name, econ_id, row, values[, error]); filters on folder, econ_id and file_name choose the files."""
    roots = list(root) if isinstance(root, (list, tuple)) else [root]
    reader = spark.read.format(register_source(spark, decoder)).option("roots", json.dumps(roots)).option("glob", glob)
    rows = (reader.option("variables", json.dumps(list(variables) if variables else None)).option("transpose", str(transpose).lower())
            .option("split_bytes", split_bytes).load())
    return rows if keep_errors else rows.where(F.col("error").isNull()).drop("error")


def write_matrix_shards(rows: DataFrame, out_dir: str, prefix: str, key: str = "econ_id", num_partitions: int | None = None,
                        folder: str | None = None, variables: Sequence[str] = (), file_bytes: int = FILE_BYTES,
                        values: Column | None = None) -> DataFrame:
    """Land (key, values) rows as ``[<folder>/]{prefix}{key}.p{task}-{n}.npy``
    files of at most about ``file_bytes``; returns (path, key, n_rows) of the files, read back.
    ``values`` makes a row's array from its other columns once the rows are where they are
    written, so that arrays that follow from a few columns are neither shuffled nor sorted."""
    spark = rows.sparkSession
    name = register_source(spark)
    groups = ([folder] if folder else []) + [key]
    # range-partition on (group, row hash): each task holds a contiguous run
    # of groups, so a group lands in one or a few files, and a hot economy is
    # split across tasks by the hash instead of landing in one.
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = ["values"] if values is None else [c for c in rows.columns if c not in groups]
    src = rows.select(*groups, *own).repartitionByRange(n, *groups, F.xxhash64(*own)).sortWithinPartitions(*groups)
    src = src.select(*groups, (F.col("values") if values is None else values).alias("values"))
    writer = src.write.format(name).mode("append").option("out", out_dir).option("prefix", prefix).option("key", key)
    if folder:
        writer = writer.option("folder", folder)
    writer.option("variables", json.dumps(list(variables))).option("file_bytes", file_bytes).save()
    back = scan_matrix(spark, out_dir, f"{prefix}*")
    return back.groupBy("path", F.col("econ_id").cast("bigint").alias(key)).agg(F.count(F.lit(1)).alias("n_rows"))
