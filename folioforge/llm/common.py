"""What the operators of this subpackage share: scratch tables, folds, and views of texts as bytes."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch: some MB of texts, or of pairs of shingle sets, even if many are long.
MAX_RECORDS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tune(spark: SparkSession) -> None:
    """Arrow batches small enough that a batch of very long texts fits beside the JVM. Results are computed later, so the
    setting stays with the session; a smaller one is left alone."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= MAX_RECORDS:
        spark.conf.set(key, str(MAX_RECORDS))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; a local one only where none is named and Spark is local."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    folder = tempfile.mkdtemp(prefix="folioforge-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    root = "file://" + folder
    spark.sparkContext.setCheckpointDir(root)
    return root


class Scratch:
    """Tables written to the shared folder: they cut the lineage, and survive the loss of executors."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.n = spark, f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}", 0
        self.paths: dict[int, str] = {}

    def table(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:04d}"
        df.write.parquet(path)
        if self.n == 1:  # what isn't dropped before goes when the driver ends
            delete_at_exit(self.spark, self.root)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for t in tables:
            if path := self.paths.pop(id(t), None):
                delete(self.spark, path)


#: Of the C library, where it has it.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give memory that is free back to the system: workers outlive their tasks, and the driver its fits."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def fold(key: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; null ids are hashed as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def payload(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without gaps, and offsets (one more than rows). Null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if not len(column) or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8, offs[-1] - offs[0], offs[0]), offs - offs[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The batch in slices of about `limit` bytes of text (one row at least), each with its bytes and offsets."""
    at = batch.schema.names.index(column)
    data, offs = payload(batch.column(at))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(offs, offs[start] + limit, "right")) - 1)
        yield batch.slice(start, stop - start), data[offs[start] : offs[stop]], offs[start : stop + 1] - offs[start]
        start = stop


def over_texts(docs: DataFrame, id_col: str, text_col: str, make: Callable[[], Callable], schema: str, limit: int = 1 << 20) -> DataFrame:
    """Map slices of (id, text): make() runs once a task and gives f(ids, data, offs) -> list of Arrow arrays for `schema`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for part, data, offs in pieces(batch, "_text", limit):
                yield pa.RecordBatch.from_arrays(f(part.column(0), data, offs), names)
        release()

    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema)


def filtered(docs: DataFrame, text_col: str, make: Callable[[], Callable], limit: int = 1 << 18) -> DataFrame:
    """Rows of docs, columns untouched, for which f(data, offs) of their slice gives True."""
    schema = docs.schema
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            names = batch.schema.names
            batch = batch.rename_columns([f"c{i}" for i in range(len(names))])
            for part, data, offs in pieces(batch, f"c{at}", limit):
                yield part.filter(pa.array(f(data, offs))).rename_columns(names)
        release()

    return docs.mapInArrow(run, schema)


def hashed_sample(df: DataFrame, n: int, key: str) -> DataFrame:
    """At most n rows of df, those with the least hashes of `key`. Rows that can't be among them are dropped where they
    are read, so what tasks send on is bounded by n, whatever their number."""
    total = df.count()
    h = F.xxhash64(key)
    if total > 2 * n:
        df = df.where(F.pmod(h, F.lit(1 << 30)) < int((1 << 30) * (1.2 * n + 200) / total))
    return df.orderBy(F.pmod(h, F.lit(1 << 30)), *df.columns).limit(n)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))[_LOWER]
_BASE, _BASE_INVERSE = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(20, (n - 1).bit_length())
        made = []
        for base in (_BASE, _BASE_INVERSE):
            p = np.full(size, base, _U)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _powers[:] = made
    return _powers[0], _powers[1]


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of texts (A-Z lower-cased, words end at ASCII white space and at a text's end), and where they start and stop."""
    n = len(data)
    if not n:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = _SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offs] = True
    word = ~space
    start = np.flatnonzero(word & (np.concatenate(([True], space[:-1])) | first[:-1]))
    stop = np.flatnonzero(word & (np.concatenate((space[1:], [True])) | first[1:])) + 1
    up, down = _power_tables(n + 1)
    total = np.zeros(n + 1, _U)
    np.cumsum(_BYTE[data] * up[:n], out=total[1:])
    return mix64((total[stop] - total[start]) * down[start] + (stop - start).astype(_U) * _U(0x2545F4914F6CDD1D)), start, stop


#: Code points in lower case where that is one letter too; 32 for all that aren't letters.
_fold: list[np.ndarray] = []


def folded(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' code points in lower case, 32 for what isn't a letter, and offsets in code points."""
    if not _fold:
        table_ = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                table_[c] = ord(x.lower()) if len(x.lower()) == 1 else c
        _fold.append(table_)
    starts = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=starts[1:])
    raw = data.tobytes()
    points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    if len(points) != starts[-1]:  # bytes that aren't UTF-8
        each = [np.frombuffer(raw[a:b].decode("utf-8", "replace").encode("utf-32-le"), np.uint32) for a, b in zip(offs[:-1], offs[1:], strict=True)]
        points, chars = np.concatenate([*each, np.zeros(0, np.uint32)]), np.cumsum([0, *map(len, each)])
    else:
        chars = starts[offs]
    return _fold[0][points], chars


def hashed_grams(points: np.ndarray, n: int, bits: int) -> np.ndarray:
    """A bin of 2^bits for the n-gram that starts at each code point (the last n - 1 have none)."""
    run = points[: max(0, len(points) - n + 1)].astype(_U) + _U(n << 32)
    for k in range(1, n):
        run = run * _U(0x9E3779B97F4A7C15) + points[k : k + len(run)]
    return ((run ^ (run >> _U(29))) * _U(0xBF58476D1CE4E5B9) >> _U(64 - bits)).astype(np.int64)
