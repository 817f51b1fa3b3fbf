"""What the corpus operators share: tables, the shared workspace, Arrow helpers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text handed to numpy or a tokenizer at once, in bytes; only a longer single document exceeds it.
SLICE_BYTES = 1 << 20
#: Rows go to Python workers in batches of at most 1 MB (only a longer single document exceeds it), and texts are read 512 rows at a
#: time: setting, its default, and the value that takes the default's place.
_BOUNDS = [("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", f"{1 << 20}b"), ("spark.sql.parquet.columnarReaderBatchSize", "4096", "512")]
#: Tables of at most so many rows are broadcast, once counted.
MOST_BROADCAST = 1 << 20
#: A key is hot if it holds more than LEAST_HOT rows and more than 1 of HOT_KEYS of all rows: there are fewer than HOT_KEYS such keys.
LEAST_HOT, HOT_KEYS = 1000, 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workspace(spark: SparkSession) -> str:
    """A new folder below the cluster's shared spark.checkpoint.dir, removed when the driver's JVM ends.

    A local session without that setting (tests) gets a temporary folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="atlasloom-")
        spark.conf.set("spark.checkpoint.dir", shared)
    path = f"{shared.rstrip('/')}/atlasloom-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def bounded(df: DataFrame) -> DataFrame:
    """df itself; its session from now on reads texts and hands rows to Python workers in small batches, unless it names sizes of its own."""
    conf = df.sparkSession.conf
    for name, default, small in _BOUNDS:
        if conf.get(name, default) == default:
            conf.set(name, small)
    return df


_held: dict[str, Callable[[], None]] = {}


def claim(owner: str, release: Callable[[], None] | None = None) -> None:
    """In a worker, which later stages use again: frees what other operators have cached there; `release` frees the owner's own cache."""
    others = [name for name in _held if name != owner]
    for name in others:
        _held.pop(name)()
    if release is not None:
        _held[owner] = release
    if others:
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Writes df as Parquet and reads it back: lineage ends there, and lost executors take nothing with them. Small row groups bound what a task holds."""
    df.write.option("compression", "lz4_raw").option("parquet.block.size", 16 << 20).option("parquet.page.size", 256 << 10).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or a longer one that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def beside(rows: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """rows joined with a written table of one row a key: broadcast if it is counted to be small, else by a shuffle."""
    return rows.join(F.broadcast(small) if small.count() <= MOST_BROADCAST else small, key)


def attach(rows: DataFrame, keyed: DataFrame, key: str, count: str, total: int, how: str = "inner") -> DataFrame:
    """rows joined with `keyed`, which has one row a key with the number `count` of rows that hold it, among `total` rows.

    Hot keys are fewer than HOT_KEYS, whatever the data: they are broadcast, and their rows stay where they are. In the
    shuffle of the other rows no key has more than LEAST_HOT rows or 1 of HOT_KEYS of all. how: inner, or left_semi.
    """
    most = max(LEAST_HOT, total // HOT_KEYS)
    hot = keyed.where(F.col(count) > most).drop(count)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(keyed.where(F.col(count) <= most).drop(count), key, how)
    return rows.join(F.broadcast(hot), key, how).unionByName(rest)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a table of the workspace that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has no bytes."""
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32, n + 1, column.offset * 4).astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold at most `most` bytes, or one longer text."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1)
        yield low, min(high, n)
        low = high


def within(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Sum of values[low:high] for each pair of bounds."""
    flags = values.dtype == bool and len(values) < 1 << 31
    total = np.zeros(len(values) + 1, np.int32 if flags else np.int64)
    np.cumsum(values, out=total[1:], dtype=total.dtype)
    return (total[high] - total[low]).astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of x changes about half of the result's bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def cast_id(df: DataFrame, name: str):
    """The id column as a long under its own name."""
    return F.col(f"`{name}`").cast("long").alias(name)
