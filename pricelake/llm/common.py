"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local: dict[str, str] = {}
#: Whole texts go to Python in batches small enough for several copies of one.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
#: While a table is written: shuffles behind it are freed afterwards.
STAGING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", **BATCHES}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Where it is unset, a folder of this
    run alone is made, which only a session whose executors share the driver's disk can use."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or _local.get(spark.sparkContext.applicationId)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = _local[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="pricelake-")
    return shared


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """STAGING's settings, for as long as a job of an operator's own runs."""
    before = {name: spark.conf.get(name) for name in STAGING}
    for name, value in STAGING.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def keep_batches_small(spark: SparkSession) -> None:
    """BATCHES from now on, for rows that a caller of the session writes later: their batches are cut as
    the session says then, and Spark's own 10,000 rows of whole texts are held several times in a task."""
    for name, value in BATCHES.items():
        spark.conf.set(name, value)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts lineage: a lost executor re-reads the table instead of recomputing it, and
    values that depend on row placement are computed exactly once.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/pricelake/{label}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete staged tables from which nothing will be read any more."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.staged_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of docs is called so."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_side(rows: DataFrame, limit: int = 1_000_000) -> DataFrame:
    """``rows``, of a few numbers each, marked for broadcast if they are counted to be at most ``limit``."""
    return F.broadcast(rows) if rows.count() <= limit else rows


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Memo(dict):
    """A dict that computes missing values and empties itself beyond ``limit`` keys."""

    def __init__(self, make, limit: int = 400_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def release() -> None:
    """Freed memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def releasing(function):
    """``function`` of batches, after which the memory that it freed goes back to the system: a worker
    lives on for other tasks, and what it holds counts for its executor."""

    @wraps(function)
    def run(batches):
        try:
            yield from function(batches)
        finally:
            release()

    return run


def text_of(value: str | None) -> str:
    """A null text counts as the empty text."""
    return value or ""


def ascii_words(text: str | None) -> list[bytes]:
    """Maximal runs outside space and U+0009..U+000D, as UTF-8 (bytes.split's own set)."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def utf8(column: pa.Array) -> list[bytes]:
    """Each text's bytes; a null text is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that sums of products become well spread keys."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


#: An odd multiplier: invertible modulo 2**64.
_BASE = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64)
_inverse_powers = np.ones(1, np.uint64)


def _grown(powers: np.ndarray, base: int, n: int) -> np.ndarray:
    while len(powers) < n:
        last = np.uint64(int(powers[-1]) * base % (1 << 64))
        powers = np.concatenate([powers, powers * last])
    return powers


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


#: Bytes of a text, or words, that are hashed at once, so that memory doesn't follow the longest text.
AT_ONCE = 1 << 17
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def pieces(data: bytes) -> Iterator[bytes]:
    """``data``, cut before white space into pieces of little more than AT_ONCE bytes; no word is cut."""
    start = 0
    while len(data) - start > AT_ONCE and (blank := _BLANK.search(data, start + AT_ONCE)):
        yield data[start : blank.start()]
        start = blank.start()
    yield data[start:] if start else data


def _prefix_sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of value * base**place before each place, modulo 2**64, and the inverse powers. The tables
    of powers grow, but beyond a few pieces they aren't kept."""
    global _powers, _inverse_powers
    n = len(values)
    powers, inverse = _grown(_powers, _BASE, n), _grown(_inverse_powers, _BASE_INVERSE, n)
    if len(powers) <= 4 * AT_ONCE:
        _powers, _inverse_powers = powers, inverse
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers[:n], out=sums[1:])
    return sums, inverse


def word_bounds(signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of ascii_words' words in the bytes of a text."""
    if not len(signs):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    space = _SPACE[signs]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    bounds = np.concatenate([[] if space[0] else [0], edges, [] if space[-1] else [len(signs)]]).astype(np.int64)
    return bounds[0::2], bounds[1::2]


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash for each of ascii_words' words, without cutting the text into words."""
    found = []
    for piece in pieces(data):
        signs = np.frombuffer(piece, np.uint8)
        starts, ends = word_bounds(signs)
        sums, inverse = _prefix_sums(signs + np.uint64(1))
        found.append(mix64((sums[ends] - sums[starts]) * inverse[starts]))
    return np.concatenate(found) if len(found) > 1 else found[0]


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive word hashes."""
    found = [np.empty(0, np.uint64)]
    step = max(AT_ONCE, width)
    for start in range(0, len(hashes) - width + 1, step):
        sums, inverse = _prefix_sums(hashes[start : start + step + width - 1])
        ends = sums[width:]
        found.append(mix64((ends - sums[: len(ends)]) * inverse[: len(ends)]))
    return np.concatenate(found) if len(found) != 2 else found[1]


def distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values, ascending."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
