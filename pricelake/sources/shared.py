"""Folders that all executors share, tables staged there, and small files put in one step."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below ``spark.checkpoint.dir``. Where that is unset, only a session whose
    executors are on the driver's machine gets one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or _local.get(spark.sparkContext.applicationId)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = _local[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="pricelake-")
    return f"{root}/pricelake/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table and read again: computed once, whatever is lost later."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(rows: DataFrame, limit: int = 200_000) -> DataFrame:
    """``rows``, marked for broadcast if they are counted to be at most ``limit``."""
    return F.broadcast(rows) if rows.count() <= limit else rows


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for as long as the block runs."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


class Files:
    """The few operations on files that readers and writers of tables don't offer."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self.jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.conf), where

    def names(self, path: str) -> list[str]:
        """Names in a folder; none where it doesn't exist."""
        fs, where = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []

    def delete(self, path: str) -> None:
        fs, where = self._at(path)
        fs.delete(where, True)

    def text(self, path: str) -> str | None:
        fs, where = self._at(path)
        if not fs.exists(where):
            return None
        stream = fs.open(where)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, path: str, text: str) -> None:
        """The file appears, or replaces the one before, with its whole content or not at all."""
        fs, where = self._at(path)
        beside = self.jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
        stream = fs.create(beside, True)
        stream.write(text.encode())
        stream.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.jvm.java.lang.reflect.Array.newInstance(rename.OVERWRITE.getClass(), 1)
        options[0] = rename.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.conf).rename(beside, where, options)
