"""Tables with versioned partitions.

A commit writes new partitions beside the old ones and then replaces one small file, the
pointer, that says which commit holds each partition. Readers follow the pointer, so they
see the version before or after a commit, whole, whenever a writer fails. Partitions that
neither the present version nor the one before it names are collected afterwards.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.sources.shared import Files

POINTER, PART = "_pointer.json", "_part"


def part_name(value: object) -> str:
    """A partition's folder: the value's text in hexadecimal digits, so that no value is read as another type."""
    return f"{PART}=none" if value is None else f"{PART}=x{str(value).encode().hex()}"


class ConcurrentCommit(RuntimeError):
    """Another writer committed in the meantime; nothing was changed."""


class History:
    """A table below ``path``, partitioned by the text of the column ``partition``; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, partition: str):
        self.spark, self.path, self.partition, self.files = spark, path.rstrip("/"), partition, Files(spark)

    def state(self) -> dict:
        """version, parts (folder to commit, one entry for each partition), the parts before, and a note."""
        text = self.files.text(f"{self.path}/{POINTER}")
        return json.loads(text) if text else {"version": 0, "parts": {}, "before": {}, "note": []}

    def read(self, values: list | None = None) -> DataFrame | None:
        """The present version, or only its partitions of those values; None if there are none."""
        parts = self.state()["parts"]
        if values is not None:
            wanted = {part_name(v) for v in values}
            parts = {k: c for k, c in parts.items() if k in wanted}
        if not parts:
            return None
        base = f"{self.path}/data"
        found = self.spark.read.option("mergeSchema", "true").option("basePath", base).parquet(*(f"{base}/commit={c}/{k}" for k, c in sorted(parts.items())))
        return found.drop("commit", PART)

    def commit(self, rows: DataFrame, note: list | None = None) -> int:
        """Replaces the partitions that occur in ``rows``; the new version's number. A note, or the one
        before, belongs to the version."""
        before, name = self.state(), uuid.uuid4().hex
        text = F.col(self.partition).cast("string")
        part = F.when(text.isNull(), "none").otherwise(F.concat(F.lit("x"), F.lower(F.hex(text.cast("binary")))))
        folder = f"{self.path}/data/commit={name}"
        rows.withColumn(PART, part).write.partitionBy(PART).parquet(folder)
        written = {n: name for n in self.files.names(folder) if n.startswith(f"{PART}=")}
        if self.state()["version"] != before["version"]:
            raise ConcurrentCommit(self.path)
        after = {"version": before["version"] + 1, "parts": before["parts"] | written, "before": before["parts"], "note": before["note"] if note is None else note}
        self.files.put(f"{self.path}/{POINTER}", json.dumps(after, sort_keys=True))
        return after["version"]

    def collect(self) -> int:
        """Deletes partitions that no version in use names, those of failed commits too; how many."""
        state, gone = self.state(), 0
        used = {(c, k) for parts in (state["parts"], state["before"]) for k, c in parts.items()}
        for commit in self.files.names(f"{self.path}/data"):
            folder = f"{self.path}/data/{commit}"
            names = [n for n in self.files.names(folder) if n.startswith(f"{PART}=")]
            stale = [n for n in names if (commit.removeprefix("commit="), n) not in used]
            for n in stale if len(stale) < len(names) else []:
                self.files.delete(f"{folder}/{n}")
            if len(stale) == len(names):
                self.files.delete(folder)
            gone += len(stale)
        return gone
