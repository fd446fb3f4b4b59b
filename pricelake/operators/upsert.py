"""History tables: upsert by key, the newest row wins, partition by partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators.dedupe import dedupe
from pricelake.sources.history import History


def merged(history: DataFrame, batch: DataFrame, keys: list[str], precombine: str, partition: str) -> DataFrame:
    """The touched partitions after the upsert; a new row wins a tie. Added columns are kept."""
    touched = batch.select(partition).distinct()
    old = history.join(touched, partition, "left_semi").withColumn("_new", F.lit(0))
    rows = old.unionByName(batch.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    rest = [F.col(c).cast("string") for c in sorted(batch.columns) if c not in (*keys, precombine, partition)]
    return dedupe(rows, [*keys, partition], [F.col(precombine), F.col("_new"), *rest], keep="last").drop("_new")


def upsert(path: str, batch: DataFrame, keys: list[str], precombine: str, partition: str) -> int:
    """One commit to the history at ``path``: only the touched partitions are read and written, once.
    Reruns change nothing but the version, which is returned."""
    table = History(batch.sparkSession, path, partition)
    history = table.read([r[0] for r in batch.select(F.col(partition).cast("string")).distinct().collect()])
    if history is None:
        order = [F.col(precombine), *[F.col(c).cast("string") for c in sorted(batch.columns) if c not in (*keys, precombine)]]
        return table.commit(dedupe(batch, [*keys, partition], order, keep="last"))
    return table.commit(merged(history, batch, keys, precombine, partition))


def snapshot_of(spark: SparkSession, path: str, partition: str, value: str) -> DataFrame | None:
    """One business date of the history at ``path``: only its folder is read. None if there is none."""
    return History(spark, path, partition).read([value])


def write_rows(rows: DataFrame, path: str, kind: str, keys: list[str], precombine: str, partition: str) -> None:
    """``kind``: "parquet" replaces the touched partitions of a plain table, "history" upserts into a versioned one."""
    if kind == "parquet":
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    elif kind == "history":
        upsert(path, rows, keys, precombine, partition)
    else:
        raise ValueError(f"unknown kind of output: {kind}")
